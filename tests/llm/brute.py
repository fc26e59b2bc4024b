"""Plain single-machine versions of the operators, for small tables only."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from functools import cache

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    votes = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        votes.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))


def simhash(rows: list[tuple[int, str | None]]) -> list[tuple]:
    prints = [(i, fingerprint(t)) for i, t in rows]
    different = sorted({f for _, f in prints})
    sets = Sets()
    for i, a in enumerate(different):
        for b in different[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                sets.join(a, b)
    least: dict[int, int] = {}
    for i, f in prints:
        root = sets.find(f)
        if i is not None:
            least[root] = min(i, least.get(root, i))
    return [(i, f"{f:016x}", least.get(sets.find(f))) for i, f in prints]


def quality(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


def line_rules(rows: list[tuple[int, str | None, str | None]], min_docs: int, max_share: float, min_left: float, max_docs: int = 200, by: str = "documents") -> list[tuple]:
    """(doc_id, text, host) to (doc_id, quality..., kept, words_left)."""
    def normal(line):
        return " ".join(WORD.findall(line.translate(UPPER)))

    held, all_of = defaultdict(set), defaultdict(set)
    for i, text, host in rows:
        one = i if by == "documents" else text or ""
        all_of[host].add(one)
        for line in (text or "").split("\n"):
            if normal(line):
                held[host, normal(line)].add(one)
    out = []
    for i, text, host in rows:
        q = quality(text)
        lost = 0
        for line in (text or "").split("\n"):
            n = len(held.get((host, normal(line)), ()))
            if n > max_docs or n > min_docs and n > max_share * len(all_of[host]):
                lost += len(WORD.findall(line))
        left = q[0] - lost
        out.append((i, *q, not q[5] and left >= 50 and left >= min_left * q[0], left))
    return out


def mix_targets(sizes: dict, weights=(1, 2, 3), cap=3) -> dict:
    """Targets by the rule as it is stated: share by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target: dict = {}
    free, rest = set(sizes), float(sum(sizes.values()))
    while free:
        unit = rest / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = float(cap * sizes[s])
            rest -= target[s]
        free -= over
    return target


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def bpe(path: str, text: str | None) -> tuple:
    t = _tokenizer(path)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def normal_line(line: str) -> str:
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower()).strip(" ")


def shingles(line: str) -> set:
    return {line[i:i + 5] for i in range(len(line) - 4)} or {line}


def fuzzy_lines(rows: list[tuple[int, str | None]], similar: float = 0.8) -> dict[int, list[int]]:
    """Removed line numbers by document, from all pairs of different lines."""
    places = defaultdict(list)
    for i, text in rows:
        for pos, line in enumerate((text or "").split("\n") if text else []):
            if normal_line(line):
                places[normal_line(line)].append((i, pos))
    lines = sorted(places, key=len)
    sets = [shingles(x) for x in lines]
    by = Sets()
    for a in range(len(lines)):
        for b in range(a + 1, len(lines)):
            if len(sets[a]) < similar * len(sets[b]):
                if len(lines[a]) < similar * len(lines[b]) * 0.5:
                    break
                continue
            both = len(sets[a] & sets[b])
            if both >= similar * (len(sets[a]) + len(sets[b]) - both):
                by.join(lines[a], lines[b])
    classes = defaultdict(list)
    for line, at in places.items():
        classes[by.find(line)] += at
    gone = defaultdict(list)
    for at in classes.values():
        for i, pos in sorted(at)[1:]:
            gone[i].append(pos)
    return {i: sorted(gone.get(i, [])) for i, _ in rows}


def order_minhash(text: str, factors: list[int], k: int, chosen: int) -> list[int]:
    """16-bit tuple hashes: per order the numbered k-mers that come first, hashed in text order."""
    wide, base, step = 2**64, 0x9E3779B97F4A7C15, 0xD1342543DE82EF95

    def mixed(x: int) -> int:
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % wide
        x = (x ^ x >> 27) * 0x94D049BB133111EB % wide
        return x ^ x >> 31

    parts = [text[i:i + k] for i in range(len(text) - k + 1)] or ([text] if text else [])
    if not parts:
        return [0] * len(factors)
    hashed, numbered, seen = {}, [], {}
    for p in parts:
        if p not in hashed:
            h = 0
            for c in p:
                h = (h * base + ord(c) + 1) % wide
            hashed[p] = mixed(h)
        numbered.append(mixed((hashed[p] + seen.get(p, 0) * step) % wide) >> 32)
        seen[p] = seen.get(p, 0) + 1
    out = []
    for f in factors:
        first = sorted(range(len(parts)), key=lambda i: (numbered[i] * f % 2**32, i))[:chosen]
        h = 0
        for i in sorted(first):
            h = mixed((h * base + hashed[parts[i]]) % wide)
        out.append(h >> 48)
    return out


def ranked(rows: list, items: list, term: str, count: int = 10) -> list[tuple]:
    """item, rank, doc, score by adding up every document's score."""
    import math
    import re

    split = lambda t: re.findall(term, (t or "").translate({c: c + 32 for c in range(65, 91)}))
    docs = [(i, split(t)) for i, t in rows]
    docs = [(i, ts) for i, ts in docs if ts]
    n_docs, all_terms = len(docs), sum(len(ts) for _, ts in docs)
    held: dict = {}
    for _, ts in docs:
        for t in set(ts):
            held[t] = held.get(t, 0) + 1
    out = []
    for item, text in set(items):
        found = []
        for i, ts in docs:
            m, score = 10 + 90 * len(ts) * n_docs // all_terms, 0
            for t in set(split(text)) & set(ts):
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10**9 * ts.count(t) // (1000 * ts.count(t) + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, n + 1, f[3], -f[0]) for n, f in enumerate(sorted(found)[:count])]
    return out


def pu_gradient(docs: list[list[int]], positive: list[bool], weights: list[float], prior: float, decay: float) -> tuple[float, list[float]]:
    """The clean risk that is left and the step direction, document by document; weights end with the bias."""
    import math

    n_p, n_u = sum(positive), len(docs) - sum(positive)
    s = [1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[f] for f in d) + weights[-1])))) for d in docs]
    rest = sum(x for x, p in zip(s, positive, strict=True) if not p) / n_u - prior * sum(x for x, p in zip(s, positive, strict=True) if p) / n_p
    grad = [decay * w for w in weights]
    for d, x, p in zip(docs, s, positive, strict=True):
        clean = (-prior / n_p if p else 1 / n_u) * x * (1 - x)
        toxic = (-prior / n_p if p else 0.0) * x * (1 - x)
        step = clean + toxic if rest >= 0 else -clean
        for f in d:
            grad[f] += step
        grad[-1] += step
    return rest, grad


def pu_features(text: str | None) -> set[str]:
    import re

    return {part for w in re.findall(r"\w+", (text or "").lower()) for part in [f"={w}", *(f"{n}{w[:n]}" for n in (3, 4, 5, 6) if len(w) >= n)]}


def secret_spans(text: str) -> list[tuple[int, str, int]]:
    """Start, kind, end of the labelled secrets, by start and then kind as listed."""
    import re

    assign = r"""(?a)(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(s, ("assign", "access", "hex")[k], e) for s, k, e in sorted(out)]
