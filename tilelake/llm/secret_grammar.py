"""Secret scans with inferred grammars.

A first pass over the texts finds the labelled credentials, which three fixed patterns mark, and
samples them and all other candidate strings. From the sample, a probabilistic automaton is
inferred per kind: a prefix tree of their letters (as letter classes) whose states are merged
wherever the frequencies of what follows are statistically compatible. The second pass scores every
candidate by each automaton: whatever the labelled strings could be spelled with and is as long as
the shortest of them, cut at the labelled spans. Those that look as likely as labelled strings
which the automaton wasn't inferred from, and likelier than ordinary strings, are reported besides
the labelled spans.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from statistics import fmean, pstdev

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import map_columns, narrow
from tilelake.session import materialize

# Fixed values of the query contract: kinds in order, patterns, least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # as [0-9a-f]+ with the short ones dropped
LEAST = {"assign": 6, "access": 20, "hex": 24}
FOUND = "format"  # the kind of spans that the grammars add

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")  # the letters and the least length of all kinds
WORDLIKE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# The fit's documented bounds.
SAMPLE = 1000  # credentials of a kind that its automaton is inferred from
BACKGROUND = 4000  # ordinary candidates that the other automaton is inferred from
APART = 4  # one in so many of a kind's sample isn't learned from and sets the least score:
DEVIATIONS = 2.5  # so many standard deviations below their mean
FITTED = 4096  # letters of one string that are learned from; every letter is scored
FITTED_ALL = 200_000  # ... and of all strings of a kind; a string beyond that is left to the scan
REMEMBERED = 200_000  # strings whose scores a task remembers, ...
SHORT = 64  # ... of so many letters at most
ALPHA = 0.05  # confidence of the Hoeffding bound on the merge test
ENOUGH = 30  # strings a state must have seen for a test of its own

LETTERS = "9fzFZ-$"  # letter classes, other signs, and the end of the string
_CLASSES = str.maketrans({c: group for group, signs in (
    ("9", "0123456789"), ("f", "abcdef"), ("z", "ghijklmnopqrstuvwxyz"), ("F", "ABCDEF"), ("Z", "GHIJKLMNOPQRSTUVWXYZ"), ("-", "+/_.=-")) for c in signs})


def letters(value: str) -> str:
    return value.translate(_CLASSES)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind's number, end of the labelled credentials, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def credential(text: str, kind: int, start: int, end: int) -> str:
    return ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end]


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Spans of the strings that may be credentials, without what the labelled spans take of them."""
    i = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while i < len(base) and base[i][2] <= start:
            i += 1
        for s, _, e in base[i:]:
            if s >= end:
                break
            if s - start >= LEAST["assign"]:
                yield start, s
            start = max(start, e)
        if end - start >= LEAST["assign"]:
            yield start, end


def likelihood(steps: list[dict[str, int]], logs: dict[int, dict[str, float]], lengths: list[int], string: str, length: int | None = None) -> float:
    """Mean log-likelihood per letter, and that of the length; a letter without a way on stays in its state.
    ``length`` is that of the whole, where ``string`` is the part that is learned from.

    Deep states have seen too few strings to know where these end: lengths are counted, give or take an eighth.
    """
    at, total = 0, 0.0
    for c in string:
        total += logs[at][c]
        at = steps[at].get(c, at)
    n = len(string) if length is None else length
    near = bisect_right(lengths, n + n // 8) - bisect_left(lengths, n - n // 8)
    return total / max(len(string), 1) + math.log((near + 0.5) / (len(lengths) + 0.5))


class Automaton:
    """A probabilistic automaton inferred from strings by merging compatible states of their prefix tree."""

    def __init__(self, strings: list[str], alpha: float = ALPHA, enough: int = ENOUGH, lengths: list[int] | None = None):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        for s, n in sorted(Counter(strings).items()):
            at = 0
            for c in s:
                self.count[at][c] += n
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                at = self.next[at][c]
            self.count[at]["$"] += n
        self.lengths = sorted(map(len, strings) if lengths is None else lengths)
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        self.enough = enough
        self._infer()

    def _alike(self, a: int, b: int) -> bool:
        """Whether no frequency of what follows differs by more than chance allows, here and below."""
        stack = [(a, b)]
        while stack:
            p, q = stack.pop()
            n, m = sum(self.count[p].values()), sum(self.count[q].values())
            if n < self.enough or m < self.enough:
                continue  # too little seen to tell them apart
            bound = self.width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if any(abs(self.count[p][c] / n - self.count[q][c] / m) > bound for c in self.count[p].keys() | self.count[q].keys()):
                return False
            stack += [(self.next[p][c], self.next[q][c]) for c in self.next[p].keys() & self.next[q].keys() if self.next[p][c] != self.next[q][c]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        stack = [(a, b)]
        while stack:
            p, q = stack.pop()
            self.count[p].update(self.count[q])
            for c, child in self.next[q].items():
                if c in self.next[p]:
                    stack.append((self.next[p][c], child))
                else:
                    self.next[p][c] = child

    def _infer(self) -> None:
        red, blue = [0], [(0, c) for c in sorted(self.next[0])]
        while blue:
            parent, c = blue.pop(0)
            state = self.next[parent][c]
            if state in red:
                continue
            for r in red:
                if self._alike(r, state):
                    self.next[parent][c] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)
            blue = [(r, x) for r in red for x in sorted(self.next[r]) if self.next[r][x] not in red]
        self.states = len(red)
        self.logs = {}
        for r in red:
            total = sum(self.count[r].values()) + 0.5 * len(LETTERS)
            self.logs[r] = {x: math.log((self.count[r][x] + 0.5) / total) for x in LETTERS}

    def likelihood(self, string: str, length: int | None = None) -> float:
        return likelihood(*self.plain(), string, length)

    def plain(self) -> tuple[list[dict[str, int]], dict[int, dict[str, float]], list[int]]:
        """What scoring needs, in plain types, which any worker can read."""
        return self.next, self.logs, self.lengths


def samples(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, background: int = BACKGROUND) -> DataFrame:
    """``kind, dice, letters, length, wordlike``: of each kind's different strings, and of all other candidates
    (one kind more), those with the smallest hashes. A task gives no more rows than the bounds, and of a row no more
    than the first ``FITTED`` letters, with the whole length.
    """
    other = len(KINDS)
    most = [sample] * other + [background]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[int, tuple[str, int, bool]]] = [{} for _ in most]
        bound = [1 << 63] * len(most)
        seen: set[str] = set()

        def take(kind: int, value: str) -> None:
            dice = xxhash.xxh64_intdigest(value, kind) >> 1
            if dice < bound[kind]:
                held[kind][dice] = letters(value[:FITTED]), len(value), WORDLIKE.fullmatch(value) is not None
                if len(held[kind]) >= 2 * most[kind]:
                    held[kind] = dict(sorted(held[kind].items())[:most[kind]])
                    bound[kind] = max(held[kind])

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                base = base_spans(text)
                for s, k, e in base:
                    take(k, credential(text, k, s, e))
                for s, e in candidates(text, base):
                    if (value := text[s:e]) not in seen:
                        if len(seen) > REMEMBERED:
                            seen.clear()
                        if e - s <= SHORT:
                            seen.add(value)
                        take(other, value)
        rows = [(k, dice, *v) for k, part in enumerate(held) for dice, v in sorted(part.items())[:most[k]]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.bool_()), strict=True)],
                                             names=["kind", "dice", "letters", "length", "wordlike"])

    return docs.select(F.col(f"`{text_col}`")).mapInArrow(run, "kind int, dice long, letters string, length long, wordlike boolean")


def infer(found: DataFrame, sample: int = SAMPLE, background: int = BACKGROUND) -> tuple[dict[int, Automaton], Automaton | None, dict[int, float]]:
    """An automaton per kind, one of ordinary strings, and the least score of each kind.

    The samples are the strings with the smallest hashes: bounded in number and letters, and the same in every run.
    Ordinary strings are the candidates that look like words or that reach no kind's least score, so that
    unlabelled credentials don't pass for what is usual.
    """
    def lowest(kind: int, most: int) -> list:
        rows, total = [], 0
        for r in found.where(F.col("kind") == kind).distinct().orderBy("dice", "letters").limit(most).collect():
            if total + len(r.letters) <= FITTED_ALL:
                total += len(r.letters)
                rows.append(r)
        return rows

    def automaton(rows: list) -> Automaton:
        return Automaton([r.letters for r in rows], lengths=[r.length for r in rows])

    fitted, least = {}, {}
    for k in range(len(KINDS)):
        rows = lowest(k, sample)
        if len(rows) >= ENOUGH:
            fitted[k] = automaton([r for r in rows if r.dice % APART])
            apart = [fitted[k].likelihood(r.letters, r.length) for r in rows if r.dice % APART == 0]
            least[k] = fmean(apart) - DEVIATIONS * pstdev(apart) if apart else math.inf
    usual = [r for r in lowest(len(KINDS), background) if r.wordlike or all(a.likelihood(r.letters, r.length) < least[k] for k, a in fitted.items())]
    return fitted, automaton(usual) if usual else None, least


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id, base, added``; spans in code points, end exclusive.

    Labelled spans always stay; ``added`` holds candidates outside them with the automaton's kind
    and score (its log-likelihood over that of ordinary strings; of equal scores the kind
    listed first). Null and empty texts have no spans. Repeated rows and null ids each get theirs. Very long texts
    are read whole, and every letter of a very long string is scored. Fewer than
    ``ENOUGH`` different labelled strings of a kind: it adds nothing. An empty table gives no rows;
    other columns are ignored.
    """
    found = materialize(samples(docs, text_col, sample), "samples")
    fitted, other, least = infer(found, sample)
    # Bounded by the samples, and in plain types: a broadcast is read where the library needn't be.
    model = docs.sparkSession.sparkContext.broadcast(({k: a.plain() for k, a in fitted.items()}, other and other.plain(), least))

    def work():
        automata, plain, floor = model.value
        known: dict[str, tuple[int, float] | None] = {}

        def score(form: str):
            best = None
            usual = likelihood(*plain, form) if plain else -math.inf
            for k, a in automata.items():
                value = likelihood(*a, form)
                if value >= floor[k] and value > usual and (best is None or value - usual > best[1]):
                    best = (k, value - usual)
            return best

        def one(text: str):
            base = base_spans(text)
            added = []
            for s, e in candidates(text, base) if automata else ():
                value = text[s:e]
                if e - s > SHORT:
                    like = score(letters(value))
                else:
                    if value not in known:
                        if len(known) > REMEMBERED:
                            known.clear()
                        known[value] = score(letters(value))
                    like = known[value]
                if like:
                    added.append({"start": s, "end": e, "like": KINDS[like[0]], "score": like[1]})
            return [{"start": s, "kind": k, "end": e} for s, k, e in base], added

        def step(batch):
            rows = [one(t.as_py() or "") for t in batch["text"]]
            return {"doc_id": batch["doc_id"], "base": [r[0] for r in rows], "added": [r[1] for r in rows]}

        return step

    rows = narrow(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_columns(rows, work, f"doc_id {kind}, base array<struct<start: int, kind: int, end: int>>, "
                       "added array<struct<start: int, end: int, like: string, score: double>>")


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    names = F.array(*map(F.lit, KINDS))
    rows = scan(docs)
    base = F.transform("base", lambda x: F.struct(x["start"].alias("s"), x["kind"].alias("k"), x["end"].alias("e"), F.element_at(names, x["kind"] + 1).alias("n")))
    added = F.transform("added", lambda x: F.struct(x["start"].alias("s"), F.lit(len(KINDS)).alias("k"), x["end"].alias("e"), F.lit(FOUND).alias("n")))
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["n"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(text(F.sort_array(base)), 256).alias("base_sha256"),
        text(F.sort_array(F.concat(base, added))).alias("spans"), F.size("added").cast("long").alias("n_added"))
