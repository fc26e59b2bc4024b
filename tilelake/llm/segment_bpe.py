"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

``encode`` gives token ids for whole texts as the ``tokenizers`` library does for a BPE file with
word ends; ``decode`` gives the text back. The tree's root names the leftmost pair of the lowest
rank; a merge changes at most three leaves, so a text of n symbols costs O(n log n) however long
its words are. Pieces between white space never influence each other, so a bounded table per worker
remembers the pieces it has met.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from itertools import pairwise
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import map_columns, narrow

REMEMBERED = 64 << 20  # bytes of words, and again of pieces, that a worker remembers with their ids
ENTRY = 200  # ... which one takes besides its letters and ids

# The characters that the normaliser's \s stands for.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The letter for each byte: printable Latin-1 stands for itself, others follow from 256 on."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def tree_of(keys: list[int], absent: int) -> tuple[list[int], int]:
    """Minimum tree over ``keys``: its nodes, the root at 1, and the place of the first leaf."""
    width = 1
    while width < len(keys):
        width *= 2
    tree = [absent] * width + keys + [absent] * (width - len(keys))
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    return tree, width


def put(tree: list[int], at: int, key: int) -> None:
    """Give a leaf a key; the walk to the root ends where nothing changes."""
    tree[at] = key
    while at > 1:
        other = tree[at ^ 1]
        if other < key:
            key = other
        at >>= 1
        if tree[at] == key:
            return
        tree[at] = key


def merge(symbols: list[int], ranks: dict[int, int], made_by: list[int]) -> list[int]:
    """Merge the leftmost pair of the lowest rank until none is left.

    ``ranks`` is by ``left << 20 | right``, ``made_by`` names the symbol by rank; the last rank is
    that of pairs which don't merge. A leaf is the rank before the pair's position.
    """
    n = len(symbols)
    find, bits, never = ranks.get, n.bit_length(), len(made_by)
    absent = never << bits
    keys = [find(a << 20 | b, never) << bits | i for i, (a, b) in enumerate(pairwise(symbols))]
    if n < 2 or min(keys) >= absent:
        return symbols
    tree, width = tree_of(keys, absent)
    places = (1 << bits) - 1
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (low := tree[1]) < absent:
        i = low & places
        symbols[i] = made = made_by[low >> bits]
        j = after[i]
        symbols[j] = -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if tree[width + j] < absent:
                put(tree, width + j, absent)
            put(tree, width + i, find(made << 20 | symbols[k], never) << bits | i)
        else:
            put(tree, width + i, absent)
        if (h := before[i]) >= 0:
            key = find(symbols[h] << 20 | made, never) << bits | h
            if tree[width + h] != key:
                put(tree, width + h, key)
    return [s for s in symbols if s >= 0]


def names_of(data: dict) -> np.ndarray:
    """A tokenizer file's tokens by id."""
    by_id = {i: t for t, i in data["model"]["vocab"].items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
    return np.array([by_id.get(i, "") for i in range(max(by_id) + 1)], dtype=object)


class Encoder:
    """Ids of a text under a tokenizer file of the word-end BPE kind."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.ranks, self.made_by = {}, []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] << 20 | vocab[b]] = len(self.made_by)
            self.made_by.append(vocab[a + b])
        letters = byte_letters()
        self.inner = [vocab.get(c, -1) for c in letters]
        self.last = [vocab.get(c + end, -1) for c in letters]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.words = regex.compile(data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.white = re.compile(f"[{WHITE}]+")
        self.names = names_of(data)
        self.pieces: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.room = {id(self.pieces): REMEMBERED, id(self.known): REMEMBERED}

    def remember(self, held: dict[str, bytes], key: str, ids: bytes) -> bytes:
        """Keep the ids, if need be in place of all that was kept before."""
        size = ENTRY + len(key) + len(ids)
        if self.room[id(held)] < size:
            held.clear()
            self.room[id(held)] = REMEMBERED
        if size <= self.room[id(held)]:
            self.room[id(held)] -= size
            held[key] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        """Ids, as 32-bit integers, of a piece without white space: composed, lower-cased letter by letter, cut, merged."""
        flat = piece.lower() if piece.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", piece)))
        return b"".join(map(self.word, self.words.findall(flat)))

    def word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            raw = word.encode()
            symbols = [self.inner[b] for b in raw]
            symbols[-1] = self.last[raw[-1]]
            if -1 in symbols:
                symbols = [s for s in symbols if s >= 0]
            ids = self.remember(self.known, word, array("i", merge(symbols, self.ranks, self.made_by)).tobytes())
        return ids

    def plain(self, text: str) -> bytes:
        # str.split also cuts at the four separators below, which the normaliser keeps.
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        pieces = self.white.split(text) if odd else text.split()
        ids = list(map(self.pieces.get, pieces))
        if None in ids:
            for i, found in enumerate(ids):
                if found is None:
                    ids[i] = self.pieces.get(pieces[i]) or self.learn(pieces[i])
        return b"".join(ids)

    def learn(self, piece: str) -> bytes:
        return self.remember(self.pieces, piece, self.piece(piece))

    def encode(self, text: str) -> np.ndarray:
        parts, at = [], 0
        for m in self.cut.finditer(text) if self.cut else ():
            parts += self.plain(text[at:m.start()]), array("i", [self.special[m.group()]]).tobytes()
            at = m.end()
        parts.append(self.plain(text[at:] if at else text))
        return np.frombuffer(b"".join(parts), np.int32)


def encoder_of(spec: str) -> Encoder:
    """One encoder per Python worker, whose memory of words later tasks of the worker take up."""
    kept = sys.modules.setdefault("_tilelake_encoders", ModuleType("_tilelake_encoders")).__dict__
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in kept:
        kept[name] = Encoder(spec)
    return kept[name]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encoded(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, keep: tuple[str, ...], decoded: bool) -> DataFrame:
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    rows = narrow(docs, doc_id=id_col, text=text_col, **{c: c for c in keep})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def work():
        encoder = encoder_of(spec.value)

        def step(batch):
            rows, offsets, texts = [], [0], []
            for text in batch["text"]:
                rows.append(encoder.encode(text.as_py() or ""))
                offsets.append(offsets[-1] + len(rows[-1]))
                if decoded:
                    texts.append(" ".join(encoder.names[rows[-1]]))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows) if rows else np.array([], np.int32)))
            return {n: c for n, c in batch.items() if n != "text"} | {"ids": ids, "decoded": texts}

        return step

    return map_columns(rows, work, f"{kinds}, ids array<int>" + ", decoded string" * decoded)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, ids array<int>`` (and the columns of ``keep``), one row per row of ``docs``.

    ``tokenizer`` is a file the driver can read; its text (a vocabulary, so of bounded size) is
    broadcast. A null text gives no ids, as an empty one. Repeated rows stay repeated; other
    columns are ignored, an empty table gives none. Special tokens found in a text become their id.
    """
    return _encoded(docs, tokenizer, id_col, text_col, keep, False)


def tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """What ``encode`` gives, with ``decoded`` as ``decode`` gives it, in one pass."""
    return _encoded(docs, tokenizer, id_col, text_col, keep, True)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the tokens joined by one space, as the file names no decoder.

    Null or empty ids give the empty text.
    """
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    kept = [c for c in encoded.columns if c != "decoded"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*(F.col(f"`{c}`") for c in kept)).schema)

    def work():
        names = names_of(json.loads(spec.value))

        def step(batch):
            texts = []
            for ids in batch[ids_col]:
                row = ids.values if ids.is_valid else None
                texts.append(" ".join(names[row.to_numpy()]) if row is not None and len(row) else "")
            return batch | {"decoded": texts}

        return step

    return map_columns(encoded.select(*(F.col(f"`{c}`") for c in kept)), work, f"{kinds}, decoded string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The query's columns: counts and digests of the ids and of the decoded text."""
    return tokens(docs, tokenizer).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
