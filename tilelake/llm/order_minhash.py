"""Document fingerprints by Order MinHash, whose likeness follows the edit distance.

A text's k-mers are all its runs of ``K`` code points, each numbered by how often it has occurred
before. Every one of the ``SKETCHES`` random orders picks the ``CHOSEN`` numbered k-mers that come first in
it, puts them back into the order in which they stand in the text, and hashes the tuple of k-mers.
The share of equal hashes estimates how much of two texts is the same *in the same order*: moved
passages and repeats count, which sets of shingles don't see.

A text's k-mers are hashed at once with numpy; the orders, odd multiples of the hash, meet them block
by block, so a text of any length takes a fixed buffer besides its own hashes.

The report compares each text with the next document's. Rows are range-partitioned by falling id, and
a task passes over its rows once, holding two texts. Only the first and last row of a partition
have neighbours elsewhere: a second, small pass joins these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tilelake.llm.common import narrow
from tilelake.session import materialize

K = 8  # code points of a k-mer
CHOSEN = 2  # k-mers of a tuple
SKETCHES = 64  # tuples of a fingerprint
BLOCK = 2048  # k-mers that meet all orders at a time
DIGITS = 4  # hexadecimal digits of a tuple's hash
SEED = 11

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed bijection of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def orders(sketches: int = SKETCHES, seed: int = SEED) -> np.ndarray:
    """The odd factors that make the random orders."""
    with np.errstate(over="ignore"):
        made = _mixed(np.arange(1, sketches + 1, dtype=np.uint64) * _BASE + np.uint64(seed))
    return (made >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _kmers(text: str, k: int) -> np.ndarray:
    """Hash of the k-mer at each place; a shorter text is one k-mer, an empty one has none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    n = max(len(points) - k + 1, min(len(points), 1))
    h = np.zeros(n, np.uint64)
    for d in range(min(k, len(points))):
        h *= _BASE
        h += points[d:n + d]
    return _mixed(h)


def _numbered(kmers: np.ndarray) -> np.ndarray:
    """32-bit hash of each k-mer with the number of times that it has stood before."""
    by = np.argsort(kmers, kind="stable")
    ranked = kmers[by]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    number = np.zeros(len(by), np.uint64)
    if len(first) < len(by):
        number[by] = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
    return (_mixed(kmers + number * _STEP) >> np.uint64(32)).astype(np.uint32)


class Sketcher:
    """Makes signatures: an array with one 16-bit hash per order, all zero for an empty text."""

    def __init__(self, k: int = K, chosen: int = CHOSEN, sketches: int = SKETCHES) -> None:
        self.k, self.chosen = k, chosen
        self.factors = orders(sketches)
        self.each = np.arange(sketches)
        self.ranks = np.empty(sketches * BLOCK, np.uint32)

    def _first(self, base: np.ndarray, take: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ranks and places of the k-mers that come first in each order; of equal ranks the earlier place."""
        width, m = len(base), len(self.factors)
        ranks = np.multiply(self.factors[:, None], base, out=self.ranks[:m * width].reshape(m, width))
        values, places = [], []
        for _ in range(min(take, width)):
            at = ranks.argmin(axis=1)
            values.append(ranks[self.each, at])
            places.append(at)
            ranks[self.each, at] = 2**32 - 1
        return values, places

    def __call__(self, text: str) -> np.ndarray:
        kmers = _kmers(text, self.k)
        n = len(kmers)
        if not n:
            return np.zeros(len(self.factors), np.uint16)
        base, take = _numbered(kmers), min(self.chosen, n)
        values, places = [], []
        for start in range(0, n, BLOCK):
            v, p = self._first(base[start:start + BLOCK], take)
            values += v
            places += [x + start for x in p]
        picked = np.stack(places)
        if len(places) > take:
            best = np.argsort(np.stack(values), axis=0, kind="stable")[:take]
            picked = np.take_along_axis(picked, best, axis=0)
        picked.sort(axis=0)
        out = np.zeros(len(self.factors), np.uint64)
        for at in picked:
            out = _mixed(out * _BASE + kmers[at])
        return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the orders that picked the same tuple."""
    return float(np.mean(a == b))


def printed(signature: Column) -> Column:
    """A binary signature as the fingerprint string."""
    return F.lower(F.hex(signature))


def _bytes(signature: np.ndarray) -> bytes:
    return signature.astype(">u2").tobytes()


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, chosen: int = CHOSEN, sketches: int = SKETCHES,
) -> DataFrame:
    """One row per document: ``doc_id, signature`` (binary, two bytes per order), of each whole text.

    Null counts as empty, and an empty text's signature is zero. A text shorter than ``k`` is one
    k-mer. Repeated rows stay repeated, null ids stay null; no rows: no rows. Other columns are
    ignored. A long text is hashed in blocks, so memory is some 100 bytes a code point.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(k, chosen, sketches)
        for batch in batches:
            made = [_bytes(sketch(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["doc_id", "signature"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, signature binary")


def likeness_of(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint strings of the same parameters."""
    parts = F.size(F.filter(F.sequence(F.lit(0), (F.length(a) / DIGITS).cast("int") - 1), lambda i: F.substr(
        a, i * DIGITS + 1, F.lit(DIGITS)) == F.substr(b, i * DIGITS + 1, F.lit(DIGITS))))
    return parts * DIGITS / F.length(a)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the following one."""
    take = len(text) // 3
    return text[:len(text) - take] + following[:take]


_DONE, _FIRST, _LAST = 0, 1, 2
_COLUMNS = "n_chars long, edited_sha256 string, signature binary, edited_signature binary, near_edited double, near_next double"


def _compared(sketch: Sketcher, text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    changed = edited(text, following)
    then = own if changed == text else sketch(changed)
    return (len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), _bytes(own), _bytes(then),
            likeness(own, then), likeness(own, theirs))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text and the next document, by falling id.

    ``doc_id, n_chars, edited_sha256, signature, edited_signature, near_edited, near_next``. The
    last document is followed by the first; a single one by itself. Null ids come last, and of rows
    with one id those with the smaller hash of their text come first; equal rows follow each other.
    Null texts are empty, two empty texts are alike (1.0). No rows: no rows. Other columns are
    ignored. A task holds an Arrow batch and two texts, however long they are.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"),
                       F.monotonically_increasing_id().alias("n"))
    falling = [F.col("doc_id").desc_nulls_last(), "h", "n"]
    rows = rows.repartitionByRange(*falling).sortWithinPartitions(*falling).select(
        F.spark_partition_id().alias("part"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"kind int, part int, doc_id {kind}, text string, {_COLUMNS}")
    result = StructType.fromDDL(f"doc_id {kind}, {_COLUMNS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        sketch, before, part = Sketcher(), None, None
        blank = (None,) * 6

        def table(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)], schema=arrow)

        for batch in batches:
            made = []
            for i, body in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                body = body.as_py()
                if before is None:
                    part = batch.column(0)[0].as_py()
                    made.append((_FIRST, part, i, body, *blank))
                    own = sketch(body)
                else:
                    own = before[2] if body == before[1] else sketch(body)
                    made.append((_DONE, part, before[0], None, *_compared(sketch, before[1], before[2], body, own)))
                before = (i, body, own)
            if made:
                yield table(made)
        if before is not None:
            yield table([(_LAST, part, before[0], before[1], *blank)])

    passed = materialize(rows.mapInArrow(run, schema), "order-minhash")
    columns = [c.split()[0] for c in _COLUMNS.split(", ")]

    # One row per partition from here on: the last row of each, with the first of the next that has any.
    ends = passed.where(F.col("kind") != _DONE)
    parts = ends.where(F.col("kind") == _FIRST).select("part")
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    first = ends.where(F.col("kind") == _FIRST).select(F.col("part").alias("next"), F.col("text").alias("following"))
    pairs = ends.where(F.col("kind") == _LAST).select("part", "doc_id", "text").join(after, "part").join(first, "next")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(result)
        sketch = Sketcher()
        for batch in batches:
            made = [_compared(sketch, a, sketch(a), b, sketch(b)) for a, b in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            filled = zip(*made, strict=True) if made else [[]] * len(columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(
                pa.array(c, f.type) for c, f in zip(filled, list(arrow)[1:], strict=True))], schema=arrow)

    rest = pairs.select("doc_id", "text", "following").mapInArrow(last, result)
    return passed.where(F.col("kind") == _DONE).select("doc_id", *columns).unionByName(rest)


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return neighbours(docs).select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("signature")).alias("fingerprint"),
        printed(F.col("edited_signature")).alias("edited_fingerprint"), "near_edited", "near_next")
