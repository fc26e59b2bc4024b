"""Ranked lexical search on K2-treaps over the term-document grid.

The grid has a row per term, a column per document, and in each filled cell the term's impact in
the document, before the term's weight. Documents are cut into ranges as they lie in the table, and a
task turns a range into a K2-treap: a quadtree over the square grid that keeps filled cells only,
level by level, as the mask of each cell's four children and the largest impact below it, stored as
the difference to the cell above. Rows are ordered from the most to the least frequent term.

An item follows the rows of its terms down all trees at once: what is open are ranges of columns,
each with the cell of every term that is filled there, and the weighted sum of the cells' maxima
bounds the score of any document in the range. The ranges with the highest bounds are halved
first, a batch at a time, until none left can reach the best documents found. A range of one
column holds the exact impacts, so its bound is the score. Scores are integers throughout.

The index is written once and needs no weights: how many documents hold a term is counted from
the ranges' term lists when items are searched. Trees and lists are compressed, so that a range is
a row of a few megabytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tilelake.llm.common import ascii_lower, narrow
from tilelake.session import materialize

# Fixed values of the query contract: terms, weights and impacts.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 10
ONE = 1_000_000_000
SHARE = 90  # percent of the length norm that follows the document's length

CELLS = 1 << 19  # filled cells of a range, after which the next one starts
COLUMNS = 1 << 12  # documents of a range
BATCH = 128  # open ranges of columns that are halved together
ITEM_TERMS = 100_000  # terms of the items that are searched together


def _letters() -> bytes:
    """For each byte what it counts as: itself, its lower case, or a space where no term has it."""
    out = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 0x20
    return bytes(out)


_LETTERS = _letters()


def terms(text: str) -> list[bytes]:
    """The terms of a whole text in UTF-8, in order, with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


# -- the tree --------------------------------------------------------------------------------------


def _interleaved(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Cell numbers along the Z curve; each pair of bits is a quadrant, the row's bit first."""
    def spread(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.uint64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = (x | (x << np.uint64(shift))) & np.uint64(mask)
        return x

    return (spread(rows) << np.uint64(1)) | spread(columns)


def plant(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> tuple[int, bytes, bytes]:
    """``height, masks, drops`` of the tree over different cells with positive impacts.

    Masks are a byte per inner cell, from the root down; drops are 32-bit: the root's impact, then
    for every other cell, level by level, how far its maximum lies below that of the cell above.
    """
    height = max(int(max(rows.max(), columns.max())).bit_length(), 1)
    code = _interleaved(rows, columns)
    by = np.argsort(code)
    code, value = code[by], impacts[by].astype(np.int64)
    masks, drops = [], []
    for _ in range(height):
        above = code >> np.uint64(2)
        first = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
        masks.append(np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.int64)), first).astype(np.uint8))
        most = np.maximum.reduceat(value, first)
        drops.append((np.repeat(most, np.diff(np.append(first, len(code)))) - value).astype(np.uint32))
        code, value = above[first], most
    drops.append(value.astype(np.uint32))
    return height, np.concatenate(masks[::-1]).tobytes(), np.concatenate(drops[::-1]).tobytes()


# By mask and quadrant: whether that child is there, and how many come before it.
_THERE = np.array([m >> q & 1 for m in range(16) for q in range(4)], bool)
_BEFORE = np.array([(m & ((1 << q) - 1)).bit_count() for m in range(16) for q in range(4)], np.int32)
_SIZES = np.array([m.bit_count() for m in range(16)], np.int64)


class Treap:
    """A planted tree, opened: per cell its children's mask, its first child and its maximum.

    Each list ends with an empty cell, which -1 stands for.
    """

    def __init__(self, height: int, masks: bytes, drops: bytes) -> None:
        self.height = height
        inner = np.frombuffer(masks, np.uint8)
        self.mask = np.append(inner, np.uint8(0)).astype(np.int32) * 4
        self.first = (1 + np.concatenate(([0], np.cumsum(_SIZES[inner])))).astype(np.int32)
        most = np.append(np.frombuffer(drops, np.uint32), np.uint32(0)).astype(np.int64)
        at, cells = 0, 1
        for _ in range(height):  # each level's maxima follow from those above
            children = _SIZES[inner[at:at + cells]]
            low = at + cells
            most[low:low + int(children.sum())] = np.repeat(most[at:at + cells], children) - most[low:low + int(children.sum())]
            at, cells = low, int(children.sum())
        self.most = most

    def best(self, rows: np.ndarray, weights: np.ndarray, count: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
        """``columns, scores`` of the documents that score ``least`` or more and are among the ``count`` best,
        with all that tie with the last of them; and the score that is needed for that.
        """
        columns, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        reached = np.empty(0, np.int64)
        # The row's half at each level, as the quadrants' upper bit.
        halves = (rows[None, :] >> np.arange(self.height - 1, -1, -1)[:, None] & 1).astype(np.int32) * 2
        cells = np.zeros((1, len(rows)), np.int32)
        level, block, bound = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([int(self.most[0]) * int(weights.sum())])
        while len(bound):
            now, rest = slice(None), slice(0, 0)
            if len(bound) > BATCH:
                by = np.argpartition(bound, len(bound) - BATCH)
                now, rest = by[-BATCH:], by[:-BATCH]
                rest = rest[bound[rest] >= least]
            here, deeper, place = cells[now], level[now] + 1, block[now] * 2
            child = self.mask[here] + halves[deeper - 1]
            base = self.first[here]
            child = np.concatenate((child, child + 1))
            child = np.where(_THERE[child], np.concatenate((base, base)) + _BEFORE[child], -1)
            score = self.most[child] @ weights
            keep = np.flatnonzero(score >= least)
            score = score[keep]
            deeper, place = np.concatenate((deeper, deeper))[keep], np.concatenate((place, place + 1))[keep]
            leaf = deeper == self.height
            if leaf.any():
                columns.append(place[leaf])
                scores.append(score[leaf])
                reached = np.sort(np.concatenate((reached, score[leaf])))[-count:]
                if len(reached) == count:
                    least = max(least, int(reached[0]))
            wide = ~leaf & (score >= least)
            cells = np.concatenate((cells[rest], child[keep[wide]]))
            level, block, bound = (np.concatenate((x[rest], y[wide])) for x, y in ((level, deeper), (block, place), (bound, score)))
        columns, scores = np.concatenate(columns), np.concatenate(scores)
        keep = scores >= least
        return columns[keep], scores[keep], least


# -- the index -------------------------------------------------------------------------------------


def totals(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and the number of their terms with repeats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = 0, 0
        for batch in batches:
            lengths = [len(terms(t.as_py() or "")) for t in batch.column(0)]
            found = found[0] + sum(map(bool, lengths)), found[1] + sum(lengths)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in found], names=["docs", "terms"])

    got = docs.select(F.col(f"`{text_col}`")).mapInArrow(count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return int(got[0] or 0), int(got[1] or 0)


def impact(tf: np.ndarray, length: np.ndarray, docs: int, all_terms: int) -> np.ndarray:
    """A term's impact before its weight, in 64-bit integers rounded down."""
    m = 100 - SHARE + SHARE * length * docs // all_terms
    return ONE * tf // (1000 * tf + 8 * m)


def _packed(*parts: bytes) -> bytes:
    """Parts of known sizes, compressed together."""
    whole = b"".join(parts)
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> memoryview:
    return memoryview(pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True))


def build(docs: DataFrame, counts: tuple[int, int], id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, columns: int = COLUMNS) -> DataFrame:
    """The index, written to the shared folder: ``ids, size, lexicon, height, inner, tree``, a row per range of documents.

    ``ids`` are the documents' ids by column; ``lexicon`` packs in how many of them each of ``size`` terms
    stands, and the terms, by row; ``tree`` packs the masks of ``inner`` cells and all drops. ``counts`` are the ``totals``.
    A null text, or one without terms, has no column. Repeated rows and ids
    have a column each. A very long text takes a range of its own at most; memory is bounded by ``cells``.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    n_docs, all_terms = counts
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"ids array<{kind}>, size int, lexicon binary, height int, inner int, tree binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            term = np.concatenate(of)
            sizes = list(map(len, of))
            column = np.repeat(np.arange(len(ids)), sizes)
            held = np.bincount(term)
            order = np.argsort(-held, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            value = impact(np.concatenate(tf), np.repeat(lengths, sizes), n_docs, all_terms)
            full = np.flatnonzero(value)  # an impact of 0 adds nothing to any score
            height, masks, drops = plant(rank[term[full]], column[full], value[full]) if len(full) else (0, b"", b"")
            names = list(known)
            return pa.RecordBatch.from_arrays([
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([len(order)], pa.int32()),
                pa.array([_packed(held[order].astype(np.int32).tobytes(), b" ".join(names[i] for i in order))], pa.binary()),
                pa.array([height], pa.int32()), pa.array([len(masks)], pa.int32()), pa.array([_packed(masks, drops)], pa.binary())],
                names=["ids", "size", "lexicon", "height", "inner", "tree"])

        ids, of, tf, lengths, known, filled = [], [], [], [], {}, 0
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                counts = Counter(terms(text.as_py() or ""))
                if not counts:
                    continue
                if filled and filled + len(counts) > cells or len(ids) == columns:
                    yield close()
                    ids, of, tf, lengths, known, filled = [], [], [], [], {}, 0
                ids.append(batch.column(0).slice(i, 1))
                of.append(np.fromiter((known.setdefault(t, len(known)) for t in counts), np.int64, len(counts)))
                tf.append(np.fromiter(counts.values(), np.int64, len(counts)))
                lengths.append(int(tf[-1].sum()))
                filled += len(counts)
        if ids:
            yield close()

    return materialize(rows.mapInArrow(run, schema), "k2-treaps")


def _lexicon(size: int, packed: bytes) -> tuple[np.ndarray, list[bytes]]:
    """How many documents hold each term, and the terms."""
    raw = _unpacked(packed)
    return np.frombuffer(raw[:4 * size], np.int32), bytes(raw[4 * size:]).split(b" ")


# -- search ----------------------------------------------------------------------------------------


def weight(df: Column, docs: Column | int) -> Column:
    """A term's weight from the number of documents that hold it."""
    docs = docs if isinstance(docs, Column) else F.lit(docs)
    return F.floor(F.lit(1000) * F.log((2 * docs + 2).cast("double") / (2 * df + 1).cast("double"))).cast("long")


def _item_terms(items: DataFrame) -> DataFrame:
    """``item_id, body, term`` for each different row of items; a term counts once."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    found = F.explode(F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))))
    return rows.select("item_id", F.sha2("text", 256).alias("body"), found.alias("term"))


def _searched(index: DataFrame, block: list, n_docs: int, count: int, kind: str, item_kind: str) -> DataFrame:
    """Scores of the items of one block, whose terms are bounded: per range the documents that may be among the best."""
    spark = index.sparkSession
    wanted = spark.sparkContext.broadcast({r.term.encode() for r in block})

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = [(t, int(n)) for n, t in zip(*_lexicon(size, packed.as_py()), strict=True) if t in wanted.value]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())], names=["term", "held"])

    held = index.select("size", "lexicon").mapInArrow(holding, "term binary, held long").groupBy("term").agg(F.sum("held").alias("df"))
    # The block's terms come back, as many as it has at most.
    weights = {bytes(r.term): r.w for r in held.select("term", weight(F.col("df"), n_docs).alias("w")).collect() if r.w > 0}
    asked: dict = {}
    for r in block:
        if (term := r.term.encode()) in weights:
            asked.setdefault((r.item_id, r.body), []).append((term, weights[term]))
    ids = sorted(asked, key=lambda k: k[1])
    plan = spark.sparkContext.broadcast((weights, [(i, k[0], asked[k]) for i, k in enumerate(ids)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = plan.value
        least: dict[int, list[int]] = {}  # the best scores that this task has seen, per item
        for batch in batches:
            for row in range(len(batch)):
                height, inner = batch.column(3)[row].as_py(), batch.column(4)[row].as_py()
                if not height:
                    continue
                raw = _unpacked(batch.column(5)[row].as_py())
                tree = Treap(height, raw[:inner], raw[inner:])
                _, names = _lexicon(batch.column(1)[row].as_py(), batch.column(2)[row].as_py())
                rank = {t: i for i, t in enumerate(names) if t in weights}
                docs = batch.column(0)[row].values
                out_item, out_at, out_score = [], [], []
                for number, _, pairs in items:
                    here = [(rank[t], w) for t, w in pairs if t in rank]
                    if not here:
                        continue
                    r, w = np.array(here, np.int64).T
                    known = least.setdefault(number, [])
                    at, scores, _ = tree.best(r, w, count, known[0] if len(known) == count else 1)
                    if len(at):
                        least[number] = sorted([*known, *scores.tolist()])[-count:]
                        out_item.append(np.full(len(at), number))
                        out_at.append(at)
                        out_score.append(scores)
                if out_item:
                    numbers = np.concatenate(out_item)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(numbers, pa.int32()), pa.array([items[i][1] for i in numbers.tolist()]).cast(item_type), docs.take(pa.array(np.concatenate(out_at))),
                        pa.array(np.concatenate(out_score))], names=["item", "item_id", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(f"item int, item_id {item_kind}, doc_id {kind}, score long")
    item_type = to_arrow_type(schema["item_id"].dataType)
    return index.select("ids", "size", "lexicon", "height", "inner", "tree").mapInArrow(run, schema)


def search(
    index: DataFrame, items: DataFrame, docs: int, count: int = BEST, id_col: str = "item_id", text_col: str = "text", item_terms: int = ITEM_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's best documents among the index's, ``docs`` of them with terms.

    Equal scores rank by ascending doc_id, null ids last; documents that repeat an id rank next to
    each other. Items that repeat id and text are one item, items that share an id only are
    ranked each by itself. An item without a term that a document holds has no rows. Items are
    searched in blocks of ``item_terms`` terms (an item is never divided), one after the other.
    """
    asked = _item_terms(narrow(items, item_id=id_col, text=text_col))
    kind = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = asked.schema["item_id"].dataType.simpleString()
    asked = materialize(asked, "item-terms")
    blocks = -(-asked.count() // item_terms)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "body"), F.lit(max(blocks, 1))))
    found = None
    for b in range(blocks):
        rows = asked.where(F.col("block") == b).collect()  # a block of the stated items
        part = _searched(index, rows, docs, count, kind, item_kind).withColumn("block", F.lit(b)) if rows else None
        found = part if found is None else found.unionByName(part) if part is not None else found
    if found is None:
        return index.sparkSession.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    # Spark ranks before the shuffle as well, so an item's rows shrink to ``count`` per task.
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).select("item_id", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame, items: DataFrame, count: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Index all documents and search all items; see ``build`` and ``search``. No documents or items: no rows."""
    counts = totals(docs, text_col)
    return search(build(docs, counts, id_col, text_col), items, counts[0], count, item_col, item_text_col)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The query's columns."""
    return ranked(docs, items)
