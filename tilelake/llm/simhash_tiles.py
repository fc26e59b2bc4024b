"""SimHash near-duplicates by tiled exact comparison.

A fingerprint is 64 bits: a bit is set if more than half of the hashes of the text's three-word
shingles have it. Different fingerprints are compared exactly, tile against tile, with numpy
exclusive-or and bit counts. A tile holds the fingerprints with the same population counts in each
of four 16-bit quarters. Two fingerprints at most r bits apart have quarter counts whose
differences sum to at most r, so all other tile pairs are skipped and none of their links is lost.
A fingerprint is dealt to its own tile and, as a guest, to the tiles in reach that come later; a
tile sees its members in blocks, and within a task only a spanning forest of the links is kept, so
a group of n near copies gives n - 1 rows and not n squared. Copies share a fingerprint and are
compared once.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.llm.common import fresh, narrow
from tilelake.llm.components import components
from tilelake.session import materialize

SEED = 42
RADIUS = 3
WIDTH = 3  # words of a shingle
QUARTERS = 4
BLOCK = 4096  # members of a tile that one task compares with its guests
STRIP = 512  # rows of one exclusive-or


def fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(WIDTH, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)),
        np.uint64, len(words) - k + 1)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * votes > len(hashes)).tolist()))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long; null texts count as empty."""
    rest = [c for c in docs.columns if c != out]

    @F.pandas_udf("long")
    def of(texts):
        return texts.map(lambda t: signed(fingerprint(t or "")))

    return docs.select(*(F.col(f"`{c}`") for c in rest), of(F.col(f"`{text_col}`")).alias(out))


def _reach(radius: int) -> list[tuple[int, ...]]:
    """Steps between tiles that can hold a link, one of each pair of opposite steps, without zero."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=QUARTERS) if 0 < sum(map(abs, s)) <= radius]
    return [s for s in steps if s > tuple(-x for x in s)]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: a spanning forest, per tile block, of the pairs of different ``fp`` within reach.

    ``prints`` holds each fingerprint once. The components of the forest are those of all links.
    """
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(0xFFFF)).cast("long") for q in range(QUARTERS)]
    packed = sum((c * 32**q for q, c in enumerate(counts)), F.lit(0).cast("long"))
    own = prints.select("fp", packed.alias("tile"))
    # Blocks bound what a task holds of a tile; every guest meets every block.
    tiles = own.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = own.join(tiles, "tile").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    own = materialize(own, "tiles")
    tiles = own.groupBy("tile").agg(F.first("blocks").alias("blocks"))

    # Members of later blocks are guests of the earlier ones, and members of later tiles in reach of all blocks.
    inside = own.where("blocks > 1").select("tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"), "fp", "block")
    inside = inside.where("to < block").select("tile", F.col("to").alias("block"), "fp")
    steps = [sum(x * 32**q for q, x in enumerate(s)) for s in _reach(radius)]
    shifts = F.explode(F.array(*(F.lit(x).cast("long") for x in steps)))
    pairs = (tiles.select(F.col("tile").alias("from"), shifts.alias("step")).select("from", (F.col("from") - F.col("step")).alias("tile"))
             .join(tiles, "tile").groupBy("from").agg(F.collect_list(F.struct("tile", "blocks")).alias("hosts")))
    across = (own.join(pairs, F.col("from") == F.col("tile")).select("fp", F.explode("hosts").alias("h"))
              .select(F.col("h.tile").alias("tile"), F.explode(F.sequence(F.lit(0), F.col("h.blocks") - 1)).alias("block"), "fp"))
    dealt = own.select("tile", "block", "fp", F.lit(False).alias("guest")).unionByName(
        inside.unionByName(across).select("tile", "block", "fp", F.lit(True).alias("guest")))
    dealt = dealt.repartition("tile", "block").sortWithinPartitions("tile", "block", "guest")
    return dealt.mapInArrow(_comparer(radius), "a long, b long")


def _comparer(radius: int):
    def run(batches):
        key, members, guests = None, [], []

        for batch in batches:
            tile, block, fp, guest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if not len(fp):
                continue
            edges = np.flatnonzero((tile[1:] != tile[:-1]) | (block[1:] != block[:-1])) + 1
            for i, j in zip([0, *edges], [*edges, len(fp)], strict=True):
                if (tile[i], block[i]) != key:
                    yield from _pairs(members, guests, radius)
                    key, members, guests = (tile[i], block[i]), [], []
                part, is_guest = fp[i:j].view(np.uint64), guest[i:j]
                if not is_guest.all():
                    members.append(part[~is_guest])
                if is_guest.any():
                    guests.append(part[is_guest])
                    if sum(map(len, guests)) > 8 * BLOCK:  # members come first, so guests can be met and let go
                        yield from _pairs(members, guests, radius, inside=False)
                        guests = []
        yield from _pairs(members, guests, radius)

    return run


def _pairs(members: list, guests: list, radius: int, inside: bool = True):
    """Links among the members and between members and guests, thinned to a forest per strip."""
    if not members or not (inside or guests):
        return
    own = np.concatenate(members)
    found_a, found_b = [], []
    others_of = [(own, True)] * inside
    if guests:
        others_of.append((np.concatenate(guests), False))
    for others, same in others_of:
        for i in range(0, len(own), STRIP):
            rows = own[i:i + STRIP]
            for j in range(i if same else 0, len(others), 8 * STRIP):
                hit = np.bitwise_count(rows[:, None] ^ others[None, j:j + 8 * STRIP]) <= radius
                if same:
                    hit &= np.arange(len(rows))[:, None] + i < np.arange(j, j + hit.shape[1])[None, :]
                a, b = np.nonzero(hit)
                if len(a):
                    a, b = _forest(rows[a], others[j + b])
                    found_a.append(a)
                    found_b.append(b)
    if found_a:
        a, b = _forest(np.concatenate(found_a), np.concatenate(found_b))
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one edge per node but the smallest: minimum labels, jumped to their roots."""
    if len(a) < 2:
        return a, b
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[moved]], nodes[moved]


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, root`` for every fingerprint; fingerprints with the same root are one group."""
    once = materialize(prints.select("fp").distinct(), "fps")
    linked = components(materialize(links(once, radius), "links"))
    return once.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id, fp, root, component_id`` (the smallest id of its group).

    Null and blank texts have fingerprint zero and link like any other. Repeated rows stay
    repeated. Null ids are never the smallest unless a group has no other, whose id is then null.
    An empty table gives no rows; other columns are ignored.
    """
    rows = materialize(fingerprints(narrow(docs, doc_id=id_col, text=text_col)).drop("text"), "fingerprints")
    firsts = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "firsts")
    of = materialize(classes(firsts, radius), "classes")
    named = firsts.join(of, "fp").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(of.join(named, "root"), "fp")


def report(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of each group, with all its columns; null ids come last.

    Rows that repeat that id and fingerprint stay once.
    """
    keep_id, mark = fresh(docs, "_keep_id", "_keep_text")
    key, body = F.col(f"`{id_col}`"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("body", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = materialize(fingerprints(rows).drop("text"), "fingerprints")
    firsts = materialize(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "body")).alias("k")), "firsts")
    best = firsts.join(classes(firsts, radius), "fp").groupBy("root").agg(F.min("k").alias("k"))
    best = best.select(F.col("k.doc_id").alias(keep_id), F.col("k.body").alias(mark)).distinct()
    kept = docs.join(best, key.eqNullSafe(F.col(keep_id)) & (body == F.col(mark)))
    return kept.dropDuplicates([id_col, mark]).select(*(F.col(f"`{c}`") for c in docs.columns))
