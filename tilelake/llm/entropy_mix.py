"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a token target. Document rates minimise their relative entropy to one copy each,
``sum r log r - r``, under the source's token constraint ``sum n r = target`` and ``r <= 3``. The
solution is the tilt ``r = min(3, exp(lambda z))`` with ``z`` the document's size over the mean of
its source, and ``lambda`` is the root of the convex dual's gradient. All sources take Newton steps
at once; a step is one grouped sum over a histogram of sizes, which holds a hot source in as many
rows as it has sizes. Steps act on the logarithm of the constraint, where the dual is close to
linear, and a bracket catches those that leave it.

Rates become copies by error feedback: documents of a source are dealt to buckets of bounded size
by a hash of their id, and within a bucket, from the largest to the smallest, the rounding error in
words is carried on, so that small documents settle what large ones leave.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilelake.llm.common import WORD, fresh
from tilelake.operators.slices import row_numbers
from tilelake.session import materialize

WEIGHTS = (1, 2, 3)
CAP = 3
BUCKET = 256  # documents whose rounding is settled together
ALIKE = 64  # rows alike that are rounded as one
TOLERANCE = 1e-9
MAX_STEPS = 80


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (``source, source_size, docs``) with ``target``.

    Weights repeat over the sources by code point, null last. A target stops at ``cap`` times its
    source; the level that the others share is found from the sorted ratios of cap to weight. One
    row per source: this small table is the only one that a single task orders.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    nth = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(everything) - 1, F.lit(n)) + 1)
    ranked = sources.withColumn("weight", nth.cast("long")).withColumn("most", F.col("source_size") * cap)
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    ranked = ranked.withColumn("level", level)
    # The first source that its level doesn't fill sets the level of all that follow.
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "level"))).over(whole)
    ranked = ranked.withColumn("common", free["level"])
    return ranked.select("source", "source_size", "docs", F.coalesce(
        F.least(F.col("common") * F.col("weight"), F.col("most").cast("double")), F.col("most").cast("double")).alias("target"))


def _tilt(z: Column, tilt: Column, cap: int) -> Column:
    """exp(tilt z), at most ``cap``; the exponent is held back so that no product overflows."""
    return F.exp(F.least(F.lit(math.log(cap)), z * tilt))


def balance(sizes: DataFrame, aims: DataFrame, cap: int = CAP, tolerance: float = TOLERANCE) -> DataFrame:
    """``key, tilt`` for each source: Newton on the dual over the histogram ``key, size, n``.

    ``aims`` is ``key, source_size, docs, target``. Sources without words get no tilt; those whose
    target is their cap get an infinite one.
    """
    hist = materialize(sizes.where("size > 0").groupBy("key", "size").agg(F.count("*").alias("n")), "histogram")
    full = F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)
    state = aims.where("source_size > 0").select(
        "key", "target", (F.col("source_size") / F.col("docs")).alias("mean"), full.alias("full"),
        F.lit(0.0).alias("tilt"), F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high"), F.lit(math.inf).alias("gap"))
    state = materialize(state, "tilts")
    for _ in range(MAX_STEPS):
        z = F.col("size") / F.col("mean")
        rate = _tilt(z, F.col("tilt"), cap)
        slope = F.when(z * F.col("tilt") < math.log(cap), z * rate).otherwise(0.0)
        got = hist.join(state.where(~F.col("full")), "key").groupBy("key").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"), F.sum(F.col("n") * F.col("size") * slope).alias("slope"))
        gap = F.log(F.col("got") / F.col("target"))
        low = F.when(gap < 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.least("high", "tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - gap * F.col("got") / F.col("slope")
        middle = (F.when(high == math.inf, low * 2 + 1).when(low == -math.inf, high * 2 - 1).otherwise((low + high) / 2))
        sound = step.isNotNull() & ~F.isnan(step) & (step > low) & (step < high)
        state = materialize(
            state.join(got, "key", "left").withColumns({"gap": F.when(F.col("full"), 0.0).otherwise(gap), "_low": low, "_high": high, "_next": F.when(sound, step).otherwise(middle)})
            .select("key", "target", "mean", "full", F.when(F.col("full") | (F.abs("gap") <= tolerance), F.col("tilt")).otherwise(F.col("_next")).alias("tilt"),
                    F.col("_low").alias("low"), F.col("_high").alias("high"), "gap"), "tilts")
        worst = state.agg(F.max(F.abs("gap"))).first()[0]
        if worst is None or worst <= tolerance:
            break
    return state.select("key", "mean", F.when(F.col("full"), math.inf).otherwise(F.col("tilt")).alias("tilt"))


def _settle(items: Column, cap: int) -> Column:
    """Copies for a bucket's items, given as an array of (a: -size, b: order, d: rate, m: rows alike), largest first."""
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<long>").alias("copies"))

    def step(state, item):
        size = -item["a"]
        want = item["d"] * item["m"] + state["owed"] / size
        copies = F.greatest(F.lit(0).cast("long"), F.least(F.lit(cap) * item["m"], F.floor(want + 0.5)))
        return F.struct((state["owed"] + (item["d"] * item["m"] - copies) * size).alias("owed"), F.concat(state["copies"], F.array(copies)).alias("copies"))

    return F.aggregate(items, start, step, lambda s: s["copies"])


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, keep_order: bool = False) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    A null or blank text has size 0, takes no words and counts as one copy. A null source is a
    source of its own, sorted last. Rows with the same id, source and text are told apart by nothing, and
    any of them may get a copy more; null ids are told apart by their texts. Very long texts are counted
    whole. No words at all: all targets are 0. An empty table gives no rows; other columns are ignored.
    """
    text = F.col(f"`{text_col}`")
    body = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = materialize(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), words(text).alias("size"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("")).alias("key"), body.alias("body")), "sizes")
    totals = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    aims = targets(materialize(totals, "totals"), weights, cap).withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    aims = materialize(aims, "targets")
    tilts = balance(rows, aims, cap)
    of = aims.join(tilts, "key", "left").select("key", "source_size", "docs", "target", "mean", "tilt")
    z = F.col("size") / F.col("mean")
    rate = (F.when(F.col("size") == 0, 1.0).when(F.col("tilt") == math.inf, float(cap)).otherwise(_tilt(z, F.col("tilt"), cap)))
    # Rows alike are one item, up to ALIKE of them, so that a text repeated without end still spreads over buckets.
    alike = rows.groupBy("key", "doc_id", "body", "size").agg(F.count("*").alias("rows"))
    items = alike.select("key", "doc_id", "body", "size", "rows", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / ALIKE))).alias("nth"))
    items = items.withColumn("m", F.least(F.lit(ALIKE).cast("long"), F.col("rows") - F.col("nth") * ALIKE))
    dice = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "body", "nth")
    rated = items.join(of, "key").withColumn("rate", rate)
    item = F.struct((-F.col("size")).alias("a"), dice.alias("b"), F.col("rate").alias("d"), "m", F.col("doc_id").alias("c"), F.col("body").alias("e"))
    filled = rated.where("size > 0").withColumn("bucket", F.pmod(dice, F.ceil(F.col("docs") / BUCKET)))
    settled = (filled.repartition("key", "bucket").groupBy("key", "bucket").agg(F.sort_array(F.collect_list(item)).alias("items"))
               .withColumn("copies", _settle(F.col("items"), cap)).select("key", F.explode(F.arrays_zip("items", "copies")).alias("x")))
    settled = settled.select("key", F.col("x.items.c").alias("doc_id"), F.col("x.items.e").alias("body"), (-F.col("x.items.a")).alias("size"),
                             F.col("x.items.d").alias("rate"), F.col("x.items.m").alias("m"), F.col("x.copies").alias("total"))
    blank = rated.where("size = 0").select("key", "doc_id", "body", "size", "rate", "m", F.col("m").alias("total"))
    each = settled.unionByName(blank).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    copies = (F.floor(F.col("total") / F.col("m")) + (F.col("i") < F.col("total") % F.col("m")).cast("long")).cast("int")
    each = each.withColumn("copies", copies)
    return each.join(aims.select("key", "source", "source_size", "target"), "key").select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "body")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed table: each document as often as it has copies, with all its columns.

    Rows that repeat id, source and text share their copies out by number, as ``plan`` does; which
    of them gets one more is arbitrary where they differ in other columns.
    """
    made, mark, found, origin, alike, number = fresh(docs, "_copies", "_body", "_found_id", "_found_source", "_alike", "_number")
    shares = materialize(plan(docs, id_col, text_col, source_col, **how).groupBy("doc_id", "source", "body").agg(
        F.sum("copies").alias(made), F.count("*").alias(alike)).where(F.col(made) > 0), "shares")
    shares = shares.select(F.col("doc_id").alias(found), F.col("source").alias(origin), F.col("body").alias(mark), made, alike)
    body = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = docs.join(shares, F.col(f"`{id_col}`").eqNullSafe(F.col(found)) & F.col(f"`{source_col}`").eqNullSafe(F.col(origin)) & (body == F.col(mark)))
    times = F.col(made)
    if shares.where(F.col(alike) > 1).head(1):
        once = rows.where(F.col(alike) == 1).withColumn(number, F.lit(0).cast("long"))
        # Numbered over slices, so that one repeated row may be any share of the table.
        again = row_numbers(rows.where(F.col(alike) > 1).withColumn(number, F.monotonically_increasing_id()), [found, origin, mark], [number], name=f"{number}s")
        rows = once.unionByName(again.withColumn(number, F.col(f"{number}s") - 1).drop(f"{number}s"))
        times = F.floor(F.col(made) / F.col(alike)) + (F.col(number) < F.col(made) % F.col(alike)).cast("long")
    rows = rows.where(times > 0).withColumn(mark, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
