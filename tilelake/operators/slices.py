"""Running totals over ordered data without ever putting one key into one task.

A plain window sends every row of a key to a single task. Here the rows are range-partitioned on
(keys, order) into *slices* of similar size, so a key that owns a third of all rows spreads over
a third of the slices. Each slice runs its own window, and the totals of the slices before it
are added as a carry. A key can continue from one slice into the next only at the slice
boundary, so there is at most one carry row per slice: the carry table is bounded by the number
of slices, whatever the size of the data, and is safe to broadcast.

The sliced rows are written to the shared folder: slice numbers come from sampled range bounds
and must not change between the two passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilelake.session import materialize

SLICE, ROW = "_slice", "_row"
_ROW_MASK = (1 << 33) - 1

# op -> (aggregate, how a carry joins a local value)
_OPS = {
    "sum": (F.sum, lambda local, carry: F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
}


def slice_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Rows with ``_slice`` and ``_row`` (position in the slice), globally ordered by
    (keys, order). ``order`` must end in a unique column, else equal rows cannot be split.

    Without ``slices`` there are ``spark.sql.shuffle.partitions`` of them, which AQE merges (in
    order) where they are small.
    """
    by = [F.col(c) for c in (*keys, *order)]
    spread = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    ranged = (
        spread.sortWithinPartitions(*by)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(ROW, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)))
    )
    return materialize(ranged, "slices")


def continuing_keys(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The (slice, key) pairs whose key started in an earlier slice: at most one per slice."""
    ends = sliced.groupBy(SLICE).agg(F.max(ROW).alias("_last"))
    heads = sliced.where(F.col(ROW) == 0).select(SLICE, *keys)
    tails = (
        sliced.join(F.broadcast(ends), SLICE)
        .where(F.col(ROW) == F.col("_last"))
        .select(SLICE, F.struct(*keys).alias("_tail"))
    )
    # One row per slice: this ordering of a single partition holds as many rows as slices.
    w = Window.orderBy(SLICE)
    previous = tails.select(SLICE, F.lag("_tail").over(w).alias("_tail"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_tail.{k}"))
    return (
        heads.join(F.broadcast(previous), SLICE)
        .where(F.col("_tail").isNotNull() & same)
        .select(SLICE, *keys)
    )


def match_keys(left: DataFrame, small: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Null-safe join with a slice-bounded table, which is broadcast."""
    renamed = small.select(*[
        F.col(c).alias(f"_k_{c}") if c in columns else F.col(c) for c in small.columns
    ])
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns]
    joined = left.join(F.broadcast(renamed), on, how)
    return joined.drop(*[f"_k_{c}" for c in columns])


def _carries(
    sliced: DataFrame, keys: Sequence[str], specs: Mapping[str, tuple[str, Column]],
    origin: DataFrame | None = None,
) -> DataFrame:
    aggregates = [_OPS[op][0](value).alias(f"_c_{name}") for name, (op, value) in specs.items()]
    rows, continued = sliced, None
    if keys:
        continued = continuing_keys(sliced if origin is None else origin, keys)
        rows = match_keys(sliced, continued.select(*keys).distinct(), keys, "left_semi")
    totals = rows.groupBy(SLICE, *keys).agg(*aggregates)
    before = (
        Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        SLICE, *keys,
        *[
            _OPS[op][0](f"_c_{name}").over(before).alias(f"_c_{name}")
            for name, (op, _) in specs.items()
        ],
    )
    if continued is not None:
        carries = match_keys(carries, continued, [SLICE, *keys], "left_semi")
    return carries


def running(
    sliced: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    inclusive: Mapping[str, tuple[str, Column]] | None = None,
    exclusive: Mapping[str, tuple[str, Column]] | None = None,
    origin: DataFrame | None = None,
) -> DataFrame:
    """Add running ``sum``/``max``/``min`` columns per key, up to and with the row
    (``inclusive``) or up to the row before it (``exclusive``).

    ``origin`` names the written slices when ``sliced`` is derived from them, so that slice
    boundaries are read from the table and not from the derived plan.
    """
    inclusive, exclusive = inclusive or {}, exclusive or {}
    specs = {**inclusive, **exclusive}
    w = Window.partitionBy(SLICE, *keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.select(
        "*",
        *[_OPS[op][0](v).over(upto).alias(f"_l_{n}") for n, (op, v) in inclusive.items()],
        *[_OPS[op][0](v).over(before).alias(f"_l_{n}") for n, (op, v) in exclusive.items()],
    )
    carries = _carries(sliced, keys, specs, origin)
    joined = match_keys(local, carries, [SLICE, *keys], "left")
    kept = [c for c in sliced.columns]
    return joined.select(
        *kept,
        *[
            _OPS[op][1](F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n)
            for n, (op, _) in specs.items()
        ],
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number"
) -> DataFrame:
    """1, 2, 3 … per key (over everything without keys) in the given order."""
    sliced = slice_rows(df, keys, order)
    if keys:
        numbered = running(sliced, keys, order, inclusive={name: ("sum", F.lit(1))})
        return numbered.drop(SLICE, ROW).withColumn(name, F.col(name).cast("bigint"))
    # Without keys the position in the slice is known already: only the offsets are needed.
    offsets = _carries(sliced, [], {"n": ("sum", F.lit(1))})
    placed = match_keys(sliced, offsets, [SLICE], "left")
    number = (F.coalesce(F.col("_c_n"), F.lit(0)) + F.col(ROW) + 1).cast("bigint")
    return placed.withColumn(name, number).drop(SLICE, ROW, "_c_n")
