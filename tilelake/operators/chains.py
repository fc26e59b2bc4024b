"""Greedy spaced selection: the first element of a key, then always the next element at least
``step`` further on.

Fixed-lifetime sessions (next event after expiry) and circuit-breaker trips (next tripping
failure once the failure list was cleared) are both this chain. It is sequential by nature, but
a slice of ordered rows only needs to know where the chain stood when it entered:

1. rows are cut into slices (see ``slices``), so that hot keys spread out;
2. for keys that continue from slice to slice, each slice works out, for every place the chain
   could enter, where it would stand at the end. Neighbouring entries mostly end alike and are
   merged into runs;
3. each run is linked to the run of a later slice where the chain enters next. Which runs lie on
   the chain from the key's first slice follows by pointer doubling: links of 1, 2, 4 ... runs are
   joined from the links half as long, and the chain is marked with the longest first;
4. every slice marks its own rows, given the entry found in step 3.

No task ever sees more than a slice's rows or runs. The chain itself has at most one run per slice
and key that continues into it, as have the borders of the slices: only these are broadcast.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.operators.slices import ROW, SLICE, continuing_keys, match_keys, slice_rows
from tilelake.session import materialize


def _exits(positions: np.ndarray, step: int) -> np.ndarray:
    """Index of the last chain element inside the slice, for a chain entering at each index."""
    n = len(positions)
    jump = np.searchsorted(positions, positions + step, side="left")
    last = np.arange(n)
    jump = np.where(jump < n, jump, last)
    while True:  # pointer doubling: log2(chain length) rounds
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump
        jump = further


# Keys travel through Python as one text column: it is never NULL and never rounded.
KEY = "_key"


NODE, NEXT = "_node", "_next"
_SLICE_BITS = 33  # a slice's runs are numbered below


def _runs(pos: str, step: int, borders):
    def one_slice(pdf: pd.DataFrame) -> pd.DataFrame:
        parts, count = [], 0
        for key, part in pdf.sort_values(ROW).groupby(KEY, sort=False):
            positions = part[pos].to_numpy(np.int64)
            exits = positions[_exits(positions, step)]
            at = int(part[SLICE].iloc[0])
            continues = bool(part["_continues"].iloc[0])
            if continues:
                # The chain enters at the first element within one step, or just beyond it.
                reach = np.searchsorted(positions, positions[0] + step, side="right") + 1
                entries, exits = positions[:reach], exits[:reach]
                ends = np.append(np.nonzero(np.diff(exits))[0], len(exits) - 1)
            else:
                entries, ends = positions[:1], np.array([0])
            # The slice that holds the first element beyond the exit's step, if any does.
            lasts, slices = borders.value.get(key, ((), ()))
            to = np.searchsorted(np.array(lasts, np.int64), exits[ends] + step, side="left")
            target = np.append(np.array(slices, np.int64), -1)[to]
            parts.append(pd.DataFrame({
                SLICE: at, KEY: key, NODE: (at << _SLICE_BITS) + count + np.arange(len(ends)), "first": not continues,
                "entry_hi": entries[ends], "exit": exits[ends], "target": np.where(target > at, target, -1),
            }))
            count += len(ends)
        return pd.concat(parts)

    return one_slice


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """For a slice's runs and the chains that enter there: from each chain's run to the one it enters by."""
    parts = []
    for _, part in pdf.groupby(KEY, sort=False):
        own = part[~part["enters"]].sort_values("at")
        come = part[part["enters"]]
        to = np.searchsorted(own["at"].to_numpy(np.int64), come["at"].to_numpy(np.int64), side="left")
        found = to < len(own)
        parts.append(pd.DataFrame({NODE: come[NODE].to_numpy()[found], NEXT: own[NODE].to_numpy()[to[found]]}))
    return pd.concat(parts) if parts else pd.DataFrame({NODE: [], NEXT: []}, dtype="int64")


def _on_chain(runs: DataFrame, step: int) -> DataFrame:
    """The runs that the chains of their keys go through: ``_slice, _key, exit``."""
    doors = runs.select(SLICE, KEY, NODE, F.col("entry_hi").alias("at"), F.lit(False).alias("enters"))
    come = runs.where("target >= 0").select(F.col("target").cast("int").alias(SLICE), KEY, NODE, (F.col("exit") + step).alias("at"), F.lit(True).alias("enters"))
    links = doors.unionByName(come).groupBy(SLICE).applyInPandas(_links, f"{NODE} bigint, {NEXT} bigint")
    jumps = [materialize(links, "links")]
    while jumps[-1].head(1):
        near, far = jumps[-1], jumps[-1].select(F.col(NODE).alias(NEXT), F.col(NEXT).alias("_far"))
        jumps.append(materialize(near.join(far, NEXT).select(NODE, F.col("_far").alias(NEXT)), "links"))
    marked = runs.where("first").select(NODE)
    for jump in reversed(jumps[:-1]):
        further = jump.join(F.broadcast(marked), NODE).select(F.col(NEXT).alias(NODE))
        marked = materialize(marked.unionByName(further), "chain")
    return runs.join(F.broadcast(marked), NODE, "left_semi").select(SLICE, KEY, "exit")


def _marks(pos: str, step: int, columns: list[str]):
    def one_slice(table: pa.Table) -> pa.Table:
        table = table.sort_by(ROW)
        positions, heads_in = table[pos].to_pylist(), table["_head_in"].to_pylist()
        keys = np.asarray(table[KEY].to_pylist(), dtype=object)
        cuts = (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()
        heads = np.empty(len(positions), np.int64)
        for lo, hi in zip([0, *cuts], [*cuts, len(positions)], strict=True):
            head = positions[lo] if heads_in[lo] is None else heads_in[lo]
            start = lo
            while start < hi:
                following = bisect_left(positions, head + step, start, hi)
                heads[start:following] = head
                start = following
                if start < hi:
                    head = positions[start]
        return table.select(columns).append_column("_head", pa.array(heads))

    return one_slice


def greedy_chain(
    df: DataFrame, keys: Sequence[str], pos: str, step: int, order: Sequence[str] = ()
) -> DataFrame:
    """Add ``_head``: the position of the chain element in force at each row.

    A row is itself selected when its position equals ``_head``. ``pos`` is a bigint column
    without NULL; ``order`` breaks ties so that equal positions can be split.
    """
    if step <= 0:
        raise ValueError("step must be positive")
    named = df.withColumn(KEY, F.to_json(F.struct(*keys)))
    sliced = slice_rows(named, [KEY], [pos, *order])
    continued = continuing_keys(sliced, [KEY])

    rows = match_keys(
        sliced.select(SLICE, ROW, KEY, pos), continued.select(KEY).distinct(), [KEY], "left_semi"
    )
    flagged = match_keys(
        rows, continued.withColumn("_continues", F.lit(True)), [SLICE, KEY], "left"
    ).withColumn("_continues", F.coalesce("_continues", F.lit(False)))
    # One row per slice and key that continues: bounded by the slices.
    last = flagged.groupBy(KEY, SLICE).agg(F.max(pos).alias("last")).orderBy(KEY, SLICE).collect()
    found: dict[str, tuple[list[int], list[int]]] = {}
    for r in last:
        lasts, slices = found.setdefault(r[KEY], ([], []))
        lasts.append(r["last"])
        slices.append(r[SLICE])
    borders = df.sparkSession.sparkContext.broadcast(found)
    runs = materialize(flagged.groupBy(SLICE).applyInPandas(
        _runs(pos, step, borders),
        f"{SLICE} int, {KEY} string, {NODE} bigint, first boolean, entry_hi bigint, exit bigint, target bigint",
    ), "runs")
    # A slice's chain comes from the last run before it; again one row per slice.
    before = Window.partitionBy(KEY).orderBy(SLICE, "asks").rowsBetween(Window.unboundedPreceding, -1)
    chain = _on_chain(runs, step).select(SLICE, KEY, "exit", F.lit(1).alias("asks"))
    asked = continued.select(SLICE, KEY, F.lit(None).cast("bigint").alias("exit"), F.lit(0).alias("asks"))
    entries = (
        chain.unionByName(asked)
        .withColumn("_head_in", F.last("exit", ignorenulls=True).over(before))
        .where("asks = 0").select(SLICE, KEY, "_head_in")
    )
    schema = T.StructType([*df.schema.fields, T.StructField("_head", T.LongType())])
    return (
        match_keys(sliced, entries, [SLICE, KEY], "left")
        .groupBy(SLICE)
        .applyInArrow(_marks(pos, step, df.columns), schema)
    )
