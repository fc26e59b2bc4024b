"""Per-key state machines over event time.

Rows wait in the state until the watermark has passed them and are then handled in time order,
so the result does not depend on how rows were split into micro-batches. Rows later than the
watermark are dropped by the engine.

Waiting rows are kept in map state, in parts that hold a stretch of time each, or some hundreds of
rows where a stretch has fewer: a batch adds parts with its own rows and touches no others, and only
parts that the watermark has reached are read and removed; what is left of small ones is put
together. So a key costs what a batch brings and what becomes due, however many of its rows are
waiting, and one with few rows costs a single part, since each call to the state takes longer than many rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WATERMARK = "10 minutes"


def use_rocksdb(spark: SparkSession) -> None:
    """Custom state needs the RocksDB store, which also keeps state off the JVM heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


STRETCH_US = 60_000_000  # of event time, whose rows a batch keeps together
STRETCHES = 16  # ... or so many longer ones, where its rows span more
LEAST = 500  # rows before a new stretch begins a new part
PART = 20_000  # rows that are written at once


class OrderedProcessor(StatefulProcessor):
    """Buffers rows until they are final; subclasses say what a row and a quiet time mean.

    ``buffer_schema`` lists the row columns after the key, starting with ``t bigint, id bigint``.
    ``memory_schema`` is one struct of state. ``output`` are the output columns after the key.
    """

    key_column = "client_id"
    buffer_schema = "t bigint, id bigint"
    memory_schema = ""
    columns: tuple[str, ...] = ()

    def start(self) -> tuple:
        raise NotImplementedError

    def row(self, memory: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError

    def quiet(self, memory: tuple, now_us: int) -> tuple[tuple, list[tuple]]:
        """What passing time alone brings about, given that no earlier rows are left."""
        return memory, []

    def wake_at(self, memory: tuple) -> int | None:
        """When ``quiet`` should be asked next, if rows do not come first."""
        return None

    # -- engine callbacks

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._names = [part.split()[0] for part in self.buffer_schema.split(", ")]
        arrays = ", ".join(f"{n} array<{part.split()[1]}>" for n, part in zip(self._names, self.buffer_schema.split(", "), strict=True))
        self._rows = handle.getMapState("rows", "part bigint", arrays)
        # The parts there are, with their earliest times.
        self._waiting = handle.getValueState("waiting", "parts array<bigint>, firsts array<bigint>")
        self._memory = handle.getValueState("memory", self.memory_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting = self._read_waiting()
        for pdf in rows:
            plain = pdf[self._names].astype(object).where(pdf[self._names].notna(), None)
            self._keep(waiting, sorted(plain.itertuples(index=False, name=None), key=lambda r: r[:2]))
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs(), waiting)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs(), self._read_waiting())

    def close(self) -> None:
        pass

    def _read_waiting(self) -> dict[int, int]:
        held = self._waiting.get()
        return dict(zip(*held, strict=True)) if held else {}

    def _keep(self, waiting: dict[int, int], rows: list[tuple], together: bool = False) -> None:
        """Add rows, in order, as new parts."""
        if not rows:
            return
        width = max(STRETCH_US, (rows[-1][0] - rows[0][0]) // STRETCHES + 1)
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or i - start == PART or not together and i - start >= LEAST and (rows[i][0] - rows[0][0]) // width != (rows[i - 1][0] - rows[0][0]) // width:
                part = max(waiting, default=-1) + 1
                self._rows.updateValue((part,), tuple(map(list, zip(*rows[start:i], strict=True))))
                waiting[part], start = rows[start][0], i

    def _take(self, waiting: dict[int, int], now: int) -> list[tuple]:
        """Remove the rows up to ``now`` and return them in order. A part that holds later rows too is cut there."""
        due: list[tuple] = []
        left: list[tuple] = []
        for part in [p for p, first in waiting.items() if first <= now]:
            rows = list(zip(*self._rows.getValue((part,)), strict=True))
            del waiting[part]
            self._rows.removeKey((part,))
            ready = [r for r in rows if r[0] <= now]
            due += ready
            if len(rows) - len(ready) < LEAST:
                left += rows[len(ready):]
            else:
                self._keep(waiting, rows[len(ready):], together=True)
        self._keep(waiting, sorted(left, key=lambda r: r[:2]), together=True)
        return sorted(due, key=lambda r: r[:2])

    def _advance(self, key, watermark_ms: int, waiting: dict[int, int]) -> Iterator[pd.DataFrame]:
        now = watermark_ms * 1000
        memory = tuple(self._memory.get() or self.start())
        out: list[tuple] = []
        for row in self._take(waiting, now):
            memory, made = self.quiet(memory, row[0] - 1)
            out += made
            memory, made = self.row(memory, row)
            out += made
            if len(out) >= PART:
                yield self._frame(key, out)
                out = []
        memory, made = self.quiet(memory, now)
        out += made
        self._memory.update(memory)
        if waiting:
            self._waiting.update(([*waiting], [*waiting.values()]))
        else:
            self._waiting.clear()
        self._set_timer([min(waiting.values(), default=None), self.wake_at(memory)], watermark_ms)
        if out:
            yield self._frame(key, out)

    def _frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(*key, *r) for r in rows], columns=[self.key_column, *self.columns])

    def _set_timer(self, times_us: list[int | None], watermark_ms: int) -> None:
        for old in list(self._handle.listTimers()):
            self._handle.deleteTimer(old)
        due = [t // 1000 for t in times_us if t is not None]
        if due:
            self._handle.registerTimer(max(min(due), watermark_ms + 1))


def run_ordered(
    events: DataFrame, processor: OrderedProcessor, output: str, watermark: str = WATERMARK,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Apply a processor to a stream with ``client_id, ts, req_id`` and ``extra`` columns."""
    use_rocksdb(events.sparkSession)
    timed = events.withWatermark("ts", watermark).where(F.col("ts").isNotNull()).select(
        processor.key_column, "ts", F.unix_micros("ts").alias("t"),
        F.col("req_id").alias("id"), *extra,
    )
    return timed.groupBy(processor.key_column).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=output,
        outputMode="Append",
        timeMode="EventTime",
    )
