"""Streams that need little or no custom state: dedup, windows and their totals, silence windows, outcome upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tilelake.operators.catalog import ITEM_IDENTITY
from tilelake.operators.logs import progress_windows
from tilelake.operators.plan import latest_outcome
from tilelake.session import scratch_path
from tilelake.streaming.ordered import WATERMARK, use_rocksdb


def stream_dedup(items: DataFrame, watermark: str | None = None) -> DataFrame:
    """Items as they arrive, each once.

    Without a watermark this is exact and the state grows with the number of items. With one,
    state is bounded and duplicates are caught only within the delay.
    """
    if watermark is None:
        return items.dropDuplicates(list(ITEM_IDENTITY))
    return items.withWatermark("item_ts", watermark).dropDuplicatesWithinWatermark(
        list(ITEM_IDENTITY)
    )


def stream_progress(
    progress: DataFrame, length: str = "1 minute", slide: str | None = None,
    watermark: str = WATERMARK,
) -> DataFrame:
    return progress_windows(progress.withWatermark("ts", watermark), length, slide)


class _Running(StatefulProcessor):
    """Adds windows up in time order. Windows arrive once each, when the watermark has passed them, so no later
    batch holds an earlier one; the state is two numbers."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._totals = handle.getValueState("totals", "nbytes bigint, files bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(list(rows)).sort_values("window_start")
        nbytes, files = self._totals.get() if self._totals.exists() else (0, 0)
        windows["total_bytes"] = windows["nbytes"].fillna(0).cumsum().astype("int64") + nbytes
        windows["total_files"] = windows["files"].cumsum().astype("int64") + files
        self._totals.update((int(windows["total_bytes"].iloc[-1]), int(windows["total_files"].iloc[-1])))
        yield windows[["window_start", "window_end", "nbytes", "events", "files", "total_bytes", "total_files"]]

    def close(self) -> None:
        pass


def stream_totals(progress: DataFrame, length: str = "1 minute", watermark: str = WATERMARK) -> DataFrame:
    """Each window's bytes, events and files, with the totals up to it, as ``logs.running_total`` gives them.

    ``progress`` has ``ts, nbytes`` and ``done``. Two stateful operators in one stream: the windows are
    aggregated in parallel, and only their rows, one each, meet in the running total.
    """
    use_rocksdb(progress.sparkSession)
    windows = stream_progress(progress, length, watermark=watermark)
    return windows.withColumn("all", F.lit(0)).groupBy("all").transformWithStateInPandas(
        statefulProcessor=_Running(),
        outputStructType="window_start timestamp, window_end timestamp, nbytes bigint, events bigint, files bigint, total_bytes bigint, total_files bigint",
        outputMode="Append", timeMode="None",
    )


def silence_windows(
    progress: DataFrame, seconds: int = 30, watermark: str | None = WATERMARK
) -> DataFrame:
    """Stretches of activity per transfer that end with a silence of ``seconds``."""
    if watermark:
        progress = progress.withWatermark("ts", watermark)
    w = F.session_window("ts", f"{seconds} seconds")
    return progress.groupBy("client_id", w.alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("nbytes").alias("nbytes")
    ).select("client_id", F.col("w.start").alias("start"), F.col("w.end").alias("silent_at"),
             "events", "nbytes")


# -- outcome snapshots ----------------------------------------------------------------------


def outcome_upsert(outcomes: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the latest outcome per asset while outcomes arrive.

    A batch only writes its own latest outcomes, under its batch number, so the cost of a batch
    does not grow with the history and a repeated batch replaces itself. ``current_outcomes``
    reads the state; ``compact_outcomes`` folds old batches into a new version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_outcome(batch).write.mode("overwrite").parquet(f"{path}/deltas/batch={batch_id}")

    return (
        outcomes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_outcomes(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Latest outcome per asset from a compacted version (if any) and the batches after it."""
    deltas = spark.read.parquet(f"{path}/deltas")
    if version is None:
        return latest_outcome(deltas.drop("batch"))
    base = spark.read.parquet(f"{path}/versions/version={version}")
    newer = deltas.where(F.col("batch") > version).drop("batch")
    return latest_outcome(base.unionByName(newer))


def compact_outcomes(
    spark: SparkSession, path: str, batch: int, previous: int | None = None
) -> int:
    """Write version ``batch``: everything up to and with that batch. Returns the version."""
    deltas = spark.read.parquet(f"{path}/deltas").where(F.col("batch") <= batch)
    rows = deltas.drop("batch")
    if previous is not None:
        base = spark.read.parquet(f"{path}/versions/version={previous}")
        rows = base.unionByName(deltas.where(F.col("batch") > previous).drop("batch"))
    latest_outcome(rows).write.parquet(f"{path}/versions/version={batch}")
    return batch


# -- running a stream to its end ------------------------------------------------------------


def run_to_table(
    source: DataFrame, build: Callable[[DataFrame], DataFrame], label: str = "stream",
    output_mode: str = "append", state_partitions: int | None = None,
) -> DataFrame:
    """Process everything a stream has now, into a table in the shared folder.

    The number of state partitions is fixed for the life of a checkpoint; one per core unless
    given.
    """
    spark = source.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    result = build(source)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    count = state_partitions or spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    try:
        query = (
            result.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).outputMode(output_mode)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return spark.read.schema(result.schema).parquet(out)
