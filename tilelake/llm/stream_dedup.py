"""Exact deduplication as a stream with disk-backed state that never expires.

Two streams run one after the other, each with its own checkpoint, so either can be stopped and
taken up again and new files only cost their own rows:

1. ``index``: documents to digest, stable id and content locator (file and row), one row each;
2. ``state``: per digest the smallest locator-bearing row that stays and the number of rows, as a
   streaming aggregate in RocksDB without a watermark. Rows of a digest meet in the partial
   aggregate first, so a digest with a third of all rows is one row per task when it shuffles.

Digest hits are then checked on full bytes: every row of a digest held twice is joined with the
text its state's locator names. Rows whose bytes differ are grouped again by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.llm.common import ascii_lower
from tilelake.session import materialize, scratch_path

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BYTES_PER_BATCH = 64 << 30


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _session(spark: SparkSession) -> SparkSession:
    """A session of its own, so that the caller's settings stay as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.files.maxPartitionBytes"):
        if (value := spark.conf.get(key, None)) is not None:
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # No space is set aside ahead of time, which small states of many partitions would leave empty.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    return own


def _located(source: DataFrame, id_col: str, text_col: str, normal: Callable[[Column], Column]) -> DataFrame:
    text = normal(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    about = source.metadataColumn("_metadata")  # of the file, even where the table has a column of that name
    return source.select(
        F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"),
        F.struct(about["file_path"].alias("file"), about["row_index"].alias("row")).alias("at"))


def index_stream(
    spark: SparkSession, path: str, root: str, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, normal: Callable[[Column], Column] = ascii_lower, bytes_per_batch: int = BYTES_PER_BATCH,
) -> None:
    """Add the documents that ``path`` has gained since the last call to the index under ``root``."""
    schema = spark.read.parquet(path).schema
    # As a pattern, the path may be one file as well as a folder.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    source = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(pattern)
    rows = _located(source, id_col, text_col, normal).select("doc_id", "at", digest(F.col("text")).alias("digest"))
    (rows.writeStream.format("parquet").option("path", f"{root}/index").option("checkpointLocation", f"{root}/index-log")
     .trigger(availableNow=True).start().awaitTermination())


def state_stream(spark: SparkSession, root: str, schema, bytes_per_batch: int = BYTES_PER_BATCH) -> None:
    """Fold new index rows into the keyed state, and append each changed key with its batch."""
    own = _session(spark)
    source = own.readStream.schema(schema).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(f"{root}/index")
    state = source.groupBy("digest").agg(
        F.max(F.struct(F.col("doc_id"), F.col("at"))).alias("best"), F.count("*").alias("held"))

    def upsert(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/state/batch={batch}")

    (state.writeStream.outputMode("update").option("checkpointLocation", f"{root}/state-log")
     .foreachBatch(upsert).trigger(availableNow=True).start().awaitTermination())


def dedup(
    spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", root: str | None = None,
    digest: Callable[[Column], Column] = sha256, normal: Callable[[Column], Column] = ascii_lower, bytes_per_batch: int = BYTES_PER_BATCH,
) -> DataFrame:
    """One row per document of the Parquet files at ``path``: ``doc_id, keep_id, group_size, kept, digest``.

    Texts are equal when ``normal`` makes them so (default: A-Z lower-cased); null is the empty text.
    The row with the largest id stays; of repeated ids the one with the largest locator. Null ids are
    smaller than all others. Very long texts are compared whole. An empty table gives no rows; other columns are never read. ``root`` is
    the folder of index, state and logs: give the same one again to add files that have come since.
    """
    root = root or scratch_path(spark, "stream-dedup")
    kind = dict(spark.read.parquet(path).select(F.col(f"`{id_col}`").alias("doc_id")).dtypes)["doc_id"]
    at = "struct<file: string, row: bigint>"
    index_schema = f"doc_id {kind}, at {at}, digest string"
    state_schema = f"digest string, best struct<doc_id: {kind}, at: {at}>, held bigint"
    # Both tables exist even if no batch ever runs.
    spark.createDataFrame([], index_schema).write.mode("append").parquet(f"{root}/index")
    spark.createDataFrame([], state_schema).write.mode("overwrite").parquet(f"{root}/state/batch=-1")
    index_stream(spark, path, root, id_col, text_col, digest, normal, bytes_per_batch)
    index = spark.read.schema(index_schema).parquet(f"{root}/index")
    state_stream(spark, root, index.schema, bytes_per_batch)
    state = spark.read.schema(f"{state_schema}, batch bigint").parquet(f"{root}/state")
    state = state.groupBy("digest").agg(F.max_by(F.struct("best", "held"), "batch").alias("s"))
    hits = materialize(state.where("s.held > 1").select("digest", "s.best", "s.held"), "hits")

    # Copies grow with the table, so their digests are never broadcast: the same plan at every size.
    # Full bytes of every row of a digest that is held more than once, next to those of the row that stays.
    docs = _located(spark.read.parquet(path), id_col, text_col, normal).withColumn("digest", digest(F.col("text")))
    members = materialize(docs.join(hits.hint("merge"), "digest").select("doc_id", "at", "digest", "text", (F.col("at") == F.col("best.at")).alias("stays")), "members")
    stay = members.where("stays").select("digest", F.col("text").alias("stay_text"))
    differ = materialize(members.join(stay, "digest").where("text <> stay_text").select("doc_id", "at", "digest", "text"), "differ")
    apart = differ.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "at")).alias("best"), F.count("*").alias("held"))
    apart = differ.join(apart, ["digest", "text"]).select("at", F.struct("best", "held").alias("apart"))
    moved = differ.groupBy("digest").agg(F.count("*").alias("moved"))

    whole = hits.join(moved, "digest", "left").select(
        "digest", F.struct("best", (F.col("held") - F.coalesce("moved", F.lit(0))).alias("held")).alias("whole"))
    alone = F.struct(F.struct("doc_id", "at").alias("best"), F.lit(1).cast("long").alias("held"))
    rows = index.join(materialize(whole, "whole"), "digest", "left").join(apart, "at", "left")
    return rows.withColumn("g", F.coalesce("apart", "whole", alone)).select(
        "doc_id", F.col("g.best.doc_id").alias("keep_id"), F.col("g.held").alias("group_size"),
        (F.col("at") == F.col("g.best.at")).alias("kept"), F.col("digest"))
