"""Structured Streaming operators over files derived from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F


from tilelake.plans.fixtures import view
from tilelake.queries.logs import _CHAIN_SQL, COOLDOWN_S, HOUR, SESSION_SQL, TTL_S, WINDOW_S, request_log
from tilelake.queries.registry import query
from tilelake.session import scratch_path
from tilelake.sources.tables import read_request_log
from tilelake.streaming import flows, machines

_CLOSING = -1  # client of the row that moves the watermark past all others


def log_stream(spark, sf):
    """The request log as a stream, with a last row far in the future so that all is final."""
    log = request_log(spark, sf)
    closing = log.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("bigint").alias("req_id"), (F.col("ts") + F.expr("INTERVAL 60 DAYS")).alias("ts"),
        F.lit(_CLOSING).cast("bigint").alias("client_id"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("retry_after"),
        F.lit(None).cast("string").alias("location"), F.lit(0).cast("bigint").alias("nbytes"))
    path = scratch_path(spark, "log-stream")
    log.unionByName(closing).write.parquet(path)
    return read_request_log(spark, path, stream=True)


def finished(rows):
    return rows.where(F.col("client_id") != _CLOSING)


@query("stream_breaker", f"""{_CHAIN_SQL}
SELECT r.client_id, r.req_id, t.req_id IS NOT NULL AS tripped, coalesce(r.ts < max(t.open_until) OVER (
  PARTITION BY r.client_id ORDER BY r.ts, r.req_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS blocked
FROM request_log r LEFT JOIN trips t ON t.req_id = r.req_id""", recursive=True)
def stream_breaker(spark, sf):
    out = flows.run_to_table(log_stream(spark, sf), lambda s: machines.breaker(s, 3, WINDOW_S, COOLDOWN_S))
    return finished(out).select("client_id", "req_id", "tripped", "blocked")


@query("stream_token_bucket", """
SELECT client_id, req_id, greatest(t, coalesce(base + (n - 4) * 1000000000, t)) - t AS wait_us FROM (
  SELECT client_id, req_id, t, n, max(t - (n - 1) * 1000000000) OVER (PARTITION BY client_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM (
    SELECT client_id, req_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY client_id ORDER BY ts, req_id) AS n FROM request_log) a) b""")
def stream_token_bucket(spark, sf):
    out = flows.run_to_table(log_stream(spark, sf), lambda s: machines.token_bucket(s, 0.001, 4))
    return finished(out).select("client_id", "req_id", "wait_us")


@query("stream_sessions", SESSION_SQL, recursive=True)
def stream_sessions(spark, sf):
    out = flows.run_to_table(log_stream(spark, sf), lambda s: machines.fixed_ttl_sessions(s, TTL_S))
    return finished(out).select("client_id", "opened", "last", "events")


@query("stream_stalls", """
SELECT client_id, epoch_us(ts) AS since, resume_offset::bigint AS resume_offset FROM (
  SELECT client_id, ts, lead(ts) OVER w AS following, sum(nbytes) OVER (PARTITION BY client_id ORDER BY ts, req_id ROWS UNBOUNDED PRECEDING) AS resume_offset
  FROM progress WINDOW w AS (PARTITION BY client_id ORDER BY ts, req_id)) t WHERE following IS NULL OR epoch_us(following) - epoch_us(ts) > 21600000000""")
def stream_stalls(spark, sf):
    out = flows.run_to_table(log_stream(spark, sf).where("status = 200"), lambda s: machines.stall_alerts(s, 6 * HOUR))
    return finished(out).select("client_id", "since", "resume_offset")


@query("stream_progress", """
SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, sum(nbytes)::bigint AS nbytes, count(*) AS events FROM progress GROUP BY 1""")
def stream_progress(spark, sf):
    out = flows.run_to_table(log_stream(spark, sf).where("status = 200"), lambda s: flows.stream_progress(s, "1 hour"))
    return out.select(F.unix_micros("window_start").alias("start_us"), "nbytes", "events")


@query("stream_totals", """
SELECT start_us, nbytes, events, files, sum(nbytes) OVER (ORDER BY start_us)::bigint AS total_bytes, sum(files) OVER (ORDER BY start_us)::bigint AS total_files FROM (
  SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, sum(nbytes)::bigint AS nbytes, count(*) AS events, count(*) FILTER (WHERE req_id % 4 = 0) AS files FROM progress GROUP BY 1) w""")
def stream_totals(spark, sf):
    log = log_stream(spark, sf).where("status = 200").withColumn("done", F.col("req_id") % 4 == 0)
    out = flows.run_to_table(log, lambda s: flows.stream_totals(s, "1 hour"))
    return out.select(F.unix_micros("window_start").alias("start_us"), "nbytes", "events", "files", "total_bytes", "total_files")


@query("stream_silence", """
SELECT client_id, min(t) AS start_us, max(t) + 21600000000 AS silent_us, count(*) AS events, sum(nbytes)::bigint AS nbytes FROM (
  SELECT *, sum(opens) OVER (PARTITION BY client_id ORDER BY t, req_id) AS run FROM (
    SELECT client_id, req_id, epoch_us(ts) AS t, nbytes, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY client_id ORDER BY ts, req_id) < 21600000000 THEN 0 ELSE 1 END AS opens
    FROM progress) a) b GROUP BY client_id, run""")
def stream_silence(spark, sf):
    out = flows.run_to_table(log_stream(spark, sf).where("status = 200"), lambda s: flows.silence_windows(s, 6 * HOUR))
    return finished(out).select("client_id", F.unix_micros("start").alias("start_us"), F.unix_micros("silent_at").alias("silent_us"), "events", "nbytes")


def _item_stream(spark, sf):
    path = scratch_path(spark, "items-stream")
    items = view(spark, sf, "cat_items_raw").withColumn("item_ts", F.col("item_ts").cast("timestamp"))
    items.select("collection_id", "item_id", "size_bytes", "item_ts").write.parquet(path)
    return spark.readStream.schema("collection_id string, item_id string, size_bytes bigint, item_ts timestamp").parquet(path)


@query("stream_dedup", "SELECT DISTINCT collection_id, item_id, size_bytes FROM cat_items_raw")
def stream_dedup(spark, sf):
    out = flows.run_to_table(_item_stream(spark, sf), flows.stream_dedup)
    return out.select("collection_id", "item_id", "size_bytes")


@query("stream_dedup_bounded", "SELECT DISTINCT collection_id, item_id, size_bytes FROM cat_items_raw")
def stream_dedup_bounded(spark, sf):
    """Copies of an item carry its time, so any watermark finds them all."""
    out = flows.run_to_table(_item_stream(spark, sf), lambda s: flows.stream_dedup(s, "1 day"))
    return out.select("collection_id", "item_id", "size_bytes")


@query("outcome_upsert", """
SELECT collection_id, item_id, run_id, status FROM (SELECT *, row_number() OVER (
  PARTITION BY collection_id, item_id, asset_key ORDER BY finished_at DESC, run_id DESC) AS rn FROM outcomes) t WHERE rn = 1""")
def outcome_upsert(spark, sf):
    path, target, state = (scratch_path(spark, n) for n in ("outcomes", "upsert", "upsert-state"))
    outcomes = view(spark, sf, "outcomes").withColumn("finished_at", F.col("finished_at").cast("timestamp"))
    outcomes.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(outcomes.schema).option("maxFilesPerTrigger", 1).parquet(path)
    flows.outcome_upsert(stream, target, state).awaitTermination()
    version = flows.compact_outcomes(spark, target, 1)
    return flows.current_outcomes(spark, target, version).select("collection_id", "item_id", "run_id", "status")


@query("batch_silence", """
SELECT client_id, min(t) AS start_us, count(*) AS events FROM (
  SELECT *, sum(opens) OVER (PARTITION BY client_id ORDER BY t, req_id) AS run FROM (
    SELECT client_id, req_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY client_id ORDER BY ts, req_id) < 21600000000 THEN 0 ELSE 1 END AS opens
    FROM progress) a) b GROUP BY client_id, run""")
def batch_silence(spark, sf):
    rows = flows.silence_windows(request_log(spark, sf).where("status = 200"), 6 * HOUR, watermark=None)
    return rows.select("client_id", F.unix_micros("start").alias("start_us"), "events")


