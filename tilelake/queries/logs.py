"""Request, pause and transfer logs in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilelake.functions.http import is_throttled
from tilelake.operators import logs
from tilelake.plans.fixtures import view
from tilelake.queries.registry import query

HOUR = 3600
# Requests of the test log are minutes apart, so the policy windows are scaled up.
WINDOW_S, COOLDOWN_S, TTL_S = 24 * HOUR, 12 * HOUR, 24 * HOUR


def request_log(spark, sf):
    log = view(spark, sf, "request_log")
    return log.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("status", F.col("status").cast("int"))


def us(column: str, name: str | None = None):
    return F.unix_micros(F.col(column)).alias(name or column)


def pauses(spark, sf):
    p = view(spark, sf, "pauses")
    start = F.col("start_ts").cast("timestamp")
    return p.select("pause_id", start.alias("start"), F.timestamp_micros(F.unix_micros(start) + F.col("seconds") * 1_000_000).alias("end"))


def progress(spark, sf):
    return view(spark, sf, "progress").withColumn("ts", F.col("ts").cast("timestamp"))


_ISLANDS_SQL = """(SELECT min(s) AS s, max(e) AS e, count(*) AS parts FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, max(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (
      SELECT epoch_us(start_ts) AS s, epoch_us(start_ts) + seconds * 40000000::bigint AS e FROM pauses) p) r) i GROUP BY island) merged"""


def _long_pauses(spark, sf):
    """Pauses stretched fortyfold so that many overlap."""
    p = view(spark, sf, "pauses")
    start = F.col("start_ts").cast("timestamp")
    return p.select("pause_id", start.alias("start"), F.timestamp_micros(
        F.unix_micros(start) + F.col("seconds") * F.lit(40_000_000).cast("bigint")).alias("end"))


@query("merge_intervals", f"SELECT s AS start_us, e AS end_us, parts FROM {_ISLANDS_SQL}")
def merge_intervals(spark, sf):
    return logs.merge_intervals(_long_pauses(spark, sf)).select(us("start", "start_us"), us("end", "end_us"), "parts")


@query("paused_seconds", f"SELECT sum(e - s)::bigint AS paused_us FROM {_ISLANDS_SQL}")
def paused_seconds(spark, sf):
    return logs.paused_seconds(_long_pauses(spark, sf))


_CHAIN_SQL = """WITH fails AS (SELECT client_id, req_id, ts, row_number() OVER w AS num, lag(ts, 2) OVER w AS kth FROM request_log WHERE status IN (429, 503) WINDOW w AS (PARTITION BY client_id ORDER BY ts, req_id)),
cand AS (SELECT * FROM fails WHERE kth >= ts - INTERVAL 24 HOUR),
chain AS (SELECT client_id, min(num) AS num FROM cand GROUP BY client_id UNION ALL
          SELECT c.client_id, min(d.num) FROM chain c JOIN cand d ON d.client_id = c.client_id AND d.num >= c.num + 3 GROUP BY c.client_id),
trips AS (SELECT d.client_id, d.req_id, d.ts, d.ts + INTERVAL 12 HOUR AS open_until FROM chain c JOIN cand d ON d.client_id = c.client_id AND d.num = c.num)
"""


def _trips(spark, sf):
    return logs.breaker_trips(request_log(spark, sf), 3, WINDOW_S, COOLDOWN_S)


@query("throttle_stats", f"""{_CHAIN_SQL}
SELECT (SELECT count(*) FROM request_log WHERE status IN (429, 503)) AS throttled_responses, (SELECT count(*) FROM trips) AS breaker_trips,
       (SELECT sum(e - s)::bigint FROM {_ISLANDS_SQL}) AS paused_us""", recursive=True)
def throttle_stats(spark, sf):
    return logs.throttle_stats(request_log(spark, sf), _long_pauses(spark, sf), _trips(spark, sf))


@query("rolling_failures", """
SELECT req_id, failures, failures >= 5 AS candidate FROM (SELECT req_id, count(*) FILTER (WHERE status IN (429, 503)) OVER (
  ORDER BY ts RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW) AS failures FROM request_log) t""")
def rolling_failures(spark, sf):
    return logs.rolling_failures(request_log(spark, sf), 3 * HOUR, 5)


@query("rolling_failures_by_client", """
SELECT client_id, req_id, failures, failures >= 3 AS candidate FROM (SELECT client_id, req_id, count(*) FILTER (WHERE status IN (429, 503)) OVER (
  PARTITION BY client_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS failures FROM request_log) t""")
def rolling_failures_by_client(spark, sf):
    return logs.rolling_failures(request_log(spark, sf), WINDOW_S, 3, ["client_id"])


@query("breaker_trips", f"{_CHAIN_SQL} SELECT client_id, req_id, epoch_us(ts) AS t, epoch_us(open_until) AS open_until FROM trips", recursive=True)
def breaker_trips(spark, sf):
    return _trips(spark, sf).select("client_id", "req_id", us("ts", "t"), us("open_until"))


@query("breaker_labels", f"""{_CHAIN_SQL}
SELECT client_id, req_id, coalesce(ts < held, false) AS blocked FROM (SELECT r.client_id, r.req_id, r.ts, max(t.open_until) OVER (
  PARTITION BY r.client_id ORDER BY r.ts, r.req_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM request_log r LEFT JOIN trips t ON t.req_id = r.req_id) x""", recursive=True)
def breaker_labels(spark, sf):
    log = request_log(spark, sf)
    return logs.breaker_labels(log, _trips(spark, sf)).select("client_id", "req_id", "blocked")


@query("breaker_trips_global", f"""{_CHAIN_SQL.replace('PARTITION BY client_id ORDER', 'ORDER').replace('lag(ts, 2)', 'lag(ts, 4)').replace('INTERVAL 24 HOUR', 'INTERVAL 3 HOUR').replace('+ 3', '+ 5').replace('SELECT client_id, req_id, ts, row', 'SELECT 0 AS client_id, req_id, ts, row')}
SELECT req_id, epoch_us(ts) AS t FROM trips""", recursive=True)
def breaker_trips_global(spark, sf):
    # One breaker for the whole run: every row has the same key, and still spreads over slices.
    log = request_log(spark, sf).withColumn("run", F.lit(0))
    return logs.breaker_trips(log, 5, 3 * HOUR, COOLDOWN_S, ["run"]).select("req_id", us("ts", "t"))


@query("retry_after_deadline", """
SELECT req_id, epoch_us(in_force) AS in_force, greatest(coalesce(epoch_us(in_force) - epoch_us(ts), 0), 0) AS wait_us FROM (
  SELECT req_id, ts, max(ts + cast(retry_after AS int) * INTERVAL 1 SECOND) OVER (ORDER BY ts, req_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS in_force FROM request_log) t""")
def retry_after_deadline(spark, sf):
    return logs.retry_after_deadline(request_log(spark, sf)).select("req_id", us("in_force"), "wait_us")


_BUCKET_SQL = """(SELECT client_id, req_id, t, n, max(t - (n - 1) * 1000000000) OVER (PARTITION BY client_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM (
  SELECT client_id, req_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY client_id ORDER BY ts, req_id) AS n FROM request_log) a) b"""


@query("token_bucket", f"""
SELECT client_id, req_id, greatest(t, coalesce(base + (n - 4) * 1000000000, t)) - t AS wait_us FROM {_BUCKET_SQL}""")
def token_bucket(spark, sf):
    # The slowest rate that is kept (1/1000 per second), since the log is sparse.
    return logs.token_bucket(request_log(spark, sf), 0.001, 4).select("client_id", "req_id", "wait_us")


@query("stalls", """
SELECT client_id, req_id, epoch_us(since) AS since, gap_us, resume_offset::bigint AS resume_offset FROM (
  SELECT client_id, req_id, lag(ts) OVER w AS since, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS gap_us,
         sum(nbytes) OVER (PARTITION BY client_id ORDER BY ts, req_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS resume_offset
  FROM progress WINDOW w AS (PARTITION BY client_id ORDER BY ts, req_id)) t WHERE gap_us > 21600000000""")
def stalls(spark, sf):
    return logs.stalls(progress(spark, sf), 6 * HOUR).select("client_id", "req_id", us("since"), "gap_us", "resume_offset")


@query("progress_windows", """
SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, sum(nbytes)::bigint AS nbytes, count(*) AS events FROM progress GROUP BY 1""")
def progress_windows(spark, sf):
    return logs.progress_windows(progress(spark, sf), "1 hour").select(us("window_start", "start_us"), "nbytes", "events")


@query("progress_sliding", """
SELECT s AS start_us, sum(nbytes)::bigint AS nbytes, count(*) AS events, cast(floor(sum(nbytes)::double / 7200.0::double * 1000 + 0.5) AS bigint) AS millibytes_per_s FROM (
  SELECT nbytes, epoch_us(time_bucket(INTERVAL 30 MINUTE, ts)) - k * 1800000000 AS s FROM progress, range(4) r(k)) t GROUP BY s""")
def progress_sliding(spark, sf):
    out = logs.progress_windows(progress(spark, sf), "2 hours", "30 minutes")
    return out.select(us("window_start", "start_us"), "nbytes", "events", F.floor(F.col("bytes_per_s") * 1000 + 0.5).cast("bigint").alias("millibytes_per_s"))


@query("running_total", """
SELECT s AS start_us, (sum(nbytes) OVER (ORDER BY s))::bigint AS total_bytes FROM (
  SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS s, sum(nbytes) AS nbytes FROM progress GROUP BY 1) t""")
def running_total(spark, sf):
    windows = logs.progress_windows(progress(spark, sf), "1 hour")
    return logs.running_total(windows).select(us("window_start", "start_us"), "total_bytes")


SESSION_SQL = """WITH ev AS (SELECT client_id, ts FROM request_log),
chain AS (SELECT client_id, min(ts) AS ts FROM ev GROUP BY client_id UNION ALL
          SELECT c.client_id, min(e.ts) FROM chain c JOIN ev e ON e.client_id = c.client_id AND e.ts >= c.ts + INTERVAL 24 HOUR GROUP BY c.client_id),
spans AS (SELECT client_id, ts AS opened, lead(ts) OVER (PARTITION BY client_id ORDER BY ts) AS following FROM chain)
SELECT s.client_id, epoch_us(s.opened) AS opened, epoch_us(max(e.ts)) AS last, count(*) AS events
FROM spans s JOIN ev e ON e.client_id = s.client_id AND e.ts >= s.opened AND (s.following IS NULL OR e.ts < s.following) GROUP BY s.client_id, s.opened"""


@query("fixed_ttl_sessions", SESSION_SQL, recursive=True)
def fixed_ttl_sessions(spark, sf):
    out = logs.fixed_ttl_sessions(request_log(spark, sf), TTL_S)
    return out.select("client_id", us("session_start", "opened"), us("last_event", "last"), "events")


@query("severest_pause", """
SELECT pause_id, reason FROM (SELECT pause_id, CASE pause_id % 3 WHEN 0 THEN 'retry_backoff' WHEN 1 THEN 'retry_after' ELSE 'circuit_breaker' END AS reason, start_ts,
  start_ts + seconds * INTERVAL 40 SECOND AS end_ts FROM pauses) p
WHERE start_ts <= (SELECT max(ts) - INTERVAL 2 HOUR FROM request_log) AND end_ts > (SELECT max(ts) - INTERVAL 2 HOUR FROM request_log)
ORDER BY CASE reason WHEN 'circuit_breaker' THEN 0 WHEN 'retry_after' THEN 1 ELSE 2 END, end_ts DESC, pause_id LIMIT 1""")
def severest_pause(spark, sf):
    reason = F.when(F.col("pause_id") % 3 == 0, "retry_backoff").when(F.col("pause_id") % 3 == 1, "retry_after").otherwise("circuit_breaker")
    at = request_log(spark, sf).agg(F.max("ts") - F.expr("INTERVAL 2 HOURS")).scalar()
    return logs.severest_pause(_long_pauses(spark, sf).withColumn("reason", reason), at).select("pause_id", "reason")


@query("throttled_requests", "SELECT req_id, status FROM request_log WHERE status IN (429, 503)")
def throttled_requests(spark, sf):
    return request_log(spark, sf).where(is_throttled(F.col("status"))).select("req_id", "status")
