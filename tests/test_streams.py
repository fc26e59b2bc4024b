"""Streams over several micro-batches give what the batch operators give."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tilelake.operators import logs
from tilelake.operators.metrics import ProgressLog, stream_metrics
from tilelake.session import scratch_path
from tilelake.sources.tables import read_request_log
from tilelake.streaming import flows, machines

COLUMNS = "req_id bigint, t bigint, client_id bigint, status int, nbytes bigint"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).select(
        "req_id", F.timestamp_micros("t").alias("ts"), "client_id", "status", F.lit(None).cast("string").alias("retry_after"),
        F.lit(None).cast("string").alias("location"), "nbytes")


@pytest.fixture(scope="module")
def events(spark):
    """A log in three files, out of order within five minutes, and a closing row."""
    rng = random.Random(2)
    t, rows = 1_700_000_000_000_000, []
    for i in range(900):
        t += rng.randint(0, 20_000_000)
        rows.append((i, t + rng.randint(-60, 60) * 1_000_000, rng.randint(0, 3), rng.choice([200, 200, 429, 503]), rng.randint(0, 99)))
    path = scratch_path(spark, "events")
    parts = [rows[:300], rows[300:600], rows[600:], [(-1, t + 10**12, -1, 200, 0)]]
    for part in parts:
        rows_of(spark, part).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken in the order they were written
    return rows_of(spark, rows), lambda: read_request_log(spark, path, stream=True, files_per_trigger=1)


def as_set(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def done(df):
    return df.where("client_id >= 0")


def test_breaker(events):
    log, stream = events
    trips = logs.breaker_trips(log, 3, 60, 90)
    labels = logs.breaker_labels(log, trips).join(trips.select("req_id", F.lit(True).alias("tripped")), "req_id", "left")
    got = done(flows.run_to_table(stream(), lambda s: machines.breaker(s, 3, 60, 90, "5 minutes")))
    want = labels.withColumn("tripped", F.coalesce("tripped", F.lit(False)))
    assert as_set(got, "req_id", "blocked", "tripped") == as_set(want, "req_id", "blocked", "tripped")


def test_bucket(events):
    log, stream = events
    got = done(flows.run_to_table(stream(), lambda s: machines.token_bucket(s, 0.05, 2, "5 minutes")))
    assert as_set(got, "req_id", "wait_us") == as_set(logs.token_bucket(log, 0.05, 2), "req_id", "wait_us")


def test_sessions(events):
    log, stream = events
    got = done(flows.run_to_table(stream(), lambda s: machines.fixed_ttl_sessions(s, 300, 30, "5 minutes")))
    want = logs.fixed_ttl_sessions(log, 300, 30).select("client_id", F.unix_micros("session_start").alias("opened"), F.unix_micros("last_event").alias("last"), "events")
    assert as_set(got, "client_id", "opened", "last", "events") == as_set(want, "client_id", "opened", "last", "events")


def test_stalls(events):
    log, stream = events
    got = done(flows.run_to_table(stream(), lambda s: machines.stall_alerts(s, 60, "5 minutes")))
    between = logs.stalls(log, 60).select("client_id", F.unix_micros("since").alias("since"), "resume_offset")
    final = log.groupBy("client_id").agg(F.unix_micros(F.max("ts")).alias("since"), F.sum("nbytes").alias("resume_offset"))
    assert as_set(got, "client_id", "since", "resume_offset") == as_set(between.unionByName(final), "client_id", "since", "resume_offset")


def test_windows_and_metrics(spark, events):
    log, stream = events
    seen = ProgressLog()
    spark.streams.addListener(seen)
    try:
        got = flows.run_to_table(stream(), lambda s: flows.stream_progress(stream_metrics(s, "rows_in", bytes=F.sum("nbytes")), "5 minutes", "1 minute"))
        want = logs.progress_windows(log, "5 minutes", "1 minute")
        assert as_set(got, "window_start", "nbytes", "events") == as_set(want, "window_start", "nbytes", "events")
        for _ in range(50):
            if sum(row["rows"] for stage, _, row in seen.events if stage == "rows_in") >= 901:
                break
            time.sleep(0.1)
        assert sum(row["rows"] for stage, _, row in seen.events if stage == "rows_in") == 901
    finally:
        spark.streams.removeListener(seen)


def test_dedup_within_a_watermark(spark):
    path = scratch_path(spark, "dups")
    rows = [("c", f"i{i % 50}", i) for i in range(200)]
    spark.createDataFrame(rows, "collection_id string, item_id string, s int").select(
        "collection_id", "item_id", F.timestamp_seconds("s").alias("item_ts")).write.parquet(path)
    stream = lambda: spark.readStream.schema("collection_id string, item_id string, item_ts timestamp").parquet(path)
    assert flows.run_to_table(stream(), flows.stream_dedup).count() == 50
    assert flows.run_to_table(stream(), lambda s: flows.stream_dedup(s, "1 hour")).count() == 50


def test_outcomes_repeat_and_compact(spark):
    schema = "collection_id string, item_id string, asset_key string, run_id int, finished_at timestamp, status string"
    make = lambda n, run, status: spark.range(n).select(
        F.lit("c").alias("collection_id"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("item_id"), F.lit("data").alias("asset_key"),
        F.lit(run).alias("run_id"), F.timestamp_seconds(F.lit(run)).alias("finished_at"), F.lit(status).alias("status"))
    source, target, state = (scratch_path(spark, n) for n in ("o", "t", "s"))
    run = lambda: flows.outcome_upsert(spark.readStream.schema(schema).parquet(source), target, state).awaitTermination()
    make(20, 1, "failed").write.mode("append").parquet(source)
    run()
    make(5, 2, "downloaded").write.mode("append").parquet(source)
    run()
    state_of = lambda v=None: {r.status: r["count"] for r in flows.current_outcomes(spark, target, v).groupBy("status").count().collect()}
    assert state_of() == {"failed": 15, "downloaded": 5}
    version = flows.compact_outcomes(spark, target, 1)
    make(20, 3, "skipped").write.mode("append").parquet(source)
    run()
    assert state_of(version) == {"skipped": 20} == state_of(flows.compact_outcomes(spark, target, 2, version))


def test_totals_over_several_batches(events):
    log, stream = events
    done = lambda df: df.withColumn("done", F.col("req_id") % 3 == 0)
    got = flows.run_to_table(stream(), lambda s: flows.stream_totals(done(s), "10 minutes", "5 minutes"))
    want = logs.running_total(logs.progress_windows(done(log), "10 minutes"))
    columns = ["window_start", "nbytes", "events", "files", "total_bytes", "total_files"]
    assert as_set(got, *columns) == as_set(want, *columns)


def test_late_rows_are_counted(spark):
    path = scratch_path(spark, "late")
    t = 1_700_000_000_000_000
    for part in ([(1, t, 0, 200, 5)], [(2, t + 10**10, 0, 200, 5)], [(6, t + 10**10, 0, 200, 5)], [(3, t, 0, 200, 5), (4, t + 1, 1, 200, 5), (5, t + 2 * 10**10, 0, 200, 5)]):
        rows_of(spark, part).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    seen = ProgressLog()
    spark.streams.addListener(seen)
    try:
        flows.run_to_table(read_request_log(spark, path, stream=True, files_per_trigger=1), lambda s: flows.stream_progress(s, "1 minute", watermark="1 minute"))
        for _ in range(50):
            if seen.late_rows():
                break
            time.sleep(0.1)
        assert seen.late_rows() == 1  # the two late rows fall in one window: they reach the state as one partial sum
        assert {name for _, name, _ in seen.late} == {"stateStoreSave"}
    finally:
        spark.streams.removeListener(seen)


class _State:
    """A map state that counts its calls."""

    def __init__(self):
        self.parts, self.calls = {}, 0

    def updateValue(self, key, value):
        self.calls += 1
        self.parts[key] = value

    def getValue(self, key):
        self.calls += 1
        return self.parts[key]

    def removeKey(self, key):
        self.calls += 1
        del self.parts[key]


def test_a_key_with_few_rows_costs_few_calls():
    """Rows of a month are one part, whatever remains of several parts is one again, and all come out in order."""
    p, waiting, day = machines._Bucket(1000, 4), {}, 86_400_000_000
    p._rows = _State()
    rows = [(i * day // 3, i) for i in range(90)]
    p._keep(waiting, rows[::2])
    p._keep(waiting, rows[1::2])
    assert p._rows.calls == 2
    got = p._take(waiting, 10 * day)
    assert len(waiting) == 1 and p._rows.calls <= 7 and got == [r for r in rows if r[0] <= 10 * day]
    assert got + p._take(waiting, 40 * day) == rows and not waiting and not p._rows.parts


def test_a_hot_key_is_buffered_in_stretches(spark):
    """Many rows of one key and time, in several batches: each once, in order, whatever the batches."""
    path, t = scratch_path(spark, "hot"), 1_700_000_000_000_000
    rng = random.Random(9)
    rows = [(i, t + rng.randrange(200) * 1_000_000, 1, 200, 1) for i in range(6_000)]
    for part in (rows[:2000], rows[2000:4000], rows[4000:], [(-1, t + 10**11, -1, 200, 0)]):
        rows_of(spark, part).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    got = done(flows.run_to_table(read_request_log(spark, path, stream=True, files_per_trigger=1), lambda s: machines.token_bucket(s, 1000.0, 2, "5 minutes")))
    assert as_set(got, "req_id", "wait_us") == as_set(logs.token_bucket(rows_of(spark, rows), 1000.0, 2), "req_id", "wait_us")


@pytest.mark.parametrize("made", [
    lambda: machines._Breaker(3, 60, 90), lambda: machines._Bucket(1000, 4), lambda: machines._Session(60, 0), lambda: machines._Stall(30), lambda: flows._Running()])
def test_processors_go_with_the_task(made):
    from pyspark import cloudpickle

    assert len(cloudpickle.dumps(made())) < 200_000
