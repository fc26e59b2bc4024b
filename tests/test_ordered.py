"""Sliced running totals, greedy chains and the log operators, against plain Python loops."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tilelake.operators import logs
from tilelake.operators.chains import greedy_chain
from tilelake.operators.slices import row_numbers, running, slice_rows


@pytest.fixture(scope="module")
def skewed():
    """Two thirds of the rows have one key; some keys are NULL."""
    rng = random.Random(3)
    key = lambda: 0 if rng.random() < 0.66 else rng.choice([None, *range(1, 30)])
    return [(key(), rng.randint(0, 20_000), i) for i in range(3000)]


def by_key(rows):
    groups = defaultdict(list)
    for k, p, i in sorted(rows, key=lambda r: (r[1], r[2])):
        groups[k].append((p, i))
    return groups


def test_running(spark, skewed):
    df = spark.createDataFrame(skewed, "k bigint, p bigint, i bigint")
    sliced = slice_rows(df, ["k"], ["p", "i"])
    assert sliced.where("k = 0").select("_slice").distinct().count() > 3  # the hot key is split
    out = running(sliced, ["k"], ["p", "i"], inclusive={"n": ("sum", F.lit(1))}, exclusive={"m": ("max", F.col("i")), "low": ("min", F.col("i"))})
    got = {r.i: (r.n, r.m, r.low) for r in out.collect()}
    want = {}
    for group in by_key(skewed).values():
        seen = []
        for n, (_, i) in enumerate(group, 1):
            want[i] = (n, max(seen, default=None), min(seen, default=None))
            seen.append(i)
    assert got == want


def test_row_numbers(spark, skewed):
    df = spark.createDataFrame(skewed, "k bigint, p bigint, i bigint")
    got = {r.i: r.row_number for r in row_numbers(df, [], ["p", "i"]).collect()}
    assert got == {i: n for n, (_, _, i) in enumerate(sorted(skewed, key=lambda r: (r[1], r[2])), 1)}


@pytest.mark.parametrize("step", [1, 20, 700, 9000, 100_000])
def test_greedy_chain(spark, skewed, step):
    df = spark.createDataFrame(skewed, "k bigint, p bigint, i bigint")
    got = {r.i: r._head for r in greedy_chain(df, ["k"], "p", step, ["i"]).collect()}
    want = {}
    for group in by_key(skewed).values():
        head = None
        for p, i in group:
            head = p if head is None or p >= head + step else head
            want[i] = head
    assert got == want


def test_chain_of_a_strictly_regular_key(spark):
    """Evenly spaced rows never let two chains meet, the hardest case for the slice maps."""
    df = spark.range(4000).select(F.lit("only").alias("k"), (F.col("id") * 10).alias("p"))
    heads = greedy_chain(df, ["k"], "p", 1005).select("_head").distinct().orderBy("_head").collect()
    assert [h[0] for h in heads] == list(range(0, 40_000, 1010))


def test_chain_keeps_large_keys(spark):
    """Keys beyond 2**53 next to a NULL key must not be rounded on their way through Python."""
    big = 2**62
    rows = [(k, p, p) for k in (None, big, big + 1) for p in range(40)]
    df = spark.createDataFrame(rows, "k bigint, p bigint, i bigint")
    got = {(r.k, r.p): r._head for r in greedy_chain(df, ["k"], "p", 7, ["i"]).collect()}
    assert got == {(k, p): p // 7 * 7 for k, p, _ in rows}


# -- logs -----------------------------------------------------------------------------------


def log_of(spark, rows):
    """rows: (seconds, status) of one client."""
    data = [(i, float(t), 1, s) for i, (t, s) in enumerate(rows)]
    return spark.createDataFrame(data, "req_id bigint, t double, client_id bigint, status int").select(
        "req_id", F.timestamp_micros((F.col("t") * 1_000_000).cast("bigint")).alias("ts"), "client_id", "status",
        F.lit(None).cast("string").alias("retry_after"))


def breaker(rows, k=5, window=120, cooldown=600):
    recent, open_until, trips, blocked = [], 0, [], []
    for i, (t, s) in enumerate(rows):
        blocked.append(t < open_until)
        if s in (429, 503):
            recent = [f for f in recent if t - f <= window] + [t]
            if len(recent) >= k:
                trips.append(i)
                open_until, recent = max(open_until, t + cooldown), []
    return trips, blocked


SEQUENCES = {
    "five in the window": [(t, 429) for t in (0, 10, 20, 30, 40)],
    "spread out": [(t * 31, 503) for t in range(9)],
    "exactly the window": [(0, 429), (1, 429), (2, 429), (3, 429), (120, 503)],
    "just beyond": [(0, 429), (1, 429), (2, 429), (3, 429), (120.001, 503)],
    "list is cleared": [(t, 429) for t in range(12)],
    "successes do not count": [(t, 200 if t % 2 else 429) for t in range(10)],
}


@pytest.mark.parametrize("name", SEQUENCES)
def test_breaker(spark, name):
    rows = SEQUENCES[name]
    log = log_of(spark, rows)
    trips = logs.breaker_trips(log)
    want, blocked = breaker(rows)
    assert sorted(r.req_id for r in trips.collect()) == want
    labels = {r.req_id: r.blocked for r in logs.breaker_labels(log, trips).collect()}
    assert [labels[i] for i in range(len(rows))] == blocked


def test_breaker_on_a_long_log(spark):
    rng = random.Random(9)
    t, rows = 0.0, []
    for _ in range(2500):
        t += rng.choice([0.25, 1, 5, 40])
        rows.append((t, rng.choice([200, 200, 429, 503])))
    log = log_of(spark, rows)
    trips = logs.breaker_trips(log)
    want, blocked = breaker(rows)
    assert sorted(r.req_id for r in trips.collect()) == want and len(want) > 20
    labels = {r.req_id: r.blocked for r in logs.breaker_labels(log, trips).collect()}
    assert [labels[i] for i in range(len(rows))] == blocked


def waits(times, rate, burst):
    bound, out = 0.0, []
    for t in times:
        out.append(max(0.0, bound - (burst - 1) / rate - t))
        bound = max(bound, t) + 1 / rate
    return out


@pytest.mark.parametrize(("rate", "burst"), [(2.0, 4), (10.0, 7), (0.5, 1)])
def test_token_bucket(spark, rate, burst):
    rng = random.Random(4)
    times, t = [], 0.0
    for _ in range(300):
        t += rng.choice([0, 0, 0.125, 1.5])
        times.append(t)
    got = {r.req_id: r.wait_us for r in logs.token_bucket(log_of(spark, [(t, 200) for t in times]), rate, burst).collect()}
    assert [got[i] / 1e6 for i in range(300)] == pytest.approx(waits(times, rate, burst), abs=2e-6)


def test_burst_then_half_a_second(spark):
    got = {r.req_id: r.wait_us for r in logs.token_bucket(log_of(spark, [(0, 200)] * 6)).collect()}
    assert [got[i] for i in range(6)] == [0, 0, 0, 0, 500_000, 1_000_000]


def test_pauses_count_once(spark):
    at = lambda s: F.timestamp_seconds(F.lit(s))
    spans = [(0, 10), (5, 12), (12, 15), (20, 21), (2, 3)]
    pauses = None
    for a, b in spans:
        row = spark.range(1).select(at(a).alias("start"), at(b).alias("end"))
        pauses = row if pauses is None else pauses.unionByName(row)
    assert logs.paused_seconds(pauses).first()[0] == 16_000_000
    merged = logs.merge_intervals(pauses).select(F.unix_seconds("start"), F.unix_seconds("end"), "parts").collect()
    assert sorted(tuple(r) for r in merged) == [(0, 15, 4), (20, 21, 1)]
    assert logs.paused_seconds(pauses.limit(0)).first()[0] == 0


def test_severest_pause(spark):
    rows = [(1, "retry_backoff", 0, 100), (2, "retry_after", 0, 50), (3, "retry_after", 0, 60), (4, "circuit_breaker", 0, 1), (5, "circuit_breaker", 90, 99)]
    df = spark.createDataFrame(rows, "pause_id int, reason string, s int, e int").select(
        "pause_id", "reason", F.timestamp_seconds("s").alias("start"), F.timestamp_seconds("e").alias("end"))
    shown = lambda at: [r.pause_id for r in logs.severest_pause(df, F.timestamp_seconds(F.lit(at))).collect()]
    assert (shown(0), shown(70), shown(95), shown(200)) == ([3], [1], [5], [])
