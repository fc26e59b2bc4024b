"""Analytics over request, pause and transfer logs (batch).

Every ordered computation runs on slices (see ``slices``), so one client may own any share of
the log. Times are compared as whole microseconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.functions.http import is_throttled, parse_retry_after
from tilelake.operators.chains import greedy_chain
from tilelake.operators.slices import ROW, SLICE, running, slice_rows

# Fixed values of the request policy.
BREAKER_FAILURES, BREAKER_WINDOW_S, BREAKER_COOLDOWN_S = 5, 120, 600
RATE_PER_SECOND, BURST = 2.0, 4
RATE_PRECISION = 1000
STALL_S = 30
SESSION_TTL_S = 30 * 60
MIN_SHOWN_PAUSE_S = 2.0
PAUSE_PRIORITY = ("circuit_breaker", "retry_after", "retry_backoff")

_US = 1_000_000


def _micros(column: str = "ts") -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


# -- pauses ---------------------------------------------------------------------------------


_PAUSE_ORDER = ["start", "end"]


def _with_reach(pauses: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Pauses in start order with the latest end before each of them, and their slices."""
    sliced = slice_rows(pauses.select(*keys, "start", "end"), keys, _PAUSE_ORDER)
    reached = running(sliced, keys, _PAUSE_ORDER, exclusive={"reach": ("max", F.col("end"))})
    return reached, sliced


def merge_intervals(pauses: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Union of overlapping (or touching) intervals per key: ``start``, ``end``, ``parts``."""
    keys = list(keys)
    marked, origin = _with_reach(pauses, keys)
    opens = F.coalesce(F.col("start") > F.col("reach"), F.lit(True))
    grouped = running(
        marked, keys, _PAUSE_ORDER,
        inclusive={"island": ("max", F.when(opens, F.col("start")))}, origin=origin,
    )
    return grouped.groupBy(*keys, "island").agg(
        F.max("end").alias("end"), F.count(F.lit(1)).alias("parts")
    ).withColumnRenamed("island", "start")


def paused_seconds(pauses: DataFrame) -> DataFrame:
    """Total time covered by pauses, overlaps counted once; one pass, no islands needed."""
    marked, _ = _with_reach(pauses, [])
    micros = F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(
        F.greatest("start", F.coalesce("reach", "start")).cast("timestamp")
    )
    return marked.agg(
        F.coalesce(F.sum(F.greatest(micros, F.lit(0))), F.lit(0)).alias("paused_us")
    )


def throttle_stats(log: DataFrame, pauses: DataFrame, trips: DataFrame) -> DataFrame:
    """One row: throttled responses, breaker trips, paused time with overlaps counted once."""
    return log.agg(F.count_if(is_throttled(F.col("status"))).alias("throttled_responses")).select(
        "throttled_responses",
        trips.agg(F.count(F.lit(1))).scalar().alias("breaker_trips"),
        paused_seconds(pauses).scalar().alias("paused_us"),
    )


def severest_pause(pauses: DataFrame, at: Column) -> DataFrame:
    """The pause to show at an instant: breaker before Retry-After before backoff, then the
    latest end; waits under two seconds are ordinary pacing."""
    rank = F.array_position(F.array(*[F.lit(r) for r in PAUSE_PRIORITY]), F.col("reason"))
    length = (F.unix_micros("end") - F.unix_micros("start")) / F.lit(float(_US))
    active = (F.col("start") <= at) & (F.col("end") > at) & (length >= MIN_SHOWN_PAUSE_S)
    return pauses.where(active).orderBy(rank, F.col("end").desc(), "pause_id").limit(1)


# -- failures -------------------------------------------------------------------------------

_ADD, _ASK, _EXPIRE = 0, 1, 2


def _sweep(log: DataFrame, keys: Sequence[str], seconds: float, every_row: bool) -> DataFrame:
    """The log as a sweep line: each failure enters at its time and leaves after the window.

    A running sum of the deltas is the number of failures in the trailing window: no range
    frame, hence no task that has to hold a whole window.
    """
    window_us = int(seconds * _US)
    t = _micros()
    event = lambda at, kind, delta: F.struct(
        at.alias("t"), F.lit(kind).alias("kind"), F.lit(delta).cast("bigint").alias("delta")
    )
    failure = [event(t, _ADD, 1), event(t + window_us, _EXPIRE, -1)]
    asked = [event(t, _ASK, 0)] if every_row else []
    events = F.when(is_throttled(F.col("status")), F.array(*failure, *asked))
    events = events.otherwise(F.array(*asked)) if every_row else events
    return log.select(*keys, "req_id", F.explode(events).alias("e")).select(
        *keys, "req_id", "e.t", "e.kind", "e.delta"
    )


def rolling_failures(
    log: DataFrame, seconds: float = BREAKER_WINDOW_S, threshold: int = BREAKER_FAILURES,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Failures in the trailing window (both ends included) at every request, and whether they
    would trip a breaker that never clears its list."""
    keys = list(keys)
    order = ["t", "kind", "req_id"]
    sliced = slice_rows(_sweep(log, keys, seconds, every_row=True), keys, order)
    counted = running(sliced, keys, order, inclusive={"failures": ("sum", F.col("delta"))})
    return counted.where(F.col("kind") == _ASK).select(
        *keys, "req_id", "failures", (F.col("failures") >= threshold).alias("candidate")
    )


def breaker_trips(
    log: DataFrame, failures: int = BREAKER_FAILURES, window_s: float = BREAKER_WINDOW_S,
    cooldown_s: float = BREAKER_COOLDOWN_S, keys: Sequence[str] = ("client_id",),
) -> DataFrame:
    """Trips of a breaker that clears its failure list on every trip.

    A failure can trip when the ``failures``-th last failure is still in the window. After a
    trip the list starts anew, so the next trip is the next such failure at least ``failures``
    places on: a greedy chain over failure numbers.
    """
    keys = list(keys)
    order = ["t", "kind", "req_id"]
    sliced = slice_rows(_sweep(log, keys, window_s, every_row=False), keys, order)
    counted = running(
        sliced, keys, order,
        inclusive={
            "in_window": ("sum", F.col("delta")),
            "number": ("sum", F.greatest(F.col("delta"), F.lit(0).cast("bigint"))),
        },
    )
    able = counted.where((F.col("kind") == _ADD) & (F.col("in_window") >= failures)).select(
        *keys, "req_id", "t", "number"
    )
    return (
        greedy_chain(able, keys, "number", failures, ["req_id"])
        .where(F.col("number") == F.col("_head"))
        .select(
            *keys, "req_id", F.timestamp_micros("t").alias("ts"),
            F.timestamp_micros(F.col("t") + int(cooldown_s * _US)).alias("open_until"),
        )
    )


def breaker_labels(
    log: DataFrame, trips: DataFrame, keys: Sequence[str] = ("client_id",)
) -> DataFrame:
    """Each request with the cooldown in force when it was seen."""
    keys, order = list(keys), ["ts", "req_id"]
    opened = log.join(trips.select("req_id", "open_until"), "req_id", "left")
    sliced = slice_rows(opened, keys, order)
    seen = running(sliced, keys, order, exclusive={"held_until": ("max", F.col("open_until"))})
    blocked = F.coalesce(F.col("ts") < F.col("held_until"), F.lit(False))
    return seen.drop(SLICE, ROW, "open_until").withColumn("blocked", blocked)


def retry_after_deadline(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The Retry-After wait in force when each request was seen."""
    keys, order = list(keys), ["ts", "req_id"]
    own = F.timestamp_micros(
        F.unix_micros("ts")
        + F.floor(parse_retry_after(F.col("retry_after"), F.col("ts")) * _US).cast("bigint")
    )
    sliced = slice_rows(log.select(*keys, "req_id", "ts", own.alias("deadline")), keys, order)
    seen = running(sliced, keys, order, exclusive={"in_force": ("max", F.col("deadline"))})
    wait = F.greatest(F.unix_micros("in_force") - F.unix_micros("ts"), F.lit(0))
    return seen.select(
        *keys, "req_id", "ts", "in_force", F.coalesce(wait, F.lit(0)).cast("bigint").alias("wait_us")
    )


def token_bucket(
    log: DataFrame, rate: float = RATE_PER_SECOND, burst: int = BURST,
    keys: Sequence[str] = ("client_id",),
) -> DataFrame:
    """When a bucket of ``burst`` tokens, refilled at ``rate`` per second, lets each request
    pass if requests wait their turn.

    With interval ``T`` the bucket's arrival-time bound after request ``n`` is
    ``max(previous, t) + T``, hence ``n*T + max over j <= n of (t_j - (j-1)*T)``: a row number
    and a running maximum instead of a row-by-row state machine.
    """
    if rate <= 0 or burst < 1:
        raise ValueError("rate and burst must be positive")
    keys, order = list(keys), ["ts", "req_id"]
    interval_ns = round(1_000_000_000 * RATE_PRECISION / max(1, round(rate * RATE_PRECISION)))
    slim = log.select(*keys, "req_id", "ts")
    sliced = slice_rows(slim, keys, order)
    numbered = running(sliced, keys, order, inclusive={"n": ("sum", F.lit(1).cast("bigint"))})
    t_ns = F.unix_micros("ts") * 1000
    bound = running(
        numbered, keys, order,
        exclusive={"base": ("max", t_ns - (F.col("n") - 1) * F.lit(interval_ns))}, origin=sliced,
    )
    admitted = F.greatest(t_ns, F.col("base") + (F.col("n") - burst) * F.lit(interval_ns))
    wait_us = F.floor((admitted - t_ns) / 1000).cast("bigint")
    return bound.select(
        *keys, "req_id", "ts", wait_us.alias("wait_us"),
        F.timestamp_micros(F.unix_micros("ts") + wait_us).alias("admitted_at"),
    )


# -- transfers and sessions -----------------------------------------------------------------


def stalls(
    progress: DataFrame, seconds: float = STALL_S, keys: Sequence[str] = ("client_id",)
) -> DataFrame:
    """Silences longer than ``seconds`` within a transfer, with the offset to resume from."""
    keys, order = list(keys), ["ts", "req_id"]
    sliced = slice_rows(progress.select(*keys, "req_id", "ts", "nbytes"), keys, order)
    seen = running(
        sliced, keys, order,
        exclusive={"since": ("max", F.col("ts")), "resume_offset": ("sum", F.col("nbytes"))},
    )
    gap = F.unix_micros("ts") - F.unix_micros("since")
    return seen.where(gap > int(seconds * _US)).select(
        *keys, "req_id", "since", "ts", gap.alias("gap_us"), "resume_offset"
    )


def progress_windows(
    progress: DataFrame, length: str = "1 minute", slide: str | None = None
) -> DataFrame:
    """Bytes, events and rate per tumbling or sliding window, on batch and streams alike; with a column
    ``done``, true for a file's last event, also the files that were finished."""
    span = F.window("ts", length, slide) if slide else F.window("ts", length)
    files = [F.count_if(F.col("done")).alias("files")] if "done" in progress.columns else []
    totals = progress.groupBy(span.alias("w")).agg(
        F.sum("nbytes").alias("nbytes"), F.count(F.lit(1)).alias("events"), *files
    )
    seconds = (F.unix_micros("w.end") - F.unix_micros("w.start")) / F.lit(float(_US))
    return totals.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "nbytes", "events", (F.col("nbytes") / seconds).alias("bytes_per_s"), *(["files"] if files else []),
    )


def running_total(windows: DataFrame) -> DataFrame:
    """Bytes, and files if the windows count them, so far at the end of every window."""
    order = ["window_start"]
    sliced = slice_rows(windows, [], order)
    sums = {"total_bytes": ("sum", F.col("nbytes"))}
    if "files" in windows.columns:
        sums["total_files"] = ("sum", F.col("files"))
    return running(sliced, [], order, inclusive=sums).drop(SLICE, ROW)


def fixed_ttl_sessions(
    events: DataFrame, ttl_s: float = SESSION_TTL_S, margin_s: float = 0.0,
    keys: Sequence[str] = ("client_id",), tie: str = "req_id",
) -> DataFrame:
    """Sessions that end a fixed time after they began, used or not; the next event after
    that (less the refresh margin) opens a new one."""
    keys = list(keys)
    step = int((ttl_s - margin_s) * _US)
    timed = events.select(*keys, tie, _micros().alias("t"))
    return (
        greedy_chain(timed, keys, "t", step, [tie])
        .groupBy(*keys, F.col("_head").alias("opened"))
        .agg(F.count(F.lit(1)).alias("events"), F.max("t").alias("last"))
        .select(
            *keys, F.timestamp_micros("opened").alias("session_start"),
            F.timestamp_micros(F.col("opened") + int(ttl_s * _US)).alias("expires_at"),
            F.timestamp_micros("last").alias("last_event"), "events",
        )
    )
