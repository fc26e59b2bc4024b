"""Breaker, token bucket, session and stall operators over event streams.

Each has a batch twin in ``tilelake.operators.logs`` that gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tilelake.functions.http import THROTTLE_STATUSES
from tilelake.operators import logs
from tilelake.streaming.ordered import WATERMARK, OrderedProcessor, run_ordered

_US = 1_000_000


class _Breaker(OrderedProcessor):
    buffer_schema = "t bigint, id bigint, status int"
    memory_schema = "failures array<bigint>, open_until bigint"
    columns = ("req_id", "t", "blocked", "tripped")

    def __init__(self, failures: int, window_s: float, cooldown_s: float) -> None:
        self.limit, self.window = failures, int(window_s * _US)
        self.cooldown = int(cooldown_s * _US)

    def start(self):
        return ([], 0)

    def row(self, memory, row):
        recent, open_until = list(memory[0]), memory[1]
        t, req_id, status = row
        blocked, tripped = t < open_until, False
        if status in THROTTLE_STATUSES:
            recent = [f for f in recent if t - f <= self.window] + [t]
            if len(recent) >= self.limit:
                tripped, open_until, recent = True, max(open_until, t + self.cooldown), []
        return (recent, open_until), [(req_id, t, blocked, tripped)]


def breaker(
    log: DataFrame, failures: int = logs.BREAKER_FAILURES,
    window_s: float = logs.BREAKER_WINDOW_S, cooldown_s: float = logs.BREAKER_COOLDOWN_S,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Label each request of a stream with cooldown and trip."""
    return run_ordered(
        log, _Breaker(failures, window_s, cooldown_s),
        "client_id bigint, req_id bigint, t bigint, blocked boolean, tripped boolean",
        watermark, extra=("status",),
    )


class _Bucket(OrderedProcessor):
    memory_schema = "bound bigint"
    columns = ("req_id", "t", "wait_us")

    def __init__(self, interval_ns: int, burst: int) -> None:
        self.interval = interval_ns
        self.slack = (burst - 1) * interval_ns

    def start(self):
        return (0,)

    def row(self, memory, row):
        t_ns = row[0] * 1000
        wait_us = max(0, memory[0] - self.slack - t_ns) // 1000
        return (max(memory[0], t_ns) + self.interval,), [(row[1], row[0], wait_us)]


def token_bucket(
    log: DataFrame, rate: float = logs.RATE_PER_SECOND, burst: int = logs.BURST,
    watermark: str = WATERMARK,
) -> DataFrame:
    interval_ns = round(
        1_000_000_000 * logs.RATE_PRECISION / max(1, round(rate * logs.RATE_PRECISION))
    )
    return run_ordered(
        log, _Bucket(interval_ns, burst),
        "client_id bigint, req_id bigint, t bigint, wait_us bigint", watermark,
    )


class _Session(OrderedProcessor):
    memory_schema = "opened bigint, last bigint, events bigint"
    columns = ("opened", "last", "events")

    def __init__(self, ttl_s: float, margin_s: float) -> None:
        self.step = int((ttl_s - margin_s) * _US)

    def start(self):
        return (None, None, 0)

    def row(self, memory, row):
        opened, _, events = memory
        if opened is None:
            return (row[0], row[0], 1), []
        return (opened, row[0], events + 1), []

    def quiet(self, memory, now_us):
        # The next row at or after the expiry opens a new session, so this one is final.
        if memory[0] is not None and now_us + 1 >= memory[0] + self.step:
            return self.start(), [memory]
        return memory, []

    def wake_at(self, memory):
        return None if memory[0] is None else memory[0] + self.step


def fixed_ttl_sessions(
    events: DataFrame, ttl_s: float = logs.SESSION_TTL_S, margin_s: float = 0.0,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Sessions of a stream, each emitted once it has expired."""
    return run_ordered(
        events, _Session(ttl_s, margin_s),
        "client_id bigint, opened bigint, last bigint, events bigint", watermark,
    )


class _Stall(OrderedProcessor):
    buffer_schema = "t bigint, id bigint, nbytes bigint"
    memory_schema = "last bigint, offset bigint, alerted boolean"
    columns = ("since", "resume_offset")

    def __init__(self, seconds: float) -> None:
        self.limit = int(seconds * _US)

    def start(self):
        return (None, 0, False)

    def row(self, memory, row):
        return (row[0], memory[1] + (row[2] or 0), False), []

    def quiet(self, memory, now_us):
        last, offset, alerted = memory
        if last is None or alerted or now_us + 1 - last <= self.limit:
            return memory, []
        return (last, offset, True), [(last, offset)]

    def wake_at(self, memory):
        return None if memory[0] is None or memory[2] else memory[0] + self.limit


def stall_alerts(
    progress: DataFrame, seconds: float = logs.STALL_S, watermark: str = WATERMARK
) -> DataFrame:
    """One alert per silence longer than ``seconds``, as soon as the watermark shows it."""
    return run_ordered(
        progress, _Stall(seconds),
        "client_id bigint, since bigint, resume_offset bigint", watermark, extra=("nbytes",),
    )
