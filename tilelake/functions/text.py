"""Human-readable sizes and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tilelake.functions.let import bind

# SI size units.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def _tenths(value: Column) -> Column:
    """``value`` * 10 rounded to a whole number as C's ``%.1f`` rounds: by the exact binary
    value, ties to even. Spark's own formatting rounds the shortest decimal text half up.

    The value is split into a 26-bit head and a tail, so both products by ten are exact.
    """

    def split(v: Column) -> Column:
        spread = v * F.lit(134217729.0)
        return bind(
            spread - (spread - v),
            lambda head: F.struct((head * 10).alias("head"), ((v - head) * 10).alias("tail")),
        )

    def rounded(p: Column) -> Column:
        def up(whole: Column) -> Column:
            rest = (p["head"] - whole - F.lit(0.5)) + p["tail"]
            return whole + F.when(rest > 0, 1).when(rest < 0, 0).otherwise(whole % 2)

        return bind(F.floor(p["head"] + p["tail"]).cast("double"), up)

    return bind(bind(value, split), rounded).cast("bigint")


def _one_decimal(value: Column) -> Column:
    return bind(
        _tenths(value),
        lambda t: F.concat(F.floor(t / 10).cast("string"), F.lit("."), (t % 10).cast("string")),
    )


def human_size(num_bytes: Column) -> Column:
    """Decimal byte size such as ``68.2 GB``; ``unknown`` for NULL, never 0."""
    last = len(SIZE_UNITS) - 1
    scaled = F.struct(F.abs(num_bytes.cast("double")).alias("v"), F.lit(0).alias("unit"))
    for _ in range(last):
        scaled = bind(
            scaled,
            lambda s: F.when(
                s["v"] >= 1000, F.struct((s["v"] / 1000.0).alias("v"), (s["unit"] + 1).alias("unit"))
            ).otherwise(s),
        )
    units = F.array(*[F.lit(u) for u in SIZE_UNITS])
    digits = lambda s: F.when(
        s["unit"] == 0, F.rint(s["v"]).cast("bigint").cast("string")
    ).otherwise(_one_decimal(s["v"]))
    sign = F.when(num_bytes < 0, F.lit("-")).otherwise(F.lit(""))
    text = bind(scaled, lambda s: F.concat(sign, digits(s), F.lit(" "), units[s["unit"]]))
    return F.coalesce(F.when(num_bytes.isNotNull(), text), F.lit("unknown"))


def human_duration(seconds: Column) -> Column:
    """``m:ss`` from one minute up, else ``N s``; halves round to even."""
    whole = F.greatest(F.lit(0), F.rint(seconds.cast("double")).cast("bigint"))
    minutes = F.floor(whole / 60)
    rest = whole % 60
    return F.when(
        minutes > 0,
        F.concat(minutes.cast("string"), F.lit(":"), F.lpad(rest.cast("string"), 2, "0")),
    ).otherwise(F.concat(rest.cast("string"), F.lit(" s")))
