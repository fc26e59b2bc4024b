"""Grid arithmetic for bounds, cells and byte estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell sizes in bytes, nodata default, pyramid overhead and large-file limit.
DTYPE_BYTES = {
    "uint8": 1, "int8": 1, "uint16": 2, "int16": 2, "uint32": 4, "int32": 4,
    "float32": 4, "float64": 8,
}
DEFAULT_NODATA = -999.0
PYRAMID_FACTOR = 1.34
LARGE_BYTES = 2 * 1024**3

_SIDES = ("minx", "miny", "maxx", "maxy")


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    values = (minx, miny, maxx, maxy)
    return F.struct(*[v.cast("double").alias(n) for v, n in zip(values, _SIDES)])


def snap_outward(bounds: Column, res: Column | float) -> Column:
    """Grow bounds to whole multiples of ``res``."""
    step = res if isinstance(res, Column) else F.lit(float(res))
    down = lambda n: F.floor(bounds[n] / step) * step
    up = lambda n: F.ceil(bounds[n] / step) * step
    return box(down("minx"), down("miny"), up("maxx"), up("maxy"))


def clamp_bounds(bounds: Column, limits: Column) -> Column:
    """Intersection of two boxes; NULL when they share no area."""
    cut = box(
        F.greatest(bounds["minx"], limits["minx"]), F.greatest(bounds["miny"], limits["miny"]),
        F.least(bounds["maxx"], limits["maxx"]), F.least(bounds["maxy"], limits["maxy"]),
    )
    return F.when((cut["minx"] < cut["maxx"]) & (cut["miny"] < cut["maxy"]), cut)


def half_even(value: Column) -> Column:
    """Whole number nearest to ``value``, ties to even."""
    return F.rint(value).cast("bigint")


def quantize(z: Column, max_err: float, nodata: float = DEFAULT_NODATA) -> Column:
    """Round to steps of twice the error bound; nodata stays as it is."""
    if max_err <= 0:
        return z
    step = F.lit(2.0 * max_err)
    return F.when(z == nodata, z).otherwise(F.floor(z / step + 0.5) * step)


def dtype_bytes(dtype: Column) -> Column:
    pairs = [F.lit(v) for pair in DTYPE_BYTES.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), dtype)


def estimate_bytes(width: Column, height: Column, dtype: Column) -> Column:
    """Uncompressed size, size with pyramid (truncated) and the large-file flag."""
    base = width.cast("bigint") * height.cast("bigint") * dtype_bytes(dtype)
    return F.struct(
        base.alias("base_bytes"),
        F.floor(base * F.lit(PYRAMID_FACTOR)).cast("bigint").alias("final_bytes"),
        (base > LARGE_BYTES).alias("large"),
    )
