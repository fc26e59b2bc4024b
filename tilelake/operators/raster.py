"""Raster tile sets: audit, mosaic, clip, overviews, regions and verification.

Cells come in long form (``px``, ``py``, ``z``) or packed into square blocks
(``bx``, ``by``, ``vals``); see ``blocks`` for the packed form.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.functions.grid import DEFAULT_NODATA, clamp_bounds, half_even, snap_outward
from tilelake.functions.let import bind
from tilelake.operators.slices import row_numbers

# Tolerances and defaults of the tile-set and pyramid rules.
PIXEL_TOLERANCE = 1e-9
RATIO_TOLERANCE = 1e-6
NODATA_TOLERANCE = 1e-9
SAMPLE_TILES = 200
STOP_DIM = 512
MAX_Z_ERROR = 0.05

_BOX = ("minx", "miny", "maxx", "maxy")


# -- headers --------------------------------------------------------------------------------


def union_bounds(headers: DataFrame) -> DataFrame:
    """The box around all tiles; no row when there are no tiles."""
    return headers.agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
    ).where(F.col("minx").isNotNull())


def mosaic_shape(headers: DataFrame) -> DataFrame:
    """Bounds, cell size (of the first tile by path) and size in cells of the mosaic."""
    whole = headers.agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"),
        F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
        F.min_by("pixel_size_x", "path").alias("res"),
    ).where(F.col("minx").isNotNull())
    return whole.select(
        "*",
        half_even((F.col("maxx") - F.col("minx")) / F.col("res")).alias("width"),
        half_even((F.col("maxy") - F.col("miny")) / F.col("res")).alias("height"),
    )


def sample_every(df: DataFrame, n: int, order: Sequence[str] = ("path",)) -> DataFrame:
    """First, last and every ``max(1, N div n)``-th row; all rows when there are at most n."""
    total = df.agg(F.count(F.lit(1))).scalar()
    step = F.greatest(F.floor(total / F.lit(n)), F.lit(1))
    index = F.col("_rn") - 1
    chosen = (total <= n) | (index % step == 0) | (F.col("_rn") == total)
    return row_numbers(df, [], list(order), "_rn").where(chosen).drop("_rn")


def tileset_audit(headers: DataFrame, fast: bool = False, sample: int = SAMPLE_TILES) -> DataFrame:
    """Tiles that break the rules of one seamless mosaic, with the names of what they break.

    The first tile by path sets the CRS, type and cell size. With ``fast`` these are compared
    on a sample only; band counts are checked on every tile.
    """
    first = headers.agg(
        F.min_by(F.struct("crs", "dtype", "pixel_size_x", "pixel_size_y"), "path")
    ).scalar()
    off = lambda c: F.abs(F.col(c) - first[c]) > PIXEL_TOLERANCE
    bands = F.when(F.col("band_count") != 1, F.lit("band_count"))
    shared = [
        F.when(~F.col("crs").eqNullSafe(first["crs"]), F.lit("crs")),
        F.when(~F.col("dtype").eqNullSafe(first["dtype"]), F.lit("dtype")),
        F.when(off("pixel_size_x") | off("pixel_size_y"), F.lit("pixel_size")),
        F.when(F.col("rotated"), F.lit("rotated")),
    ]
    if not fast:
        checked = headers.withColumn("violations", F.array_compact(F.array(bands, *shared)))
    else:
        sampled = sample_every(headers, sample).select("path", F.lit(True).alias("_sampled"))
        inside = F.coalesce("_sampled", F.lit(False))
        checked = headers.join(sampled, "path", "left").withColumn(
            "violations", F.array_compact(F.array(bands, *[F.when(inside, c) for c in shared]))
        ).drop("_sampled")
    return checked.where(F.size("violations") > 0).select("path", "violations")


def resolve_nodata(headers: DataFrame, override: float | None = None) -> DataFrame:
    """The nodata value to use, or why there is none.

    ``issue`` is NULL, ``inconsistent`` or ``partly_missing`` (errors), or ``defaulted``.
    """
    seen = headers.agg(
        F.count(F.lit(1)).alias("tiles"),
        F.count_if(F.col("nodata").isNull()).alias("missing"),
        F.min("nodata").alias("low"), F.max("nodata").alias("high"),
    )
    if override is not None:
        return seen.select(
            F.lit(float(override)).alias("nodata"), F.lit(None).cast("string").alias("issue"),
            "tiles", "missing",
        )
    issue = (
        F.when(F.col("low") != F.col("high"), "inconsistent")
        .when(F.col("low").isNotNull() & (F.col("missing") > 0), "partly_missing")
        .when(F.col("low").isNull(), "defaulted")
    )
    value = F.when(issue.isNull(), F.col("low")).when(issue == "defaulted", F.lit(DEFAULT_NODATA))
    return seen.select(value.alias("nodata"), issue.alias("issue"), "tiles", "missing")


# -- mosaic ---------------------------------------------------------------------------------


def _placed(headers: DataFrame) -> DataFrame:
    """Headers with their offset in the mosaic grid."""
    mosaic = mosaic_shape(headers).select(F.struct("minx", "maxy", "res")).scalar()
    return headers.select(
        "path", "width", "height",
        half_even((F.col("minx") - mosaic["minx"]) / mosaic["res"]).alias("dx"),
        half_even((mosaic["maxy"] - F.col("maxy")) / mosaic["res"]).alias("dy"),
    )


def crowded_tiles(headers: DataFrame) -> DataFrame:
    """Paths of tiles that may overlap another one: tiles that share a tile-sized grid cell.

    Counting tiles per cell finds them without pairing tiles; tiles that merely share a cell
    are included, which costs time but not correctness.
    """
    placed = _placed(headers)
    size = headers.agg(F.struct(F.max("width").alias("w"), F.max("height").alias("h"))).scalar()
    cell = lambda off, extent, by: F.sequence(
        F.floor(off / by), F.floor((off + extent - 1) / by)
    )
    cells = placed.select(
        "path", F.explode(cell(F.col("dx"), F.col("width"), size["w"])).alias("cx"), "dy", "height"
    ).select(
        "path", "cx", F.explode(cell(F.col("dy"), F.col("height"), size["h"])).alias("cy")
    )
    crowded = cells.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return cells.join(crowded, ["cx", "cy"], "left_semi").select("path").distinct()


def mosaic(pixels: DataFrame, headers: DataFrame) -> DataFrame:
    """Cells of all tiles on the mosaic grid; where tiles overlap the last path wins.

    ``pixels`` holds ``path, lx, ly, z`` with positions inside the tile. Only tiles that may
    overlap are aggregated; the cells of all others pass through without a shuffle.
    """
    shared = crowded_tiles(headers).withColumn("_shared", F.lit(True))
    tiles = _placed(headers).select("path", "dx", "dy").join(shared, "path", "left")
    placed = pixels.join(tiles, "path").select(
        (F.col("lx") + F.col("dx")).cast("bigint").alias("px"),
        (F.col("ly") + F.col("dy")).cast("bigint").alias("py"),
        "z", "path", "_shared",
    )
    alone = placed.where(F.col("_shared").isNull()).select("px", "py", "z")
    merged = (
        placed.where(F.col("_shared"))
        .groupBy("px", "py")
        .agg(F.max_by("z", "path").alias("z"))
    )
    return alone.unionByName(merged)


def overlap_count(pixels: DataFrame, headers: DataFrame) -> DataFrame:
    """How many mosaic cells are given by more than one tile."""
    placed = pixels.join(crowded_tiles(headers), "path", "left_semi").join(
        _placed(headers).select("path", "dx", "dy"), "path"
    )
    return (
        placed.groupBy((F.col("lx") + F.col("dx")).alias("px"), (F.col("ly") + F.col("dy")).alias("py"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("overlapping_cells"))
    )


def clip_window(
    headers: DataFrame, bbox: Sequence[float] | None, grid_res: float | None = None
) -> DataFrame:
    """The window of a mosaic that a box selects after snapping to the grid and clamping.

    One row: offset and size in cells, and the bounds. No row when nothing overlaps.
    """
    shape = mosaic_shape(headers)
    limits = F.struct(*_BOX)
    if bbox is None:
        cut = limits
    else:
        wanted = F.struct(*[F.lit(float(v)).alias(n) for v, n in zip(bbox, _BOX)])
        cut = clamp_bounds(snap_outward(wanted, grid_res or 1.0), limits)
    b = F.col("_cut")
    return shape.withColumn("_cut", cut).where(b.isNotNull()).select(
        half_even((b["minx"] - F.col("minx")) / F.col("res")).alias("col_off"),
        half_even((F.col("maxy") - b["maxy"]) / F.col("res")).alias("row_off"),
        half_even((b["maxx"] - b["minx"]) / F.col("res")).alias("width"),
        half_even((b["maxy"] - b["miny"]) / F.col("res")).alias("height"),
        *[b[n].alias(n) for n in _BOX],
    )


def clip_pixels(cells: DataFrame, window: DataFrame) -> DataFrame:
    """Cells inside a window, renumbered from its upper-left corner.

    The window enters as scalar subqueries, so the range filter is decided before the scan.
    """
    value = lambda c: window.select(c).scalar()
    col0, row0 = value("col_off"), value("row_off")
    right = window.select(F.col("col_off") + F.col("width")).scalar()
    bottom = window.select(F.col("row_off") + F.col("height")).scalar()
    inside = (
        (F.col("px") >= col0) & (F.col("px") < right)
        & (F.col("py") >= row0) & (F.col("py") < bottom)
    )
    return cells.where(inside).withColumn("px", F.col("px") - col0).withColumn(
        "py", F.col("py") - row0
    )


# -- overviews ------------------------------------------------------------------------------


def overview(cells: DataFrame, factor: int, nodata: float = DEFAULT_NODATA) -> DataFrame:
    """Mean of the valid cells per ``factor`` × ``factor`` block of the merged grid."""
    return _with_mean(_level(_valid(cells, nodata), factor), factor, nodata)


def _valid(cells: DataFrame, nodata: float) -> DataFrame:
    ok = F.col("z").isNotNull() & (F.col("z") != nodata)
    return cells.select(
        F.col("px").alias("ox"), F.col("py").alias("oy"),
        F.when(ok, F.col("z")).otherwise(0.0).alias("sum_z"),
        ok.cast("bigint").alias("n_valid"),
    )


def _level(finer: DataFrame, ratio: int) -> DataFrame:
    """Sums and counts of blocks; partial sums are combined before the shuffle."""
    block = lambda c: F.floor(F.col(c) / F.lit(ratio)).cast("bigint")
    return finer.groupBy(block("ox").alias("ox"), block("oy").alias("oy")).agg(
        F.sum("sum_z").alias("sum_z"), F.sum("n_valid").alias("n_valid")
    )


def _with_mean(level: DataFrame, factor: int, nodata: float) -> DataFrame:
    mean = F.when(F.col("n_valid") > 0, F.col("sum_z") / F.col("n_valid")).otherwise(F.lit(nodata))
    return level.select(
        F.lit(factor).alias("factor"), "ox", "oy", "sum_z", "n_valid", mean.alias("z")
    )


def pyramid(
    cells: DataFrame, factors: Sequence[int], nodata: float = DEFAULT_NODATA
) -> DataFrame:
    """All overview levels, each from the one before by sums and counts.

    Sums and counts make every level equal to averaging the native cells directly, with nodata
    and partial edge blocks too. Every factor must be a multiple of its predecessor.
    """
    previous, source, levels = 1, _valid(cells, nodata), []
    for factor in factors:
        if factor <= previous or factor % previous:
            raise ValueError(f"factor {factor} is not a multiple of {previous}")
        source = _level(source, factor // previous)
        levels.append(_with_mean(source, factor, nodata))
        previous = factor
    if not levels:
        raise ValueError("at least one overview factor is required")
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    return whole


def _doublings(start: int, longest: int, stop: int) -> list[int]:
    factors = [start]
    while longest // factors[-1] > stop:
        factors.append(factors[-1] * 2)
    return factors


def integer_ratio(native: float, ensure: float) -> int:
    """Whole number of native cells along a guaranteed overview cell, within the tolerance."""
    cells = int(ensure / native + 0.5) if native > 0 else 0
    if cells < 1 or abs(ensure - cells * native) > RATIO_TOLERANCE * ensure:
        raise ValueError(f"no whole number of cells of size {native} makes one of size {ensure}")
    return cells


def overview_factors(
    native: float, ensure: float | None, width: int, height: int, stop: int = STOP_DIM
) -> list[int]:
    """Factors of a pyramid that is sure to hold the resolution ``ensure``.

    Powers of two that divide the guaranteed factor, the factor, then its doublings until the
    longest side is at most ``stop``. Without ``ensure`` plain powers of two.
    """
    longest = max(width, height)
    factor = 1 if ensure is None else integer_ratio(native, ensure)
    if factor == 1:
        return _doublings(2, longest, stop)
    powers = [2**k for k in range(1, factor.bit_length()) if 2**k < factor]
    return [p for p in powers if factor % p == 0] + _doublings(factor, longest, stop)


def overview_factor_list(
    native: Column, ensure: Column, width: Column, height: Column, stop: int = STOP_DIM
) -> Column:
    """``overview_factors`` for a table of mosaics; NULL where the ratio is not a whole number."""
    ratio = ensure / native
    whole = ensure.isNull() | (
        (native > 0) & (ensure >= native)
        & (F.abs(ratio - F.rint(ratio)) <= RATIO_TOLERANCE * F.greatest(F.rint(ratio), F.lit(1.0)))
    )
    bits = lambda n: F.when(n > 0, F.length(F.bin(n))).otherwise(0)
    none = F.array().cast("array<bigint>")
    powers = lambda first, base, count: F.when(
        count > 0,
        F.transform(F.sequence(first, first + count - 1), lambda k: F.pow(F.lit(2.0), k).cast("bigint") * base),
    ).otherwise(none)

    def levels(s: Column) -> Column:
        factor, start = s["factor"], F.when(s["factor"] == 1, F.lit(2)).otherwise(s["factor"])
        # Powers of two below the factor that divide it: up to its lowest set bit.
        low = bits(factor.bitwiseAND(-factor)) - 1
        low = F.when(F.pow(F.lit(2.0), low).cast("bigint") == factor, low - 1).otherwise(low)
        # Doublings until longest // f <= stop, that is 2**d > longest // ((stop + 1) * start).
        more = bits(F.floor(s["longest"] / (start * (stop + 1))))
        return F.concat(
            powers(F.lit(1), F.lit(1).cast("bigint"), low),
            powers(F.lit(0), start.cast("bigint"), more + 1),
        )

    facts = F.struct(
        F.coalesce(half_even(ratio), F.lit(1).cast("bigint")).alias("factor"),
        F.greatest(width, height).alias("longest"),
    )
    return F.when(whole, bind(facts, levels))


def required_levels(
    levels: DataFrame, native: float, required: Sequence[float]
) -> DataFrame:
    """Whether each required resolution has a level (within 1e-6)."""
    wanted = F.array(*[F.lit(float(r)) for r in required])
    # One row: a pyramid has tens of levels.
    factors = levels.agg(F.collect_set("factor").alias("factors"))
    at = lambda f: f * F.lit(float(native))
    return factors.select(F.explode(wanted).alias("resolution"), "factors").select(
        "resolution",
        F.exists(
            "factors",
            lambda f: F.abs(at(f) - F.col("resolution"))
            <= RATIO_TOLERANCE * F.greatest(at(f), F.col("resolution")),
        ).alias("present"),
    )


# -- regions and verification ---------------------------------------------------------------


def region_grid(bounds: DataFrame, region_size: float, grid_res: float) -> DataFrame:
    """Aligned regions of snapped bounds, row by row; edge regions may be smaller."""
    if region_size <= 0 or grid_res <= 0:
        raise ValueError("region size and grid resolution must be positive")
    step = F.lit(math.ceil(region_size / grid_res) * grid_res)
    snapped = bounds.select(snap_outward(F.struct(*_BOX), grid_res).alias("b"))
    count = lambda low, high: F.greatest(
        F.ceil((F.col(f"b.{high}") - F.col(f"b.{low}")) / step), F.lit(1)
    )
    rows = snapped.select("b", F.explode(F.sequence(F.lit(0), count("miny", "maxy") - 1)).alias("row"))
    cells = rows.select(
        "b", "row", F.explode(F.sequence(F.lit(0), count("minx", "maxx") - 1)).alias("col")
    )
    left = F.col("b.minx") + F.col("col") * step
    low = F.col("b.miny") + F.col("row") * step
    return cells.select(
        F.col("col").cast("int").alias("region_col"), F.col("row").cast("int").alias("region_row"),
        left.alias("minx"), low.alias("miny"),
        F.least(left + step, F.col("b.maxx")).alias("maxx"),
        F.least(low + step, F.col("b.maxy")).alias("maxy"),
    )


def assign_region(
    df: DataFrame, bounds: Sequence[float], region_size: float, grid_res: float,
    x: Column, y: Column,
) -> DataFrame:
    """Region of each point by arithmetic on the grid of ``region_grid``; no join. Points beyond the
    bounds have none; the far edges belong to the last regions."""
    minx, miny = (math.floor(v / grid_res) * grid_res for v in bounds[:2])
    maxx, maxy = (math.ceil(v / grid_res) * grid_res for v in bounds[2:])
    step = math.ceil(region_size / grid_res) * grid_res
    inside = x.between(minx, maxx) & y.between(miny, maxy)
    index = lambda v, low, high: F.when(inside, F.least(
        F.floor((v - F.lit(low)) / F.lit(step)),
        F.lit(max(1, math.ceil((high - low) / step)) - 1),
    )).cast("int")
    return df.withColumn("region_col", index(x, minx, maxx)).withColumn(
        "region_row", index(y, miny, maxy)
    )


def verify_lossy(
    original: DataFrame, encoded: DataFrame, max_err: float = MAX_Z_ERROR,
    nodata: float = DEFAULT_NODATA, tile: int = STOP_DIM,
) -> DataFrame:
    """Per tile: largest error, cells over the bound, and cells valid on one side only."""
    a = original.select("px", "py", F.col("z").alias("za"))
    b = encoded.select("px", "py", F.col("z").alias("zb"))
    valid = lambda z: F.col(z).isNotNull() & (F.col(z) != nodata)
    error = F.when(valid("za") & valid("zb"), F.abs(F.col("za") - F.col("zb")))
    return (
        a.join(b, ["px", "py"], "full")
        .groupBy(
            F.floor(F.col("px") / tile).cast("bigint").alias("tile_col"),
            F.floor(F.col("py") / tile).cast("bigint").alias("tile_row"),
        )
        .agg(
            F.max(error).alias("max_error"),
            F.count_if(error > max_err).alias("over_bound"),
            F.count_if(valid("za") != valid("zb")).alias("nodata_mismatch"),
            F.count(F.lit(1)).alias("cells"),
        )
    )


def grid_validate(outputs: DataFrame, expected: DataFrame, key: str = "path") -> DataFrame:
    """All mismatches of each output against what was expected, not only the first.

    Both sides hold ``width, height, crs, nodata, dtype`` per ``path``.
    """
    want = expected.select(
        key, *[F.col(c).alias(f"want_{c}") for c in ("width", "height", "crs", "nodata", "dtype")]
    )
    differ = lambda c: ~F.col(c).eqNullSafe(F.col(f"want_{c}"))
    gap = F.abs(F.col("nodata") - F.col("want_nodata"))
    close = gap <= NODATA_TOLERANCE * F.greatest(F.abs("nodata"), F.abs("want_nodata"))
    checks = F.array_compact(F.array(
        F.when(F.col("_present").isNull(), F.lit("missing")),
        F.when(differ("crs"), F.lit("crs")),
        F.when(~F.coalesce(close, F.lit(False)), F.lit("nodata")),
        F.when(differ("dtype"), F.lit("dtype")),
        F.when(differ("width") | differ("height"), F.lit("size")),
    ))
    return (
        want.join(outputs.withColumn("_present", F.lit(True)), key, "left")
        .select(key, checks.alias("mismatches"))
        .where(F.size("mismatches") > 0)
    )
