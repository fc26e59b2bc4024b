"""Raster tile sets, mosaics, overviews and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilelake.functions.grid import quantize
from tilelake.operators import blocks, raster
from tilelake.plans import lifecycle
from tilelake.plans.fixtures import table, view
from tilelake.queries.registry import query
from tilelake.session import scratch_path


def headers(spark, sf):
    h = view(spark, sf, "raster_headers")
    return h.select(
        "path", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"),
        "minx", "miny", "maxx", "maxy", F.lit(0.5).alias("pixel_size_x"), F.lit(0.5).alias("pixel_size_y"),
        F.lit("EPSG:3763").alias("crs"), F.lit("float32").alias("dtype"), F.lit(1).alias("band_count"),
        F.lit(False).alias("rotated"), F.lit(-999.0).alias("nodata"), "tile_col", "tile_row")


def cells(spark, sf):
    return view(spark, sf, "pixels").select("px", F.col("py").cast("bigint").alias("py"), "z")


def tile_cells(spark, sf):
    """Cells by tile, positioned inside their tile."""
    p = view(spark, sf, "pixels")
    path = F.concat(F.lit("tile-"), F.lpad(F.col("tile_row").cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(F.col("tile_col").cast("string"), 4, "0"), F.lit(".tif"))
    return p.select(path.alias("path"), (F.col("px") - F.col("tile_col") * 32).alias("lx"),
                    (F.col("py") - F.col("tile_row") * 32).alias("ly"), "z")


_SHAPE_SQL = "(SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM raster_headers) s"


@query("union_bounds", f"SELECT cast(minx * 10 AS bigint) AS minx, cast(miny * 10 AS bigint) AS miny, cast(maxx * 10 AS bigint) AS maxx, cast(maxy * 10 AS bigint) AS maxy FROM {_SHAPE_SQL}")
def union_bounds(spark, sf):
    return raster.union_bounds(headers(spark, sf)).select(*[(F.col(c) * 10).cast("bigint").alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query("mosaic_shape", "SELECT max(px) + 1 AS width, cast(max(py) + 1 AS bigint) AS height FROM pixels")
def mosaic_shape(spark, sf):
    return raster.mosaic_shape(headers(spark, sf)).select("width", "height")


def flawed(spark, sf):
    """Headers with one planted defect in five of seven tiles."""
    m = (F.col("tile_row") * 4 + F.col("tile_col")) % 7
    put = lambda at, value, c: F.when(m == at, value).otherwise(F.col(c)).alias(c)
    return headers(spark, sf).select(
        "path", "width", "height", "minx", "miny", "maxx", "maxy",
        put(3, F.lit(0.5 + 1e-6), "pixel_size_x"), "pixel_size_y", put(1, F.lit("EPSG:4326"), "crs"),
        put(2, F.lit("int16"), "dtype"), put(5, F.lit(3), "band_count"), put(4, F.lit(True), "rotated"), "nodata")


_DEFECT_SQL = "CASE (tile_row * 4 + tile_col) % 7 WHEN 1 THEN 'crs' WHEN 2 THEN 'dtype' WHEN 3 THEN 'pixel_size' WHEN 4 THEN 'rotated' WHEN 5 THEN 'band_count' END"


@query("tileset_audit", f"SELECT path, {_DEFECT_SQL} AS violations FROM raster_headers WHERE {_DEFECT_SQL} IS NOT NULL")
def tileset_audit(spark, sf):
    return raster.tileset_audit(flawed(spark, sf)).select("path", F.array_join("violations", ",").alias("violations"))


_SAMPLE_SQL = """(SELECT *, n <= 5 OR (rn - 1) % greatest(1, n // 5) = 0 OR rn = n AS sampled
FROM (SELECT *, row_number() OVER (ORDER BY path) AS rn, count(*) OVER () AS n FROM raster_headers) w) h"""


@query("tileset_audit_fast", f"SELECT path, {_DEFECT_SQL} AS violations FROM {_SAMPLE_SQL} WHERE {_DEFECT_SQL} = 'band_count' OR ({_DEFECT_SQL} IS NOT NULL AND sampled)")
def tileset_audit_fast(spark, sf):
    return raster.tileset_audit(flawed(spark, sf), fast=True, sample=5).select("path", F.array_join("violations", ",").alias("violations"))


@query("sample_every", f"SELECT path FROM {_SAMPLE_SQL} WHERE sampled")
def sample_every(spark, sf):
    return raster.sample_every(headers(spark, sf), 5).select("path")


@query("resolve_nodata", """
SELECT c.scenario, c.nodata, c.issue, n AS tiles, CASE c.scenario WHEN 'partly' THEN first_col WHEN 'none' THEN n ELSE 0 END AS missing
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE tile_col = 0) AS first_col FROM raster_headers) h,
     (VALUES ('override', 7, NULL), ('common', -999, NULL), ('mixed', NULL, 'inconsistent'), ('partly', NULL, 'partly_missing'), ('none', -999, 'defaulted')) c(scenario, nodata, issue)""")
def resolve_nodata(spark, sf):
    h = headers(spark, sf)
    other = lambda value: h.withColumn("nodata", F.when(F.col("tile_col") == 0, value).otherwise(F.col("nodata")))
    scenarios = {
        "override": (other(F.lit(-1.0)), 7.0), "common": (h, None), "mixed": (other(F.lit(-1.0)), None),
        "partly": (other(F.lit(None)), None), "none": (h.withColumn("nodata", F.lit(None).cast("double")), None),
    }
    out = None
    for name, (tiles, override) in scenarios.items():
        row = raster.resolve_nodata(tiles, override).select(
            F.lit(name).alias("scenario"), F.col("nodata").cast("int").alias("nodata"), "issue", "tiles",
            F.when(F.lit(name == "override"), F.lit(0)).otherwise(F.col("missing")).alias("missing"))
        out = row if out is None else out.unionByName(row)
    return out


_LEVEL_SQL = """SELECT {f} AS factor, px // {f} AS ox, cast(py // {f} AS bigint) AS oy, cast(floor(sum(CASE WHEN z = -999.0 THEN 0 ELSE z END) * 10 + 0.5) AS bigint) AS sum_dz,
 count(*) FILTER (WHERE z <> -999.0) AS n_valid FROM pixels GROUP BY 1, 2, 3"""


def _level_ints(levels):
    return levels.select("factor", "ox", "oy", F.floor(F.col("sum_z") * 10 + 0.5).cast("bigint").alias("sum_dz"), "n_valid")


@query("overview", _LEVEL_SQL.format(f=5))
def overview(spark, sf):
    return _level_ints(raster.overview(cells(spark, sf), 5))


@query("pyramid", " UNION ALL ".join(_LEVEL_SQL.format(f=f) for f in (2, 4, 20, 40, 80)))
def pyramid(spark, sf):
    return _level_ints(raster.pyramid(cells(spark, sf), [2, 4, 20, 40, 80]))


@query("pyramid_blocks", " UNION ALL ".join(_LEVEL_SQL.format(f=f) for f in (2, 5, 20, 48, 80)))
def pyramid_blocks(spark, sf):
    packed = blocks.pack_blocks(cells(spark, sf), 32)
    return _level_ints(blocks.pyramid_blocks(packed, [2, 5, 20, 48, 80], 32))


@query("overview_blocks", _LEVEL_SQL.format(f=4))
def overview_blocks(spark, sf):
    packed = blocks.pack_blocks(cells(spark, sf), 32)
    return _level_ints(blocks.overview_blocks(packed, 4, 32))


@query("unpack_blocks", "SELECT px, cast(py AS bigint) AS py, cast(floor(z * 10 + 0.5) AS bigint) AS dz FROM pixels")
def unpack_blocks(spark, sf):
    out = blocks.unpack_blocks(blocks.pack_blocks(cells(spark, sf), 32), 32)
    return out.select("px", "py", F.floor(F.col("z") * 10 + 0.5).cast("bigint").alias("dz"))


_FACTOR_SQL = """
SELECT o_orderkey, CASE WHEN whole THEN array_to_string(list_concat(
    [p FOR p IN [2, 4, 8, 16, 32, 64, 128] IF p < f AND f % p = 0],
    [s * (2 ^ k)::bigint FOR k IN range(0, 20) IF k = 0 OR side // (s * (2 ^ k)::bigint // 2) > 512]), ',') END AS factors
FROM (SELECT *, CASE WHEN f = 1 THEN 2 ELSE f END AS s FROM (
  SELECT o_orderkey, 1 + o_orderkey % 40 AS f, o_orderkey % 11 <> 0 AS whole, greatest(o_custkey * 20 + 1, o_orderkey + 1) AS side FROM orders) a) b"""


@query("overview_factors", _FACTOR_SQL)
def overview_factors(spark, sf):
    k = F.col("o_orderkey")
    ensure = 0.5 * (k % 40 + 1) + F.when(k % 11 == 0, F.lit(0.1)).otherwise(F.lit(0.0))
    factors = raster.overview_factor_list(F.lit(0.5), ensure, F.col("o_custkey") * 20 + 1, k + 1)
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(factors.cast("array<string>"), ",").alias("factors"))


@query("required_levels", """
SELECT (f * 5)::int AS resolution_dm, f IN (2, 4, 20) AS present FROM (SELECT unnest([2, 4, 5, 20, 40]) AS f) t WHERE (SELECT count(*) FROM pixels) > 0""")
def required_levels(spark, sf):
    levels = raster.pyramid(cells(spark, sf), [2, 4, 20])
    return raster.required_levels(levels, 0.5, [1.0, 2.0, 2.5, 10.0, 20.0]).select(
        (F.col("resolution") * 10).cast("int").alias("resolution_dm"), "present")


@query("mosaic", "SELECT px, cast(py AS bigint) AS py, cast(floor(z * 10 + 0.5) AS bigint) AS dz FROM pixels")
def mosaic(spark, sf):
    merged = raster.mosaic(tile_cells(spark, sf), headers(spark, sf))
    return merged.select("px", "py", F.floor(F.col("z") * 10 + 0.5).cast("bigint").alias("dz"))


def _overlapping(spark, sf):
    """The tiles plus a later copy of the second column, moved by eight cells, with raised cells."""
    h, t = headers(spark, sf), tile_cells(spark, sf)
    moved = h.where("tile_col = 1").withColumn("path", F.concat(F.lit("zz-"), "path")).withColumn(
        "minx", F.col("minx") + 4.0).withColumn("maxx", F.col("maxx") + 4.0)
    copies = t.where(F.col("path").endswith("-0001.tif")).withColumn("path", F.concat(F.lit("zz-"), "path")).withColumn("z", F.col("z") + 1)
    return t.unionByName(copies), h.unionByName(moved)


@query("mosaic_overlap", """
SELECT px, cast(py AS bigint) AS py, cast(floor(z * 10 + 0.5) AS bigint) AS dz FROM (SELECT *, row_number() OVER (PARTITION BY px, py ORDER BY late DESC) AS rn
FROM (SELECT px, py, z, 0 AS late FROM pixels UNION ALL SELECT px + 8, py, z + 1, 1 FROM pixels WHERE tile_col = 1) u) r WHERE rn = 1""")
def mosaic_overlap(spark, sf):
    merged = raster.mosaic(*_overlapping(spark, sf))
    return merged.select("px", "py", F.floor(F.col("z") * 10 + 0.5).cast("bigint").alias("dz"))


@query("overlap_count", "SELECT count(*) AS overlapping_cells FROM pixels a JOIN (SELECT px + 8 AS px, py FROM pixels WHERE tile_col = 1) b ON a.px = b.px AND a.py = b.py")
def overlap_count(spark, sf):
    return raster.overlap_count(*_overlapping(spark, sf))


@query("clip_pixels", """
SELECT px - 25 AS px, cast(py - 20 AS bigint) AS py, cast(floor(z * 10 + 0.5) AS bigint) AS dz FROM pixels WHERE px >= 25 AND px < 105 AND py >= 20""")
def clip_pixels(spark, sf):
    # Snapped to 2.5 m: west 12.5, north -10, east 52.5; the south is clamped to the mosaic.
    window = raster.clip_window(headers(spark, sf), (13.3, -1e9, 50.9, -12.4), 2.5)
    out = raster.clip_pixels(cells(spark, sf), window)
    return out.select("px", "py", F.floor(F.col("z") * 10 + 0.5).cast("bigint").alias("dz"))


@query("clip_blocks", """
SELECT px - 25 AS px, cast(py - 20 AS bigint) AS py, cast(floor(z * 10 + 0.5) AS bigint) AS dz FROM pixels WHERE px >= 25 AND px < 105 AND py >= 20""")
def clip_blocks(spark, sf):
    """The window of clip_pixels, from blocks that were written by their key."""
    path = scratch_path(spark, "blocks")
    blocks.write_blocks(blocks.pack_blocks(cells(spark, sf), 16), path)
    w = raster.clip_window(headers(spark, sf), (13.3, -1e9, 50.9, -12.4), 2.5).first()
    col, row, width, height = (int(w[c]) for c in ("col_off", "row_off", "width", "height")) if w else (0, 0, 0, 0)
    out = blocks.read_window(spark, path, col, row, col + width, row + height, 16)
    return out.select((F.col("px") - col).alias("px"), (F.col("py") - row).alias("py"), F.floor(F.col("z") * 10 + 0.5).cast("bigint").alias("dz"))


_LOSSY_SQL = """
SELECT px // 32 AS tile_col, cast(py // 32 AS bigint) AS tile_row, max(CASE WHEN z <> -999.0 AND py % 50 <> 3 THEN (px % 4) * 2 END)::bigint AS max_error_cm,
       count(*) FILTER (WHERE z <> -999.0 AND py % 50 <> 3 AND px % 4 = 3) AS over_bound,
       count(*) FILTER (WHERE z <> -999.0 AND py % 50 = 3) AS nodata_mismatch, count(*) AS cells FROM pixels GROUP BY 1, 2"""


def _lossy(original):
    return original.withColumn("z", F.when((F.col("py") % 50 == 3) | (F.col("z") == -999.0), F.lit(-999.0)).otherwise(
        F.col("z") + (F.col("px") % 4) * 0.02))


def _lossy_ints(out):
    return out.select("tile_col", "tile_row", F.floor(F.col("max_error") * 100 + 0.5).cast("bigint").alias("max_error_cm"),
                      "over_bound", "nodata_mismatch", "cells")


@query("verify_lossy", _LOSSY_SQL)
def verify_lossy(spark, sf):
    original = cells(spark, sf)
    return _lossy_ints(raster.verify_lossy(original, _lossy(original), 0.05, tile=32))


@query("verify_lossy_blocks", _LOSSY_SQL)
def verify_lossy_blocks(spark, sf):
    original = cells(spark, sf)
    pair = (blocks.pack_blocks(c, 40) for c in (original, _lossy(original)))
    return _lossy_ints(blocks.verify_lossy_blocks(*pair, 0.05, tile=32, block=40))


@query("grid_validate", """
SELECT path, CASE (tile_row * 4 + tile_col) % 7 WHEN 0 THEN 'missing,crs,nodata,dtype,size' WHEN 1 THEN 'crs' WHEN 2 THEN 'dtype' WHEN 3 THEN 'nodata' ELSE 'size' END AS mismatches
FROM raster_headers WHERE (tile_row * 4 + tile_col) % 7 IN (0, 1, 2, 3, 4)""")
def grid_validate(spark, sf):
    want = headers(spark, sf)
    m = (F.col("tile_row") * 4 + F.col("tile_col")) % 7
    got = want.where(m != 0).withColumn("crs", F.when(m == 1, F.lit("EPSG:4326")).otherwise(F.col("crs"))).withColumn(
        "dtype", F.when(m == 2, F.lit("int16")).otherwise(F.col("dtype"))).withColumn(
        "nodata", F.when(m == 3, F.lit(0.0)).otherwise(F.col("nodata"))).withColumn("width", F.when(m == 4, 1).otherwise(F.col("width")))
    checked = raster.grid_validate(got.select("path", "width", "height", "crs", "nodata", "dtype"), want)
    return checked.select("path", F.array_join("mismatches", ",").alias("mismatches"))


_REGION_SQL = f"""(SELECT floor(minx / 2.5) * 2.5 AS minx, floor(miny / 2.5) * 2.5 AS miny, ceil(maxx / 2.5) * 2.5 AS maxx, ceil(maxy / 2.5) * 2.5 AS maxy FROM {_SHAPE_SQL}) g"""


@query("region_grid", f"""
SELECT c::int AS region_col, r::int AS region_row, cast((minx + c * 12.5) * 10 AS bigint) AS minx, cast((miny + r * 12.5) * 10 AS bigint) AS miny,
       cast(least(minx + (c + 1) * 12.5, maxx) * 10 AS bigint) AS maxx, cast(least(miny + (r + 1) * 12.5, maxy) * 10 AS bigint) AS maxy
FROM {_REGION_SQL}, range(2000) cs(c), range(2000) rs(r) WHERE c < greatest(1, ceil((maxx - minx) / 12.5)) AND r < greatest(1, ceil((maxy - miny) / 12.5))""")
def region_grid(spark, sf):
    out = raster.region_grid(raster.union_bounds(headers(spark, sf)), 11.0, 2.5)
    return out.select("region_col", "region_row", *[(F.col(c) * 10).cast("bigint").alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query("assign_region", """
SELECT px, cast(py AS bigint) AS py, CASE WHEN ok THEN least(floor((px * 0.5 + 0.25 - 0) / 12.5), 5)::int END AS region_col, CASE WHEN ok THEN least(floor((-py * 0.5 - 0.25 + 5000) / 12.5), 399)::int END AS region_row
FROM (SELECT *, px * 0.5 + 0.25 BETWEEN 0 AND 65 AND -py * 0.5 - 0.25 BETWEEN -5000 AND 0 AS ok FROM pixels) p""")
def assign_region(spark, sf):
    x, y = F.col("px") * 0.5 + 0.25, -F.col("py") * 0.5 - 0.25
    return raster.assign_region(cells(spark, sf), (0.0, -5000.0, 64.0, 0.0), 11.0, 2.5, x, y).select("px", "py", "region_col", "region_row")


@query("merge_tiles", """
SELECT count(*) AS cells, count(*) FILTER (WHERE z <> -999.0) AS n_valid,
       sum(CASE WHEN z = -999.0 THEN -4995 ELSE cast(floor(z / 0.2 + 0.5) AS bigint) END)::bigint AS sum_half_dz FROM pixels""")
def merge_tiles(spark, sf):
    merged = lifecycle.merge_tiles(tile_cells(spark, sf), headers(spark, sf), ensure_res=10.0, max_err=0.1)
    half = F.when(F.col("z") == -999.0, F.lit(-4995)).otherwise(F.floor(F.col("z") / 0.2 + 0.5)).cast("bigint")
    return merged.cells.agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("z") != -999.0).alias("n_valid"), F.sum(half).alias("sum_half_dz"))


@query("merge_tiles_levels", " UNION ALL ".join(_LEVEL_SQL.format(f=f) for f in (2, 4, 20)))
def merge_tiles_levels(spark, sf):
    # 10 m is 20 cells of 0.5 m; of the powers of two, 2 and 4 divide 20.
    merged = lifecycle.merge_tiles(tile_cells(spark, sf), headers(spark, sf), ensure_res=10.0)
    return _level_ints(merged.levels)


@query("quantize_mosaic", "SELECT px, cast(py AS bigint) AS py, CASE WHEN z = -999.0 THEN -9990 ELSE cast(floor(z / 0.8 + 0.5) * 8 AS bigint) END AS dz FROM pixels")
def quantize_mosaic(spark, sf):
    merged = raster.mosaic(tile_cells(spark, sf), headers(spark, sf))
    return merged.select("px", "py", F.floor(quantize(F.col("z"), 0.4) * 10 + 0.5).cast("bigint").alias("dz"))
