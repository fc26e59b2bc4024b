"""Projections, polygons, areas of interest and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilelake.functions import grid
from tilelake.functions import projections as pj
from tilelake.functions import rings as rg
from tilelake.operators import spatial
from tilelake.operators.slices import row_numbers
from tilelake.plans import lifecycle
from tilelake.plans.fixtures import table, view
from tilelake.queries.registry import query
from tilelake.queries.scalars import int_columns, tile_rings

# -- projection SQL, step by step from the same published constants --------------------------


def _series(kind: str, coefficients, a: str, b: str) -> str:
    """Sum of c_j * cos|sin(2j a) * sinh|cosh(2j b)."""
    f, g = {"east": ("cos", "sinh"), "north": ("sin", "cosh")}[kind]
    return " + ".join(f"({c!r}) * {f}({2 * j} * {a}) * {g}({2 * j} * {b})" for j, c in enumerate(coefficients, 1))


def tm06_sql(source: str) -> str:
    """``source`` (with lon, lat) plus x, y in EPSG:3763."""
    return f"""(SELECT *, {pj._RECT!r} * (eta + {_series('east', pj._ALPHA, 'xi', 'eta')}) AS x,
       {pj._RECT!r} * (xi + {_series('north', pj._ALPHA, 'xi', 'eta')}) - ({pj._N0!r}) AS y
FROM (SELECT *, atanh(sin(lam) / sqrt(1 + t * t)) AS eta, atan2(t, cos(lam)) AS xi
FROM (SELECT *, radians(lon - ({pj._LON0_DEG!r})) AS lam,
             sinh(atanh(sin(radians(lat))) - {pj._E!r} * atanh({pj._E!r} * sin(radians(lat)))) AS t FROM {source}) p1) p2)"""


def from_tm06_sql(source: str) -> str:
    delta = " + ".join(f"({c!r}) * sin({2 * j} * chi)" for j, c in enumerate(pj._DELTA, 1))
    return f"""(SELECT *, degrees(atan2(sinh(h), cos(g))) + ({pj._LON0_DEG!r}) AS lon, degrees(chi + {delta}) AS lat
FROM (SELECT *, asin(sin(g) / cosh(h)) AS chi
FROM (SELECT *, eta - ({_series('east', pj._BETA, 'xi', 'eta')}) AS h, xi - ({_series('north', pj._BETA, 'xi', 'eta')}) AS g
FROM (SELECT *, x / {pj._RECT!r} AS eta, (y + ({pj._N0!r})) / {pj._RECT!r} AS xi FROM {source}) p1) p2) p3)"""


def _ea_y(lat: str) -> str:
    q = (f"{1 - pj._E2_WGS84!r} * (sin(radians({lat})) / (1 - {pj._E2_WGS84!r} * sin(radians({lat})) * sin(radians({lat}))) "
         f"+ atanh({pj._E_WGS84!r} * sin(radians({lat}))) / {pj._E_WGS84!r})")
    return f"{pj._A / (2 * pj._K0)!r} * ({q})"


_EA_X = f"{pj._A * pj._K0!r} * radians(lon)"
_EA_Y = _ea_y("lat")

_POINTS_SQL = "(SELECT c_custkey, -9.5 + (c_custkey % 300) / 100.0::double AS lon, 37.0 + (c_custkey % 500) / 100.0::double AS lat FROM customer) pts"


def _points(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey", (F.lit(-9.5) + (k % 300) / 100.0).alias("lon"), (F.lit(37.0) + (k % 500) / 100.0).alias("lat")
    )


def _scaled(column, name: str, power: int):
    return F.floor(column * 10**power + 0.5).cast("bigint").alias(name)


@query("to_tm06", f"SELECT c_custkey, cast(floor(x * 100 + 0.5) AS bigint) AS x_cm, cast(floor(y * 100 + 0.5) AS bigint) AS y_cm FROM {tm06_sql(_POINTS_SQL)} t")
def to_tm06(spark, sf):
    p = _points(spark, sf).select("c_custkey", pj.to_tm06(F.col("lon"), F.col("lat")).alias("p"))
    return p.select("c_custkey", _scaled(F.col("p.x"), "x_cm", 2), _scaled(F.col("p.y"), "y_cm", 2))


_CORNERS_SQL = "(SELECT DISTINCT cast((tx - 200) * 1000 AS double) AS x, cast((ty - 300) * 1000 AS double) AS y FROM cat_items_raw) c"


@query("from_tm06", f"""
SELECT cast(x AS bigint) AS x, cast(y AS bigint) AS y, cast(floor(lon * 1e7 + 0.5) AS bigint) AS lon_e7, cast(floor(lat * 1e7 + 0.5) AS bigint) AS lat_e7
FROM {from_tm06_sql(_CORNERS_SQL)} t""")
def from_tm06(spark, sf):
    corners = view(spark, sf, "cat_items_raw").selectExpr("(tx - 200) * 1000 AS x", "(ty - 300) * 1000 AS y").distinct()
    p = corners.select("x", "y", pj.from_tm06(F.col("x"), F.col("y")).alias("p"))
    return p.select("x", "y", _scaled(F.col("p.x"), "lon_e7", 7), _scaled(F.col("p.y"), "lat_e7", 7))


@query("to_equal_area", f"SELECT c_custkey, cast(floor({_EA_X} * 100 + 0.5) AS bigint) AS x_cm, cast(floor({_EA_Y} * 100 + 0.5) AS bigint) AS y_cm FROM {_POINTS_SQL}")
def to_equal_area(spark, sf):
    p = _points(spark, sf).select("c_custkey", pj.to_equal_area(F.col("lon"), F.col("lat")).alias("p"))
    return p.select("c_custkey", _scaled(F.col("p.x"), "x_cm", 2), _scaled(F.col("p.y"), "y_cm", 2))


@query("from_equal_area", f"SELECT c_custkey, cast(floor(lon * 1e6 + 0.5) AS bigint) AS lon_e6, cast(floor(lat * 1e6 + 0.5) AS bigint) AS lat_e6 FROM {_POINTS_SQL}")
def from_equal_area(spark, sf):
    out = _points(spark, sf).select("c_custkey", pj.to_equal_area(F.col("lon"), F.col("lat")).alias("p")).select(
        "c_custkey", pj.from_equal_area(F.col("p.x"), F.col("p.y")).alias("q"))
    return out.select("c_custkey", _scaled(F.col("q.x"), "lon_e6", 6), _scaled(F.col("q.y"), "lat_e6", 6))


_AOI_SQL = """(SELECT c_custkey, w, s, w + 0.02 + (c_custkey % 7) / 100.0::double AS e, s + 0.02 + (c_custkey % 5) / 100.0::double AS n
 FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN -28.5 ELSE -9.0 END + (c_custkey % 250) / 100.0::double AS w,
       37.013 + (c_custkey % 480) / 100.0::double AS s FROM customer) b) aoi"""


def lonlat_aoi(spark, sf):
    """Lon/lat rectangles, a quarter of them outside the mainland."""
    k = F.col("c_custkey")
    west = F.when(k % 4 == 0, F.lit(-28.5)).otherwise(F.lit(-9.0)) + (k % 250) / 100.0
    south = F.lit(37.013) + (k % 480) / 100.0
    boxes = table(spark, sf, "customer").select("c_custkey", west.alias("w"), south.alias("s")).select(
        "c_custkey", "w", "s", (F.col("w") + 0.02 + (k % 7) / 100.0).alias("e"), (F.col("s") + 0.02 + (k % 5) / 100.0).alias("n"))
    return boxes.select(
        F.col("c_custkey").cast("string").alias("aoi_id"), F.lit(0).alias("part_id"),
        rg.rectangle(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("rings"))


_MAINLAND_SQL = "w >= -9.56 AND s >= 36.95 AND e <= -6.19 AND n <= 42.16"


@query("metric_crs", f"SELECT cast(c_custkey AS varchar) AS aoi_id, CASE WHEN {_MAINLAND_SQL} THEN 'EPSG:3763' ELSE 'EPSG:6933' END AS crs FROM {_AOI_SQL}")
def metric_crs(spark, sf):
    return lonlat_aoi(spark, sf).select("aoi_id", pj.metric_crs(rg.ring_bounds(F.col("rings"))).alias("crs"))


def _l_shape(spark, sf):
    """L-shaped polygons on a whole-number grid."""
    k = F.col("s_suppkey")
    a, x, y = (k % 9 + 1) * 100, (k % 37) * 50, (k % 23) * 70
    p = lambda dx, dy: rg.point(F.col("x") + F.col("a") * dx, F.col("y") + F.col("a") * dy)
    return table(spark, sf, "supplier").select("s_suppkey", a.alias("a"), x.alias("x"), y.alias("y")).withColumn(
        "rings", F.array(F.array(p(0, 0), p(2, 0), p(2, 1), p(1, 1), p(1, 2), p(0, 2), p(0, 0))))


_L_SQL = "(SELECT s_suppkey, (s_suppkey % 9 + 1) * 100 AS a, (s_suppkey % 37) * 50 AS x, (s_suppkey % 23) * 70 AS y FROM supplier) l"


@query("ring_bounds", f"SELECT s_suppkey, x AS minx, y AS miny, x + 2 * a AS maxx, y + 2 * a AS maxy FROM {_L_SQL}")
def ring_bounds(spark, sf):
    out = _l_shape(spark, sf).select("s_suppkey", rg.ring_bounds(F.col("rings")).alias("b")).select("s_suppkey", "b.*")
    return int_columns(out, "minx", "miny", "maxx", "maxy")


@query("planar_area", f"SELECT s_suppkey, 3 * a * a AS area FROM {_L_SQL}")
def planar_area(spark, sf):
    return _l_shape(spark, sf).select("s_suppkey", rg.planar_area(F.col("rings")).cast("bigint").alias("area"))


@query("clip_to_box", f"""
SELECT s_suppkey, greatest(least(x + 2 * a, 1500) - greatest(x, 300), 0) * greatest(least(y + a, 1300) - greatest(y, 400), 0)
     + greatest(least(x + a, 1500) - greatest(x, 300), 0) * greatest(least(y + 2 * a, 1300) - greatest(y + a, 400), 0) AS area FROM {_L_SQL}""")
def clip_to_box(spark, sf):
    window = grid.box(F.lit(300), F.lit(400), F.lit(1500), F.lit(1300))
    return _l_shape(spark, sf).select(
        "s_suppkey", rg.planar_area(rg.clip_to_box(F.col("rings"), window)).cast("bigint").alias("area"))


@query("geometry_audit", """
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'unclosed' WHEN 2 THEN 'self_crossing' WHEN 3 THEN 'too_few_points,zero_area' ELSE 'zero_area' END AS defects
FROM supplier""")
def geometry_audit(spark, sf):
    k = F.col("s_suppkey")
    p = lambda dx, dy: rg.point(k + dx, k + dy)
    shapes = (
        F.array(p(0, 0), p(2, 0), p(2, 2), p(0, 2), p(0, 0)), F.array(p(0, 0), p(2, 0), p(2, 2), p(0, 2)),
        F.array(p(0, 0), p(2, 2), p(2, 0), p(0, 3), p(0, 0)), F.array(p(0, 0), p(1, 1), p(0, 0)),
        F.array(p(1, 1), p(1, 1), p(1, 1), p(1, 1)),
    )
    rings = F.array(F.element_at(F.array(*shapes), (k % 5 + 1).cast("int")))
    return table(spark, sf, "supplier").select("s_suppkey", F.array_join(rg.geometry_audit(rings), ",").alias("defects"))


# Rings of 40 to 1,200 vertices on a wave; in every third one, two vertices have changed places.
@query("geometry_audit_long", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'self_crossing' ELSE '' END AS defects FROM supplier")
def geometry_audit_long(spark, sf):
    k = F.col("s_suppkey")
    n = (k % 30 + 1) * 40
    # A few bytes become a ring of up to 1,200 vertices, so rows are spread before.
    rows = table(spark, sf, "supplier").select("s_suppkey").repartition(4 * spark.sparkContext.defaultParallelism)
    wave = F.transform(F.sequence(F.lit(0), n), lambda i: rg.point(i * 3 + k, F.lit(2.0) * (i % 5)))
    mixed = F.transform(wave, lambda p, i: F.when((k % 3 == 0) & i.isin(20, 21), F.get(wave, F.lit(41) - i)).otherwise(p))
    back = F.array(rg.point(n * 3 + k, F.lit(-50.0)), rg.point(k, F.lit(-50.0)), mixed[0])
    rings = rows.select("s_suppkey", F.array(F.concat(mixed, back)).alias("rings"))
    return spatial.audit(rings, "s_suppkey").select("s_suppkey", F.array_join("defects", ",").alias("defects"))


@query("to_geojson", f"""
SELECT s_suppkey, '{{"type":"Polygon","coordinates":[[' || string_agg('[' || px || '.0,' || py || '.0]', ',' ORDER BY i) || ']]}}' AS geometry
FROM (SELECT s_suppkey, i, x + a * CASE WHEN i IN (1, 2) THEN 2 WHEN i IN (3, 4) THEN 1 ELSE 0 END AS px,
             y + a * CASE WHEN i IN (2, 3) THEN 1 WHEN i IN (4, 5) THEN 2 ELSE 0 END AS py
      FROM {_L_SQL}, range(7) r(i)) v GROUP BY s_suppkey""")
def to_geojson(spark, sf):
    return _l_shape(spark, sf).select("s_suppkey", rg.to_geojson(F.col("rings")).alias("geometry"))


_AREA_SQL = f"""
SELECT aoi_id, crs, cast(floor(abs(sum(x * ny - nx * y)) / 2 / 100.0 + 0.5) AS bigint) AS area_100m2
FROM (SELECT aoi_id, crs, x, y, coalesce(lead(x) OVER o, first_value(x) OVER o) AS nx, coalesce(lead(y) OVER o, first_value(y) OVER o) AS ny
FROM (SELECT aoi_id, crs, i, CASE crs WHEN 'EPSG:3763' THEN x ELSE {_EA_X} END AS x, CASE crs WHEN 'EPSG:3763' THEN y ELSE {_EA_Y} END AS y
FROM {tm06_sql(f'''(SELECT cast(c_custkey AS varchar) AS aoi_id, i, CASE WHEN {_MAINLAND_SQL} THEN 'EPSG:3763' ELSE 'EPSG:6933' END AS crs,
      CASE WHEN i IN (0, 1) THEN e ELSE w END AS lon, CASE WHEN i IN (1, 2) THEN n ELSE s END AS lat FROM {_AOI_SQL}, range(4) r(i)) v''')} t) u
WINDOW o AS (PARTITION BY aoi_id ORDER BY i)) q GROUP BY aoi_id, crs"""


@query("area_km2", _AREA_SQL)
def area_km2(spark, sf):
    areas = spatial.aoi_area_km2(lonlat_aoi(spark, sf))
    return areas.select("aoi_id", "crs", F.floor(F.col("area_km2") * 10000 + 0.5).cast("bigint").alias("area_100m2"))


@query("overlapping_parts", "SELECT DISTINCT cast(s_nationkey AS varchar) AS aoi_id FROM supplier WHERE s_nationkey % 2 = 1 AND s_nationkey IN (SELECT s_nationkey FROM supplier GROUP BY s_nationkey HAVING count(*) > 1)")
def overlapping_parts(spark, sf):
    # Parts side by side for even areas; each shifted by half its width for odd ones.
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    rank = row_numbers(table(spark, sf, "supplier").select("s_nationkey", "s_suppkey"), ["s_nationkey"], ["s_suppkey"], "i")
    width = F.when(n % 2 == 1, F.lit(0.005)).otherwise(F.lit(0.01))
    west = F.lit(-9.0) + F.col("i") * width
    parts = rank.select(
        n.cast("string").alias("aoi_id"), k.cast("int").alias("part_id"),
        rg.rectangle(west, F.lit(38.0), west + 0.0099999, F.lit(38.01)).alias("rings"))
    return spatial.overlapping_parts(parts)


_MAX_KM2 = 10.0
_SIDE = 10.0**0.5 * 1000


_QUADS_SQL = f"""(SELECT c_custkey, k, CASE WHEN k < 2 THEN e ELSE w END AS lon, CASE WHEN k IN (1, 2) THEN n ELSE s END AS lat
  FROM {_AOI_SQL}, (VALUES (0), (1), (2), (3)) v(k) WHERE {_MAINLAND_SQL}) corners"""


# On the mainland an area is a slanting quadrangle: a cell of its grid counts if it isn't all on the outer side of an edge.
@query("chunk_aoi", f"""
WITH xy AS (SELECT c_custkey, k, x, y FROM {tm06_sql(_QUADS_SQL)} t),
edge AS (SELECT p.c_custkey, p.x AS px, p.y AS py, q.x - p.x AS dx, q.y - p.y AS dy, q.x AS qx, q.y AS qy FROM xy p JOIN xy q ON p.c_custkey = q.c_custkey AND q.k = (p.k + 1) % 4),
area AS (SELECT c_custkey, abs(sum((px - x0) * (qy - y0) - (qx - x0) * (py - y0))) / 2 AS m2 FROM edge JOIN (SELECT c_custkey, min(x) AS x0, min(y) AS y0 FROM xy GROUP BY 1) o USING (c_custkey) GROUP BY 1),
box AS (SELECT c_custkey, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM xy GROUP BY 1),
col AS (SELECT *, unnest(range(0, ceil((x1 - x0) / {_SIDE!r})::bigint)) AS i FROM box),
cell AS (SELECT *, unnest(range(0, ceil((y1 - y0) / {_SIDE!r})::bigint)) AS j FROM col),
seen AS (SELECT c_custkey, i, j, min(
    dx * (CASE WHEN dx > 0 THEN least(y0 + (j + 1) * {_SIDE!r}, y1) ELSE y0 + j * {_SIDE!r} END - py)
    - dy * (CASE WHEN dy > 0 THEN x0 + i * {_SIDE!r} ELSE least(x0 + (i + 1) * {_SIDE!r}, x1) END - px)) AS reach
  FROM cell JOIN edge USING (c_custkey) GROUP BY 1, 2, 3),
quads AS (SELECT c_custkey, CASE WHEN any_value(m2) > {_MAX_KM2 * 1e6} THEN count(*) ELSE 1 END AS chunks FROM seen JOIN area USING (c_custkey) WHERE reach > 0 GROUP BY 1)
SELECT cast(t.c_custkey AS varchar) AS aoi_id, CASE WHEN {_MAINLAND_SQL} THEN chunks
       WHEN ww * hh > {_MAX_KM2 * 1e6} THEN cast(ceil(ww / {_SIDE!r}) * ceil(hh / {_SIDE!r}) AS bigint) ELSE 1 END AS chunks, true AS area_kept, true AS all_small
FROM (SELECT *, {pj._A * pj._K0!r} * radians(e - w) AS ww, {_ea_y('n')} - {_ea_y('s')} AS hh FROM {_AOI_SQL}) t LEFT JOIN quads USING (c_custkey)""")
def chunk_aoi(spark, sf):
    aoi = lonlat_aoi(spark, sf)
    pieces = spatial.chunk_aoi(aoi, _MAX_KM2).groupBy("aoi_id").agg(
        F.count_distinct("chunk_col", "chunk_row").alias("chunks"), F.sum("area_km2").alias("total"), F.max("area_km2").alias("largest"))
    whole = spatial.with_metric(aoi).select("aoi_id", (rg.planar_area(F.col("metric_rings")) / 1e6).alias("area"))
    return whole.join(pieces, "aoi_id").select(
        "aoi_id", "chunks",
        (F.abs(F.col("total") - F.col("area")) <= F.col("area") * 1e-9).alias("area_kept"),
        (F.col("largest") <= _MAX_KM2 * (1 + 1e-9)).alias("all_small"))


# -- searches in the tile plane --------------------------------------------------------------

_BOXES_SQL = """(SELECT n_nationkey, (110 + n_nationkey * 7 % 37 - 200) * 1000 + 150 AS minx, (190 + n_nationkey * 5 % 28 - 300) * 1000 - 400 AS miny,
  (1 + n_nationkey % 3) * 700 AS side FROM nation) b"""


def tile_boxes(spark, sf, shape: str = "box"):
    """Search areas in metres, as boxes or right-angled triangles."""
    k = F.col("n_nationkey")
    b = table(spark, sf, "nation").select(
        k, ((F.lit(110) + k * 7 % 37 - 200) * 1000 + 150).alias("minx"), ((F.lit(190) + k * 5 % 28 - 300) * 1000 - 400).alias("miny"),
        ((k % 3 + 1) * 700).alias("side"))
    x, y, d = F.col("minx"), F.col("miny"), F.col("side")
    rings = rg.rectangle(x, y, x + d, y + d) if shape == "box" else F.array(F.array(
        rg.point(x, y), rg.point(x + d * 3, y), rg.point(x, y + d * 3), rg.point(x, y)))
    return b.select(F.lit("area").alias("aoi_id"), F.col("n_nationkey").cast("int").alias("part_id"), rings.alias("rings"))


def search_items(spark, sf):
    return tile_rings(view(spark, sf, "cat_items_raw")).select("collection_id", "item_id", "size_bytes", "item_ts", "tx", "ty", "search_page", "rings")


_EXTENT_SQL = "(SELECT *, (tx - 200) * 1000 AS x0, (ty - 301) * 1000 AS y0 FROM cat_items_raw) i"
_MEETS_BOX = "x0 <= minx + side AND x0 + 1000 >= minx AND y0 <= miny + side AND y0 + 1000 >= miny"


@query("search_bbox", f"SELECT DISTINCT collection_id, item_id FROM {_EXTENT_SQL} JOIN {_BOXES_SQL} ON {_MEETS_BOX}")
def search_bbox(spark, sf):
    return spatial.search(search_items(spark, sf), tile_boxes(spark, sf), 2000.0).select("collection_id", "item_id")


@query("search_polygon", f"""
SELECT collection_id, item_id, search_page, epoch_us(item_ts) AS item_us, ty FROM (
  SELECT *, row_number() OVER (PARTITION BY collection_id, item_id ORDER BY search_page, item_ts, size_bytes, tx, ty) AS place
  FROM {_EXTENT_SQL} JOIN {_BOXES_SQL}
  ON x0 <= minx + 3 * side AND x0 + 1000 >= minx AND y0 <= miny + 3 * side AND y0 + 1000 >= miny AND x0 + y0 <= minx + miny + 3 * side) h
WHERE place = 1""")
def search_polygon(spark, sf):
    found = spatial.search(search_items(spark, sf), tile_boxes(spark, sf, "triangle"), 2000.0, order=("search_page", "item_ts", "size_bytes", "tx", "ty"))
    return found.select("collection_id", "item_id", "search_page", F.unix_micros(F.col("item_ts").cast("timestamp")).alias("item_us"), "ty")


@query("search_chunked", f"""
SELECT n_nationkey AS part_id, tx, ty, count(*) AS copies FROM {_EXTENT_SQL} JOIN {_BOXES_SQL} ON {_MEETS_BOX} GROUP BY 1, 2, 3""")
def search_chunked(spark, sf):
    pairs = spatial.search_chunked(search_items(spark, sf), tile_boxes(spark, sf), 2000.0)
    return pairs.groupBy("part_id", "tx", "ty").agg(F.count(F.lit(1)).alias("copies"))


@query("search_estimate", f"""
SELECT collection_id, count(*) AS item_count, coalesce(sum(size_bytes), 0)::bigint AS known_bytes,
       count(*) FILTER (WHERE size_bytes IS NULL) AS unknown_size_count, grouping(collection_id)::int AS is_total,
       coalesce(sum(size_bytes), 0) > 50000000000 AS is_large
FROM (SELECT DISTINCT collection_id, item_id, size_bytes FROM {_EXTENT_SQL} JOIN {_BOXES_SQL} ON {_MEETS_BOX}
      WHERE collection_id IN ('LAZ', 'MDT-2m', 'MDT-50cm', 'ORTOS-2021') AND item_ts >= timestamp '1995-01-01' AND item_ts <= timestamp '2000-12-31 23:59:59') t
GROUP BY ROLLUP (collection_id)""")
def search_estimate(spark, sf):
    return lifecycle.search_estimate(
        search_items(spark, sf), tile_boxes(spark, sf), ["LAZ", "MDT-2m", "MDT-50cm", "ORTOS-2021"], 2000.0, "1995/2000")


# -- SQL surface -----------------------------------------------------------------------------


@query("sql_functions", f"""
SELECT c_custkey, cast(floor(x * 100 + 0.5) AS bigint) AS x_cm, cast(floor(y * 100 + 0.5) AS bigint) AS y_cm,
       CASE WHEN c_custkey % 997 < 60 THEN (c_custkey % 997) || ' s'
            ELSE cast(c_custkey % 997 // 60 AS varchar) || ':' || lpad(cast(c_custkey % 997 % 60 AS varchar), 2, '0') END AS shown FROM {tm06_sql(_POINTS_SQL)} t""")
def sql_functions(spark, sf):
    from tilelake.functions.sql import register

    register(spark)
    return spark.sql("""
        SELECT c_custkey, cast(floor(p.x * 100 + 0.5) AS bigint) AS x_cm, cast(floor(p.y * 100 + 0.5) AS bigint) AS y_cm,
               tl_human_duration(c_custkey % 997) AS shown
        FROM (SELECT c_custkey, tl_to_tm06(lon, lat) AS p FROM {pts}) t""", pts=_points(spark, sf))


@query("sql_chunk_grid", """
SELECT s_suppkey, c AS chunk_col, r AS chunk_row, x + c * 150 AS minx, y + r * 150 AS miny,
       least(x + (c + 1) * 150, x + 2 * a) AS maxx, least(y + (r + 1) * 150, y + 2 * a) AS maxy
FROM (SELECT s_suppkey, (s_suppkey % 9 + 1) * 100 AS a, (s_suppkey % 37) * 50 AS x, (s_suppkey % 23) * 70 AS y FROM supplier) l, range(12) cs(c), range(12) rs(r)
WHERE c < ceil(2 * a / 150.0) AND r < ceil(2 * a / 150.0)""")
def sql_chunk_grid(spark, sf):
    from tilelake.functions.sql import register

    register(spark)
    boxes = _l_shape(spark, sf).selectExpr("s_suppkey", "double(x) AS x0", "double(y) AS y0", "double(x + 2 * a) AS x1", "double(y + 2 * a) AS y1")
    out = spark.sql("""
        SELECT s_suppkey, bigint(chunk_col) AS chunk_col, bigint(chunk_row) AS chunk_row, bigint(minx) AS minx,
               bigint(miny) AS miny, bigint(maxx) AS maxx, bigint(maxy) AS maxy
        FROM {boxes}, LATERAL tl_chunk_grid(x0, y0, x1, y1, 150D)""", boxes=boxes)
    return out


@query("run_metrics", "SELECT count(*) AS rows, sum(size_bytes)::bigint AS known_bytes FROM cat_items_raw")
def run_metrics(spark, sf):
    from tilelake.operators.metrics import run_metrics as op
    from tilelake.session import materialize

    watched, seen = op(view(spark, sf, "cat_items_raw"), "scan", known_bytes=F.sum("size_bytes"))
    materialize(watched, "watched")
    got = seen.get
    return spark.createDataFrame([(got["rows"], got["known_bytes"])], "rows bigint, known_bytes bigint")
