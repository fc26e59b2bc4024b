"""Projections, polygons, chunking and the spatial join."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tilelake.functions import projections as pj
from tilelake.functions import rings as rg
from tilelake.functions.grid import box
from tilelake.operators import spatial
from tilelake.sources.aoi import aoi_from_bbox, aoi_from_wkt

# Published corners (lon, lat) of one tile and their metric coordinates.
CORNERS = [
    (-9.1333284, 38.7091897, -87000, -106000), (-9.1332029, 38.7001829, -87000, -107000),
    (-9.1217092, 38.7002807, -86000, -107000), (-9.1218332, 38.7092875, -86000, -106000),
]
T_SHAPE = "POLYGON((0 0, 3000 0, 3000 1000, 2000 1000, 2000 3000, 1000 3000, 1000 1000, 0 1000, 0 0))"  # 5 km2


def test_projection_hits_known_corners(spark):
    df = spark.createDataFrame(CORNERS, "lon double, lat double, x int, y int")
    for r in df.select("x", "y", pj.to_tm06(F.col("lon"), F.col("lat")).alias("p")).collect():
        assert abs(r.p.x - r.x) < 0.02 and abs(r.p.y - r.y) < 0.02


@pytest.mark.parametrize(("to", "back", "tolerance"), [
    (pj.to_tm06, pj.from_tm06, 1e-10), (pj.to_equal_area, pj.from_equal_area, 1e-11)])
def test_projections_round_trip(spark, to, back, tolerance):
    points = [(-9.5 + i * 0.1, 37.0 + j * 0.2) for i in range(30) for j in range(25)]
    df = spark.createDataFrame(points, "lon double, lat double").select("lon", "lat", to(F.col("lon"), F.col("lat")).alias("p"))
    for r in df.select("lon", "lat", back(F.col("p.x"), F.col("p.y")).alias("q")).collect():
        assert abs(r.q.x - r.lon) < tolerance and abs(r.q.y - r.lat) < tolerance


def wkt(spark, text, crs="EPSG:4326"):
    return aoi_from_wkt(spark.createDataFrame([("a", text)], "aoi_id string, wkt string"), crs=crs)


def bbox(spark, text):
    return aoi_from_bbox(spark.createDataFrame([("a", text)], "aoi_id string, bbox string"))


def test_equal_area_outside_the_mainland(spark):
    """The true area of a box on the ellipsoid, by the authalic integral."""
    west, south, east, north = -17.2, 32.61, -16.93, 32.84
    e2 = 2 / 298.257223563 - 1 / 298.257223563**2
    q = lambda lat: (1 - e2) * (math.sin(lat) / (1 - e2 * math.sin(lat) ** 2) + math.atanh(math.sqrt(e2) * math.sin(lat)) / math.sqrt(e2))
    want = 6378.137**2 * math.radians(east - west) * (q(math.radians(north)) - q(math.radians(south))) / 2
    area = spatial.aoi_area_km2(bbox(spark, f"{west},{south},{east},{north}")[0]).first()
    assert area.crs == "EPSG:6933" and area.area_km2 == pytest.approx(want, rel=1e-9)


def test_t_shape_gives_five_chunks_and_keeps_its_area(spark):
    aoi, bad = wkt(spark, T_SHAPE, "EPSG:3763")
    assert bad.count() == 0
    assert spatial.aoi_area_km2(aoi).first().area_km2 == pytest.approx(5.0, abs=1e-6)
    chunks = spatial.chunk_aoi(aoi, 1.0).collect()
    assert sorted((c.chunk_col, c.chunk_row) for c in chunks) == [(0, 0), (1, 0), (1, 1), (1, 2), (2, 0)]
    assert sum(c.area_km2 for c in chunks) == pytest.approx(5.0, abs=1e-6)


def test_small_area_is_one_chunk_and_point_survives(spark):
    aoi, _ = bbox(spark, "-9.14,38.70,-9.13,38.71")
    assert [c.chunk_col for c in spatial.chunk_aoi(aoi).collect()] == [0]
    point = spark.createDataFrame([("p", 0, [[(-9.0, 38.0)] * 4])], "aoi_id string, part_id int, rings array<array<struct<x:double,y:double>>>")
    assert spatial.chunk_aoi(point).count() == 1
    assert spatial.aoi_area_km2(point).first().area_km2 == 0


def test_slivers_stay_whole(spark):
    # Cells of 0.1 m2 are all below the noise level.
    small, _ = bbox(spark, "-9.14,38.70,-9.1399,38.70005")
    assert spatial.chunk_aoi(small, 1e-7).count() == 1


def test_bad_chunk_size(spark):
    with pytest.raises(ValueError):
        spatial.chunk_aoi(bbox(spark, "0,0,1,1")[0], 0)


@pytest.mark.parametrize("text", ["1,2,3", "1,2,3,x", "3,2,1,4", "1,4,3,2", "1,2,1,4", ""])
def test_bad_bbox(spark, text):
    good, bad = bbox(spark, text)
    assert good.count() == 0 and bad.count() == 1


@pytest.mark.parametrize("text", ["", "POINT(1 2)", "POLYGON((0 0, 1 1))", "POLYGON((0 0,1 0,1 1,0 1))", "POLYGON(0 0)", "POLYGON((a b, c d, e f, a b))"])
def test_bad_wkt(spark, text):
    good, bad = wkt(spark, text)
    assert good.count() == 0 and bad.count() == 1


def test_overlapping_parts_have_no_area(spark):
    aoi, _ = wkt(spark, "MULTIPOLYGON(((0 0,1000 0,1000 1000,0 1000,0 0)),((500 500,1500 500,1500 1500,500 1500,500 500)))", "EPSG:3763")
    assert spatial.aoi_area_km2(aoi).first().asDict() == {"aoi_id": "a", "crs": "EPSG:3763", "area_km2": None, "parts_overlap": True}
    beside, _ = wkt(spark, "MULTIPOLYGON(((0 0,1000 0,1000 1000,0 1000,0 0)),((2000 0,3000 0,3000 1000,2000 1000,2000 0)))", "EPSG:3763")
    assert spatial.aoi_area_km2(beside).first().area_km2 == pytest.approx(2.0, abs=1e-6)


# -- brute force ----------------------------------------------------------------------------


def _orient(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def _on(a, b, c):
    return _orient(a, b, c) == 0 and min(a[0], b[0]) <= c[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= c[1] <= max(a[1], b[1])


def _touch(a, b, c, d):
    s = lambda v: (v > 0) - (v < 0)
    if s(_orient(a, b, c)) != s(_orient(a, b, d)) and s(_orient(c, d, a)) != s(_orient(c, d, b)):
        return True
    return _on(a, b, c) or _on(a, b, d) or _on(c, d, a) or _on(c, d, b)


def _inside(p, ring):
    odd = False
    for a, b in zip(ring, ring[1:]):
        if _on(a, b, p):
            return True
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]):
            odd = not odd
    return odd


def brute(r, s):
    edges = lambda ring: list(zip(ring, ring[1:]))
    return any(_touch(*e, *f) for e in edges(r) for f in edges(s)) or _inside(r[0], s) or _inside(s[0], r)


def star(rng, cx, cy, size):
    """A simple polygon on whole numbers: vertices sorted by direction from the middle."""
    import math

    points = [(cx + rng.randint(-size, size), cy + rng.randint(-size, size)) for _ in range(rng.randint(3, 7))]
    mx, my = sum(p[0] for p in points) / len(points), sum(p[1] for p in points) / len(points)
    points.sort(key=lambda p: math.atan2(p[1] - my, p[0] - mx))
    return [*points, points[0]]


@pytest.mark.parametrize("cell", [7.0, 40.0, 500.0])
def test_search_equals_brute_force(spark, cell):
    rng = random.Random(5)
    items = [("c", f"i{k}", star(rng, rng.randint(0, 300), rng.randint(0, 300), 12)) for k in range(300)]
    areas = [("a", k, star(rng, rng.randint(0, 300), rng.randint(0, 300), 60)) for k in range(8)]
    as_rings = lambda ring: [[(float(x), float(y)) for x, y in ring]]
    schema = "array<array<struct<x:double,y:double>>>"
    left = spark.createDataFrame([(c, i, as_rings(r)) for c, i, r in items], f"collection_id string, item_id string, rings {schema}")
    right = spark.createDataFrame([(a, k, as_rings(r)) for a, k, r in areas], f"aoi_id string, part_id int, rings {schema}")
    want = {(i, k) for _, i, r in items for _, k, s in areas if brute(r, s)}
    pairs = spatial.search_chunked(left, right, cell).select("item_id", "part_id").collect()
    assert len(pairs) == len(set(pairs)) and {tuple(p) for p in pairs} == want
    found = [r.item_id for r in spatial.search(left, right, cell).collect()]
    assert sorted(found) == sorted({i for i, _ in want})


def test_search_without_broadcast_gives_the_same(spark):
    rng = random.Random(6)
    schema = "array<array<struct<x:double,y:double>>>"
    make = lambda: [[(float(x), float(y)) for x, y in star(rng, rng.randint(0, 90), rng.randint(0, 90), 9)]]
    left = spark.createDataFrame([("c", f"i{k}", make()) for k in range(80)], f"collection_id string, item_id string, rings {schema}")
    right = spark.createDataFrame([("a", k, make()) for k in range(9)], f"aoi_id string, part_id int, rings {schema}")
    small = {tuple(r) for r in spatial.search_chunked(left, right, 20.0).select("item_id", "part_id").collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = spatial.search_chunked(left, right, 20.0).select("item_id", "part_id")
        assert {tuple(r) for r in large.collect()} == small
        assert "SortMergeJoin" in large._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clip_area_of_random_polygons(spark):
    rng = random.Random(7)
    shapes = [(k, [[(float(x), float(y)) for x, y in star(rng, 50, 50, 50)]]) for k in range(60)]
    df = spark.createDataFrame(shapes, "k int, rings array<array<struct<x:double,y:double>>>")
    tile = lambda i, j: rg.planar_area(rg.clip_to_box(F.col("rings"), box(F.lit(i * 30), F.lit(j * 30), F.lit(i * 30 + 30), F.lit(j * 30 + 30))))
    cells = sum((tile(i, j) for i in range(4) for j in range(4)), F.lit(0.0))
    for r in df.select(rg.planar_area(F.col("rings")).alias("whole"), cells.alias("cut")).collect():
        assert r.cut == pytest.approx(r.whole, rel=1e-9)


def test_holes(spark):
    ring = lambda lo, hi: [(lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo)]
    df = spark.createDataFrame([([ring(0.0, 10.0), ring(4.0, 6.0)],)], "rings array<array<struct<x:double,y:double>>>")
    r = F.col("rings")
    inside = lambda v: rg.point_in_polygon(F.lit(v), F.lit(v), r)
    got = df.select(rg.planar_area(r), inside(1.0), inside(5.0), inside(4.0), rg.planar_area(rg.clip_to_box(r, box(F.lit(0), F.lit(0), F.lit(5), F.lit(5)))),
                    rg.polygons_intersect(r, rg.rectangle(F.lit(4.5), F.lit(4.5), F.lit(5.5), F.lit(5.5)))).first()
    assert tuple(got) == (96.0, True, False, True, 24.0, False)


def test_any_part_of_an_item_counts(spark):
    ring = lambda lo, hi: [(lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo)]
    schema = "array<array<struct<x:double,y:double>>>"
    item = spark.createDataFrame([("c", "i", [ring(0.0, 1.0), ring(50.0, 51.0)])], f"collection_id string, item_id string, rings {schema}")
    areas = spark.createDataFrame([("a", 0, [ring(40.0, 60.0)]), ("a", 1, [ring(10.0, 20.0)])], f"aoi_id string, part_id int, rings {schema}")
    assert [r.part_id for r in spatial.search_chunked(item, areas, 7.0).collect()] == [0]


def test_wkt_with_many_vertices(spark):
    from tilelake.functions.rings import wkt_polygons

    ring = [f"{i % 700} {i * 0.5}" for i in range(20_000)]
    text = f"POLYGON (({', '.join([*ring, ring[0]])}))"
    df = spark.createDataFrame([(text,), (text.replace("))", ", 1 1))"),), (text[:-1],), ("POLYGON ((0 0, 1 0, 1 1, 0 0)), ((0 0, 1 0, 1 1, 0 0))",)], "t string")
    assert [p and (len(p), len(p[0][0])) for (p,) in df.select(wkt_polygons(F.col("t"))).collect()] == [(1, 20_001), None, None, None]


def crosses_itself(points):
    """All pairs of edges that aren't neighbours, by orientation."""
    edges = list(zip(points, points[1:]))
    side = lambda a, b, c: (v := (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])) and (1 if v > 0 else -1)
    for i, (p, q) in enumerate(edges):
        for j in range(i + 2, len(edges)):
            if i == 0 and j == len(edges) - 1:
                continue
            r, s = edges[j]
            apart = any(max(a[k], b[k]) < min(c[k], d[k]) for k in (0, 1) for a, b, c, d in ((p, q, r, s), (r, s, p, q)))
            if not apart and side(p, q, r) * side(p, q, s) <= 0 and side(r, s, p) * side(r, s, q) <= 0:
                return True
    return False


def test_audit_finds_rings_that_cross_or_touch_themselves(spark):
    rng = random.Random(11)
    rings = [[(float(rng.randrange(12)), float(rng.randrange(12))) for _ in range(rng.randrange(3, 9))] for _ in range(150)]
    rings += [[(float(x), float(y)) for x, y in star(rng, 50, 50, 30)] for _ in range(50)]
    rings = [r if r[0] == r[-1] else [*r, r[0]] for r in rings]
    df = spark.createDataFrame([(i, [r]) for i, r in enumerate(rings)], "k int, rings array<array<struct<x:double,y:double>>>")
    got = {r.k: r.defects for r in spatial.audit(df, "k").collect()}
    inline = {r.k: r.d for r in df.select("k", rg.geometry_audit(F.col("rings")).alias("d")).collect()}
    assert len(got) == len(rings) and got == inline
    for i, r in enumerate(rings):
        assert ("self_crossing" in got[i]) == crosses_itself(r), r


def test_crossings_of_crowded_thin_and_long_edged_rings():
    """Shapes that one grid parts badly: nearly all vertices in a corner, long waves, combs of long teeth."""
    import pyarrow as pa

    from tilelake.functions.crossings import crossed

    rng = random.Random(13)
    rings = [[(1e5 + math.cos(i / n * 6.28) * (1 + 0.3 * (i % 5)) * (1e-3 if i < 0.8 * n else 1e3), math.sin(i / n * 6.28) * (1 + 0.3 * (i % 5)) * (1e-3 if i < 0.8 * n else 1e3))
              for i in range(n)] for n in range(50, 250, 10)]
    rings += [[(float(x), y) for i in range(n) for x, y in ((i, 0.0), (i, 100.0 if i % 2 else 1.0), (i + 0.5, 100.0 if i % 2 else 1.0), (i + 0.5, 0.0))] + [(n, -5.0), (0.0, -5.0)]
              for n in range(20, 80, 3)]
    rings += [[(3.0 * i, 2.0 * (i % 5)) for i in range(n)] + [(3.0 * n, -50.0), (0.0, -50.0)] for n in range(40, 400, 20)]
    for r in rings[::2]:
        k = rng.randrange(len(r) - 4)
        r[k], r[k + 2] = r[k + 2], r[k]
    rings = [[*r, r[0]] for r in rings]
    rows = [[[{"x": x, "y": y} for x, y in r]] for r in rings] + [None, [], [[]]]
    got = crossed(pa.array(rows, pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))))
    assert got.tolist() == [*map(crosses_itself, rings), False, False, False]


def test_audit_shuffles_no_edges(spark):
    """One pass over the polygons: dealing every edge to a shuffle is what made long rings slow."""
    ring = F.array(*[rg.point(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (2, 0), (2, 2), (0, 0))])
    plan = spatial.audit(spark.range(3).select(F.col("id").alias("k"), F.array(ring).alias("rings")), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_audit_of_a_ring_with_very_many_vertices(spark):
    n = 100_000
    at = lambda i: F.struct((F.cos(i * (6.283185307179586 / n)) * (1000 + i % 7)).alias("x"), (F.sin(i * (6.283185307179586 / n)) * (1000 + i % 7)).alias("y"))
    ring = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), at)
    mixed = F.transform(ring, lambda p, i: F.when(i == 500, F.get(ring, F.lit(507))).when(i == 507, F.get(ring, F.lit(500))).otherwise(p))
    df = spark.range(2).select(F.col("id").alias("k"), F.when(F.col("id") == 0, ring).otherwise(mixed).alias("r"))
    df = df.select("k", F.array(F.concat("r", F.slice("r", 1, 1))).alias("rings"))
    assert {r.k for r in spatial.self_crossing(df, "k").collect()} == {1}


def test_search_with_items_of_all_sizes_over_shapes_with_holes(spark):
    """Items smaller and larger than a cell, areas with holes and round coordinates, against the plain test of every pair."""
    rng = random.Random(12)
    schema = "array<array<struct<x:double,y:double>>>"
    boxed = lambda x, y, w, h: [(x + w, y), (x + w, y + h), (x, y + h), (x, y), (x + w, y)]
    areas = [("a", k, [boxed(10.0 * k, 5.0, 30.0, 30.0), boxed(10.0 * k + 10, 15.0, 10.0, 10.0)]) for k in range(4)]
    areas += [("b", k, [[(float(x), float(y)) for x, y in star(rng, 40, 40, 35)]]) for k in range(4)]
    items = [("c", f"i{n}", [boxed(float(rng.randrange(-10, 90)), float(rng.randrange(-10, 90)), float(s), float(rng.choice([s, 1])))])
             for n, s in enumerate([1, 2, 3, 5, 8, 20, 60] * 20)]
    left = spark.createDataFrame(items, f"collection_id string, item_id string, rings {schema}")
    right = spark.createDataFrame(areas, f"aoi_id string, part_id int, rings {schema}")
    pairs = left.crossJoin(right.withColumnRenamed("rings", "area")).where(rg.polygons_intersect(F.col("rings"), F.col("area")))
    want = sorted(tuple(r) for r in pairs.select("item_id", "aoi_id", "part_id").collect())
    for cell in (2.0, 5.0, 16.0):
        got = spatial.search_chunked(left, right, cell).select("item_id", "aoi_id", "part_id").collect()
        assert sorted(map(tuple, got)) == want
