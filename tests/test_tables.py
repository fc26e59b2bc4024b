"""Catalog, planning and raster operators on small inputs, sources and sinks."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from support import DATA

from tilelake.operators import blocks, catalog, plan, raster
from tilelake.plans.lifecycle import merge_tiles
from tilelake.session import scratch_path
from tilelake.sources import envelopes, search_pages, sinks, tables
from tilelake.sources.aoi import parse_geojson_aoi

ITEMS = "collection_id string, item_id string"


# -- catalog --------------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "low", "high"), [
    ("2024", "2024-01-01T00:00:00", "2024-12-31T23:59:59"), ("2024-02", "2024-02-01T00:00:00", "2024-02-29T23:59:59"),
    ("2024-02-03", "2024-02-03T00:00:00", "2024-02-03T23:59:59"), ("2024-02-03T04:05:06Z", "2024-02-03T04:05:06", "2024-02-03T04:05:06"),
    ("2024-01-01T01:00:00+01:00/..", "2024-01-01T00:00:00", None), ("../2023", None, "2023-12-31T23:59:59"),
])
def test_datetime_bounds(text, low, high):
    shown = [None if b is None else b.isoformat().removesuffix("+00:00") for b in catalog.datetime_bounds(text)]
    assert shown == [low, high]


@pytest.mark.parametrize("text", ["../..", "2024/2023", "x"])
def test_bad_datetime(text):
    with pytest.raises(ValueError):
        catalog.datetime_bounds(text)


def test_empty_collection_list_is_an_error(spark):
    with pytest.raises(ValueError):
        catalog.filter_collections(spark.createDataFrame([], ITEMS), [])


def test_estimate_of_nothing_and_of_unknown_sizes(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("b", None)], "collection_id string, size_bytes bigint")
    rows = {r.collection_id: (r.item_count, r.known_bytes, r.unknown_size_count) for r in catalog.estimate(df).collect()}
    assert rows == {"a": (2, 5, 1), "b": (1, 0, 1), None: (3, 5, 2)}


def test_dedup_is_per_collection_and_idempotent(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "x")], ITEMS)
    once = catalog.dedup_items(df)
    assert once.count() == 2 == catalog.dedup_items(once).count()


# -- planning -------------------------------------------------------------------------------

ASSETS = "collection_id string, item_id string, asset_key string, media_type string, size_bytes bigint"


def test_reconcile(spark):
    assets = spark.createDataFrame([("c", n, "data", "image/tiff", s) for n, s in (("done", 10), ("short", 10), ("half", 10), ("new", 10), ("unknown", None))], ASSETS)
    inventory = spark.createDataFrame([("c/done.tif", 10), ("c/short.tif", 9), ("c/half.tif.part", 4), ("c/unknown.tif", 3)], "path string, length bigint")
    rows = lambda **o: {r.item_id: (r.is_complete, r.resume_offset) for r in plan.reconcile(assets, inventory, **o).collect()}
    assert rows() == {"done": (True, 0), "short": (False, 0), "half": (False, 4), "new": (False, 0), "unknown": (True, 0)}
    assert not any(done for done, _ in rows(overwrite=True).values())
    assert {k for k, (done, _) in rows(mode="existence").items() if done} == {"done", "short", "unknown"}
    s = plan.plan_summary(plan.reconcile(assets, inventory)).first()
    assert (s.to_fetch, s.already_complete, s.remaining_known_bytes, s.already_present_bytes, s.unknown_size_count) == (3, 2, 30, 10, 1)


@pytest.mark.parametrize("size", [1, 7, 50])
def test_batches_cover_the_plan_once(spark, size):
    rows = [("a" if i % 5 else "b", f"i{i:04d}", "data") for i in range(321)]
    got = plan.batch_assets(spark.createDataFrame(rows, "collection_id string, item_id string, asset_key string"), size).collect()
    assert sorted((b.collection_id, i) for b in got for i in b.item_ids) == sorted((c, i) for c, i, _ in rows)
    assert all(1 <= b.batch_size <= size for b in got)
    for c in "ab":
        order = [i for b in sorted((b for b in got if b.collection_id == c), key=lambda b: b.batch_no) for i in b.item_ids]
        assert order == sorted(order)


@pytest.mark.parametrize("size", [0, 51])
def test_bad_batch_size(spark, size):
    with pytest.raises(ValueError):
        plan.batch_assets(spark.createDataFrame([], "collection_id string, item_id string, asset_key string"), size)


def test_budget(spark):
    need = spark.createDataFrame([("a", 5), ("a", 5), ("b", 0), ("c", 1)], "volume string, need_bytes bigint")
    free = spark.createDataFrame([("a", 11), ("b", 0)], "volume string, free_bytes bigint")
    fits = lambda m: {r.volume: r.fits for r in plan.budget_check(need, free, m).collect()}
    assert fits(1) == {"a": True, "b": True, "c": False} and fits(2)["a"] is False


# -- rasters --------------------------------------------------------------------------------


@pytest.mark.parametrize(("native", "ensure", "w", "h", "stop", "want"), [
    (0.5, 10.0, 20000, 10000, 512, [2, 4, 20, 40]), (2.0, 10.0, 20000, 20000, 512, [5, 10, 20, 40]), (0.5, 8.0, 100, 100, 512, [2, 4, 8, 16]),
    (10.0, 10.0, 4000, 100, 512, [2, 4, 8]), (10.0, 10.0, 10, 10, 512, [2]), (0.5, None, 4000, 100, 512, [2, 4, 8]), (0.5, 6.0, 100, 100, 4, [2, 4, 12, 24]),
])
def test_factors(spark, native, ensure, w, h, stop, want):
    assert raster.overview_factors(native, ensure, w, h, stop) == want
    lit = lambda v: F.lit(v).cast("double")
    assert spark.range(1).select(raster.overview_factor_list(lit(native), lit(ensure), F.lit(w), F.lit(h), stop)).first()[0] == want
    assert all(b % a == 0 for a, b in zip(want, want[1:]))


@pytest.mark.parametrize(("native", "ensure"), [(2.0, 5.0), (10.0, 2.0), (0.0, 1.0), (0.5, 10.01)])
def test_impossible_factors(native, ensure):
    with pytest.raises(ValueError):
        raster.overview_factors(native, ensure, 100, 100)


def surface(spark, side=96):
    """A bowl with steps and a corner of nodata, in tiles of 32 cells."""
    gx, gy = F.col("id") % side, F.floor(F.col("id") / side)
    z = F.pow((gx - 31) / 8, F.lit(2)) + F.pow((gy - 50) / 16, F.lit(2)) + F.pmod(gx + gy, F.lit(5)) * 0.25
    hole = gx + 2 * gy < 40
    cells = spark.range(side * side).select(gx.alias("px"), gy.alias("py"), F.when(hole, -999.0).otherwise(z).alias("z"))
    tile = lambda c: F.floor(F.col(c) / 32)
    path = F.concat_ws("-", tile("py").cast("string"), tile("px").cast("string"))
    pixels = cells.select(path.alias("path"), (F.col("px") % 32).alias("lx"), (F.col("py") % 32).alias("ly"), "z")
    headers = cells.groupBy(path.alias("path"), tile("px").alias("c"), tile("py").alias("r")).agg(F.lit(32).alias("width")).select(
        "path", "width", F.lit(32).alias("height"), (F.col("c") * 16.0).alias("minx"), (-F.col("r") * 16.0 - 16.0).alias("miny"),
        (F.col("c") * 16.0 + 16.0).alias("maxx"), (-F.col("r") * 16.0).alias("maxy"), F.lit(0.5).alias("pixel_size_x"), F.lit(0.5).alias("pixel_size_y"),
        F.lit("EPSG:3763").alias("crs"), F.lit("float32").alias("dtype"), F.lit(1).alias("band_count"), F.lit(False).alias("rotated"), F.lit(-999.0).alias("nodata"))
    return cells, pixels, headers


def level(df):
    return {(r.factor, r.ox, r.oy): (r.n_valid, round(r.z, 9)) for r in df.collect()}


def test_mosaic_is_seamless_and_overviews_are_exact(spark):
    cells, pixels, headers = surface(spark)
    merged = merge_tiles(pixels, headers, ensure_res=2.0, max_err=0.05)
    a = {(r.px, r.py): r.z for r in cells.collect()}
    b = {(r.px, r.py): r.z for r in merged.cells.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) <= 0.05 + 1e-9 for k in a)
    assert merged.factors == [2, 4] and merged.sizes.first().base_bytes == 96 * 96 * 4
    direct = {}
    for f in (2, 4, 12):
        direct |= level(raster.overview(cells, f))
    assert level(raster.pyramid(cells, [2, 4, 12])) == direct
    assert raster.verify_lossy(cells, merged.cells, 0.05 + 1e-9, tile=32).agg(F.sum("over_bound"), F.sum("nodata_mismatch")).first() == (0, 0)


def test_clip_is_snapped_and_clamped(spark):
    cells, pixels, headers = surface(spark)
    merged = merge_tiles(pixels, headers, bbox=(13.3, -100.0, 40.0, -12.4), ensure_res=2.5)
    w = merged.window.first()
    assert (w.minx, w.miny, w.maxx, w.maxy, w.width, w.height) == (12.5, -48.0, 40.0, -10.0, 55, 76)
    assert merged.cells.count() == 55 * 76
    with pytest.raises(ValueError):
        merge_tiles(pixels, headers, bbox=(1000, 1000, 1001, 1001))


def test_merge_refuses_mixed_tiles(spark):
    _, pixels, headers = surface(spark, 64)
    with pytest.raises(ValueError, match="crs"):
        merge_tiles(pixels, headers.withColumn("crs", F.when(F.col("minx") > 0, "EPSG:1").otherwise(F.col("crs"))))
    with pytest.raises(ValueError, match="partly_missing"):
        merge_tiles(pixels, headers.withColumn("nodata", F.when(F.col("minx") > 0, F.col("nodata"))))


def test_blocks_round_trip_and_overview(spark):
    cells, _, _ = surface(spark)
    packed = blocks.pack_blocks(cells, 64)
    back = {(r.px, r.py): r.z for r in blocks.unpack_blocks(packed, 64).collect()}
    want = {(r.px, r.py): r.z for r in cells.collect()}
    assert back.keys() == want.keys() and all(abs(back[k] - want[k]) < 1e-4 for k in want)
    packed_level = {(r.ox, r.oy): (r.n_valid, r.z) for r in blocks.overview_blocks(packed, 8, 64).collect()}
    direct = {(r.ox, r.oy): (r.n_valid, r.z) for r in raster.overview(cells, 8).collect()}
    assert packed_level.keys() == direct.keys()
    assert all(packed_level[k][0] == direct[k][0] and abs(packed_level[k][1] - direct[k][1]) < 1e-4 for k in direct)


def test_regions_tile_the_bounds(spark):
    bounds = spark.createDataFrame([(3.0, -97.0, 101.0, 4.0)], "minx double, miny double, maxx double, maxy double")
    got = raster.region_grid(bounds, 33.0, 10.0).collect()
    assert sum((r.maxx - r.minx) * (r.maxy - r.miny) for r in got) == 110.0 * 110.0
    assert {(r.region_col, r.region_row) for r in got} == {(c, r) for c in range(3) for r in range(3)}
    assert all(r.minx % 10 == 0 and r.miny % 10 == 0 for r in got)


# -- sources and sinks ----------------------------------------------------------------------


@pytest.mark.parametrize(("text", "problem"), [
    ("<html>", "not JSON"), ('{"status": 200}', "no data"), ('{"status": 500, "message": "x", "data": {"id": "a"}}', "status is not 200"),
    ('{"status": 200, "data": {"models": 1}}', "no collections"), ('{"status": 200, "data": {"collections": {"a": 1}}}', "collections is not a list"),
    ('{"data": {"collections": []}}', "status is not 200"),
])
def test_bad_envelopes(spark, text, problem):
    good, bad = envelopes.parse_collections(spark.createDataFrame([(text, "s")], "value string, source string"))
    assert good.count() == 0 and [r.problem for r in bad.collect()] == [problem]


def test_collection_record(spark):
    body = {"status": 200, "message": "OK", "data": {"id": "MDT", "title": "T", "license": "odd (v2)", "summaries": {"visibility": ["show"], "access": ["private"]},
            "extent": {"spatial": {"bbox": [[-9.5, 37, -6, 42]]}, "temporal": {"interval": [["2024-01-02T03:04:05Z", None]]}}}}
    row = envelopes.parse_collections(spark.createDataFrame([(json.dumps(body), "s")], "value string, source string"))[0].first()
    assert (row.id, row.license, row.visibility) == ("MDT", "odd (v2)", ["show"])
    assert row.extent.spatial == [[-9.5, 37.0, -6.0, 42.0]] and row.extent.temporal[0].end is None and row.extent.temporal[0].start.day == 2


def feature(name, **more):
    return {"type": "Feature", "id": name, "collection": "LAZ", "bbox": [-9, 38, 1, -8, 39, 2],
            "geometry": {"type": "Polygon", "coordinates": [[[-9, 38, 5], [-8, 38, 5], [-8, 39, 5], [-9, 38, 5]]]},
            "assets": {"thumb": {"href": "t", "type": "image/png", "roles": ["thumbnail"]}, "las": {"href": "h", "type": "application/vnd.laszip", "roles": ["data"]}},
            "properties": {"datetime": "2025-07-16T09:05:29Z", "file:size": 12, "pc:count": 5}, **more}


def test_item_pages(spark):
    page = {"type": "FeatureCollection", "features": [feature("a"), feature("b", geometry=None, assets={})], "links": []}
    docs = spark.createDataFrame([(json.dumps(page), "p1"), ("nope", "p2"), ('{"type": "x"}', "p3")], "value string, source string")
    items, bad = envelopes.parse_item_pages(docs)
    rows = {r.item_id: r for r in catalog.sanitize_bbox(items).drop("properties").collect()}
    assert rows["a"].bbox == [-9.0, 38.0, -8.0, 39.0] and len(rows["a"].raw_bbox) == 6 and rows["b"].bbox is None
    asset = catalog.to_assets(items).collect()
    assert [(a.item_id, a.asset_key, a.size_bytes, a.media_type) for a in asset] == [("a", "las", 12, "application/vnd.laszip")]
    assert {r.source for r in bad.collect()} == {"p2", "p3"}


def test_item_pages_are_parsed_once(spark, tmp_path):
    pages = [{"features": [feature("a"), feature("b")]}, {"features": []}, {"features": None}, {"type": "x"}]
    (tmp_path / "pages.txt").write_text("\n".join([*map(json.dumps, pages), "nope"]))
    items, bad = envelopes.read_item_pages(spark, str(tmp_path), lines=True)
    plan = items.select("pos", "item_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(type") == 1
    assert sorted((r.pos, r.item_id) for r in items.select("pos", "item_id").collect()) == [(0, "a"), (1, "b")]
    assert bad.count() == 3  # without features, or not JSON; an empty page is a page


def test_search_connector_follows_links_and_prunes(spark, tmp_path):
    for chunk in ("c1", "c2"):
        for coll in ("LAZ", "MDT"):
            folder = tmp_path / chunk / coll
            folder.mkdir(parents=True)
            for n, following in (("a", "b.json"), ("b", None)):
                links = [{"rel": "next", "href": following}] if following else []
                (folder / f"{n}.json").write_text(json.dumps({"features": [feature(f"{chunk}-{coll}-{n}")], "links": links}))
    (tmp_path / "c2" / "MDT" / "a.json").write_text("broken")
    raw = search_pages.read_search(spark, str(tmp_path), ["LAZ", "MDT"])
    rows = search_pages.items_of(raw.where("chunk_id = 'c1'")).select("item_id", "page").collect()
    assert sorted(tuple(r) for r in rows) == sorted((f"c1-{c}-{n}", p) for c in ("LAZ", "MDT") for p, n in enumerate("ab"))
    assert raw.where("collection = 'LAZ'").count() == 4  # the broken page is never opened
    listed = scratch_path(spark, "chunk-table")
    spark.sql("SELECT 'c1' AS chunk_id, 7 AS more").write.parquet(listed)
    assert search_pages.read_search(spark, str(tmp_path), ["LAZ", "MDT"], chunk_table=listed).count() == 4
    for bad in ({"collections": [], "page_size": 1}, {"collections": ["LAZ"], "page_size": 0}, {"collections": ["LAZ"], "page_size": 10_001}):
        with pytest.raises(Exception, match="collection|page_size"):
            search_pages.read_search(spark, str(tmp_path), **bad).count()


def test_search_connector_reads_compressed_pages(spark, tmp_path):
    folder = tmp_path / "c1" / "LAZ"
    folder.mkdir(parents=True)
    links = [{"rel": "next", "href": "b.json.gz"}]
    (folder / "a.json").write_text(json.dumps({"features": [feature("one")], "links": links}))
    (folder / "b.json.gz").write_bytes(gzip.compress(json.dumps({"features": [feature("two")], "links": []}).encode()))
    rows = search_pages.items_of(search_pages.read_search(spark, str(tmp_path), ["LAZ"])).select("item_id", "page").collect()
    assert sorted(map(tuple, rows)) == [("one", 0), ("two", 1)]


@pytest.mark.parametrize("name", ["stac_pages", "read_item_pages"])
def test_recorded_pages_are_small_on_disk(spark, tmp_path, monkeypatch, name):
    from tilelake.queries import QUERIES, connectors, load

    load()
    monkeypatch.setattr(connectors, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    QUERIES[name](spark, f"{DATA}/sf0.01").count()
    written = sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file() and not f.name.endswith(".crc"))
    rows = spark.read.parquet(f"{DATA}/sf0.01/lineitem.parquet").count()
    assert 0 < written < 150 * rows, written / rows  # as plain text some 650 bytes a row


def test_search_connector_fails_on_a_missing_search(spark, tmp_path):
    folder = tmp_path / "c1" / "LAZ"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps({"features": [], "links": []}))
    (tmp_path / "c1" / "EMPTY").mkdir()
    assert search_pages.read_search(spark, str(tmp_path), ["LAZ"]).count() == 0
    for collection in ("MDT", "EMPTY"):
        with pytest.raises(Exception, match=collection):
            search_pages.read_search(spark, str(tmp_path), ["LAZ", collection]).count()
    listed = scratch_path(spark, "chunk-table")
    spark.sql("SELECT explode(array('c1', 'c9')) AS chunk_id").write.parquet(listed)
    with pytest.raises(Exception, match="c9"):
        search_pages.read_search(spark, str(tmp_path), ["LAZ"], chunk_table=listed).count()


GEOMETRY = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}


@pytest.mark.parametrize(("doc", "parts", "problem"), [
    (GEOMETRY, 1, None), ({"type": "Feature", "geometry": GEOMETRY, "properties": {}}, 1, None),
    ({"type": "FeatureCollection", "features": [{"geometry": GEOMETRY}, {"geometry": None}, {"geometry": {"type": "MultiPolygon", "coordinates": [GEOMETRY["coordinates"]] * 2}}]}, 3, None),
    ({"type": "GeometryCollection", "geometries": [GEOMETRY, {"type": "Point", "coordinates": [3, 4]}]}, 2, None),
    ({"type": "FeatureCollection", "features": []}, 0, "no geometries"), ({"type": "Feature", "geometry": None}, 0, "no geometries"), ({"a": 1}, 0, "no type"),
    ({**GEOMETRY, "crs": {"properties": {"name": "urn:ogc:def:crs:EPSG::27493"}}}, 0, "unknown crs"), ({**GEOMETRY, "crs": {"properties": {}}}, 0, "unknown crs"),
    ({**GEOMETRY, "crs": {"properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}}, 1, None), ({"type": "LineString", "coordinates": [[0, 0], [1, 1]]}, 0, "unsupported geometry"),
])
def test_geojson_areas(spark, doc, parts, problem):
    good, bad = parse_geojson_aoi(spark.createDataFrame([(json.dumps(doc), "x")], "value string, source string"))
    assert good.count() == parts and [r.problem for r in bad.collect()] == ([problem] if problem else [])


def test_legacy_crs_is_reprojected(spark):
    tile = {"type": "Polygon", "coordinates": [[[-87000, -107000], [-86000, -107000], [-86000, -106000], [-87000, -106000], [-87000, -107000]]]}
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3763"}}, "features": [{"geometry": tile}]}
    p = parse_geojson_aoi(spark.createDataFrame([(json.dumps(doc), "x")], "value string, source string"))[0].first().rings[0][3]
    assert (p.x, p.y) == (pytest.approx(-9.1333284, abs=2e-7), pytest.approx(38.7091897, abs=2e-7))


@pytest.mark.parametrize("count", [0, 1, 7])
def test_feature_collection_is_one_document(spark, count):
    rows = [("c", f"i{i}", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]) for i in range(count)]
    path = scratch_path(spark, "fc")
    sinks.write_feature_json(spark.createDataFrame(rows, f"{ITEMS}, rings array<array<struct<x:double,y:double>>>"), path, "collection")
    import glob

    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path.removeprefix('file:')}/part-*")))
    doc = json.loads(text)
    assert doc["type"] == "FeatureCollection" and [f["id"] for f in doc["features"]] == [f"i{i}" for i in range(count)]


def test_manifest_has_only_the_allowed_fields(spark):
    from tilelake.schemas import MANIFEST_FIELDS

    row = {**{f: "x" for f in MANIFEST_FIELDS}, "href": "https://h?token=s", "cookie": "c"}
    path = scratch_path(spark, "mf")
    sinks.write_manifest(spark.createDataFrame([row]), path)
    text = spark.read.text(path).first().value
    assert set(json.loads(text)) == set(MANIFEST_FIELDS) and "token" not in text


def test_inventory_and_glob(spark, tmp_path):
    for name, size in (("c/a.tif", 3), ("c/b.tif.part", 2), ("d/c.laz", 1)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    found = tables.read_inventory(spark, str(tmp_path))
    assert {(r.path, r.length) for r in found.collect()} == {("c/a.tif", 3), ("c/b.tif.part", 2), ("d/c.laz", 1)}
    assert {(r.dest, r.is_part) for r in tables.split_inventory(found).collect()} == {("c/a.tif", False), ("c/b.tif", True), ("d/c.laz", False)}
    match = lambda p: {r.path for r in tables.glob_filter(found, p).collect()}
    assert match("*.tif") == {"c/a.tif"} and match("?.*") == {"c/a.tif", "c/b.tif.part", "d/c.laz"} and match("[!ab].laz") == {"d/c.laz"}
