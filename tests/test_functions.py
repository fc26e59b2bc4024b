"""Scalar functions on small tables of known values."""

import pytest
from pyspark.sql import functions as F

from tilelake.functions import grid, http, keys, naming, text
from tilelake.functions.sql import register
from tilelake.queries import QUERIES, load


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


# Published tile ids and the upper-left corner of their tile in metres.
TILES = {
    "MDT-2m-113194-07-2024": (-87000, -106000), "MDT-2m-113193-06-2024": (-87000, -107000),
    "LO-114199-07-2024": (-86000, -101000), "MDT-2m-114198-07-2024": (-86000, -102000),
    "LO-160467-07-2025": (-40000, 167000), "LO-159466-07-2025": (-41000, 166000),
    "MDS-2m-162467-07-2025": (-38000, 167000), "MDS-2m-162463-07-2025": (-38000, 163000),
    "MDS-50cm-162467-07-2025": (-38000, 167000),
}
# A sound id, broken in one place each: nothing, year, tile, lot, prefix, line end.
SOUND = "ALT-5m-250310-11-2019"
FOREIGN = ["", SOUND[:-1], SOUND + "0", SOUND.replace("250310", "25031"), SOUND.replace("250310", "2503101"), SOUND.replace("250", "2x0"),
           SOUND.replace("-11-", "-1-"), SOUND.replace("-11-", "-011-"), SOUND[7:], SOUND[6:], SOUND + "\n"]


def test_tile_ids_and_corners(spark):
    k = keys.decode_tile_key(F.col("id"))
    e = keys.tile_extent(k["tile_x"], k["tile_y"])
    got = dict(
        (i, (int(x), int(y))) for i, x, y in values(spark, [(i,) for i in TILES], "id string", "id", e["minx"], e["maxy"]))
    assert got == TILES


def test_tile_id_fields(spark):
    k = keys.decode_tile_key(F.lit("a-b-c-007042-03-1999"))
    assert values(spark, [(1,)], "x int", k)[0][0] == ("a-b-c", 7, 42, 3, 1999)


def test_foreign_ids_are_null(spark):
    got = values(spark, [(i,) for i in FOREIGN], "id string", keys.decode_tile_key(F.col("id")))
    assert all(v == (None,) for v in got)


def test_points_fall_into_their_tile(spark):
    rows = [(-87000.0, -106000.0), (-86000.001, -106999.9), (-86500.0, -106000.5)]
    tile = keys.tile_of_point(F.col("x"), F.col("y"))
    assert all(t[0] == (113, 194) for t in values(spark, rows, "x double, y double", tile))


# Media types and extensions.
EXTENSIONS = [
    ("image/tiff", ".tif"), ("image/tiff; application=geotiff", ".tif"), ("Image/TIFF ;a=b", ".tif"),
    ("application/vnd.laszip", ".laz"), ("application/json", ".json"), (None, ".bin"), ("", ".bin"), ("application/x-none", ".bin"),
]


@pytest.mark.parametrize(("media", "extension"), EXTENSIONS)
def test_extension(spark, media, extension):
    assert values(spark, [(media,)], "m string", naming.asset_extension(F.col("m"))) == [(extension,)]


def test_extra_extension(spark):
    extra = {"application/x-none": ".none"}
    assert values(spark, [("application/x-none",)], "m string", naming.asset_extension(F.col("m"), extra)) == [(".none",)]


@pytest.mark.parametrize("hostile", ["../up/../down", "..", "./.", "one/two", "one\\two", "", "\t \n", ".....z", "y\x00", "  .hidden\t"])
def test_safe_component(spark, hostile):
    safe = values(spark, [(hostile,)], "s string", naming.safe_component(F.col("s")))[0][0]
    assert safe and not safe.startswith(".") and not set(safe) & set("/\\\x00")


def test_hostile_collection_stays_one_folder(spark):
    rows = [("../up/../down", "x", "image/tiff")]
    path = values(spark, rows, "collection_id string, item_id string, media_type string", naming.layout_path())[0][0]
    assert path.count("/") == 1 and path.split("/")[0] not in ("", ".", "..")


def test_unknown_layout():
    with pytest.raises(ValueError):
        naming.layout_path("nope")


SIZES = [None, 0, 1, 999, 1000, 1350, 1450, 2250, 999_949, 999_950, 68_250_000_000, 10**15, 10**18, -2250]


SIZE_TEXTS = ["unknown", "0 B", "1 B", "999 B", "1.0 KB", "1.4 KB", "1.4 KB", "2.2 KB", "999.9 KB", "1000.0 KB", "68.2 GB", "1.0 PB", "1000.0 PB", "-2.2 KB"]


def test_human_size_rounds_like_printf(spark):
    got = values(spark, [(n,) for n in SIZES], "n bigint", "n", text.human_size(F.col("n")))
    assert [s for _, s in got] == SIZE_TEXTS


def test_human_size_query_takes_keys_whose_square_is_no_long(spark, tmp_path):
    load()
    keys_ = [1, 5, 55, 604, 27_335_045, 216_000_005, 3_000_000_005, 40_000_000_004]
    spark.createDataFrame([(k,) for k in keys_], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.o_orderkey: r.size for r in QUERIES["human_size"](spark, str(tmp_path)).collect()}
    assert got == {1: "1 B", 5: "308.6 KB", 55: "37.3 MB", 604: "151.0 GB", 27_335_045: "9224.2 PB", 216_000_005: "575968.3 PB",
                   3_000_000_005: "111105000.4 PB", 40_000_000_004: "10000.0 PB"}


def test_human_duration(spark):
    rows = [(v,) for v in (-3.0, 0.4, 0.5, 1.5, 59.4, 59.5, 60.0, 125.0, 3600.0)]
    got = [v[0] for v in values(spark, rows, "s double", text.human_duration(F.col("s")))]
    assert got == ["0 s", "0 s", "0 s", "2 s", "59 s", "1:00", "1:00", "2:05", "60:00"]


def test_retry_after(spark):
    rows = [("120", 120.0), (" 7 ", 7.0), ("Wed, 21 Oct 2015 07:28:00 GMT", 60.0), ("Wed, 21 Oct 2015 07:20:00 GMT", 0.0),
            ("Wed, 21 Oct 2015 09:28:00 +0200", 60.0), ("soon", None), ("", None), ("-5", None)]
    at = F.lit("2015-10-21 07:27:00").cast("timestamp")
    got = values(spark, [(v,) for v, _ in rows], "v string", http.parse_retry_after(F.col("v"), at))
    assert [g[0] for g in got] == [want for _, want in rows]


@pytest.mark.parametrize(("status", "location", "login", "action"), [
    (302, "/auth/login", True, "reauth"), (303, "https://h/auth/login/?a=b", True, "reauth"), (302, "//h/auth/login", True, "reauth"),
    (200, "/auth/login", False, "fail"), (302, "/auth/login/x", False, "presigned"), (302, None, False, "fail"),
    (302, "https://s3/x?sig=1", False, "presigned"), (403, None, False, "remint"), (500, None, False, "fail"),
])
def test_exchange(spark, status, location, login, action):
    s, loc = F.col("s"), F.col("l")
    got = values(spark, [(status, location)], "s int, l string", http.is_login_redirect(s, loc), http.exchange_action(s, loc))
    assert got == [(login, action)]


@pytest.mark.parametrize(("case", "action"), [
    ((416, None, 10, 10, None), "complete"), ((416, None, 9, 10, None), "fail"), ((416, None, 9, None, None), "fail"),
    ((403, None, 0, 1, "<Code>AccessDenied</Code>"), "remint"), ((403, None, 0, 1, "Request has EXPIRED"), "remint"), ((403, None, 0, 1, "no"), "fail"),
    ((206, "bytes 5-9/10", 5, 10, None), "append"), ((206, "bytes 0-9/10", 5, 10, None), "restart"), ((206, "bytes 3-9/10", 5, 10, None), "discard"),
    ((206, None, 5, 10, None), "discard"), ((200, None, 5, 10, None), "restart"), ((200, None, 0, 10, None), "fresh"), ((500, None, 0, 10, None), "fail"),
])
def test_transfer(spark, case, action):
    schema = "st int, cr string, start bigint, declared bigint, body string"
    columns = [F.col(c) for c in ("st", "cr", "start", "declared", "body")]
    assert values(spark, [case], schema, http.transfer_action(*columns)) == [(action,)]


def test_backoff(spark):
    n = F.col("n")
    got = values(spark, [(i,) for i in range(0, 8)], "n int", http.retry_backoff(n), http.retry_backoff(n, "http"))
    assert got == [(None, None), (0.5, 0.0), (1.0, 4.0), (2.0, 8.0), (4.0, 16.0), (8.0, 32.0), (None, None), (None, None)]


def test_log_safe_url(spark):
    got = values(spark, [("https://h:1/p/q?X-Sig=s#f",), ("/p#f?x",), (None,)], "u string", http.log_safe_url(F.col("u")))
    assert got == [("https://h:1/p/q",), ("/p",), (None,)]


def test_bounds(spark):
    b = grid.box(F.lit(13.3), F.lit(-150.7), F.lit(187.2), F.lit(-12.4))
    snapped = grid.snap_outward(b, 2.5)
    limits = grid.box(F.lit(0), F.lit(-200), F.lit(200), F.lit(0))
    row = values(spark, [(1,)], "x int", snapped, grid.clamp_bounds(snapped, limits),
                 grid.clamp_bounds(grid.box(F.lit(300), F.lit(0), F.lit(400), F.lit(9)), limits))[0]
    assert tuple(row[0]) == (12.5, -152.5, 187.5, -10.0) == tuple(row[1])
    assert row[2] is None


def test_quantize_keeps_the_bound(spark):
    z = F.col("z")
    rows = [(v / 7.0,) for v in range(-500, 500)] + [(-999.0,)]
    got = values(spark, rows, "z double", "z", grid.quantize(z, 0.05))
    assert all(abs(a - b) <= 0.05 + 1e-12 for a, b in got)
    assert got[-1] == (-999.0, -999.0)


def test_sql_functions_agree_with_columns(spark):
    register(spark)
    from tilelake.functions.projections import to_tm06

    ids = [(i, m, float(n)) for n, (i, m) in enumerate(zip([*TILES, *FOREIGN], ["image/tiff; a", "application/vnd.laszip", None, "text/csv"] * 5, strict=True))]
    df = spark.createDataFrame(ids, "id string, m string, n double")
    pairs = {
        "tl_decode_tile_key(id)": keys.decode_tile_key(F.col("id")),
        "tl_tile_extent(int(n), int(n) * 2)": keys.tile_extent(F.col("n").cast("int"), F.col("n").cast("int") * 2),
        "tl_tile_of_point(n * 777, -n * 333)": keys.tile_of_point(F.col("n") * 777, -F.col("n") * 333),
        "tl_asset_extension(m)": naming.asset_extension(F.col("m")),
        "tl_safe_component(id)": naming.safe_component(F.col("id")),
        "tl_storage_filename(id, m)": naming.storage_filename(F.col("id"), F.col("m")),
        "tl_human_duration(n * 13.5)": text.human_duration(F.col("n") * 13.5),
        "tl_log_safe_url(concat(id, '?x'))": http.log_safe_url(F.concat("id", F.lit("?x"))),
        "tl_exchange_action(300 + int(n), id)": http.exchange_action(300 + F.col("n").cast("int"), F.col("id")),
        "tl_retry_backoff(int(n))": http.retry_backoff(F.col("n").cast("int")),
        "tl_quantize(n / 7, 0.05)": grid.quantize(F.col("n") / 7, 0.05),
        "tl_to_tm06(-9 + n / 10, 38 + n / 10)": to_tm06(F.lit(-9.0) + F.col("n") / 10, F.lit(38.0) + F.col("n") / 10),
    }
    for sql, column in pairs.items():
        # Spark folds constants in another order on the two routes; doubles agree to the digit shown.
        rows = df.select(F.expr(sql).alias("a"), column.alias("b")).collect()
        for r in rows:
            assert repr(r["a"]) == repr(r["b"]) or [round(v, 6) for v in r["a"]] == [round(v, 6) for v in r["b"]], sql
