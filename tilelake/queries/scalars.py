"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilelake.functions import assets, grid, http, keys, naming, text
from tilelake.functions.rings import rectangle
from tilelake.plans.fixtures import table, view
from tilelake.queries.registry import query

TILE_ID_SQL = "'^(.+)-([0-9]{3})([0-9]{3})-([0-9]{2})-([0-9]{4})$'"
_ITEM = ("collection_id", "item_id", "search_page")


def _part(i: int) -> str:
    return f"regexp_extract(item_id, {TILE_ID_SQL}, {i})"


def int_columns(df, *names):
    return df.select(*[F.col(n).cast("bigint").alias(n) if n in names else n for n in df.columns])


@query("decode_tile_key", f"""
SELECT item_id, search_page,
       CASE WHEN ok THEN {_part(1)} END AS prefix, CASE WHEN ok THEN cast({_part(2)} AS int) END AS tile_x,
       CASE WHEN ok THEN cast({_part(3)} AS int) END AS tile_y, CASE WHEN ok THEN cast({_part(4)} AS int) END AS lot,
       CASE WHEN ok THEN cast({_part(5)} AS int) END AS year
FROM (SELECT *, regexp_matches(item_id, {TILE_ID_SQL}) AS ok FROM cat_items_raw) t""")
def decode_tile_key(spark, sf):
    items = view(spark, sf, "cat_items_raw")
    return items.select("item_id", "search_page", keys.decode_tile_key(F.col("item_id")).alias("k")).select(
        "item_id", "search_page", "k.*"
    )


@query("tile_extent", f"""
SELECT item_id, search_page, (x - 200) * 1000 AS minx, (y - 301) * 1000 AS miny, (x - 199) * 1000 AS maxx, (y - 300) * 1000 AS maxy
FROM (SELECT item_id, search_page, try_cast({_part(2)} AS bigint) AS x, try_cast({_part(3)} AS bigint) AS y FROM cat_items_raw) t""")
def tile_extent(spark, sf):
    """Every item; those whose id isn't a tile key have no extent."""
    items = view(spark, sf, "cat_items_raw").withColumn("k", keys.decode_tile_key(F.col("item_id")))
    out = items.select("item_id", "search_page", keys.tile_extent(F.col("k.tile_x"), F.col("k.tile_y")).alias("e")).select("item_id", "search_page", "e.*")
    return int_columns(out, "minx", "miny", "maxx", "maxy")


@query("tile_of_point", """
SELECT x, y, cast(floor(x / 1000.0) + 200 AS int) AS tile_x, cast(ceil(y / 1000.0) + 300 AS int) AS tile_y
FROM (SELECT (tx - 200) * 1000 + search_page % 1000 AS x, (ty - 300) * 1000 - search_page * 7 % 1000 AS y FROM cat_items_raw) p""")
def tile_of_point(spark, sf):
    points = view(spark, sf, "cat_items_raw").selectExpr(
        "(tx - 200) * 1000 + search_page % 1000 AS x", "(ty - 300) * 1000 - search_page * 7 % 1000 AS y"
    )
    return points.select("x", "y", keys.tile_of_point(F.col("x"), F.col("y")).alias("k")).select("x", "y", "k.*")


def with_assets(items):
    """Items with an assets map as the catalog sends it: an overview first, then the data."""
    entry = lambda href, media, *roles: F.struct(
        F.lit(href).alias("href"), media.alias("type"), F.array(*[F.lit(r) for r in roles]).alias("roles")
    )
    real = F.when(F.col("asset_key") == "visual", entry("h", F.col("media_type"), "visual")).when(
        F.col("collection_id") == "MDS-50cm", entry("h", F.col("media_type"), "metadata")
    ).otherwise(entry("h", F.col("media_type"), "data", "visual"))
    return items.withColumn("assets", F.create_map(
        F.lit("overview"), entry("o", F.lit("image/png"), "thumbnail"), F.col("asset_key"), real,
        F.lit("z_visual"), entry("v", F.lit("image/jpeg"), "visual"),
    ))


@query("select_data_asset", """
SELECT item_id, search_page,
       CASE WHEN collection_id = 'MDS-50cm' THEN 'z_visual' ELSE asset_key END AS chosen_key,
       CASE WHEN collection_id = 'MDS-50cm' THEN 'image/jpeg' ELSE media_type END AS chosen_type FROM cat_items_raw""")
def select_data_asset(spark, sf):
    items = with_assets(view(spark, sf, "cat_items_raw"))
    return items.select("item_id", "search_page", assets.select_data_asset(F.col("assets")).alias("a")).select(
        "item_id", "search_page", F.col("a.asset_key").alias("chosen_key"), F.col("a.media_type").alias("chosen_type")
    )


def tile_rings(items):
    e = keys.tile_extent(F.col("tx"), F.col("ty"))
    return items.withColumn("_e", e).withColumn(
        "rings", rectangle(F.col("_e.minx"), F.col("_e.miny"), F.col("_e.maxx"), F.col("_e.maxy"))
    ).drop("_e")


def raw_boxes(items):
    """Geotransforms in place of boxes for two of three items."""
    d = lambda c: c.cast("double")
    x, y = d((F.col("tx") - 200) * 1000), d((F.col("ty") - 300) * 1000)
    return items.withColumn("bbox", F.when(
        F.col("search_page") % 3 == 0, F.array(x, y - 1000.0, x + 1000.0, y)
    ).when(
        F.col("search_page") % 3 == 1, F.array(x, F.lit(2.0), F.lit(0.0), y, F.lit(0.0), F.lit(-2.0))
    ).otherwise(F.array(x + 0.5, F.lit(2.0), F.lit(0.0), y, F.lit(0.0), F.lit(-2.0))))


@query("sanitize_bbox", """
SELECT item_id, search_page, (tx - 200) * 1000 AS minx, (ty - 301) * 1000 AS miny, (tx - 199) * 1000 AS maxx, (ty - 300) * 1000 AS maxy,
       cast(CASE WHEN search_page % 3 = 0 THEN 4 ELSE 6 END AS bigint) AS raw_values FROM cat_items_raw""")
def sanitize_bbox(spark, sf):
    from tilelake.operators.catalog import sanitize_bbox as op

    clean = op(raw_boxes(tile_rings(view(spark, sf, "cat_items_raw"))))
    sides = [F.col("bbox")[i].cast("bigint").alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))]
    return clean.select("item_id", "search_page", *sides, F.size("raw_bbox").cast("bigint").alias("raw_values"))


@query("is_geotransform_bbox",
       "SELECT item_id, search_page, search_page % 3 = 1 AS corrupted FROM cat_items_raw")
def is_geotransform_bbox(spark, sf):
    items = raw_boxes(view(spark, sf, "cat_items_raw"))
    return items.select("item_id", "search_page", assets.is_geotransform_bbox(F.col("bbox")).alias("corrupted"))


@query("asset_size", "SELECT item_id, search_page, size_bytes FROM cat_items_raw")
def asset_size(spark, sf):
    items = view(spark, sf, "cat_items_raw").withColumn("properties", F.parse_json(F.when(
        F.col("size_bytes").isNotNull(),
        F.concat(F.lit('{"file:size": '), F.col("size_bytes").cast("string"), F.lit(', "pc:count": 3}')),
    ).otherwise(F.lit('{"version": "01"}'))))
    return items.select("item_id", "search_page", assets.asset_size(F.col("properties")).alias("size_bytes"))


_EXT_SQL = "CASE WHEN media_type = 'application/vnd.laszip' THEN '.laz' WHEN media_type LIKE 'image/tiff%' THEN '.tif' ELSE '.bin' END"


@query("asset_extension", """
SELECT page_id, CASE page_id % 7 WHEN 0 THEN '.laz' WHEN 1 THEN '.tif' WHEN 2 THEN '.tif' WHEN 3 THEN '.json'
       WHEN 4 THEN '.bin' WHEN 5 THEN '.bin' ELSE '.tif' END AS extension FROM pages""")
def asset_extension(spark, sf):
    kinds = ("application/vnd.laszip", "image/tiff", " IMAGE/TIFF ; application=geotiff; profile=x",
             "application/json", "application/x-unheard-of", "", "image/tiff/sub")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("page_id") % 7 + 1).cast("int"))
    return table(spark, sf, "pages").select("page_id", naming.asset_extension(kind).alias("extension"))


@query("safe_component", r"""
SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(trim(raw), '[/\\]', '_', 'g'), '^\.+', ''), ''), '_') AS safe
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN '../' || url WHEN 2 THEN ' ..\' || url ELSE '....' END AS raw FROM pages) t""")
def safe_component(spark, sf):
    url = F.col("url")
    raw = (F.when(F.col("page_id") % 4 == 0, url).when(F.col("page_id") % 4 == 1, F.concat(F.lit("../"), url))
           .when(F.col("page_id") % 4 == 2, F.concat(F.lit(" ..\\"), url)).otherwise(F.lit("....")))
    return table(spark, sf, "pages").select("page_id", naming.safe_component(raw).alias("safe"))


@query("storage_filename", f"SELECT collection_id, item_id, item_id || {_EXT_SQL} AS filename FROM assets")
def storage_filename(spark, sf):
    return view(spark, sf, "assets").select(
        "collection_id", "item_id", naming.storage_filename(F.col("item_id"), F.col("media_type")).alias("filename")
    )


@query("layout_path", f"""
SELECT collection_id, item_id, collection_id || '/' || item_id || {_EXT_SQL} AS by_collection,
       CASE WHEN regexp_matches(item_id, {TILE_ID_SQL}) THEN {_part(2)} || {_part(3)} ELSE 'untiled' END || '/' || item_id || {_EXT_SQL} AS by_tile,
       item_id || {_EXT_SQL} AS flat FROM assets""")
def layout_path(spark, sf):
    return view(spark, sf, "assets").select(
        "collection_id", "item_id", *[naming.layout_path(n).alias(n) for n in ("by_collection", "by_tile", "flat")]
    )


@query("register_layout", f"SELECT collection_id, item_id, cast(year(item_ts) AS varchar) || '/' || item_id || {_EXT_SQL} AS dest FROM assets")
def register_layout(spark, sf):
    if "by_year" not in naming.LAYOUTS:
        naming.register_layout("by_year", lambda: F.concat_ws(
            "/", F.year("item_ts").cast("string"), naming.storage_filename(F.col("item_id"), F.col("media_type"))
        ))
    return view(spark, sf, "assets").select("collection_id", "item_id", naming.layout_path("by_year").alias("dest"))


@query("human_size", """
SELECT o_orderkey, CASE WHEN n IS NULL THEN 'unknown' WHEN n < 1000 THEN printf('%.0f B', n / 1.0)
       WHEN n / 1000.0::double < 1000 THEN printf('%.1f KB', n / 1000.0::double)
       WHEN n / 1000.0::double / 1000 < 1000 THEN printf('%.1f MB', n / 1000.0::double / 1000)
       WHEN n / 1000.0::double / 1000 / 1000 < 1000 THEN printf('%.1f GB', n / 1000.0::double / 1000 / 1000)
       ELSE printf('%.1f TB', n / 1000.0::double / 1000 / 1000 / 1000) END AS size
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN o_orderkey
             WHEN o_orderkey % 5 = 2 THEN o_orderkey * 50 WHEN o_orderkey % 5 = 3 THEN o_orderkey * 50 * 1000
             WHEN o_orderkey % 5 = 4 THEN o_orderkey * 250000000 ELSE o_orderkey * o_orderkey * 12345 END AS n FROM orders) t""")
def human_size(spark, sf):
    k = F.col("o_orderkey")
    wide = k.cast("decimal(20,0)")  # from a key of 27 million on the square's multiple is no long any more
    n = (F.when(k % 50 == 0, None).when(k % 5 == 1, k).when(k % 5 == 2, k * 50).when(k % 5 == 3, k * 50 * 1000)
         .when(k % 5 == 4, wide * 250000000).otherwise(wide * wide * 12345))
    return table(spark, sf, "orders").select("o_orderkey", text.human_size(n).alias("size"))


@query("human_duration", """
SELECT event_id, CASE WHEN s >= 60 THEN cast(cast(floor(s / 60) AS bigint) AS varchar) || ':' || lpad(cast(s % 60 AS varchar), 2, '0')
       ELSE cast(s AS varchar) || ' s' END AS shown
FROM (SELECT event_id, greatest(0, cast(round_even((event_id % 2000 - 40) / 4.0::double, 0) AS bigint)) AS s FROM events) t""")
def human_duration(spark, sf):
    seconds = (F.col("event_id") % 2000 - 40) / 4.0
    return table(spark, sf, "events").select("event_id", text.human_duration(seconds).alias("shown"))


@query("parse_retry_after", """
SELECT req_id, CASE WHEN retry_after IS NOT NULL THEN cast(retry_after AS bigint) * 1000000
       WHEN req_id % 7 = 1 THEN greatest(0, epoch_us(date_trunc('second', ts + INTERVAL 90 SECOND)) - epoch_us(ts))
       WHEN req_id % 7 = 2 THEN 0 END AS wait_us FROM request_log""")
def parse_retry_after(spark, sf):
    log = view(spark, sf, "request_log")
    date = lambda c: F.concat(F.date_format(c, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    value = (F.when(F.col("retry_after").isNotNull(), F.col("retry_after"))
             .when(F.col("req_id") % 7 == 1, date(F.col("ts") + F.expr("INTERVAL 90 SECONDS")))
             .when(F.col("req_id") % 7 == 2, date(F.col("ts") - F.expr("INTERVAL 90 SECONDS")))
             .when(F.col("req_id") % 7 == 3, F.lit("soon")))
    wait = http.parse_retry_after(value, F.col("ts").cast("timestamp"))
    return log.select("req_id", F.floor(wait * 1_000_000 + 0.5).cast("bigint").alias("wait_us"))


@query("log_safe_url", """
SELECT req_id, CASE WHEN location LIKE 'https://%' THEN 'https://store.example/o/' || req_id ELSE location END AS safe FROM request_log""")
def log_safe_url(spark, sf):
    return view(spark, sf, "request_log").select("req_id", http.log_safe_url(F.col("location")).alias("safe"))


@query("is_login_redirect", "SELECT req_id, status = 302 AND req_id % 3 = 0 AS login FROM request_log")
def is_login_redirect(spark, sf):
    location = F.when(F.col("req_id") % 2 == 0, F.col("location")).when(
        F.col("location") == "/auth/login", F.lit("https://h.example/auth/login/?next=%2F")
    ).otherwise(F.col("location"))
    return view(spark, sf, "request_log").select("req_id", http.is_login_redirect(F.col("status"), location).alias("login"))


@query("exchange_action", """
SELECT req_id, CASE WHEN status = 302 AND req_id % 3 = 0 THEN 'reauth' WHEN status = 302 AND req_id % 11 = 1 THEN 'fail'
       WHEN status = 302 THEN 'presigned' WHEN status = 200 AND req_id % 5 = 0 THEN 'remint' ELSE 'fail' END AS action FROM request_log""")
def exchange_action(spark, sf):
    status = F.when((F.col("status") == 200) & (F.col("req_id") % 5 == 0), 403).otherwise(F.col("status"))
    location = F.when((F.col("req_id") % 3 != 0) & (F.col("req_id") % 11 == 1), None).otherwise(F.col("location"))
    return view(spark, sf, "request_log").select("req_id", http.exchange_action(status, location).alias("action"))


@query("transfer_action", """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'complete' WHEN 1 THEN 'fail' WHEN 2 THEN 'remint' WHEN 3 THEN 'fail'
       WHEN 4 THEN 'append' WHEN 5 THEN 'restart' WHEN 6 THEN 'discard' WHEN 7 THEN 'restart' WHEN 8 THEN 'fresh' ELSE 'fail' END AS action
FROM events""")
def transfer_action(spark, sf):
    case = lambda *values: F.element_at(
        F.array(*[v if not isinstance(v, (int, str, type(None))) else F.lit(v) for v in values]), (F.col("event_id") % 10 + 1).cast("int")
    )
    at = F.concat(F.lit("bytes "), F.col("event_id").cast("string"), F.lit("-9/*"))
    return table(spark, sf, "events").select("event_id", http.transfer_action(
        case(416, 416, 403, 403, 206, 206, 206, 200, 200, 500),
        case("", "", "", "", at, "bytes 0-9/10", "bytes 7777777-9/10", "", "", ""),
        F.when(F.col("event_id") % 10 == 8, 0).otherwise(F.col("event_id")).cast("bigint"),
        F.when(F.col("event_id") % 10 == 0, F.col("event_id")).when(F.col("event_id") % 10 == 1, F.col("event_id") + 1).cast("bigint"),
        case("", "", "<Error>AccessDenied</Error>", "<Error>Other</Error>", "", "", "", "", "", ""),
    ).alias("action"))


@query("retry_backoff", """
SELECT event_id, CASE WHEN n BETWEEN 1 AND 5 THEN cast(least(30.0, 0.5 * pow(2, n - 1)) * 10 AS bigint) END AS transfer_ds,
       CASE WHEN n = 1 THEN 0 WHEN n BETWEEN 2 AND 5 THEN cast(least(120.0, 2.0 * pow(2, n - 1)) * 10 AS bigint) END AS http_ds
FROM (SELECT event_id, event_id % 9 AS n FROM events) t""")
def retry_backoff(spark, sf):
    n = F.col("event_id") % 9
    tenths = lambda kind: (http.retry_backoff(n, kind) * 10).cast("bigint")
    return table(spark, sf, "events").select("event_id", tenths("transfer").alias("transfer_ds"), tenths("http").alias("http_ds"))


def _boxes(orders):
    z = F.col("o_totalprice")
    return orders.select("o_orderkey", grid.box(-z, z / 3, z / 2, z).alias("b"))


_BOX_SQL = """(SELECT o_orderkey, -o_totalprice AS minx, o_totalprice / 3 AS miny, o_totalprice / 2 AS maxx, o_totalprice AS maxy FROM orders) t"""


@query("snap_outward", f"""
SELECT o_orderkey, cast(floor(minx / 10) * 10 AS bigint) AS minx, cast(floor(miny / 10) * 10 AS bigint) AS miny,
       cast(ceil(maxx / 10) * 10 AS bigint) AS maxx, cast(ceil(maxy / 10) * 10 AS bigint) AS maxy FROM {_BOX_SQL}""")
def snap_outward(spark, sf):
    out = _boxes(table(spark, sf, "orders")).select("o_orderkey", grid.snap_outward(F.col("b"), 10.0).alias("s"))
    return int_columns(out.select("o_orderkey", "s.*"), "minx", "miny", "maxx", "maxy")


@query("clamp_bounds", f"""
SELECT o_orderkey, ok AS overlaps, CASE WHEN ok THEN cast(floor(greatest(minx, 0) * 100 + 0.5) AS bigint) END AS minx,
       CASE WHEN ok THEN cast(floor(least(maxy, 100000) * 100 + 0.5) AS bigint) END AS maxy
FROM (SELECT *, greatest(minx, 0) < least(maxx, 100000) AND greatest(miny, 50000) < least(maxy, 100000) AS ok FROM {_BOX_SQL}) u""")
def clamp_bounds(spark, sf):
    limits = grid.box(F.lit(0), F.lit(50000), F.lit(100000), F.lit(100000))
    out = _boxes(table(spark, sf, "orders")).select("o_orderkey", grid.clamp_bounds(F.col("b"), limits).alias("c"))
    cents = lambda n: F.floor(F.col(f"c.{n}") * 100 + 0.5).cast("bigint").alias(n)
    return out.select("o_orderkey", F.col("c").isNotNull().alias("overlaps"), cents("minx"), cents("maxy"))


@query("quantize", """
SELECT px, py, CASE WHEN z = -999.0 THEN -99900 ELSE cast(floor(z / 0.5 + 0.5) * 50 AS bigint) END AS q100 FROM pixels""")
def quantize(spark, sf):
    q = grid.quantize(F.col("z"), 0.25)
    return view(spark, sf, "pixels").select("px", "py", F.floor(q * 100 + 0.5).cast("bigint").alias("q100"))


@query("estimate_bytes", """
SELECT o_orderkey, b AS base_bytes, cast(floor(b * 1.34::double) AS bigint) AS final_bytes, b > 2147483648 AS large
FROM (SELECT o_orderkey, o_orderkey * 40 * (o_custkey * 20) * CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 8 END AS b FROM orders) t""")
def estimate_bytes(spark, sf):
    dtype = F.element_at(F.array(F.lit("uint8"), F.lit("float32"), F.lit("float64")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    e = grid.estimate_bytes(F.col("o_orderkey") * 40, F.col("o_custkey") * 20, dtype)
    return table(spark, sf, "orders").select("o_orderkey", e.alias("e")).select("o_orderkey", "e.*")
