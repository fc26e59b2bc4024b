"""Views over the given test tables, as SQL text that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# The catalog, raster and log views; each may use the ones above it.
VIEWS: dict[str, str] = {
    "cat_items_raw": """
SELECT CASE WHEN k = 6 THEN concat('ORTOS-2021-cog-25cm-', cast(tx AS varchar(9)), '-', cast(lot AS varchar(9)))
            ELSE concat(prefix, '-', lpad(cast(tx AS varchar(9)), 3, '0'), lpad(cast(ty AS varchar(9)), 3, '0'),
                        '-', lpad(cast(lot AS varchar(9)), 2, '0'), '-', cast(yr AS varchar(9))) END AS item_id,
       collection_id,
       CASE WHEN k = 6 THEN 'visual' ELSE 'data' END AS asset_key,
       CASE WHEN k = 6 THEN 'image/tiff; application=geotiff; profile=cloud-optimized'
            WHEN k = 0 THEN 'application/vnd.laszip' ELSE 'image/tiff; application=geotiff' END AS media_type,
       CASE WHEN k = 6 THEN NULL ELSE 1000000 + tx * 1000 + ty * 10 + k END AS size_bytes,
       item_ts, tx, ty, search_page
FROM (SELECT l_linenumber - 1 AS k,
             CASE l_linenumber WHEN 1 THEN 'LO' WHEN 2 THEN 'MDT-2m' WHEN 3 THEN 'MDT-50cm' WHEN 4 THEN 'MDS-2m'
                               WHEN 5 THEN 'MDS-50cm' WHEN 6 THEN 'HID' ELSE 'ORTOS' END AS prefix,
             CASE l_linenumber WHEN 1 THEN 'LAZ' WHEN 2 THEN 'MDT-2m' WHEN 3 THEN 'MDT-50cm' WHEN 4 THEN 'MDS-2m'
                               WHEN 5 THEN 'MDS-50cm' WHEN 6 THEN 'MDT-2m-acores' ELSE 'ORTOS-2021' END AS collection_id,
             110 + l_partkey % 40 AS tx, 190 + l_suppkey % 30 AS ty, 1 + l_partkey % 3 AS lot,
             year(l_shipdate) AS yr, l_shipdate AS item_ts, l_orderkey AS search_page
      FROM lineitem) b""",
    "pixels": """
SELECT o_orderkey % 128 AS px, cast(floor(o_orderkey / 128) AS int) AS py,
       cast(floor((o_orderkey % 128) / 32) AS int) AS tile_col,
       cast(floor(floor(o_orderkey / 128) / 32) AS int) AS tile_row,
       CASE WHEN o_orderkey % 97 = 0 THEN -999.0 ELSE round(o_totalprice / 100.0, 1) END AS z
FROM orders""",
    "request_log": """
SELECT event_id AS req_id, ts, user_id AS client_id,
       CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 429 ELSE 503 END
                       WHEN 'signup' THEN 302 ELSE 200 END AS status,
       CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN cast(60 + event_id % 600 AS varchar(9)) END AS retry_after,
       CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '/auth/login'
            WHEN event_type = 'signup' THEN concat('https://store.example/o/', cast(event_id AS varchar(9)), '?X-Amz-Signature=s')
       END AS location,
       cast(floor(value * 1000) AS bigint) AS nbytes
FROM events""",
    "collections": """
SELECT collection_id AS id, concat('Title of ', collection_id) AS title, 'proprietary' AS license,
       CASE WHEN collection_id = 'MDT-2m-acores' THEN 'hide' ELSE 'show' END AS shown, n
FROM (SELECT collection_id, count(*) AS n FROM cat_items_raw GROUP BY collection_id) c""",
    "assets": """
SELECT collection_id, item_id, asset_key, media_type, min(size_bytes) AS size_bytes, min(item_ts) AS item_ts,
       min(tx) AS tx, min(ty) AS ty
FROM cat_items_raw GROUP BY collection_id, item_id, asset_key, media_type""",
    "placed_assets": """
SELECT a.*, (tx * 7 + ty * 13) % 10 AS m,
       concat(collection_id, '/', item_id, CASE WHEN collection_id = 'LAZ' THEN '.laz' ELSE '.tif' END) AS dest
FROM assets a""",
    "inventory": """
SELECT CASE WHEN m = 5 THEN concat(dest, '.part') ELSE dest END AS path,
       cast(CASE WHEN size_bytes IS NULL THEN 777 WHEN m < 4 THEN size_bytes WHEN m = 4 THEN size_bytes - 1
                 ELSE floor(size_bytes / 2) END AS bigint) AS length
FROM placed_assets WHERE m < 6""",
    "outcomes": """
SELECT collection_id, item_id, asset_key, media_type, size_bytes AS declared_size_bytes, dest, run_id,
       item_ts AS finished_at,
       CASE WHEN run_id = 1 AND m = 4 THEN 'failed' WHEN run_id = 1 AND m < 4 THEN 'skipped'
            WHEN run_id = 1 AND m = 5 THEN 'resumed' WHEN run_id = 1 THEN 'downloaded'
            WHEN m = 4 AND tx % 3 = 0 THEN 'failed' WHEN m = 4 THEN 'resumed' ELSE 'skipped' END AS status,
       CASE WHEN m = 4 AND run_id = 1 THEN 17 ELSE coalesce(size_bytes, 777) END AS bytes_transferred
FROM (SELECT a.*, 1 AS run_id FROM placed_assets a UNION ALL SELECT b.*, 2 AS run_id FROM placed_assets b) r""",
    "raster_headers": """
SELECT concat('tile-', lpad(cast(tile_row AS varchar(9)), 4, '0'), '-', lpad(cast(tile_col AS varchar(9)), 4, '0'), '.tif') AS path,
       tile_col, tile_row, w AS width, h AS height,
       cast(tile_col * 16 AS double) AS minx, cast(-tile_row * 16 - h * 0.5 AS double) AS miny,
       cast(tile_col * 16 + w * 0.5 AS double) AS maxx, cast(-tile_row * 16 AS double) AS maxy
FROM (SELECT tile_col, tile_row, max(px) - tile_col * 32 + 1 AS w, max(py) - tile_row * 32 + 1 AS h
      FROM pixels GROUP BY tile_col, tile_row) t""",
    "pauses": """
SELECT req_id AS pause_id, ts AS start_ts, cast(retry_after AS int) AS seconds
FROM request_log WHERE retry_after IS NOT NULL""",
    "progress": """
SELECT client_id, req_id, ts, nbytes FROM request_log WHERE status = 200""",
}

_BASES = ("lineitem", "orders", "events")


def _needs(name: str) -> list[str]:
    """The view and everything it reads, in order of definition."""
    wanted = {name}
    for view in reversed(list(VIEWS)):
        if view in wanted:
            wanted |= {v for v in VIEWS if re.search(rf"\b(?:FROM|JOIN) {v}\b", VIEWS[view])}
    return [v for v in VIEWS if v in wanted]


def with_clause(*names: str) -> str:
    """``WITH …`` for the named views and what they read."""
    wanted = {v for n in names for v in _needs(n)}
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in wanted)


def oracle(body: str, recursive: bool = False) -> str:
    """A full query: the body with every view it names defined before it."""
    names = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    text = with_clause(*names) if names else ""
    if body.lstrip().upper().startswith("WITH "):
        rest = re.sub(r"(?i)^\s*WITH\s+", "", body)
        text = f"{text},\n{rest}" if text else f"WITH {rest}"
    else:
        text = f"{text}\n{body}"
    return text.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the Parquet files."""
    text = f"{with_clause(name)}\nSELECT * FROM {name}"
    used = [b for b in _BASES if re.search(rf"\bFROM {b}\b", text)]
    for base in used:
        text = re.sub(rf"\bFROM {base}\b", f"FROM {{{base}}}", text)
    return spark.sql(text, **{b: table(spark, sf_dir, b) for b in used})
