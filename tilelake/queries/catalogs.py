"""Catalog filters, joins, estimates and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tilelake.operators import catalog, plan
from tilelake.plans.fixtures import table, view
from tilelake.queries.registry import query
from tilelake.queries.scalars import TILE_ID_SQL


def collections(spark, sf):
    known = view(spark, sf, "collections").drop("n")
    return known.withColumn("visibility", F.array("shown")).drop("shown").withColumn(
        "extent", F.lit(None).cast("string")
    )


@query("downloadable", "SELECT id FROM collections WHERE shown = 'show'")
def downloadable(spark, sf):
    return catalog.downloadable(collections(spark, sf)).select("id")


@query("list_collections", "SELECT id, title, license, shown AS visibility FROM collections")
def list_collections(spark, sf):
    listed = catalog.list_collections(collections(spark, sf), show_all=True)
    return listed.select("id", "title", "license", F.array_join("visibility", ", ").alias("visibility"))


@query("collection_record", "SELECT id, title, license, shown AS visibility FROM collections WHERE id = 'MDT-2m'")
def collection_record(spark, sf):
    one = catalog.collection(collections(spark, sf), "MDT-2m")
    return one.select("id", "title", "license", F.array_join("visibility", ", ").alias("visibility"))


@query("filter_collections", """
SELECT collection_id, item_id, size_bytes, search_page FROM cat_items_raw WHERE collection_id IN ('MDT-2m', 'LAZ')""")
def filter_collections(spark, sf):
    items = view(spark, sf, "cat_items_raw")
    return catalog.filter_collections(items, ["MDT-2m", "LAZ"]).select("collection_id", "item_id", "size_bytes", "search_page")


@query("filter_datetime", """
SELECT collection_id, item_id, search_page FROM cat_items_raw
WHERE item_ts >= timestamp '1997-03-01 00:00:00' AND item_ts <= timestamp '1999-12-31 23:59:59'""")
def filter_datetime(spark, sf):
    items = catalog.filter_datetime(view(spark, sf, "cat_items_raw"), "1997-03/1999")
    return items.select("collection_id", "item_id", "search_page")


@query("filter_by_id", """
SELECT collection_id, item_id, search_page FROM cat_items_raw
WHERE collection_id = 'MDT-2m' AND item_id IN (SELECT item_id FROM cat_items_raw WHERE tx % 5 = 0 AND ty % 3 = 0)""")
def filter_by_id(spark, sf):
    items = view(spark, sf, "cat_items_raw")
    wanted = items.where("tx % 5 = 0 AND ty % 3 = 0").select("item_id").distinct()
    return catalog.filter_by_id(items, "MDT-2m", wanted).select("collection_id", "item_id", "search_page")


@query("glob_filter", "SELECT dest FROM placed_assets WHERE dest LIKE '%/MDT-2m-1_5%.tif'")
def glob_filter(spark, sf):
    from tilelake.sources.tables import glob_filter as op

    return op(view(spark, sf, "placed_assets"), "MDT-2m-1?5*.tif", "dest").select("dest")


@query("unknown_collections", """
SELECT DISTINCT p_type AS collection_id, (SELECT string_agg(id, ',' ORDER BY id) FROM collections) AS valid_ids
FROM (SELECT p_type FROM part UNION ALL SELECT id FROM collections WHERE id LIKE 'M%') r WHERE p_type NOT IN (SELECT id FROM collections)""")
def unknown_collections(spark, sf):
    known = collections(spark, sf)
    requested = table(spark, sf, "part").select(F.col("p_type").alias("collection_id")).unionByName(
        known.where(F.col("id").startswith("M")).select(F.col("id").alias("collection_id"))
    )
    return catalog.unknown_collections(requested, known).select("collection_id", F.array_join("valid_ids", ",").alias("valid_ids"))


@query("license_of", "SELECT DISTINCT a.collection_id, c.license FROM assets a JOIN collections c ON c.id = a.collection_id")
def license_of(spark, sf):
    return catalog.license_of(view(spark, sf, "assets"), collections(spark, sf))


_ESTIMATE_SQL = """
SELECT collection_id, count(*) AS item_count, coalesce(sum(size_bytes), 0)::bigint AS known_bytes,
       count(*) FILTER (WHERE size_bytes IS NULL) AS unknown_size_count, grouping(collection_id)::int AS is_total,
       coalesce(sum(size_bytes), 0) > 50000000000 AS is_large
FROM {source} GROUP BY ROLLUP (collection_id)"""


@query("estimate", _ESTIMATE_SQL.format(source="assets"))
def estimate(spark, sf):
    return catalog.estimate(view(spark, sf, "assets"))


@query("dedup_items", "SELECT DISTINCT collection_id, item_id FROM cat_items_raw")
def dedup_items(spark, sf):
    return catalog.dedup_items(view(spark, sf, "cat_items_raw")).select("collection_id", "item_id")


@query("first_seen", """
SELECT collection_id, item_id, search_page, epoch_us(item_ts) AS item_us FROM (
  SELECT *, row_number() OVER (PARTITION BY collection_id, item_id ORDER BY search_page, item_ts, tx, ty) AS rn FROM cat_items_raw) t WHERE rn = 1""")
def first_seen(spark, sf):
    items = view(spark, sf, "cat_items_raw")
    kept = catalog.first_seen(items, ("search_page", "item_ts", "tx", "ty"))
    return kept.select("collection_id", "item_id", "search_page", F.unix_micros(F.col("item_ts").cast("timestamp")).alias("item_us"))


@query("preview", f"""
SELECT item_id, collection_id, CASE WHEN regexp_matches(item_id, {TILE_ID_SQL})
         THEN cast(cast(regexp_extract(item_id, {TILE_ID_SQL}, 2) AS int) AS varchar) || ',' || cast(cast(regexp_extract(item_id, {TILE_ID_SQL}, 3) AS int) AS varchar) ELSE '-' END AS tile,
       CASE WHEN size_bytes IS NULL THEN 'unknown' ELSE printf('%.1f MB', size_bytes / 1000.0::double / 1000) END AS size,
       strftime(item_ts, '%Y-%m-%dT%H:%M:%S+00:00') AS datetime,
       (SELECT count(*) FROM assets) AS total, greatest((SELECT count(*) FROM assets) - 200, 0) AS more
FROM assets ORDER BY collection_id, item_id LIMIT 200""")
def preview(spark, sf):
    return catalog.preview(view(spark, sf, "assets"))


@query("except_ids", """
SELECT item_id FROM assets WHERE collection_id = 'MDT-2m' EXCEPT SELECT replace(item_id, 'MDS', 'MDT') FROM assets WHERE collection_id = 'MDS-2m'""")
def except_ids(spark, sf):
    a = view(spark, sf, "assets")
    left = a.where("collection_id = 'MDT-2m'").select("item_id")
    right = a.where("collection_id = 'MDS-2m'").select(F.replace(F.col("item_id"), F.lit("MDS"), F.lit("MDT")).alias("item_id"))
    return catalog.except_ids(left, right)


@query("intersect_ids", """
SELECT item_id FROM assets WHERE collection_id = 'MDT-2m' INTERSECT SELECT replace(item_id, 'MDS', 'MDT') FROM assets WHERE collection_id = 'MDS-2m'""")
def intersect_ids(spark, sf):
    a = view(spark, sf, "assets")
    left = a.where("collection_id = 'MDT-2m'").select("item_id")
    right = a.where("collection_id = 'MDS-2m'").select(F.replace(F.col("item_id"), F.lit("MDS"), F.lit("MDT")).alias("item_id"))
    return catalog.intersect_ids(left, right)


@query("union_parts", """
SELECT collection_id, item_id FROM assets WHERE tx < 130 UNION ALL SELECT collection_id, item_id FROM assets WHERE ty > 200""")
def union_parts(spark, sf):
    a = view(spark, sf, "assets")
    return catalog.union_parts(a.where("tx < 130"), a.where("ty > 200")).select("collection_id", "item_id")


@query("colocate", f"""
SELECT tile_x, tile_y, string_agg(collection_id, ',' ORDER BY collection_id) AS collections, sum(n)::bigint AS asset_count
FROM (SELECT cast(regexp_extract(item_id, {TILE_ID_SQL}, 2) AS int) AS tile_x, cast(regexp_extract(item_id, {TILE_ID_SQL}, 3) AS int) AS tile_y,
             collection_id, count(*) AS n FROM assets WHERE regexp_matches(item_id, {TILE_ID_SQL}) GROUP BY 1, 2, 3) t GROUP BY 1, 2""")
def colocate(spark, sf):
    cells = catalog.colocate(view(spark, sf, "assets"))
    return cells.withColumn("collections", F.array_join("collections", ","))


# -- planning -------------------------------------------------------------------------------

_RECONCILE_SQL = """
SELECT a.collection_id, a.item_id, a.dest, m < 4 OR (m = 4 AND size_bytes IS NULL) AS is_complete,
       cast(CASE WHEN m = 5 THEN CASE WHEN size_bytes IS NULL THEN 777 ELSE floor(size_bytes / 2) END ELSE 0 END AS bigint) AS resume_offset,
       size_bytes FROM placed_assets a"""


def _reconciled(spark, sf, **options):
    return plan.reconcile(view(spark, sf, "assets"), view(spark, sf, "inventory"), **options)


@query("reconcile", f"SELECT collection_id, item_id, dest, is_complete, resume_offset FROM ({_RECONCILE_SQL}) r")
def reconcile(spark, sf):
    return _reconciled(spark, sf).select("collection_id", "item_id", "dest", "is_complete", "resume_offset")


@query("reconcile_existence", "SELECT collection_id, item_id, m < 5 AS is_complete FROM placed_assets")
def reconcile_existence(spark, sf):
    return _reconciled(spark, sf, mode="existence").select("collection_id", "item_id", "is_complete")


@query("plan_summary", f"""
SELECT count(*) FILTER (WHERE NOT is_complete) AS to_fetch, count(*) FILTER (WHERE is_complete) AS already_complete,
       sum(CASE WHEN NOT is_complete THEN size_bytes ELSE 0 END)::bigint AS remaining_known_bytes,
       sum(CASE WHEN is_complete THEN size_bytes ELSE 0 END)::bigint AS already_present_bytes,
       sum(size_bytes)::bigint AS total_known_bytes, count(*) FILTER (WHERE size_bytes IS NULL) AS unknown_size_count,
       sum(CASE WHEN NOT is_complete THEN size_bytes ELSE 0 END) > 5000000000 AS needs_confirmation FROM ({_RECONCILE_SQL}) r""")
def plan_summary(spark, sf):
    return plan.plan_summary(_reconciled(spark, sf))


@query("missing_from_batch", "SELECT collection_id, item_id, asset_key FROM placed_assets WHERE m = 7")
def missing_from_batch(spark, sf):
    placed = view(spark, sf, "placed_assets")
    missing = plan.missing_from_batch(placed, placed.where("m <> 7"))
    return missing.select("collection_id", "item_id", "asset_key")


_VOLUME_SQL = "SELECT n_name AS volume, n_nationkey * 40000000 AS free_bytes FROM nation WHERE n_nationkey <> 7"


@query("budget_check", f"""
SELECT r.volume, need_bytes, free_bytes, need_bytes + 1000000 AS required_bytes,
       coalesce(need_bytes <= 0 OR free_bytes >= need_bytes + 1000000, false) AS fits
FROM (SELECT 'NATION_' || (tx % 25) AS volume, coalesce(sum(size_bytes), 0)::bigint AS need_bytes FROM assets GROUP BY 1) r
LEFT JOIN ({_VOLUME_SQL}) v ON v.volume = r.volume""")
def budget_check(spark, sf):
    required = view(spark, sf, "assets").select(
        F.concat(F.lit("NATION_"), (F.col("tx") % 25).cast("string")).alias("volume"),
        F.coalesce("size_bytes", F.lit(0)).alias("need_bytes"),
    )
    volumes = table(spark, sf, "nation").where("n_nationkey <> 7").select(
        F.col("n_name").alias("volume"), (F.col("n_nationkey") * 40000000).cast("bigint").alias("free_bytes")
    )
    return plan.budget_check(required, volumes, 1_000_000)


@query("batch_assets", """
SELECT collection_id, batch_no, string_agg(item_id, ',' ORDER BY rn) AS item_ids, count(*)::int AS batch_size
FROM (SELECT collection_id, item_id, rn, cast(floor((rn - 1) / 8) AS bigint) AS batch_no FROM (
  SELECT *, row_number() OVER (PARTITION BY collection_id ORDER BY item_id, asset_key) AS rn FROM assets) a) b GROUP BY 1, 2""")
def batch_assets(spark, sf):
    batches = plan.batch_assets(view(spark, sf, "assets"))
    return batches.withColumn("item_ids", F.array_join("item_ids", ","))


@query("outcome_summary", """
SELECT status, count(*) AS n, sum(bytes_transferred)::bigint AS bytes FROM outcomes GROUP BY status""")
def outcome_summary(spark, sf):
    return plan.outcome_summary(view(spark, sf, "outcomes"))


@query("outcome_failures", "SELECT collection_id, item_id, run_id FROM outcomes WHERE status = 'failed'")
def outcome_failures(spark, sf):
    outcomes = view(spark, sf, "outcomes").withColumn("error", F.col("run_id").cast("string"))
    return plan.failures(outcomes).select("collection_id", "item_id", F.col("error").cast("int").alias("run_id"))


@query("latest_outcome", """
SELECT collection_id, item_id, run_id, status FROM (SELECT *, row_number() OVER (
  PARTITION BY collection_id, item_id, asset_key ORDER BY finished_at DESC, run_id DESC) AS rn FROM outcomes) t WHERE rn = 1""")
def latest_outcome(spark, sf):
    return plan.latest_outcome(view(spark, sf, "outcomes")).select("collection_id", "item_id", "run_id", "status")


@query("attempt_budget", """
SELECT attempt_id, row_number() OVER (PARTITION BY collection_id, item_id, asset_key, kind ORDER BY ts, attempt_id) AS attempt_no,
       row_number() OVER (PARTITION BY collection_id, item_id, asset_key, kind ORDER BY ts, attempt_id) >
         CASE kind WHEN 'transfer' THEN 6 ELSE 2 END AS over_budget
FROM (SELECT 'c' AS collection_id, cast(client_id AS varchar) AS item_id, 'data' AS asset_key, ts, req_id AS attempt_id,
             CASE status WHEN 200 THEN 'transfer' WHEN 302 THEN 'reauth' ELSE 'mint' END AS kind FROM request_log) a""")
def attempt_budget(spark, sf):
    attempts = view(spark, sf, "request_log").select(
        F.lit("c").alias("collection_id"), F.col("client_id").cast("string").alias("item_id"),
        F.lit("data").alias("asset_key"), "ts", F.col("req_id").alias("attempt_id"),
        F.when(F.col("status") == 200, "transfer").when(F.col("status") == 302, "reauth").otherwise("mint").alias("kind"),
    )
    return plan.attempt_budget(attempts).select("attempt_id", "attempt_no", "over_budget")


@query("convert_summary", """
SELECT count(*) FILTER (WHERE m < 8 AND m >= 4) AS processed, count(*) FILTER (WHERE m < 4) AS skipped, count(*) FILTER (WHERE m >= 8) AS failed,
       sum(CASE WHEN m < 8 AND m >= 4 THEN coalesce(size_bytes, 0) ELSE 0 END)::bigint AS input_bytes,
       sum(CASE WHEN m < 8 AND m >= 4 THEN 1000 ELSE 0 END)::bigint AS output_bytes FROM placed_assets""")
def convert_summary(spark, sf):
    results = view(spark, sf, "placed_assets").select(
        (F.col("m") < 8).alias("ok"), (F.col("m") < 4).alias("skipped"),
        F.col("size_bytes").alias("input_bytes"), F.lit(1000).cast("bigint").alias("output_bytes"),
    )
    return plan.convert_summary(results)
