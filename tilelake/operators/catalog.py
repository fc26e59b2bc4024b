"""Catalog operators: filters, identities, estimates and listings over items and collections."""

from __future__ import annotations

import calendar
import re
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilelake.functions.assets import asset_size, select_data_asset, true_bbox
from tilelake.functions.keys import decode_tile_key
from tilelake.functions.text import human_size

ITEM_IDENTITY = ("collection_id", "item_id")
ASSET_IDENTITY = ("collection_id", "item_id", "asset_key")

# Estimates above this many bytes are flagged; rows shown in a preview.
LARGE_ESTIMATE_BYTES = 50_000_000_000
PREVIEW_ROWS = 200


# -- collections ----------------------------------------------------------------------------


def downloadable(collections: DataFrame) -> DataFrame:
    return collections.where(F.array_contains("visibility", "show")).orderBy("id")


def list_collections(
    collections: DataFrame, show_all: bool = False, as_json: bool = False
) -> DataFrame:
    """Collections sorted by id; hidden ones only on request; as rows or as JSON text."""
    chosen = collections.orderBy("id") if show_all else downloadable(collections)
    return chosen.select(F.to_json(F.struct("*")).alias("json")) if as_json else chosen


def collection(collections: DataFrame, collection_id: str) -> DataFrame:
    return collections.where(F.col("id") == collection_id)


def unknown_collections(requested: DataFrame, known: DataFrame) -> DataFrame:
    """Requested ids the catalog lacks, each with the sorted list of valid ids.

    The list holds the ids of the catalog's collections (tens), not of its items.
    """
    wanted = requested.select("collection_id").distinct()
    valid = known.agg(F.array_sort(F.collect_set("id"))).scalar()
    missing = wanted.join(known.select(F.col("id").alias("collection_id")), "collection_id", "left_anti")
    return missing.select("collection_id", valid.alias("valid_ids"))


def license_of(assets: DataFrame, collections: DataFrame) -> DataFrame:
    """The license of each collection involved, exactly as declared."""
    involved = assets.select("collection_id").distinct()
    return involved.join(
        collections.select(F.col("id").alias("collection_id"), "license"), "collection_id"
    )


# -- filters --------------------------------------------------------------------------------


def filter_collections(items: DataFrame, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Items of an explicit list of collections, given as values or as a table."""
    if isinstance(ids, DataFrame):
        return items.join(ids.select("collection_id"), "collection_id", "left_semi")
    if not ids:
        raise ValueError("at least one collection id is required")
    return items.where(F.col("collection_id").isin(*ids))


def filter_by_id(items: DataFrame, collection_id: str, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Named items of one collection."""
    inside = items.where(F.col("collection_id") == collection_id)
    if isinstance(ids, DataFrame):
        return inside.join(ids.select("item_id"), "item_id", "left_semi")
    if not ids:
        raise ValueError("at least one item id is required")
    return inside.where(F.col("item_id").isin(*ids))


_PARTIAL = re.compile(r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?$")


def _instant(text: str, end: bool) -> datetime:
    """An RFC 3339 instant, or the first/last second of a year, month or day."""
    partial = _PARTIAL.match(text)
    if not partial:
        at = datetime.fromisoformat(text.replace("Z", "+00:00"))
        return at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)
    year, month, day = (int(g) if g else None for g in partial.groups())
    if not end:
        return datetime(year, month or 1, day or 1, tzinfo=timezone.utc)
    month = month or 12
    day = day or calendar.monthrange(year, month)[1]
    return datetime(year, month, day, tzinfo=timezone.utc) + timedelta(days=1, seconds=-1)


def datetime_bounds(expression: str) -> tuple[datetime | None, datetime | None]:
    """Inclusive bounds of ``instant`` or ``start/end`` with ``..`` for an open end."""
    start, slash, end = expression.partition("/")
    if not slash:
        return _instant(start, end=False), _instant(
            start, end=bool(_PARTIAL.match(start))
        )
    open_end = lambda t: t.strip() in ("", "..")
    low = None if open_end(start) else _instant(start, end=False)
    high = None if open_end(end) else _instant(end, end=True)
    if low is None and high is None:
        raise ValueError("a datetime interval needs at least one end")
    if low and high and low > high:
        raise ValueError(f"datetime interval {expression!r} ends before it starts")
    return low, high


def filter_datetime(items: DataFrame, expression: str, column: str = "item_ts") -> DataFrame:
    """Items whose time lies in the interval. The bounds are literals of the column's own type,
    so the comparison reaches the Parquet scan."""
    ntz = dict(items.dtypes)[column] == "timestamp_ntz"

    def literal(at: datetime) -> Column:
        text = at.replace(tzinfo=None).isoformat(sep=" ")
        return F.expr(f"TIMESTAMP_NTZ'{text}'" if ntz else f"TIMESTAMP'{text}Z'")

    low, high = datetime_bounds(expression)
    if low is not None:
        items = items.where(F.col(column) >= literal(low))
    if high is not None:
        items = items.where(F.col(column) <= literal(high))
    return items


# -- items and assets -----------------------------------------------------------------------


def sanitize_bbox(items: DataFrame) -> DataFrame:
    """Replace every declared box by the bounds of the geometry; the declared one is kept as
    ``raw_bbox``."""
    return items.withColumn("raw_bbox", F.col("bbox")).withColumn("bbox", true_bbox(F.col("rings")))


def dedup_items(items: DataFrame) -> DataFrame:
    """One row per (collection, item)."""
    return items.dropDuplicates(list(ITEM_IDENTITY))


def first_seen(items: DataFrame, order: Sequence[str] = ("chunk", "page", "pos")) -> DataFrame:
    """The first occurrence of each item in search order.

    The rank filter lets Spark keep one row per item on the map side already, so an item with
    very many copies does not gather in one task.
    """
    w = Window.partitionBy(*ITEM_IDENTITY).orderBy(*order)
    ranked = items.withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def to_assets(items: DataFrame) -> DataFrame:
    """The asset to fetch of every item; items without one are dropped."""
    chosen = select_data_asset(F.col("assets"))
    return (
        items.withColumn("_asset", chosen)
        .where(F.col("_asset").isNotNull())
        .select(
            "collection_id", "item_id",
            F.col("_asset.asset_key").alias("asset_key"),
            F.col("_asset.media_type").alias("media_type"),
            asset_size(F.col("properties")).alias("size_bytes"),
            decode_tile_key(F.col("item_id")).alias("tile_key"),
            "item_ts", "rings",
        )
    )


def estimate(assets: DataFrame) -> DataFrame:
    """Items, known bytes and unknown sizes per collection, and in total (NULL collection).

    Rows are aggregated per collection first and the rollup runs over that small result, so
    the data is not expanded once per grouping set.
    """
    per_collection = assets.groupBy("collection_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("known"),
        F.count_if(F.col("size_bytes").isNull()).alias("unknown"),
    )
    return (
        per_collection.rollup("collection_id")
        .agg(
            F.sum("n").alias("item_count"),
            F.sum("known").alias("known_bytes"),
            F.sum("unknown").alias("unknown_size_count"),
            F.grouping_id().cast("int").alias("is_total"),
        )
        .withColumn("is_large", F.col("known_bytes") > LARGE_ESTIMATE_BYTES)
    )


def preview(items: DataFrame, limit: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows for display, with the total and how many more there are."""
    total = items.agg(F.count(F.lit(1))).scalar()
    key = decode_tile_key(F.col("item_id"))
    tile = F.concat_ws(",", key["tile_x"].cast("string"), key["tile_y"].cast("string"))
    shown = items.orderBy(*ITEM_IDENTITY).limit(limit)
    return shown.select(
        "item_id",
        F.coalesce("collection_id", F.lit("-")).alias("collection_id"),
        F.when(key.isNull(), F.lit("-")).otherwise(tile).alias("tile"),
        human_size(F.col("size_bytes")).alias("size"),
        F.coalesce(
            F.date_format("item_ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit("-")
        ).alias("datetime"),
        total.alias("total"),
        F.greatest(total - limit, F.lit(0)).cast("bigint").alias("more"),
    )


# -- sets of ids ----------------------------------------------------------------------------


def except_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def intersect_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def union_parts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All parts of several areas in one table."""
    for other in others:
        first = first.unionByName(other)
    return first


def colocate(assets: DataFrame) -> DataFrame:
    """Physical tiles and the collections that hold them.

    Collections are made distinct per tile before they are gathered, so the list is bounded by
    the catalog's collections however many assets a tile has.
    """
    key = decode_tile_key(F.col("item_id"))
    cells = assets.select(
        key["tile_x"].alias("tile_x"), key["tile_y"].alias("tile_y"), "collection_id"
    ).where(F.col("tile_x").isNotNull())
    per_collection = cells.groupBy("tile_x", "tile_y", "collection_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_collection.groupBy("tile_x", "tile_y").agg(
        F.array_sort(F.collect_list("collection_id")).alias("collections"),
        F.sum("n").alias("asset_count"),
    )
