"""Writers: features, manifests, failures, pyramids and regions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilelake.functions.rings import ring_bounds
from tilelake.operators.catalog import ITEM_IDENTITY
from tilelake.operators.plan import convert_summary
from tilelake.schemas import MANIFEST_FIELDS


def _geometry(items: DataFrame) -> Column:
    """The geometry as a variant. Items that carry ``geometry_type`` and ``part_rings``, as read
    features do, keep their type and parts; all others are one polygon."""
    pair = lambda p: F.array(p["x"], p["y"])
    polygon = lambda rings: F.transform(rings, lambda r: F.transform(r, pair))
    shape = lambda kind, coordinates: F.to_variant_object(
        F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))
    rings = F.col("rings")
    single = shape("Polygon", polygon(rings))
    if not {"geometry_type", "part_rings"} <= set(items.columns):
        return F.when(rings.isNotNull(), single)
    sizes = F.col("part_rings")
    first = lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(1), lambda n, m: n + m)
    parts = F.transform(sizes, lambda n, i: polygon(F.slice(rings, first(i), n)))
    return (
        F.when(rings.isNull(), F.lit(None))
        .when(F.col("geometry_type") == "MultiPolygon", shape("MultiPolygon", parts))
        .when(F.col("geometry_type") == "Point", shape("Point", pair(rings[0][0])))
        .otherwise(single)
    )


def features(items: DataFrame) -> DataFrame:
    """Items as feature text. Properties stay as they are; the box is that of the geometry."""
    b = ring_bounds(F.col("rings"))
    optional = [F.col(c) for c in ("assets", "properties") if c in items.columns]
    feature = F.struct(
        F.lit("Feature").alias("type"), F.col("item_id").alias("id"),
        F.col("collection_id").alias("collection"),
        F.array(b["minx"], b["miny"], b["maxx"], b["maxy"]).alias("bbox"),
        _geometry(items).alias("geometry"),
        *optional,
    )
    return items.select(*ITEM_IDENTITY, F.to_json(feature).alias("value"))


def write_feature_json(items: DataFrame, path: str, fmt: str = "lines") -> None:
    """``lines``: one feature per line, written in parallel. ``collection``: part files that
    form one FeatureCollection when read in name order, so no task holds the whole document.

    Items must be unique by identity for the ``collection`` form.
    """
    rows = features(items)
    if fmt == "lines":
        rows.select("value").write.text(path)
        return
    if fmt != "collection":
        raise ValueError(f"unknown format {fmt!r}")
    first = items.agg(F.min(F.struct(*ITEM_IDENTITY))).scalar()
    comma = F.when(F.struct(*ITEM_IDENTITY) == first, "").otherwise(",")
    body = rows.select(F.lit(1).alias("rank"), *ITEM_IDENTITY, F.concat(comma, "value").alias("value"))
    frame = items.sparkSession.createDataFrame(
        [(0, '{"type": "FeatureCollection", "features": ['), (2, "]}")], "rank int, value string"
    ).select("rank", *[F.lit("").alias(c) for c in ITEM_IDENTITY], "value")
    body.unionByName(frame).orderBy("rank", *ITEM_IDENTITY).select("value").write.text(path)


def manifest(outcomes: DataFrame) -> DataFrame:
    """Exactly the allowed fields: never a link, a query string or a cookie."""
    return outcomes.select(*MANIFEST_FIELDS)


def write_manifest(outcomes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    manifest(outcomes).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_failures(results: DataFrame, csv_path: str, summary_path: str) -> None:
    """Failed rows are appended; the summary is replaced."""
    failed = results.where(~F.col("ok")).select("source_path", "error", "timestamp")
    failed.write.mode("append").option("header", "true").csv(csv_path)
    convert_summary(results).write.mode("overwrite").json(summary_path)


def write_pyramid(levels: DataFrame, path: str, block: int = 512) -> None:
    """All levels, one folder per factor, rows clustered by block so windows prune files."""
    at = lambda c: F.floor(F.col(c) / block).cast("bigint")
    keyed = levels.withColumn("bx", at("ox")).withColumn("by", at("oy"))
    (
        keyed.repartitionByRange("factor", "by", "bx", "oy", "ox")
        .sortWithinPartitions("factor", "by", "bx", "oy", "ox")
        .write.partitionBy("factor").parquet(path)
    )


def write_regions(
    cells: DataFrame, path: str, options: Mapping[str, str] | None = None
) -> None:
    """One folder per region. Ranges over region and position let a large region use several
    files and tasks."""
    (
        cells.repartitionByRange("region_row", "region_col", "py", "px")
        .sortWithinPartitions("region_row", "region_col", "py", "px")
        .write.options(**(options or {})).partitionBy("region_col", "region_row").parquet(path)
    )
