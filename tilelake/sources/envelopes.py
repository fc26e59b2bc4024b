"""Collections and item pages from recorded catalog responses (JSON)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.functions.let import bind
from tilelake.schemas import ASSET_ENTRY

_EXTENT = (
    "struct<spatial:struct<bbox:array<array<double>>>,"
    "temporal:struct<interval:array<array<string>>>>"
)
_COLLECTION = (
    "struct<id:string,title:string,description:string,license:string,"
    f"summaries:struct<visibility:array<string>>,extent:{_EXTENT}>"
)
# `data` stays text: it is a list wrapper in one response and a collection in the other.
_ENVELOPE = "status string, message string, data string, _corrupt string"
_FEATURE = (
    "struct<id:string,collection:string,bbox:array<double>,"
    "geometry:struct<type:string,coordinates:string>,"
    f"assets:map<string,{ASSET_ENTRY}>,properties:variant>"
)
_PAGE = f"type string, features array<{_FEATURE}>, _corrupt string"
_LENIENT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def read_text(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    """Documents as text with their file: one per file, or one per line."""
    raw = spark.read.text(paths, wholetext=not lines)
    return raw.select("value", F.input_file_name().alias("source"))


def _timestamps(interval: Column) -> Column:
    at = lambda i: F.try_to_timestamp(F.try_element_at(interval, F.lit(i)))
    return F.struct(at(1).alias("start"), at(2).alias("end"))


def parse_collections(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(collections, violations)`` from envelope documents (``value``, ``source``).

    An envelope must be an object with ``data`` and an inner status of 200; ``data`` holds a
    list of collections, or is itself one.
    """
    opened = documents.select("source", "value", F.from_json("value", _ENVELOPE, _LENIENT).alias("e"))
    listed = F.from_json("e.data", "struct<collections:string>")["collections"]
    many = F.from_json(listed, f"array<{_COLLECTION}>")
    single = F.from_json("e.data", _COLLECTION)
    problem = (
        F.when(F.col("e").isNull() | F.col("e._corrupt").isNotNull(), "not JSON")
        .when(F.col("e.data").isNull(), "no data")
        .when(F.coalesce(F.col("e.status"), F.lit("")) != "200", "status is not 200")
        .when(listed.isNotNull() & ~F.trim(listed).startswith("["), "collections is not a list")
        .when(listed.isNull() & single["id"].isNull(), "no collections")
    )
    judged = opened.withColumn("problem", problem)
    rows = judged.where(F.col("problem").isNull()).select(
        F.explode(F.when(listed.isNotNull(), many).otherwise(F.array(single))).alias("c")
    )
    collections = rows.select(
        F.col("c.id").alias("id"), F.col("c.title").alias("title"),
        F.col("c.description").alias("description"),
        F.coalesce("c.license", F.lit("")).alias("license"),
        F.coalesce("c.summaries.visibility", F.array().cast("array<string>")).alias("visibility"),
        F.struct(
            F.coalesce(
                "c.extent.spatial.bbox", F.array().cast("array<array<double>>")
            ).alias("spatial"),
            F.transform(
                F.coalesce(
                    "c.extent.temporal.interval", F.array().cast("array<array<string>>")
                ), _timestamps,
            ).alias("temporal"),
        ).alias("extent"),
    )
    violations = judged.where(F.col("problem").isNotNull()).select("source", "problem", "value")
    return collections, violations


def read_collections(
    spark: SparkSession, paths: str | list[str], lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    return parse_collections(read_text(spark, paths, lines))



def geometry_parts(geometry: Column) -> Column:
    """Polygons of a geometry as an array of ring lists; NULL for other geometry types.

    A point becomes a ring that stays in place, so bounds and intersection still hold.
    """
    text = geometry["coordinates"]
    xy = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    rings = lambda rs: F.transform(rs, lambda r: F.transform(r, xy))
    polygon = F.from_json(text, "array<array<array<double>>>")
    multi = F.from_json(text, "array<array<array<array<double>>>>")
    spot = F.from_json(text, "array<double>")
    return (
        F.when(geometry["type"] == "Polygon", F.array(rings(polygon)))
        .when(geometry["type"] == "MultiPolygon", F.transform(multi, rings))
        .when(
            geometry["type"] == "Point",
            F.array(F.array(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda _: xy(spot)))),
        )
    )


def _item_columns(f: str) -> list[Column]:
    """Item columns of a parsed feature. ``rings`` holds the rings of all polygons of the
    geometry, ``part_rings`` how many each polygon has, ``bbox`` what the item declared."""
    parts = geometry_parts(F.col(f"{f}.geometry"))
    return [
        F.col(f"{f}.id").alias("item_id"), F.col(f"{f}.collection").alias("collection_id"),
        F.flatten(parts).alias("rings"), F.transform(parts, F.size).alias("part_rings"),
        F.col(f"{f}.geometry.type").alias("geometry_type"),
        F.col(f"{f}.bbox").alias("bbox"), F.col(f"{f}.assets").alias("assets"),
        F.col(f"{f}.properties").alias("properties"),
        F.try_to_timestamp(
            F.try_variant_get(f"{f}.properties", "$.datetime", "string")
        ).alias("item_ts"),
    ]


def parse_features(features: DataFrame, column: str = "feature") -> DataFrame:
    """Item rows from feature text; every other column is kept."""
    kept = [c for c in features.columns if c != column]
    parsed = features.select(*kept, F.from_json(column, _FEATURE).alias("_f"))
    return parsed.select(*kept, *_item_columns("_f"))


def parse_item_pages(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(items, violations)`` from search pages: one row per feature with its position.

    A page is parsed once: conditions on the parsed page would each become a filter that parses it
    again, and so would an inner explode, for which Spark infers filters on what it explodes.
    """
    good = bind(F.from_json("value", _PAGE, _LENIENT), lambda p: F.when(p["_corrupt"].isNull(), p["features"]))
    features = documents.select("source", F.posexplode_outer(good).alias("pos", "_f")).where("pos IS NOT NULL")
    violations = documents.where(good.isNull()).select("source", F.lit("not a page").alias("problem"), "value")
    return features.select("source", "pos", *_item_columns("_f")), violations


def read_item_pages(
    spark: SparkSession, paths: str | list[str], lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    return parse_item_pages(read_text(spark, paths, lines))
