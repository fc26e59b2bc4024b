"""Areas of interest from GeoJSON, WKT and bounding boxes, always stored in lon/lat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.functions.projections import rings_to_lonlat
from tilelake.functions.rings import rectangle, wkt_polygons
from tilelake.sources.envelopes import geometry_parts, read_text

_GEOMETRY = "struct<type:string,coordinates:string>"
_COLLECTED = (
    "struct<type:string,coordinates:string,"
    "geometries:array<struct<type:string,coordinates:string>>>"
)
_DOCUMENT = (
    "type string, coordinates string, geometries array<struct<type:string,coordinates:string>>, "
    f"geometry {_COLLECTED}, features array<struct<geometry:{_COLLECTED}>>, "
    "crs struct<properties:struct<name:string>>, _corrupt string"
)
_KNOWN_CRS = ("EPSG:4326", "EPSG:3763", "EPSG:6933")


def _crs_code(name: Column) -> Column:
    """``EPSG:n`` from any spelling that ends in it; CRS84 is lon/lat."""
    code = F.regexp_extract(name, r"(?i)EPSG:+(?:[\d.]*:)?(\d+)\s*$", 1)
    return F.when(name.rlike(r"(?i)CRS:?84\s*$"), F.lit("EPSG:4326")).when(
        code != "", F.concat(F.lit("EPSG:"), code)
    )


def _flatten_geometry(g: Column) -> Column:
    """A geometry as an array of plain geometries."""
    plain = F.struct(g["type"].alias("type"), g["coordinates"].alias("coordinates"))
    return F.when(
        g["type"] == "GeometryCollection",
        F.coalesce(g["geometries"], F.array().cast(f"array<{_GEOMETRY}>")),
    ).otherwise(F.array(plain))


def _split(judged: DataFrame, parts: str) -> tuple[DataFrame, DataFrame]:
    ok = judged.where(F.col("problem").isNull()).select(
        "aoi_id", F.posexplode_outer(parts).alias("part_id", "rings")
    )
    return ok, judged.where(F.col("problem").isNotNull()).select("aoi_id", "problem")


def parse_geojson_aoi(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(aoi, violations)`` from GeoJSON text (``value``, ``source``); the source names the
    area. All features of a document are parts of one area; a legacy ``crs`` member is obeyed.
    """
    doc = F.from_json("value", _DOCUMENT, {"columnNameOfCorruptRecord": "_corrupt"})
    opened = documents.select(F.col("source").alias("aoi_id"), doc.alias("d"))
    null_list = F.array().cast(f"array<{_GEOMETRY}>")
    features = F.flatten(F.transform(
        F.filter(
            F.coalesce("d.features", F.array().cast(f"array<struct<geometry:{_COLLECTED}>>")),
            lambda f: f["geometry"].isNotNull(),
        ),
        lambda f: _flatten_geometry(f["geometry"]),
    ))
    single = F.when(F.col("d.geometry").isNotNull(), _flatten_geometry(F.col("d.geometry")))
    bare = _flatten_geometry(F.struct(
        F.col("d.type").alias("type"), F.col("d.coordinates").alias("coordinates"),
        F.col("d.geometries").alias("geometries"),
    ))
    geometries = (
        F.when(F.col("d.type") == "FeatureCollection", features)
        .when(F.col("d.type") == "Feature", F.coalesce(single, null_list))
        .otherwise(bare)
    )
    name = F.col("d.crs.properties.name")
    crs = F.when(F.col("d.crs").isNull(), F.lit("EPSG:4326")).otherwise(_crs_code(name))
    shaped = opened.select("aoi_id", "d", geometries.alias("g"), crs.alias("crs")).withColumn(
        "parts", F.flatten(F.transform("g", geometry_parts))
    )
    judged = shaped.select(
        "aoi_id",
        F.transform("parts", lambda rs: rings_to_lonlat(rs, F.col("crs"))).alias("parts"),
        F.when(F.col("d").isNull() | F.col("d._corrupt").isNotNull(), "not JSON")
        .when(F.col("d.type").isNull(), "no type")
        .when(F.size("g") == 0, "no geometries")
        .when(F.col("parts").isNull(), "unsupported geometry")
        .when(~F.coalesce(F.col("crs").isin(*_KNOWN_CRS), F.lit(False)), "unknown crs")
        .alias("problem"),
    )
    return _split(judged, "parts")


def read_geojson_aoi(
    spark: SparkSession, paths: str | list[str], lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    documents = read_text(spark, paths, lines)
    if lines:  # several areas per file: tell them apart
        documents = documents.withColumn(
            "source", F.concat_ws("#", "source", F.xxhash64("value").cast("string"))
        )
    return parse_geojson_aoi(documents)


def aoi_from_wkt(
    df: DataFrame, column: str = "wkt", crs: str = "EPSG:4326", key: str = "aoi_id"
) -> tuple[DataFrame, DataFrame]:
    """``(aoi, violations)`` from POLYGON or MULTIPOLYGON text in the given CRS."""
    if crs not in _KNOWN_CRS:
        raise ValueError(f"unknown CRS {crs!r}; known: {', '.join(_KNOWN_CRS)}")
    judged = df.select(
        F.col(key).alias("aoi_id"),
        F.transform(
            wkt_polygons(F.col(column)), lambda rs: rings_to_lonlat(rs, F.lit(crs))
        ).alias("parts"),
    ).withColumn("problem", F.when(F.col("parts").isNull(), "not a polygon text"))
    return _split(judged, "parts")


def parse_bbox(text: Column) -> Column:
    """``W,S,E,N`` text as a box of doubles; NULL unless it is four numbers in order."""
    parts = F.split(text, ",")
    number = lambda i: F.trim(F.try_element_at(parts, F.lit(i))).try_cast("double")
    west, south, east, north = (number(i) for i in range(1, 5))
    valid = (F.size(parts) == 4) & (west < east) & (south < north)
    return F.when(
        valid,
        F.struct(
            west.alias("minx"), south.alias("miny"), east.alias("maxx"), north.alias("maxy")
        ),
    )


def aoi_from_bbox(df: DataFrame, column: str = "bbox", key: str = "aoi_id") -> tuple[DataFrame, DataFrame]:
    """``(aoi, violations)`` from ``W,S,E,N`` text."""
    b = F.col("_b")
    judged = df.select(F.col(key).alias("aoi_id"), parse_bbox(F.col(column)).alias("_b")).select(
        "aoi_id",
        F.array(rectangle(b["minx"], b["miny"], b["maxx"], b["maxy"])).alias("parts"),
        F.when(b.isNull(), "not W,S,E,N with W<E and S<N").alias("problem"),
    )
    return _split(judged, "parts")
