"""Plain tables: inventories, raster headers and request logs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.schemas import RASTER_HEADERS, REQUEST_LOG


def read_inventory(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Files under ``root`` with their size; contents are never read.

    ``path`` is relative to the root, as destinations are.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(root).select("path", "length", "modificationTime")
    # Listed paths carry a scheme (file:/a/b); the root may or may not.
    strip = r"^[A-Za-z][A-Za-z0-9+.-]*:/*(?=/)"
    plain = re.sub(strip, "", root.rstrip("/"))
    return files.select(
        F.substring(F.regexp_replace("path", strip, ""), len(plain) + 2, 1 << 30).alias("path"),
        "length", F.col("modificationTime").alias("modification_time"),
    )


def split_inventory(inventory: DataFrame) -> DataFrame:
    """Mark partial files and give the destination they belong to."""
    part = F.col("path").endswith(".part")
    return inventory.select(
        "*", part.alias("is_part"), F.regexp_replace("path", r"\.part$", "").alias("dest")
    )


def glob_filter(df: DataFrame, pattern: str, column: str = "path") -> DataFrame:
    """Rows whose file name matches a glob with ``*``, ``?`` and ``[…]``."""
    return df.where(F.element_at(F.split(column, "/"), -1).rlike(_glob_regex(pattern)))


def _glob_regex(pattern: str) -> str:
    pieces = re.findall(r"\*|\?|\[[^\]]+\]|[^*?\[]|\[", pattern)
    plain = {"*": "[^/]*", "?": "[^/]"}

    def piece(text: str) -> str:
        if len(text) > 2 and text.startswith("["):
            return "[^" + text[2:] if text[1] == "!" else text
        return plain.get(text) or re.escape(text)

    return "^" + "".join(map(piece, pieces)) + "$"


def read_raster_headers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Header table of a tile set (files themselves are decoded elsewhere)."""
    return spark.read.schema(RASTER_HEADERS).format(fmt).load(path)


def read_request_log(
    spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.schema(REQUEST_LOG).parquet(path)
