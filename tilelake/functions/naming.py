"""Deterministic, path-safe destinations for assets."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media types and their file extensions. The first two also match by
# "prefix/"; the rest are exact names from the public IANA media type registry.
LASZIP = "application/vnd.laszip"
TIFF = "image/tiff"
MEDIA_EXTENSIONS = {
    LASZIP: ".laz",
    TIFF: ".tif",
    "application/json": ".json",
    "application/geo+json": ".geojson",
    "application/pdf": ".pdf",
    "application/xml": ".xml",
    "application/zip": ".zip",
    "image/jpeg": ".jpg",
    "image/png": ".png",
    "text/csv": ".csv",
    "text/html": ".html",
    "text/plain": ".txt",
}
DEFAULT_EXTENSION = ".bin"
UNTILED = "untiled"


def asset_extension(media_type: Column, extra: Mapping[str, str] | None = None) -> Column:
    """Extension for a media type with its ``;`` parameters ignored."""
    base = F.lower(F.trim(F.split_part(media_type, F.lit(";"), F.lit(1))))
    table = {**MEDIA_EXTENSIONS, **(extra or {})}
    pairs = [F.lit(text) for pair in table.items() for text in pair]
    return F.coalesce(
        F.when(base.startswith(LASZIP + "/"), F.lit(table[LASZIP])),
        F.when(base.startswith(TIFF + "/"), F.lit(table[TIFF])),
        F.try_element_at(F.create_map(*pairs), base),
        F.lit(DEFAULT_EXTENSION),
    )


def safe_component(value: Column) -> Column:
    """A single path component: no separators, no NUL, no leading dots, never empty."""
    trimmed = F.regexp_replace(value, r"^\s+|\s+$", "")
    flat = F.regexp_replace(trimmed, r"[/\\\x00]", "_")
    return F.coalesce(F.nullif(F.regexp_replace(flat, r"^\.+", ""), F.lit("")), F.lit("_"))


def storage_filename(item_id: Column, media_type: Column) -> Column:
    return F.concat(safe_component(item_id), asset_extension(media_type))


def _by_collection() -> Column:
    return F.concat_ws(
        "/", safe_component(F.col("collection_id")),
        storage_filename(F.col("item_id"), F.col("media_type")),
    )


def _by_tile() -> Column:
    from tilelake.functions.keys import decode_tile_key

    key = decode_tile_key(F.col("item_id"))
    folder = F.concat(
        F.lpad(key["tile_x"].cast("string"), 3, "0"), F.lpad(key["tile_y"].cast("string"), 3, "0")
    )
    return F.concat_ws(
        "/", F.coalesce(folder, F.lit(UNTILED)),
        storage_filename(F.col("item_id"), F.col("media_type")),
    )


def _flat() -> Column:
    return storage_filename(F.col("item_id"), F.col("media_type"))


LAYOUTS: dict[str, Callable[[], Column]] = {
    "by_collection": _by_collection,
    "by_tile": _by_tile,
    "flat": _flat,
}


def register_layout(name: str, build: Callable[[], Column]) -> None:
    """Add a layout: ``build`` returns a deterministic Column over the asset columns."""
    if name in LAYOUTS:
        raise ValueError(f"layout {name!r} exists already")
    LAYOUTS[name] = build


def layout_path(layout: str = "by_collection") -> Column:
    """Destination under the output root, from the asset columns alone."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}; known: {', '.join(sorted(LAYOUTS))}")
    return LAYOUTS[layout]()
