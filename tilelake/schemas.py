"""Explicit schemas of every table the operators read or write. Nothing is inferred."""

from __future__ import annotations

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
RINGS = f"array<{RING}>"
BOX = "struct<minx:double,miny:double,maxx:double,maxy:double>"
TILE_KEY = "struct<prefix:string,tile_x:int,tile_y:int,lot:int,year:int>"

AOI = f"aoi_id string, part_id int, rings {RINGS}"

ASSET_ENTRY = "struct<href:string,type:string,roles:array<string>>"

COLLECTION = (
    "id string, title string, description string, license string, "
    "summaries struct<visibility:array<string>>, "
    "extent struct<spatial:struct<bbox:array<array<double>>>,"
    "temporal:struct<interval:array<array<string>>>>"
)

# Envelopes: the list form nests collections under data, the detail form *is* data.
ENVELOPE = (
    "status int, message string, "
    f"data struct<collections:array<struct<{COLLECTION.replace(' string', ':string').replace('summaries ', 'summaries:').replace('extent ', 'extent:')}>>>"
)

REQUEST_LOG = (
    "req_id bigint, ts timestamp, client_id bigint, status int, "
    "retry_after string, location string, nbytes bigint"
)

RASTER_HEADERS = (
    "path string, width int, height int, minx double, miny double, maxx double, maxy double, "
    "pixel_size_x double, pixel_size_y double, crs string, dtype string, band_count int, "
    "rotated boolean, nodata double"
)

INVENTORY = "path string, length bigint, modification_time timestamp"

MANIFEST_FIELDS = (
    "item_id", "collection_id", "asset_key", "media_type", "declared_size_bytes",
    "dest", "storage_filename", "status", "bytes_transferred", "error",
)

MANIFEST = (
    "item_id string, collection_id string, asset_key string, media_type string, "
    "declared_size_bytes bigint, dest string, storage_filename string, status string, "
    "bytes_transferred bigint, error string"
)

FAILURES = "source_path string, error string, timestamp string"

# Fixed values of the outcome status, in display order.
STATUSES = ("downloaded", "resumed", "skipped", "failed")
