"""Reading catalog items: data asset, size and the untrustworthy bounding box."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tilelake.functions.keys import TILE_SIZE_M, TILE_X_ORIGIN, TILE_Y_ORIGIN
from tilelake.functions.rings import ring_bounds

# Asset roles in order of preference.
DATA_ROLES = ("data", "visual")


def select_data_asset(assets: Column) -> Column:
    """``(asset_key, href, media_type)`` of the asset to fetch, by role; NULL without one.

    ``assets`` is an array of ``(key, value)`` entries in the order of the source document, or
    a map (whose entry order Spark keeps).
    """
    entries = F.map_entries(assets)
    first = lambda role: F.try_element_at(
        F.filter(
            entries,
            lambda e: F.array_contains(F.coalesce(e["value"]["roles"], F.array()), F.lit(role)),
        ),
        F.lit(1),
    )
    chosen = F.coalesce(*[first(role) for role in DATA_ROLES])
    return F.when(
        chosen.isNotNull(),
        F.struct(
            chosen["key"].alias("asset_key"),
            chosen["value"]["href"].alias("href"),
            chosen["value"]["type"].alias("media_type"),
        ),
    )


def asset_size(properties: Column) -> Column:
    """``file:size`` of open properties; NULL when unknown, never 0."""
    return F.try_variant_get(properties, "$['file:size']", "bigint")


def true_bbox(rings: Column) -> Column:
    """The box to trust: bounds of the geometry, whatever the item declared."""
    b = ring_bounds(rings)
    return F.when(b.isNotNull(), F.array(b["minx"], b["miny"], b["maxx"], b["maxy"]))


def is_geotransform_bbox(raw: Column) -> Column:
    """A six-value geotransform in place of a box: no rotation, pixels right and down, and an
    origin that is the corner of a kilometre tile on the grid."""
    v = lambda i: F.try_element_at(raw, F.lit(i))
    on_grid = (
        (v(1) % TILE_SIZE_M == 0) & (v(4) % TILE_SIZE_M == 0)
        & (v(1) / TILE_SIZE_M + TILE_X_ORIGIN).between(0, 999)
        & (v(4) / TILE_SIZE_M + TILE_Y_ORIGIN).between(0, 999)
    )
    shape = (F.size(raw) == 6) & (v(2) > 0) & (v(6) < 0) & (v(3) == 0) & (v(5) == 0)
    return F.coalesce(shape & on_grid, F.lit(False))
