"""Tile identifiers and the 1 km tile grid (EPSG:3763 metres)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tile grid: metres per tile and the index of the grid origin.
TILE_SIZE_M = 1000.0
TILE_X_ORIGIN = 200
TILE_Y_ORIGIN = 300

# An id ends in a fixed-width tail, which is cheaper to cut than to match group by group.
TAIL_PATTERN = r"^-[0-9]{6}-[0-9]{2}-[0-9]{4}$"
TAIL_WIDTH = 15


def decode_tile_key(item_id: Column) -> Column:
    """``prefix-XXXYYY-LL-YYYY`` read from the right; NULL for any other id."""
    tail = F.substring(item_id, -TAIL_WIDTH, TAIL_WIDTH)
    number = lambda start, width: F.substring(item_id, start, width).try_cast("int")
    prefix_width = F.length(item_id) - TAIL_WIDTH
    return F.when(
        (prefix_width > 0) & tail.rlike(TAIL_PATTERN),
        F.struct(
            F.substring(item_id, F.lit(1), prefix_width).alias("prefix"),
            number(-14, 3).alias("tile_x"),
            number(-11, 3).alias("tile_y"),
            number(-7, 2).alias("lot"),
            number(-4, 4).alias("year"),
        ),
    )


def tile_extent(tile_x: Column, tile_y: Column) -> Column:
    """Extent of a tile; its origin is the top-left corner."""
    minx = (tile_x - F.lit(TILE_X_ORIGIN)) * F.lit(TILE_SIZE_M)
    maxy = (tile_y - F.lit(TILE_Y_ORIGIN)) * F.lit(TILE_SIZE_M)
    return F.struct(
        minx.alias("minx"),
        (maxy - TILE_SIZE_M).alias("miny"),
        (minx + TILE_SIZE_M).alias("maxx"),
        maxy.alias("maxy"),
    )


def tile_of_point(x: Column, y: Column) -> Column:
    """The tile that holds a metric point: left and top edges belong to the tile."""
    return F.struct(
        (F.floor(x / TILE_SIZE_M) + TILE_X_ORIGIN).cast("int").alias("tile_x"),
        (F.ceil(y / TILE_SIZE_M) + TILE_Y_ORIGIN).cast("int").alias("tile_y"),
    )
