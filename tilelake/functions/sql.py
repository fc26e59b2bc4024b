"""SQL access: scalar functions as SQL UDFs and the chunk grid as a table function.

The bodies are plain SQL that Spark inlines, so they cost no Python worker. ``tests`` hold them
against the Column functions of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tilelake.functions import grid, http, keys, naming, projections

_EXTENSIONS = ", ".join(f"'{k}', '{v}'" for k, v in naming.MEDIA_EXTENSIONS.items())
_ALPHA_N = " + ".join(
    f"{a!r}D * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(projections._ALPHA, 1)
)
_ALPHA_E = " + ".join(
    f"{a!r}D * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(projections._ALPHA, 1)
)

FUNCTIONS = {
    "tl_decode_tile_key(id STRING)": (
        "STRUCT<prefix: STRING, tile_x: INT, tile_y: INT, lot: INT, year: INT>",
        f"CASE WHEN length(id) > {keys.TAIL_WIDTH} AND right(id, {keys.TAIL_WIDTH}) "
        f"RLIKE '{keys.TAIL_PATTERN}' THEN named_struct("
        f"'prefix', left(id, length(id) - {keys.TAIL_WIDTH}), "
        + ", ".join(
            f"'{name}', try_cast(substring(id, {start}, {width}) AS INT)"
            for name, start, width in (
                ("tile_x", -14, 3), ("tile_y", -11, 3), ("lot", -7, 2), ("year", -4, 4)
            )
        ) + ") END",
    ),
    "tl_tile_extent(tile_x INT, tile_y INT)": (
        "STRUCT<minx: DOUBLE, miny: DOUBLE, maxx: DOUBLE, maxy: DOUBLE>",
        "named_struct('minx', (tile_x - 200) * 1000D, 'miny', (tile_y - 301) * 1000D, "
        "'maxx', (tile_x - 199) * 1000D, 'maxy', (tile_y - 300) * 1000D)",
    ),
    "tl_tile_of_point(x DOUBLE, y DOUBLE)": (
        "STRUCT<tile_x: INT, tile_y: INT>",
        "named_struct('tile_x', cast(floor(x / 1000) + 200 AS INT), "
        "'tile_y', cast(ceil(y / 1000) + 300 AS INT))",
    ),
    "tl_asset_extension(media_type STRING)": (
        "STRING",
        "coalesce(CASE WHEN lower(trim(split_part(media_type, ';', 1))) LIKE "
        "'application/vnd.laszip/%' THEN '.laz' WHEN lower(trim(split_part(media_type, ';', 1))) "
        "LIKE 'image/tiff/%' THEN '.tif' END, "
        f"try_element_at(map({_EXTENSIONS}), lower(trim(split_part(media_type, ';', 1)))), '.bin')",
    ),
    "tl_safe_component(value STRING)": (
        "STRING",
        r"coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(value, "
        r"'^\\s+|\\s+$', ''), '[/\\\\\\x00]', '_'), '^\\.+', ''), ''), '_')",
    ),
    "tl_storage_filename(item_id STRING, media_type STRING)": (
        "STRING", "concat(tl_safe_component(item_id), tl_asset_extension(media_type))",
    ),
    "tl_human_duration(seconds DOUBLE)": (
        "STRING",
        "CASE WHEN greatest(0, rint(seconds)) >= 60 THEN concat(cast(floor(rint(seconds) / 60) "
        "AS STRING), ':', lpad(cast(cast(rint(seconds) AS BIGINT) % 60 AS STRING), 2, '0')) "
        "ELSE concat(cast(cast(greatest(0, rint(seconds)) AS BIGINT) AS STRING), ' s') END",
    ),
    "tl_log_safe_url(url STRING)": ("STRING", "regexp_replace(url, '(?s)[?#].*$', '')"),
    "tl_is_login_redirect(status INT, location STRING)": (
        "BOOLEAN",
        "coalesce(status BETWEEN 300 AND 399 AND regexp_replace(regexp_replace("
        "tl_log_safe_url(location), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?', ''), "
        f"'/+$', '') = '{http.LOGIN_PATH}', false)",
    ),
    "tl_exchange_action(status INT, location STRING)": (
        "STRING",
        "CASE WHEN tl_is_login_redirect(status, location) THEN 'reauth' "
        "WHEN status BETWEEN 300 AND 399 AND coalesce(location, '') = '' THEN 'fail' "
        "WHEN status BETWEEN 300 AND 399 THEN 'presigned' WHEN status = 403 THEN 'remint' "
        "ELSE 'fail' END",
    ),
    "tl_retry_backoff(attempt INT)": (
        "DOUBLE",
        "CASE WHEN attempt BETWEEN 1 AND 5 THEN least(30D, 0.5D * pow(2, attempt - 1)) END",
    ),
    "tl_quantize(z DOUBLE, max_err DOUBLE)": (
        "DOUBLE",
        f"CASE WHEN z = {grid.DEFAULT_NODATA}D OR max_err <= 0 THEN z "
        "ELSE floor(z / (2 * max_err) + 0.5D) * 2 * max_err END",
    ),
    # Transverse Mercator in three steps, so that each intermediate is named once.
    "tl_tm06_t(lat DOUBLE)": (
        "DOUBLE",
        f"sinh(atanh(sin(radians(lat))) - {projections._E!r}D * "
        f"atanh({projections._E!r}D * sin(radians(lat))))",
    ),
    "tl_tm06_xy(xi DOUBLE, eta DOUBLE)": (
        "STRUCT<x: DOUBLE, y: DOUBLE>",
        f"named_struct('x', {projections._RECT!r}D * (eta + {_ALPHA_E}), "
        f"'y', {projections._RECT!r}D * (xi + {_ALPHA_N}) - ({projections._N0!r}D))",
    ),
    "tl_to_tm06(lon DOUBLE, lat DOUBLE)": (
        "STRUCT<x: DOUBLE, y: DOUBLE>",
        f"tl_tm06_xy(atan2(tl_tm06_t(lat), cos(radians(lon - ({projections._LON0_DEG!r}D)))), "
        f"atanh(sin(radians(lon - ({projections._LON0_DEG!r}D))) / "
        "sqrt(1 + tl_tm06_t(lat) * tl_tm06_t(lat))))",
    ),
}


@udtf(returnType="chunk_col int, chunk_row int, minx double, miny double, maxx double, maxy double")
class ChunkGrid:
    """Cells of a square grid from the lower-left corner of a box; the last ones are cut."""

    def eval(
        self, minx: float, miny: float, maxx: float, maxy: float, side: float
    ) -> Iterator[tuple]:
        if side <= 0:
            raise ValueError("the side must be positive")
        for row in range(max(1, math.ceil((maxy - miny) / side))):
            for col in range(max(1, math.ceil((maxx - minx) / side))):
                left, low = minx + col * side, miny + row * side
                yield col, row, left, low, min(left + side, maxx), min(low + side, maxy)


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL in this session."""
    for signature, (returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")
    spark.udtf.register("tl_chunk_grid", ChunkGrid)
