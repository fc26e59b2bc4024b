"""Areas of interest: chunking and spatial joins on grid-cell keys."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, MapType, StructField, StructType, VariantType

from tilelake.functions.crossings import crossed
from tilelake.functions.grid import box
from tilelake.functions.projections import metric_crs, rings_to_lonlat, rings_to_metric
from tilelake.functions.rings import (
    clip_to_box,
    edges,
    edges_meet,
    geometry_audit,
    is_box,
    planar_area,
    polygons_intersect,
    polygons_overlap,
    ring_bounds,
)
from tilelake.operators.catalog import ITEM_IDENTITY, first_seen
from tilelake.session import materialize

# Default chunk area, and the piece size below which a chunk is float noise.
CHUNK_KM2 = 2000.0
MIN_CHUNK_AREA_M2 = 1.0

# Corners of the grid stay off round coordinates, where borders and vertices tend to lie.
_SHIFT_X, _SHIFT_Y = 0.38196601125, 0.2360679775
_FAR = 64  # cells per side of the coarse grid, for items that are larger than a cell
_SLIVER = 1e-9  # of a cell: how far beyond its own cells an edge is dealt


def _merge_bounds(df: DataFrame, keys: list[str], bounds: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(f"{bounds}.minx").alias("minx"), F.min(f"{bounds}.miny").alias("miny"),
        F.max(f"{bounds}.maxx").alias("maxx"), F.max(f"{bounds}.maxy").alias("maxy"),
    )


def with_metric(aoi: DataFrame) -> DataFrame:
    """AOI parts with the area's metric CRS and their projected rings."""
    whole = _merge_bounds(
        aoi.select("aoi_id", ring_bounds(F.col("rings")).alias("b")), ["aoi_id"], "b"
    ).select(
        "aoi_id", metric_crs(F.struct("minx", "miny", "maxx", "maxy")).alias("crs")
    )
    return aoi.join(whole, "aoi_id").withColumn(
        "metric_rings", rings_to_metric(F.col("rings"), F.col("crs"))
    )


def overlapping_parts(aoi: DataFrame, cell_m: float = 10_000.0) -> DataFrame:
    """AOIs in which two parts share area, so that summed areas would count it twice.

    Parts meet their neighbours through grid cells in a semi join, which yields each part at
    most once however many others it overlaps.
    """
    parts = with_metric(aoi).select(
        "aoi_id", "part_id", "metric_rings", ring_bounds(F.col("metric_rings")).alias("b")
    )
    keyed = _cover(parts, "b", cell_m)
    other = keyed.select(*[F.col(c).alias(f"o_{c}") for c in keyed.columns])
    same_cell = (
        (F.col("aoi_id") == F.col("o_aoi_id")) & (F.col("_cx") == F.col("o__cx"))
        & (F.col("_cy") == F.col("o__cy"))
    )
    boxes_meet = (
        (F.col("b.minx") < F.col("o_b.maxx")) & (F.col("o_b.minx") < F.col("b.maxx"))
        & (F.col("b.miny") < F.col("o_b.maxy")) & (F.col("o_b.miny") < F.col("b.maxy"))
    )
    hit = (
        same_cell & (F.col("part_id") < F.col("o_part_id")) & boxes_meet
        & polygons_overlap(F.col("metric_rings"), F.col("o_metric_rings"))
    )
    return keyed.join(other, hit, "left_semi").select("aoi_id").distinct()


def _crossings(polygons: DataFrame, columns: list[str]) -> DataFrame:
    """The columns, with ``_crossed``: whether one of ``rings`` crosses or touches itself."""
    rows = polygons.select("rings", *columns)
    kept = rows.columns[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(crossed(batch.column(0)))], names=[*kept, "_crossed"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[1:], StructField("_crossed", BooleanType())]))


def self_crossing(polygons: DataFrame, key: str) -> DataFrame:
    """``key`` of the polygons of which a ring crosses or touches itself; any number of vertices.

    The edges of a ring meet only those in the same cell of a grid of its own (``functions.crossings``). A
    polygon comes once, however often it crosses itself.
    """
    return _crossings(polygons, [key]).where("_crossed").select(key).distinct()


def audit(polygons: DataFrame, key: str) -> DataFrame:
    """``key, defects`` of every polygon, as ``geometry_audit`` names them, for rings of any size. ``key`` is unique."""
    same = polygons.select(key, F.col("rings").alias("_rings"), "rings")
    return _crossings(same, [key, "_rings"]).select(key, geometry_audit(F.col("_rings"), F.col("_crossed")).alias("defects"))


def aoi_area_km2(aoi: DataFrame) -> DataFrame:
    """Area per AOI as the sum over its parts; NULL for AOIs whose parts overlap."""
    areas = (
        with_metric(aoi)
        .groupBy("aoi_id", "crs")
        .agg((F.sum(planar_area(F.col("metric_rings"))) / 1_000_000.0).alias("area_km2"))
    )
    doubled = overlapping_parts(aoi).withColumn("parts_overlap", F.lit(True))
    return areas.join(doubled, "aoi_id", "left").select(
        "aoi_id", "crs",
        F.when(F.col("parts_overlap").isNull(), F.col("area_km2")).alias("area_km2"),
        F.coalesce("parts_overlap", F.lit(False)).alias("parts_overlap"),
    )


def chunk_aoi(aoi: DataFrame, max_km2: float = CHUNK_KM2) -> DataFrame:
    """Cut areas above ``max_km2`` along a square grid from their lower-left corner.

    A large area is cut into strips first and the strips are spread over tasks before they are
    cut into cells, so neither one task nor one ring carries the whole grid.
    """
    if max_km2 <= 0:
        raise ValueError(f"chunk size must be positive (got {max_km2})")
    side = F.lit(math.sqrt(max_km2) * 1000.0)
    # Strips are few bytes but much work, so AQE must not merge them by size.
    tasks = 4 * aoi.sparkSession.sparkContext.defaultParallelism
    metric = with_metric(aoi).withColumn("own", ring_bounds(F.col("metric_rings")))
    metric = materialize(metric.withColumn("part_m2", planar_area(F.col("metric_rings"))), "aoi")
    areas = metric.groupBy("aoi_id").agg(
        F.sum("part_m2").alias("area_m2"),
        F.min("own.minx").alias("minx"), F.min("own.miny").alias("miny"),
        F.max("own.maxx").alias("maxx"), F.max("own.maxy").alias("maxy"),
    )
    parts = metric.join(areas, "aoi_id")
    is_large = F.col("area_m2") > max_km2 * 1_000_000.0
    uncut = lambda df: df.select(
        "aoi_id", F.lit(0).alias("chunk_col"), F.lit(0).alias("chunk_row"), "part_id", "rings",
        (F.col("part_m2") / 1_000_000.0).alias("area_km2"),
    )

    def steps(low: str, high: str, own_low: Column, own_high: Column) -> Column:
        """Grid indices from the area's corner that this part can reach."""
        count = F.ceil((F.col(high) - F.col(low)) / side).cast("int")
        first = F.floor((own_low - F.col(low)) / side).cast("int")
        last = F.floor((own_high - F.col(low)) / side).cast("int")
        return F.sequence(F.greatest(first, F.lit(0)), F.least(last, count - 1))

    strips = (
        parts.where(is_large)
        .withColumn(
            "chunk_row",
            F.explode_outer(steps("miny", "maxy", F.col("own.miny"), F.col("own.maxy"))),
        )
        .withColumn("lo", F.col("miny") + F.col("chunk_row") * side)
        .withColumn("hi", F.least(F.col("lo") + side, F.col("maxy")))
        .withColumn(
            "strip",
            clip_to_box(
                F.col("metric_rings"), box(F.col("minx"), F.col("lo"), F.col("maxx"), F.col("hi"))
            ),
        )
        .select(
            "aoi_id", "part_id", "crs", "chunk_row", "minx", "maxx", "lo", "hi", "strip",
        )
        .repartition(tasks, "aoi_id", "chunk_row", "part_id")
        .withColumn("own", ring_bounds(F.col("strip")))
        .where(F.col("own").isNotNull())
    )
    cells = (
        strips.withColumn(
            "chunk_col",
            F.explode_outer(steps("minx", "maxx", F.col("own.minx"), F.col("own.maxx"))),
        )
        .withColumn("left", F.col("minx") + F.col("chunk_col") * side)
        .withColumn("right", F.least(F.col("left") + side, F.col("maxx")))
        .select(
            "aoi_id", "chunk_col", "chunk_row", "part_id", "crs",
            clip_to_box(
                F.col("strip"), box(F.col("left"), F.col("lo"), F.col("right"), F.col("hi"))
            ).alias("piece"),
        )
        .withColumn("m2", planar_area(F.col("piece")))
    )
    # Written once: the pieces are read for the chunk totals and for the result.
    cut = materialize(cells, "chunks").where(F.col("m2") > 0)
    keys = ["aoi_id", "chunk_col", "chunk_row"]
    # A chunk counts once its pieces together exceed the noise level.
    kept = (
        cut.groupBy(*keys).agg(F.sum("m2").alias("chunk_m2"))
        .where(F.col("chunk_m2") > MIN_CHUNK_AREA_M2).select(*keys)
    )
    pieces = cut.join(kept, keys, "left_semi").select(
        *keys, "part_id", rings_to_lonlat(F.col("piece"), F.col("crs")).alias("rings"),
        (F.col("m2") / 1_000_000.0).alias("area_km2"),
    )
    # Never empty: an area of slivers only stays whole.
    slivers = parts.where(is_large).join(kept.select("aoi_id"), "aoi_id", "left_anti")
    return uncut(parts.where(~is_large)).unionByName(pieces).unionByName(uncut(slivers))


# Exploding here uses the outer form: the sequences are never empty, and for the inner form
# Spark would add a filter that evaluates the geometry expressions once more.


def _cover(df: DataFrame, bounds: str, cell: float) -> DataFrame:
    """One row per grid cell that the bounds touch."""
    index = lambda side: F.floor(F.col(f"{bounds}.{side}") / cell)
    return df.withColumn("_cx", F.explode_outer(F.sequence(index("minx"), index("maxx")))).withColumn(
        "_cy", F.explode_outer(F.sequence(index("miny"), index("maxy")))
    )


def _column_index(v: Column, cell: float, shift: float) -> Column:
    return F.floor(v / cell - shift).cast("bigint")


def _edge_blocks(borders: DataFrame, cell: float) -> DataFrame:
    """Every edge once per block of 2 x 2 cells that it touches: ``_part, _cx, _cy, e``."""
    p, q = F.col("e.p"), F.col("e.q")
    low, high = F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])
    columns = borders.withColumn("_cx", F.explode_outer(F.sequence(
        _column_index(low, cell, _SHIFT_X + _SLIVER) - 1, _column_index(high, cell, _SHIFT_X - _SLIVER))))
    left = (F.col("_cx") + _SHIFT_X) * cell
    at = lambda x: p["y"] + (q["y"] - p["y"]) * ((x - p["x"]) / (q["x"] - p["x"]))
    # Of a slanting edge, only the stretch that lies in the block's columns.
    ya, yb = at(F.greatest(left, low)), at(F.least(left + 2 * cell, high))
    level = p["x"] == q["x"]
    bottom = F.when(level, F.least(p["y"], q["y"])).otherwise(F.least(ya, yb))
    top = F.when(level, F.greatest(p["y"], q["y"])).otherwise(F.greatest(ya, yb))
    return columns.withColumn("_cy", F.explode_outer(F.sequence(
        _column_index(bottom, cell, _SHIFT_Y + _SLIVER) - 1, _column_index(top, cell, _SHIFT_Y - _SLIVER))))


def _inside_corners(borders: DataFrame, keep: list[str], cell: float) -> DataFrame:
    """The grid corners that lie inside an area part: ``_part, _cx, _cy`` of the block at that corner.

    Each grid line is met by the edges that cross it; between every other pair of crossings, in
    order, the line runs inside.
    """
    p, q = F.col("e.p"), F.col("e.q")
    lines = borders.withColumn("_cy", F.explode_outer(F.sequence(
        _column_index(F.least(p["y"], q["y"]), cell, _SHIFT_Y), _column_index(F.greatest(p["y"], q["y"]), cell, _SHIFT_Y) + 1)))
    y = (F.col("_cy") + _SHIFT_Y) * cell
    crossed = lines.where((p["y"] > y) != (q["y"] > y)).select(
        *keep, "_cy", (p["x"] + (y - p["y"]) / (q["y"] - p["y"]) * (q["x"] - p["x"])).alias("x"))
    rows = crossed.groupBy(*keep, "_cy").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    spans = rows.select(*keep, "_cy", F.explode(F.transform(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)), lambda i: F.struct(
        F.get("xs", i).alias("a"), F.get("xs", i + 1).alias("b")))).alias("s"))
    corners = spans.withColumn("_cx", F.explode_outer(F.sequence(
        _column_index(F.col("s.a"), cell, _SHIFT_X), _column_index(F.col("s.b"), cell, _SHIFT_X) + 1)))
    x = (F.col("_cx") + _SHIFT_X) * cell
    return corners.where((x >= F.col("s.a")) & (x < F.col("s.b"))).select(*keep, "_cx", "_cy")


def _area_blocks(areas: DataFrame, cell: float) -> DataFrame:
    """What an area part is within each block of 2 x 2 cells: the edges that touch it, and whether its
    lower-left corner is inside. Blocks that are inside as a whole have no edges.
    """
    keep = ["_part", "_ids", "_ab", "_abox"]
    borders = areas.select(*keep, F.explode("_ae").alias("e"))
    dealt = _edge_blocks(borders, cell).select(*keep, "_cx", "_cy", "e", F.lit(False).alias("inside"))
    corners = _inside_corners(borders, keep, cell)
    corners = corners.select(*keep, "_cx", "_cy", F.lit(None).cast(dealt.schema["e"].dataType).alias("e"), F.lit(True).alias("inside"))
    return dealt.unionByName(corners).groupBy(*keep, "_cx", "_cy").agg(
        F.collect_list("e").alias("_edges"), F.max("inside").alias("_inside"))


def _meets_block(rings: Column, cell: float) -> Column:
    """Whether an item that lies in a block meets the area, from the block's edges and corner alone."""
    x0, y0 = (F.col("_cx") + _SHIFT_X) * cell, (F.col("_cy") + _SHIFT_Y) * cell

    def crosses_path(e: Column, v: Column) -> Column:
        """From the corner up to the vertex's height, then across to the vertex: the edge is crossed once."""
        p, q = e["p"], e["q"]
        x = p["x"] + (v["y"] - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) * (q["x"] - p["x"])
        y = p["y"] + (x0 - p["x"]) / F.nullif(q["x"] - p["x"], F.lit(0.0)) * (q["y"] - p["y"])
        across = ((p["y"] > v["y"]) != (q["y"] > v["y"])) & F.coalesce((x > x0) & (x <= v["x"]), F.lit(False))
        up = ((p["x"] > x0) != (q["x"] > x0)) & F.coalesce((y > y0) & (y <= v["y"]), F.lit(False))
        return across != up

    def vertex_inside(r: Column) -> Column:
        return (F.size(F.filter("_edges", lambda e: crosses_path(e, r[0]))) % 2 == 1) != F.col("_inside")

    return F.exists(rings, vertex_inside) | edges_meet(rings, F.col("_edges"))


def _item_keys(cell: float) -> Column:
    """The block of an item that is no larger than a cell; the coarse cells of one that is."""
    b, far = F.col("_ib"), cell * _FAR
    key = lambda large, x, y: F.struct(F.lit(large).alias("_large"), x.alias("_cx"), y.alias("_cy"))
    small = (b["maxx"] - b["minx"] <= cell) & (b["maxy"] - b["miny"] <= cell)
    span = lambda low, high: F.sequence(F.floor(b[low] / far).cast("bigint"), F.floor(b[high] / far).cast("bigint"))
    coarse = F.flatten(F.transform(span("minx", "maxx"), lambda x: F.transform(span("miny", "maxy"), lambda y: key(True, x, y))))
    return F.when(small, F.array(key(False, _column_index(b["minx"], cell, _SHIFT_X), _column_index(b["miny"], cell, _SHIFT_Y)))).otherwise(coarse)


def search_chunked(
    items: DataFrame, chunks: DataFrame, cell: float, bounds: Column | None = None
) -> DataFrame:
    """Every item with every chunk part it meets (touching counts).

    ``items`` and ``chunks`` carry ``rings`` in the same plane; ``cell`` is the grid size in its
    units, best a few times the size of an item. ``bounds`` may give the items' boxes where they
    are known already. A tile across a chunk border appears once per chunk.

    The join is an equality of grid cells. An item no larger than a cell lies in the block of 2 x 2
    cells at its lower-left corner, so it has one key, and an area needs just its edges in that
    block and whether the block's corner is inside; where no edge is, the corner decides. Only for items
    larger than a cell are whole areas keyed, by cells 64 times as wide, and a pair counts in
    the cell that holds the lower-left corner of the common box.
    """
    ids = [c for c in ("aoi_id", "chunk_col", "chunk_row", "part_id") if c in chunks.columns]
    areas = (
        chunks.select(
            F.struct(*ids).alias("_ids"), F.xxhash64(*ids).alias("_part"), F.col("rings").alias("_area"),
            ring_bounds(F.col("rings")).alias("_ab"),
        )
        .where(F.col("_ab").isNotNull())
        .withColumn("_ae", edges(F.col("_area")))
        .withColumn("_abox", is_box(F.col("_area"), F.col("_ab")))
    )
    far = cell * _FAR
    blocks = _area_blocks(areas, cell).withColumns({"_large": F.lit(False), "_area": F.lit(None).cast(chunks.schema["rings"].dataType)})
    whole = _cover(areas, "_ab", far).withColumns({"_large": F.lit(True), "_edges": F.col("_ae"), "_inside": F.lit(False)})
    columns = ["_ids", "_ab", "_abox", "_large", "_cx", "_cy", "_edges", "_inside", "_area"]
    # Dealt by cell, as a merge join needs it. Spark knows the cover's true size after this
    # exchange, and only then may choose a broadcast; AQE splits a cell full of items.
    cover = blocks.select(*columns).unionByName(whole.select(*columns)).repartition("_large", "_cx", "_cy")
    boxed = items.withColumn("_ib", ring_bounds(F.col("rings")) if bounds is None else bounds)
    keyed = boxed.where(F.col("rings").isNotNull()).withColumn("_key", F.explode(_item_keys(cell))).select(
        *items.columns, "_ib", F.col("_key._large").alias("_large"), F.col("_key._cx").alias("_cx"), F.col("_key._cy").alias("_cy"))
    joined = keyed.join(cover, ["_large", "_cx", "_cy"])
    x0 = F.greatest("_ib.minx", "_ab.minx")
    y0 = F.greatest("_ib.miny", "_ab.miny")
    meet = (
        (F.col("_ib.minx") <= F.col("_ab.maxx")) & (F.col("_ib.maxx") >= F.col("_ab.minx"))
        & (F.col("_ib.miny") <= F.col("_ab.maxy")) & (F.col("_ib.maxy") >= F.col("_ab.miny"))
    )
    here = ~F.col("_large") | ((F.floor(x0 / far) == F.col("_cx")) & (F.floor(y0 / far) == F.col("_cy")))
    # One CASE from cheap to dear: Spark evaluates parts shared by the sides of an AND or OR up
    # front for every row, but keeps the branches of a CASE lazy.
    hit = (
        F.when(~(meet & here), F.lit(False))
        .when(F.col("_abox") & is_box(F.col("rings"), F.col("_ib")), F.lit(True))
        .when(F.size("_edges") == 0, F.col("_inside"))
        .when(F.col("_large"), polygons_intersect(F.col("rings"), F.col("_area"), F.col("_edges")))
        .otherwise(_meets_block(F.col("rings"), cell))
    )
    return joined.where(hit).select(*items.columns, *[F.col(f"_ids.{c}").alias(c) for c in ids])


def search(
    items: DataFrame, aoi: DataFrame, cell: float, bounds: Column | None = None,
    order: Sequence[str] = ("chunk", "page", "pos"),
) -> DataFrame:
    """Items that meet any part of the area, each once: the first of its copies that meet it.

    Copies are ordered by the columns of ``order`` that the items have, then by a hash of all others,
    so the choice doesn't depend on partitioning.
    """
    hits = search_chunked(items, aoi, cell, bounds).select(*items.columns)
    keys = [c for c in order if c in items.columns]
    unhashed = (MapType, VariantType)
    rest = [f.name for f in items.schema if f.name not in (*keys, *ITEM_IDENTITY) and not isinstance(f.dataType, unhashed)]
    return first_seen(hits, [*keys, F.xxhash64(*rest)])
