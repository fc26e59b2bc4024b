"""The three end-to-end jobs: search and estimate, plan a download, merge a mosaic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilelake.functions.grid import estimate_bytes, quantize
from tilelake.operators import catalog, plan, raster, spatial
from tilelake.session import materialize


def search_assets(
    items: DataFrame, aoi: DataFrame, collections: Sequence[str], cell: float,
    datetime: str | None = None,
) -> DataFrame:
    """Assets that match an area, a list of collections and a time.

    Cheap filters run before the spatial join and reach the scan; duplicates go last.
    """
    chosen = catalog.filter_collections(items, collections)
    if datetime:
        chosen = catalog.filter_datetime(chosen, datetime)
    return spatial.search(chosen, aoi, cell)


def search_estimate(
    items: DataFrame, aoi: DataFrame, collections: Sequence[str], cell: float,
    datetime: str | None = None,
) -> DataFrame:
    return catalog.estimate(search_assets(items, aoi, collections, cell, datetime))


@dataclass(frozen=True)
class DownloadPlan:
    rows: DataFrame
    summary: DataFrame
    batches: DataFrame
    budget: DataFrame


def plan_download(
    assets: DataFrame, inventory: DataFrame, volumes: DataFrame, volume: str,
    layout: str = "by_collection", overwrite: bool = False, batch_size: int | None = None,
) -> DownloadPlan:
    """What to fetch, how much, in which batches, and whether it fits."""
    # Written once: three results read it.
    rows = materialize(plan.reconcile(assets, inventory, layout, overwrite), "plan")
    summary = plan.plan_summary(rows)
    return DownloadPlan(
        rows, summary, plan.batch_assets(rows.where(~F.col("is_complete")), batch_size),
        plan.volume_check(summary, volumes, volume),
    )


@dataclass(frozen=True)
class Mosaic:
    cells: DataFrame
    levels: DataFrame
    window: DataFrame
    sizes: DataFrame
    factors: list[int]


def merge_tiles(
    pixels: DataFrame, headers: DataFrame, bbox: Sequence[float] | None = None,
    ensure_res: float | None = 10.0, max_err: float = raster.MAX_Z_ERROR,
    nodata: float | None = None,
) -> Mosaic:
    """One seamless mosaic with exact overviews from a set of tiles.

    Only the one-row facts about the tile set (its audit, nodata and shape) come to the driver;
    they decide the plan. Cells stay distributed.
    """
    broken = raster.tileset_audit(headers).first()
    if broken:
        raise ValueError(f"{broken['path']}: {', '.join(broken['violations'])}")
    resolved = raster.resolve_nodata(headers, nodata).first()
    if resolved["nodata"] is None:
        raise ValueError(f"nodata is {resolved['issue']}; pass a value")
    empty = resolved["nodata"]
    window = raster.clip_window(headers, bbox, ensure_res)
    shape = window.first()
    if shape is None:
        raise ValueError("the box does not overlap the tiles")
    res = raster.mosaic_shape(headers).first()["res"]
    factors = raster.overview_factors(res, ensure_res, shape["width"], shape["height"])
    whole = raster.mosaic(pixels, headers)
    cells = whole if bbox is None else raster.clip_pixels(whole, window)
    # Levels are averaged from the cells as they were; the bound applies to each level's output.
    levels = raster.pyramid(cells, factors, empty)
    dtype = headers.agg(F.min_by("dtype", "path")).scalar()
    sizes = window.select(estimate_bytes(F.col("width"), F.col("height"), dtype).alias("e")).select("e.*")
    return Mosaic(
        cells.withColumn("z", quantize(F.col("z"), max_err, empty)),
        levels.withColumn("z", quantize(F.col("z"), max_err, empty)),
        window, sizes, factors,
    )
