"""Rasters packed into square blocks: one row per block, cells as a float array.

A national mosaic has hundreds of billions of cells. Packed, a block of 512 × 512 cells is one
row of 1 MB. Overviews are computed inside the blocks; only overview cells that lie across block
borders, or hold several blocks, are put together from their parts, so no native cell is shuffled.
Two rasters are compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilelake.functions.grid import DEFAULT_NODATA
from tilelake.session import materialize

BLOCK = 512


def pack_blocks(cells: DataFrame, block: int = BLOCK, nodata: float = DEFAULT_NODATA) -> DataFrame:
    """``(bx, by, vals)`` with absent cells as NaN, and NULL as nodata. A block is one group of bounded size."""
    at = lambda c: F.floor(F.col(c) / block).cast("bigint")
    inner = lambda c: F.col(c) - at(c) * block
    keyed = cells.select(
        at("px").alias("bx"), at("py").alias("by"),
        (inner("py") * block + inner("px")).cast("int").alias("i"), F.coalesce(F.col("z"), F.lit(nodata)).cast("float").alias("z"),
    )

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.full(block * block, np.nan, np.float32)
        values[pdf["i"].to_numpy()] = pdf["z"].to_numpy(np.float32)
        return pd.DataFrame({"bx": pdf["bx"][:1], "by": pdf["by"][:1], "vals": [values]})

    return keyed.groupBy("bx", "by").applyInPandas(fill, "bx bigint, by bigint, vals array<float>")


def unpack_blocks(blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Long-form cells of packed blocks, nodata cells too, without the filling of absent ones."""
    return blocks.select("bx", "by", F.posexplode("vals").alias("i", "z")).where(~F.isnan("z")).select(
        (F.col("bx") * block + F.col("i") % block).alias("px"),
        (F.col("by") * block + F.floor(F.col("i") / block)).alias("py"),
        F.col("z").cast("double").alias("z"),
    )


def overview_blocks(
    blocks: DataFrame, factor: int, block: int = BLOCK, nodata: float = DEFAULT_NODATA
) -> DataFrame:
    """Overview cells of each block (sum and count), for a factor that divides the block. A cell with
    nodata only has nodata; one without any cell below it doesn't exist."""
    if block % factor:
        raise ValueError(f"factor {factor} does not divide the block size {block}")
    side = block // factor

    def reduce_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        oy, ox = np.divmod(np.arange(side * side), side)
        for pdf in batches:
            for bx, by, vals in zip(pdf["bx"], pdf["by"], pdf["vals"], strict=True):
                grid = np.asarray(vals, np.float64).reshape(side, factor, side, factor)
                there = ~np.isnan(grid)
                valid = there & (grid != np.float32(nodata))
                count = valid.sum(axis=(1, 3)).ravel()
                total = np.where(valid, grid, 0.0).sum(axis=(1, 3)).ravel()
                some = there.any(axis=(1, 3)).ravel()
                yield pd.DataFrame({
                    "ox": bx * side + ox[some], "oy": by * side + oy[some],
                    "sum_z": total[some], "n_valid": count[some],
                })

    levels = blocks.mapInPandas(
        reduce_blocks, "ox bigint, oy bigint, sum_z double, n_valid bigint"
    )
    return levels.select(
        F.lit(factor).alias("factor"), "ox", "oy", "sum_z", "n_valid",
        F.when(F.col("n_valid") > 0, F.col("sum_z") / F.col("n_valid")).otherwise(F.lit(nodata)).alias("z"),
    )


def _parts(bx: int, by: int, vals: np.ndarray, factor: int, block: int, nodata: float) -> tuple:
    """A block's share of each overview cell: ``ox, oy, sum, valid, whole`` arrays; whole if no other block has a share."""
    def cuts(at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = at * block
        numbers = np.arange(first // factor, (first + block - 1) // factor + 1)
        starts = np.maximum(numbers * factor - first, 0)
        whole = (numbers * factor >= first) & ((numbers + 1) * factor <= first + block)
        return numbers, starts, whole

    (nx, sx, wx), (ny, sy, wy) = cuts(bx), cuts(by)
    grid = vals.reshape(block, block)
    there = ~np.isnan(grid)
    valid = there & (grid != np.float32(nodata))
    reduce = lambda a: np.add.reduceat(np.add.reduceat(a, sy, axis=0), sx, axis=1)
    some = reduce(there.astype(np.int64)) > 0
    ox, oy = np.broadcast_to(nx, some.shape)[some], np.broadcast_to(ny[:, None], some.shape)[some]
    return ox, oy, reduce(np.where(valid, grid, 0.0).astype(np.float64))[some], reduce(valid.astype(np.int64))[some], (wy[:, None] & wx)[some]


def pyramid_blocks(
    blocks: DataFrame, factors: Sequence[int], block: int = BLOCK, nodata: float = DEFAULT_NODATA
) -> DataFrame:
    """All overview levels of packed blocks, as ``raster.pyramid`` gives them for cells; any factors.

    The blocks are read once. Of each level only cells that belong to several blocks are shuffled:
    those on block borders where the factor doesn't divide the block, and one per block where it is larger.
    """
    wanted = sorted(set(factors))
    if not wanted or wanted[0] < 1:
        raise ValueError("overview factors are positive, and there is at least one")

    def reduce_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for bx, by, vals in zip(pdf["bx"], pdf["by"], pdf["vals"], strict=True):
                for factor in wanted:
                    ox, oy, total, valid, whole = _parts(bx, by, np.asarray(vals, np.float64), factor, block, nodata)
                    yield pd.DataFrame({"factor": np.int32(factor), "ox": ox, "oy": oy, "sum_z": total, "n_valid": valid, "whole": whole})

    parts = materialize(blocks.mapInPandas(
        reduce_blocks, "factor int, ox bigint, oy bigint, sum_z double, n_valid bigint, whole boolean"), "overview-parts")
    keys = ["factor", "ox", "oy"]
    joined = parts.where(~F.col("whole")).groupBy(*keys).agg(F.sum("sum_z").alias("sum_z"), F.sum("n_valid").alias("n_valid"))
    levels = parts.where("whole").drop("whole").unionByName(joined)
    return levels.withColumn("z", F.when(F.col("n_valid") > 0, F.col("sum_z") / F.col("n_valid")).otherwise(F.lit(nodata)))


def verify_lossy_blocks(
    original: DataFrame, encoded: DataFrame, max_err: float, nodata: float = DEFAULT_NODATA,
    tile: int = BLOCK, block: int = BLOCK,
) -> DataFrame:
    """Per tile: largest error, cells over the bound, cells valid on one side only, and cells, as
    ``raster.verify_lossy`` gives them. Block rows are joined, and each pair of arrays is compared at once.
    """
    pairs = original.select("bx", "by", F.col("vals").alias("va")).join(
        encoded.select("bx", "by", F.col("vals").alias("vb")), ["bx", "by"], "full")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        absent = np.full(block * block, np.nan, np.float32)
        y, x = np.divmod(np.arange(block * block), block)
        for pdf in batches:
            for bx, by, va, vb in zip(pdf["bx"], pdf["by"], pdf["va"], pdf["vb"], strict=True):
                a, b = (absent if v is None else np.asarray(v, np.float32) for v in (va, vb))
                cell = ~(np.isnan(a) & np.isnan(b))
                ok_a, ok_b = (~np.isnan(v) & (v != np.float32(nodata)) for v in (a, b))
                error = np.where(ok_a & ok_b, np.abs(a.astype(np.float64) - b), -1.0)
                col, row = (bx * block + x) // tile, (by * block + y) // tile
                width = int(col[-1] - col[0]) + 1
                at = (row - row[0]) * width + col - col[0]
                count = lambda mask: np.bincount(at[mask], minlength=int(at[-1]) + 1)
                most = np.full(int(at[-1]) + 1, -1.0)
                np.maximum.at(most, at[cell], error[cell])
                cells = count(cell)
                tiles = np.flatnonzero(cells)
                yield pd.DataFrame({
                    "tile_col": col[0] + tiles % width, "tile_row": row[0] + tiles // width, "max_error": most[tiles],
                    "over_bound": count(error > max_err)[tiles], "nodata_mismatch": count(cell & (ok_a != ok_b))[tiles], "cells": cells[tiles],
                })

    parts = pairs.mapInPandas(
        compare, "tile_col bigint, tile_row bigint, max_error double, over_bound bigint, nodata_mismatch bigint, cells bigint")
    return parts.groupBy("tile_col", "tile_row").agg(
        F.max(F.when(F.col("max_error") >= 0, F.col("max_error"))).alias("max_error"),
        *[F.sum(c).alias(c) for c in ("over_bound", "nodata_mismatch", "cells")])


# -- stored blocks and windows of them ----------------------------------------------------------

ORIGIN = 1 << 20  # added to block numbers, which may be negative, before their bits are interleaved
_LEVELS = 21
RANGES = 64  # key ranges that a window is turned into at most


def _spread(v: Column) -> Column:
    """The bits of a number below 2^21, each followed by a zero."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def block_key(bx: Column, by: Column) -> Column:
    """A block's place on the Z curve: blocks near each other have keys near each other."""
    at = lambda c: (c + ORIGIN).cast("bigint")
    return F.shiftleft(_spread(at(by)), 1).bitwiseOR(_spread(at(bx)))


def write_blocks(blocks: DataFrame, path: str, files: int | None = None) -> None:
    """Packed blocks as Parquet in order of their key, which each file's statistics bound."""
    keyed = blocks.withColumn("key", block_key(F.col("bx"), F.col("by")))
    spread = keyed.repartitionByRange(files, "key") if files else keyed.repartitionByRange("key")
    spread.sortWithinPartitions("key").write.parquet(path)


def key_ranges(left: int, top: int, right: int, bottom: int, most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of keys, in order, that hold all blocks with ``left <= bx <= right`` and ``top <= by <= bottom``.

    Squares of the quadtree that lie inside are taken whole; the largest that only touch are split
    while there is room for more ranges.
    """
    left, top, right, bottom = (v + ORIGIN for v in (left, top, right, bottom))
    open_, done = [(_LEVELS, 0, 0)], []
    while open_:
        level, x, y = open_.pop(0)
        size = 1 << level
        if x > right or y > bottom or x + size <= left or y + size <= top:
            continue
        inside = left <= x and x + size - 1 <= right and top <= y and y + size - 1 <= bottom
        if inside or level == 0 or len(open_) + len(done) + 4 > most:
            key = sum(((x >> b & 1) | (y >> b & 1) << 1) << 2 * b for b in range(_LEVELS + 1))
            done.append((key, key + (1 << 2 * level) - 1))
        else:
            half = size // 2
            open_ += [(level - 1, x, y), (level - 1, x + half, y), (level - 1, x, y + half), (level - 1, x + half, y + half)]
    merged: list[tuple[int, int]] = []
    for low, high in sorted(done):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def read_window(spark: SparkSession, path: str, left: int, top: int, right: int, bottom: int, block: int = BLOCK) -> DataFrame:
    """Long-form cells with ``left <= px < right`` and ``top <= py < bottom`` of written blocks.

    The window becomes ranges of the stored key, so files and row groups outside it aren't read.
    """
    stored = spark.read.parquet(path)
    if right <= left or bottom <= top:
        return unpack_blocks(stored.limit(0), block)
    box = [left // block, top // block, (right - 1) // block, (bottom - 1) // block]
    wanted = F.lit(False)
    for low, high in key_ranges(*box):
        wanted = wanted | F.col("key").between(low, high)
    cells = unpack_blocks(stored.where(wanted), block)
    return cells.where((F.col("px") >= left) & (F.col("px") < right) & (F.col("py") >= top) & (F.col("py") < bottom))
