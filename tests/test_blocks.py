"""Packed blocks give what cells give, and windows read only what they need."""

import random

import pytest
from pyspark.sql import functions as F

from tilelake.operators import blocks, raster
from tilelake.session import scratch_path

NODATA = -999.0


@pytest.fixture(scope="module")
def cells(spark):
    """A raster with holes, nodata, nulls and negative positions."""
    rng = random.Random(4)
    rows = [(x, y, rng.choice([NODATA, None]) if rng.random() < 0.15 else rng.randrange(-400, 900) / 4) for x in range(-40, 75) for y in range(-21, 62)
            if rng.random() < 0.9 and not (10 <= x < 26 and y < 0)]
    return spark.createDataFrame(rows, "px bigint, py bigint, z double").repartition(5)


def as_set(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("block", [16, 20, 64])
def test_pyramid_equals_that_of_cells(spark, cells, block):
    columns = ["factor", "ox", "oy", "sum_z", "n_valid", "z"]
    factors = [2, 6, 12, 48]
    packed = blocks.pyramid_blocks(blocks.pack_blocks(cells, block, NODATA), factors, block, NODATA)
    assert as_set(packed, *columns) == as_set(raster.pyramid(cells, factors, NODATA), *columns)
    with pytest.raises(ValueError):
        blocks.pyramid_blocks(cells, [], block)


def test_only_cells_of_several_blocks_are_shuffled(spark, cells):
    packed = blocks.pyramid_blocks(blocks.pack_blocks(cells, 16, NODATA), [4, 8], 16, NODATA)
    assert packed.where("oy < 0").count() > 0
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "NOT whole" in plan


@pytest.mark.parametrize("tile,block", [(16, 16), (24, 16), (10, 32), (64, 16)])
def test_lossy_check_equals_that_of_cells(spark, cells, tile, block):
    rng = F.xxhash64("px", "py") % 7
    other = cells.where(rng != 3).withColumn("z", F.when(rng == 2, NODATA).when(F.col("z") == NODATA, 5.0).otherwise(F.col("z") + rng / 4))
    other = other.unionByName(spark.createDataFrame([(500, 500, 1.0), (-300, 2, NODATA)], cells.schema))
    columns = ["tile_col", "tile_row", "max_error", "over_bound", "nodata_mismatch", "cells"]
    pair = [blocks.pack_blocks(c, block, NODATA) for c in (cells, other)]
    got = blocks.verify_lossy_blocks(*pair, 0.6, NODATA, tile, block)
    assert as_set(got, *columns[:2], "over_bound", "cells") == as_set(raster.verify_lossy(cells, other, 0.6, NODATA, tile), *columns[:2], "over_bound", "cells")
    error = lambda df: {(r.tile_col, r.tile_row): r.max_error for r in df.collect()}
    assert error(got) == error(raster.verify_lossy(cells, other, 0.6, NODATA, tile))


def test_key_ranges_hold_the_window_and_little_else(spark):
    rng = random.Random(5)
    for _ in range(30):
        x, y = rng.randrange(-50, 50), rng.randrange(-50, 50)
        box = (x, y, x + rng.randrange(40), y + rng.randrange(40))
        ranges = blocks.key_ranges(*box)
        assert len(ranges) <= blocks.RANGES and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
        grid = spark.range(120 * 120).select((F.col("id") % 120 - 60).alias("bx"), (F.floor(F.col("id") / 120) - 60).alias("by"))
        rows = grid.select("bx", "by", blocks.block_key(F.col("bx"), F.col("by")).alias("k")).collect() if _ < 3 else []
        if rows:
            assert len({r.k for r in rows}) == len(rows)
        for r in rows:
            if box[0] <= r.bx <= box[2] and box[1] <= r.by <= box[3]:
                assert any(a <= r.k <= b for a, b in ranges)
    tight = blocks.key_ranges(0, 0, 7, 7)
    assert len(tight) == 1 and tight[0][1] - tight[0][0] == 63


def test_a_window_reads_part_of_the_files(spark, cells):
    path = scratch_path(spark, "t-blocks")
    blocks.write_blocks(blocks.pack_blocks(cells, 8, NODATA), path, 12)
    whole = blocks.unpack_blocks(blocks.pack_blocks(cells, 8, NODATA), 8)
    for window in ((0, 0, 9, 9), (-33, -7, -20, 31), (70, 60, 400, 400), (5, 5, 5, 9)):
        got = blocks.read_window(spark, path, *window, 8)
        l, t, r, b = window
        assert as_set(got, "px", "py", "z") == as_set(whole.where(f"px >= {l} and px < {r} and py >= {t} and py < {b}"), "px", "py", "z")
    plan = blocks.read_window(spark, path, 0, 0, 8, 8, 8)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(key" in plan
    files = spark.read.parquet(path).select(F.input_file_name().alias("f"), "key").groupBy("f").agg(F.min("key").alias("a"), F.max("key").alias("b")).collect()
    ranges = blocks.key_ranges(0, 0, 0, 0)
    assert len(files) == 12 and sum(any(a <= f.b and b >= f.a for a, b in ranges) for f in files) <= 2
