"""Physical plans: what is pushed down, what is combined early, and what must not appear."""

import pytest
from support import DATA

from __spark_entry__ import queries

QUERIES = queries()
SF = f"{DATA}/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NO_PYTHON = [
    "decode_tile_key", "layout_path", "human_size", "parse_retry_after", "transfer_action", "to_tm06", "from_tm06", "clip_to_box", "search_bbox",
    "estimate", "first_seen", "reconcile", "mosaic", "pyramid", "token_bucket", "merge_intervals", "overview_factors",
]


@pytest.mark.parametrize("name", NO_PYTHON)
def test_stays_in_the_jvm(spark, name):
    text = plan_of(QUERIES[name](spark, SF))
    assert "Python" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    text = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_reach_the_scan(spark):
    from tilelake.operators.catalog import filter_collections, filter_datetime
    from tilelake.session import scratch_path

    path = scratch_path(spark, "pushed")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spark.sql("SELECT 'a' AS collection_id, 'i' AS item_id, 1 AS other, timestamp'2024-01-01' AS item_ts").write.parquet(path)
    df = filter_datetime(filter_collections(spark.read.parquet(path), ["a"]), "2023/2025").select("item_id")
    text = plan_of(df)
    assert "GreaterThanOrEqual(item_ts" in text and "LessThanOrEqual(item_ts" in text and "EqualTo(collection_id,a)" in text
    assert "other" not in text.split("ReadSchema")[1]


def test_scan_reads_only_what_is_needed(spark):
    text = plan_of(QUERIES["dedup_items"](spark, SF))
    assert "l_extendedprice" not in text and "l_comment" not in text


def test_ranks_keep_one_row_per_group_before_the_shuffle(spark):
    for name in ("first_seen", "latest_outcome"):
        text = plan_of(QUERIES[name](spark, SF))
        assert text.count("WindowGroupLimit") == 2, name  # before and after the exchange


def test_search_joins_on_cells(spark):
    text = plan_of(QUERIES["search_chunked"](spark, SF))
    assert "HashJoin" in text and "_cx" in text and "_cy" in text


def test_pyramid_levels_share_their_work(spark):
    df = QUERIES["pyramid"](spark, SF)
    df.collect()
    text = plan_of(df)
    assert "ReusedExchange" in text
