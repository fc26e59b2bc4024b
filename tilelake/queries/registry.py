"""Registry of queries over the test tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tilelake.plans.fixtures import oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, recursive: bool = False) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may name any fixture view."""

    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql, recursive)
        return build

    return add
