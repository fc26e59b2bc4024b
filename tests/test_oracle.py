"""Every registered query against DuckDB on the same tables."""

import pytest
from support import DATA, difference

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name):
    assert difference(spark, name, "sf0.01", QUERIES, ORACLES) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
