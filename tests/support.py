"""Run a registered query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
DATA = os.environ.get("TILELAKE_TESTDATA", "/root/testdata")


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{sf}/{name}.parquet'")
    return con


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark, name: str, sf: str, queries, oracles) -> str | None:
    """None when both engines agree, else what differs."""
    df = queries[name](spark, f"{DATA}/{sf}")
    got = df.collect()
    result = duck(sf).execute(oracles[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    left, right = rows_of(df.columns, got), rows_of(columns, result.fetchall())
    if left == right:
        types = {type(v) for row in left for v in row} - {type(None)}
        if float in types:
            return "floats in a compared result"
        return None if got else "no rows"
    only_left, only_right = left - right, right - left
    return (f"rows {sum(left.values())} vs {sum(right.values())}; "
            f"spark only {list(only_left)[:3]}; duckdb only {list(only_right)[:3]}")
