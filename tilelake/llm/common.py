"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values of the query contracts: ASCII white space, and what a word is.
SPACES = "\x20\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, made from ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the wanted columns, under the names an operator works with."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def map_columns(
    df: DataFrame, work: Callable[[], Callable[[dict], dict]], schema: str,
) -> DataFrame:
    """Run ``work()`` once per task, and what it returns on the columns of each Arrow batch.

    The inner function takes lists by column name and gives lists or arrays by column name. A task
    holds one batch at a time.
    """
    out = StructType.fromDDL(schema)
    names = [f.name for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        step = work()
        for batch in batches:
            got = step({n: c for n, c in zip(batch.schema.names, batch.columns, strict=True)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(got[n], arrow.field(n).type) if not isinstance(got[n], pa.Array) else got[n] for n in names],
                schema=arrow)

    return df.mapInArrow(run, out)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Text without wider characters takes the built-in, which agrees there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))
