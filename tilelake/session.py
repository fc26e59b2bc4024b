"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tilelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Partition counts are left to the cluster: AQE coalesces small shuffles and splits skewed
    ones, so ``spark.sql.shuffle.partitions`` should be sized for the largest stage.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tilelake-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def _folders() -> ContextVar:
    """The scratch folders that are open here, outermost first.

    Made when first asked for: a module-level ContextVar would go with task code, and can't be pickled.
    """
    module = sys.modules[__name__]
    if not hasattr(module, "_open_folders"):
        module._open_folders = ContextVar("_open_folders", default=())
    return module._open_folders


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[None]:
    """Tables that ``materialize`` writes inside the block are removed at its end.

    What is needed afterwards must be written within the block with ``keep=True``; it goes to the
    folder of the block around, or stays where there is none. Blocks may be nested.
    """
    path = scratch_path(spark, label)
    token = _folders().set((*_folders().get(), path))
    try:
        yield
    finally:
        _folders().reset(token)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished queries now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    folders = _folders().get()
    if keep:
        folders = folders[:-1]
    return f"{folders[-1] if folders else shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table survives lost executors, fixes values that depend on partitioning, and
    lets later passes read only the columns they need. ``keep`` lets it outlast the innermost
    enclosing ``scratch_folder``.
    """
    path = scratch_path(df.sparkSession, label, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
