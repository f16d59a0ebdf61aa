"""Tables written to the folder that the cluster shares, used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Spark's setting for the size of the batches that go to Python, and the size within ``small_batches``.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    base = spark.conf.get(SETTING, None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError(f"set {SETTING} to a folder that the driver and all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return _local_roots[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs run inside send Python batches of ``BATCH_BYTES`` at most, or of a row if that is larger.

    An executor holds a batch twice for every task, in the JVM and in Python, and keeps that memory.
    """
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: short lineage, and a size that Spark knows."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "staged_path", None)
        if path:
            delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
