"""Durable intermediate tables."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="thermolane-")
        root = _local_roots[context.applicationId]
    return root.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and lets later readers prune columns. The
    files also give Catalyst the true size, so it broadcasts the table only when it is small.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/thermolane/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
