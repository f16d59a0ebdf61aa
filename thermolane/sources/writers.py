"""Sinks: CSV, tables, partitioned storage, upsert by keys, and plan outputs."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from thermolane.sources import stored

PARTITION_UNITS = {"DAY": "day", "HOUR": "hour", "MONTH": "month"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    # Spark trims text in CSV output unless told not to.
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_newest_first(df: DataFrame, path: str, ts: str = "ts") -> None:
    """CSV export sorted by time, newest first (a range sort, one task per range)."""
    write_csv(df.orderBy(F.col(ts).desc()), path)


def write_table(df: DataFrame, name: str, if_exists: str = "append") -> None:
    """Save as a catalog table: `replace`, `append` or `fail`."""
    modes = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
    df.write.mode(modes[if_exists]).saveAsTable(name)


def partition_name(ts, unit: str):
    """Storage partition of a UTC time: its day, hour or month as text that sorts by time."""
    if unit not in PARTITION_UNITS:
        raise ValueError(f"partition unit must be one of {list(PARTITION_UNITS)}, got {unit}")
    start = F.date_trunc(PARTITION_UNITS[unit], ts)
    return F.date_format(start, "yyyy-MM-dd-HH" if unit == "HOUR" else "yyyy-MM-dd")


def with_partition(df: DataFrame, ts: str, unit: str) -> DataFrame:
    """Add the storage partition `part` of the UTC time `ts`."""
    return df.withColumn("part", partition_name(F.col(ts), unit))


def write_partitioned(
    df: DataFrame, path: str, ts: str, unit: str = "DAY", cluster_by=(), mode: str = "overwrite"
) -> None:
    """Parquet partitioned by time and sorted inside files by the cluster columns.

    Rows are rebalanced by partition: adaptive execution gives small partitions one writer
    and splits a partition that holds most of the rows over many.
    """
    (
        _balanced(with_partition(df, ts, unit), cluster_by)
        .write.mode(mode)
        .partitionBy("part")
        .parquet(path)
    )


def _balanced(parts: DataFrame, cluster_by) -> DataFrame:
    return parts.hint("rebalance", F.col("part")).sortWithinPartitions("part", *cluster_by)


def merged_rows(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Target without the keys of the batch, plus every row of the batch; columns by name."""
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch, allowMissingColumns=True)


def upsert(
    batch: DataFrame, path: str, keys, ts: str, unit: str = "DAY", newest_by=None, batch_of=None
) -> bool:
    """Replace rows with equal keys and add the rest; the same batch twice changes nothing.

    The time must be one of the keys, so a row and its replacement share a partition: only
    partitions the batch touches are read, and new versions of them are written; the table
    changes in one step (see `sources.stored`, also for `newest_by` and `batch_of`). Columns
    new in the batch become columns of the table; columns it lacks are null in its rows.
    Partition names come from UTC on both sides. Says whether the batch was taken.
    """
    missing = [k for k in keys if k not in batch.columns]
    if missing:
        raise ValueError(f"key columns not in batch: {missing}")
    if ts not in keys:
        raise ValueError(f"the time column {ts} must be one of the keys")
    cluster = [k for k in keys if k != ts]
    parts = with_partition(batch, ts, unit)
    return stored.change(parts, path, keys, lambda df: _balanced(df, cluster), newest_by, batch_of)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored table with all its columns; `part` stays text, so equal names compare equal."""
    return stored.read(spark, path)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path).drop("part")


def write_plans(zone_wide: DataFrame, zone_long: DataFrame, units: DataFrame, path: str, run_id: str):
    """The three plan outputs of a run; stored by run, so a repeated run replaces itself."""
    for kind, df in (
        ("zone_schedule", zone_wide),
        ("zone_schedule_long", zone_long),
        ("unit_schedule", units),
    ):
        df.write.mode("overwrite").parquet(f"{path}/{kind}/run_id={run_id}")
