"""Clean control logs and power logs."""

from pyspark.sql import Column, DataFrame, functions as F

from thermolane.constants import OUTLIER_SIGMAS
from thermolane.functions.temporal import local_minute, time_column
from thermolane.operators import cleaning
from thermolane.sources.staging import stage


def standardize(df: DataFrame, headings: dict) -> DataFrame:
    """Rename raw headings to working names; other columns keep theirs.

    The time column is found by its name: an exact one first, else one containing "datetime".
    """
    present = {h: n for h, n in headings.items() if h in df.columns}
    when = time_column(df)
    if when and "ts" not in present.values():
        present[when] = "ts"
    return df.withColumnsRenamed(present)


def to_local_minutes(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, local_minute(F.col(ts)))


def clean_control_log(
    readings: DataFrame,
    source: Column,
    sigmas: float = OUTLIER_SIGMAS,
    keys=("ts", "unit"),
    durable: bool = True,
) -> DataFrame:
    """Floor to local minutes, de-duplicate, drop outliers, put time first.

    Linear interpolation would come next, but the outlier test has dropped every row whose
    temperature is null, so it has nothing to fill and is left out. The de-duplicated rows
    are read once per outlier column and once for the result; `durable` stages them so that
    the shuffle runs once.
    """
    minutes = to_local_minutes(readings)
    unique = (
        cleaning.drop_duplicates_prefer_on(minutes, keys, source)
        if "on_off" in readings.columns
        else cleaning.drop_duplicates_keep_first(minutes, keys, source)
    )
    if durable:
        unique = stage(unique, "control-unique")
    kept = cleaning.drop_outliers(unique, ["indoor_temp", "outdoor_temp"], sigmas)
    return cleaning.time_first(kept)


def clean_power_log(
    readings: DataFrame,
    source: Column,
    sigmas: float = OUTLIER_SIGMAS,
    keys=("ts", "mesh_id"),
    durable: bool = True,
) -> DataFrame:
    """Floor, keep the first row per (time, meter), sum phases, drop outliers, fill with 0."""
    unique = cleaning.drop_duplicates_keep_first(to_local_minutes(readings), keys, source)
    if durable:
        unique = stage(unique, "power-unique")
    kept = cleaning.drop_outliers(cleaning.add_total_kwh(unique), ["total_kwh"], sigmas)
    return cleaning.time_first(kept.fillna(0, ["phase_a", "total_kwh"]))
