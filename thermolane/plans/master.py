"""Equipment and setting dimensions from the master tables."""

from pyspark.sql import DataFrame, functions as F

from thermolane import constants as C
from thermolane.functions import categories as cat
from thermolane.functions.names import clean_outdoor_unit
from thermolane.functions.temporal import clock_hour, month_label, month_number


def _split(zone, unit, names, parts):
    """Zone of a unit after splitting: units of a split zone in no part get null."""
    inside = zone.isin(list(names))
    part = F.lit(None).cast("string")
    for name, units in parts.items():
        part = F.when(unit.isin(list(units)), F.lit(name)).otherwise(part)
    return F.when(inside, part).otherwise(zone)


def equipment(
    master: DataFrame, split_names=C.SPLIT_ZONE_NAMES, split_units=C.SPLIT_ZONE_UNITS
) -> DataFrame:
    """(site, zone, outdoor_unit, indoor_unit, load_share); the share is 1 unless given."""
    rows = master.where(
        F.col("zone").isNotNull()
        & F.col("outdoor_unit").isNotNull()
        & F.col("indoor_unit").isNotNull()
    )
    share = F.col("load_share") if "load_share" in master.columns else F.lit(1.0)
    unit = F.col("indoor_unit").cast("string")
    return rows.select(
        "site",
        _split(F.trim("zone"), unit, split_names, split_units).alias("zone"),
        clean_outdoor_unit(F.col("outdoor_unit")).alias("outdoor_unit"),
        unit.alias("indoor_unit"),
        F.coalesce(share, F.lit(1.0)).alias("load_share"),
    ).where(F.col("zone").isNotNull())


def expand_split_zones(
    df: DataFrame, split_names=C.SPLIT_ZONE_NAMES, split_units=C.SPLIT_ZONE_UNITS
) -> DataFrame:
    """Give each part of a split zone the row of the whole zone."""
    zone = F.trim("zone")
    parts = F.array(*[F.lit(p) for p in split_units])
    return df.withColumn(
        "zone", F.explode(F.when(zone.isin(list(split_names)), parts).otherwise(F.array(zone)))
    )


def operation_types(settings: DataFrame, **split) -> DataFrame:
    """(site, zone, month, operation_type) of rows where all are known."""
    rows = settings.where(
        F.col("zone").isNotNull() & F.col("operation_type").isNotNull()
    ).withColumn("month", month_number(F.col("month_label")))
    return expand_split_zones(rows.where(F.col("month").isNotNull()), **split).select(
        "site", "zone", "month", F.upper(F.trim("operation_type")).alias("operation_type")
    )


def zone_settings(zones: DataFrame, settings: DataFrame, month: int, **split) -> DataFrame:
    """Settings of every zone for one month, with defaults for what the master lacks.

    If no zone has settings for the month, all zones get the general defaults. A zone
    without a row while others have one keeps null settings but default hours.
    """
    wanted = settings.where(
        (F.col("month_label") == month_label(F.lit(month))) & F.col("zone").isNotNull()
    )
    rows = expand_split_zones(wanted, **split).withColumn("__hit", F.lit(True))
    month_known = wanted.agg(F.count(F.lit(1)) > 0).scalar()
    joined = zones.select("site", "zone").distinct().join(rows, ["site", "zone"], "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    use_default = hit | ~month_known

    def setting(name):
        default = F.lit(C.SETTING_DEFAULTS[name])
        return F.coalesce(F.col(name), F.when(use_default, default)).alias(name)

    both = F.col("comfort_min").isNotNull() & F.col("comfort_max").isNotNull()
    middle = F.when(both, (F.col("comfort_min") + F.col("comfort_max")) / 2)
    fans = F.when(hit & F.col("fan_candidates").isNotNull(), F.split("fan_candidates", ","))
    return joined.select(
        "site",
        "zone",
        F.split(setting("start_time"), " ")[0].alias("start_time"),
        F.split(setting("end_time"), " ")[0].alias("end_time"),
        setting("comfort_min"),
        setting("comfort_max"),
        setting("setpoint_min"),
        setting("setpoint_max"),
        F.coalesce(
            middle, F.when(use_default, F.lit(C.SETTING_DEFAULTS["target_room_temp"]))
        ).alias("target_room_temp"),
        F.coalesce(
            fans,
            F.when(hit, _labels(C.ROW_FAN_CANDIDATES)),
            F.when(~month_known, _labels(C.DEFAULT_FAN_CANDIDATES)),
        ).alias("fan_candidates"),
        F.when(use_default, _labels(C.MODE_CANDIDATES)).alias("mode_candidates"),
    )


def _labels(values):
    return F.array(*[F.lit(v) for v in values])


def operating_hours(settings: DataFrame) -> DataFrame:
    """(site, zone, open_hour, close_hour); 7 and 20 where not readable."""
    return settings.select(
        "site",
        "zone",
        clock_hour(F.col("start_time"), C.DEFAULT_OPEN_HOUR).alias("open_hour"),
        clock_hour(F.col("end_time"), C.DEFAULT_CLOSE_HOUR).alias("close_hour"),
    )


def with_comfort_range(df: DataFrame, settings: DataFrame) -> DataFrame:
    """Attach comfort_min and comfort_max of the row's zone and month, 22 and 25 by default."""
    ranges = settings.select(
        "site",
        "zone",
        month_number(F.col("month_label")).alias("month"),
        F.col("comfort_min").alias("__lo"),
        F.col("comfort_max").alias("__hi"),
    ).dropDuplicates(["site", "zone", "month"])
    return (
        df.join(ranges, ["site", "zone", "month"], "left")
        .withColumn("comfort_min", F.coalesce("__lo", F.lit(C.SETTING_DEFAULTS["comfort_min"])))
        .withColumn("comfort_max", F.coalesce("__hi", F.lit(C.SETTING_DEFAULTS["comfort_max"])))
        .drop("__lo", "__hi")
    )


def unit_counts(equipment_table: DataFrame) -> DataFrame:
    """Number of indoor units per zone: the most that can run."""
    return equipment_table.groupBy("site", "zone").agg(
        F.count(F.lit(1)).cast("int").alias("max_units")
    )


def candidate_settings(settings: DataFrame) -> DataFrame:
    """Fan and mode candidates of a zone as codes."""
    return settings.withColumn(
        "fan_codes", cat.candidate_codes(F.col("fan_candidates"), "fan_speed")
    ).withColumn("mode_codes", cat.candidate_codes(F.col("mode_candidates"), "mode"))
