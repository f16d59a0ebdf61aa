"""Hourly rollups, power and weather aggregates, and joins with equipment dimensions."""

from pyspark.sql import DataFrame, Window, functions as F

from thermolane.constants import CATEGORY_CODES, WEATHER_ALIASES
from thermolane.functions import categories as cat
from thermolane.functions.numeric import MEAN2_DIGITS, steady, steady_mean

ZONE_KEYS = ["site", "zone"]


def _code_counts(column: str):
    """One counter per code of a category; counters sum, so they combine map-side."""
    return [
        F.expr(f"count_if({column} = {code}) AS {column}_{code}")
        for code in CATEGORY_CODES[column].values()
    ]


def _summed_counts(column: str):
    return [F.expr(f"sum({n}) AS {n}") for n in _count_names(column)]


def _count_names(column: str):
    return [f"{column}_{code}" for code in CATEGORY_CODES[column].values()]


def _commonest_code(column: str):
    """Code with the highest counter, the lowest code on ties, null when nothing was counted."""
    counts = F.array(*_count_names(column))
    top = F.array_max(counts)
    codes = F.expr(f"array({', '.join(str(c) for c in CATEGORY_CODES[column].values())})")
    return F.when(top > 0, F.element_at(codes, F.array_position(counts, top).cast("int"))).alias(
        column
    )


def _commonest_value(column: str, weight: str):
    """Value with the highest weight, the lowest value on ties; null values do not compete."""
    order = F.struct(F.col(weight), (-F.col(column)).alias("low_first"))
    return F.max_by(column, F.when(F.col(column).isNotNull(), order)).alias(column)


# The commonest value of a group is found by counting, not with the `mode` aggregate: its
# hash-map buffers are serialised for every group and task, which dominates the rollup. Here
# categories become counters, the set point a grouping key, and plain hash aggregation does
# the rest; a second, small aggregation picks the winner.


def unit_hours(readings: DataFrame, keys=("site", "unit")) -> DataFrame:
    """One row per unit and hour: commonest set point, mode and fan, mean room, ever on.

    This is the only step that shuffles raw readings, and it combines them map-side first.
    """
    hour = F.date_trunc("hour", "ts").alias("ts")
    by_set_point = readings.groupBy(*keys, hour, "set_temp").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum("indoor_temp").alias("indoor_sum"),
        F.count("indoor_temp").alias("indoor_n"),
        F.max("on_off").alias("on_off"),
        *_code_counts("mode"),
        *_code_counts("fan_speed"),
    )
    return (
        by_set_point.groupBy(*keys, "ts")
        .agg(
            _commonest_value("set_temp", "samples"),
            steady(F.try_divide(F.sum("indoor_sum"), F.sum("indoor_n"))).alias("indoor_temp"),
            F.max("on_off").alias("on_off"),
            F.sum("samples").alias("samples"),
            *_summed_counts("mode"),
            *_summed_counts("fan_speed"),
        )
        .select(
            *keys,
            "ts",
            "set_temp",
            "indoor_temp",
            "on_off",
            _commonest_code("mode"),
            _commonest_code("fan_speed"),
            "samples",
        )
    )


def zone_hours(units: DataFrame) -> DataFrame:
    """One row per zone and hour; units_on counts the units that ran.

    The zone's mode is the mode of its first unit by name.
    """
    by_set_point = units.groupBy(*ZONE_KEYS, "ts", "set_temp").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("indoor_temp").alias("indoor_sum"),
        F.count("indoor_temp").alias("indoor_n"),
        F.sum("on_off").alias("units_on"),
        F.min(F.struct("unit", "mode")).alias("first_unit"),
        *_code_counts("fan_speed"),
    )
    return (
        by_set_point.groupBy(*ZONE_KEYS, "ts")
        .agg(
            _commonest_value("set_temp", "units"),
            steady(F.try_divide(F.sum("indoor_sum"), F.sum("indoor_n")), MEAN2_DIGITS).alias(
                "indoor_temp"
            ),
            F.sum("units_on").cast("int").alias("units_on"),
            F.min("first_unit").alias("first_unit"),
            *_summed_counts("fan_speed"),
        )
        .select(
            *ZONE_KEYS,
            "ts",
            "set_temp",
            "indoor_temp",
            "units_on",
            F.col("first_unit.mode").alias("mode"),
            _commonest_code("fan_speed"),
        )
    )


def max_samples_per_unit_hour(units: DataFrame) -> DataFrame:
    return units.groupBy(*ZONE_KEYS).agg(F.max("samples").alias("max_samples"))


def with_status(zones: DataFrame) -> DataFrame:
    status = cat.status_code(F.col("units_on"), F.col("mode"))
    return zones.withColumns({"status": status, "operation_status": status})


def zones_without_readings(hours: DataFrame, zones: DataFrame, filled: DataFrame) -> DataFrame:
    """Hourly default rows for zones that have no reading at all.

    `hours` holds the distinct (site, ts) of all readings; the result has one row per empty
    zone and hour of its site, which is what the table must contain.
    """
    empty = zones.select(*ZONE_KEYS).distinct().join(
        filled.select(*ZONE_KEYS).distinct(), ZONE_KEYS, "left_anti"
    )
    return hours.join(empty, "site").select(
        *ZONE_KEYS,
        "ts",
        F.expr("CAST(NULL AS DOUBLE) AS set_temp"),
        F.expr("CAST(NULL AS DOUBLE) AS indoor_temp"),
        *[F.lit(0).alias(c) for c in ("units_on", "mode", "fan_speed")],
    )


def with_zone(rows: DataFrame, equipment: DataFrame) -> DataFrame:
    """Attach the zones of each unit; a unit in two zones gives two rows, unlisted units go.

    Join unit hours, not raw readings: settings of a unit do not depend on its zone. No hint:
    Catalyst broadcasts the equipment table when its size is below the threshold and
    otherwise sort-merges, where adaptive execution splits hot units.
    """
    units = equipment.select(
        "site", "zone", F.col("indoor_unit").alias("unit")
    ).distinct()
    return rows.join(units, ["site", "unit"])


def coded(readings: DataFrame, fill_nulls: bool = True) -> DataFrame:
    """Category labels to codes, then the switch to 0/1."""
    codes = {
        c: cat.category_code(F.col(c), c, fill_nulls)
        for c in ("on_off", "mode", "fan_speed")
        if c in readings.columns
    }
    if "on_off" in codes:
        codes["on_off"] = (F.coalesce(codes["on_off"], F.lit(0)) > 0).cast("int")
    return readings.withColumns(codes)


def meter_choices(outdoor: DataFrame) -> DataFrame:
    """Meters an outdoor unit may have: its own id (choice 0), else the part before "-" (1)."""
    ids = F.when(
        F.col("outdoor_unit").contains("-"),
        F.array(F.col("outdoor_unit"), F.substring_index("outdoor_unit", "-", 1)),
    ).otherwise(F.array("outdoor_unit"))
    return (
        outdoor.groupBy(*ZONE_KEYS, "outdoor_unit")
        .agg(F.max("load_share").alias("load_share"))
        .select("*", F.posexplode(ids).alias("choice", "mesh_id"))
    )


def zone_power(power: DataFrame, outdoor: DataFrame) -> DataFrame:
    """Hourly power of each zone: hourly sum per meter, times load share, summed.

    Readings are summed per meter and hour before the join, so the join sees hours only. An
    outdoor unit whose own id has readings uses them; the base id is for units without any.
    The best choice is found over the hours of one outdoor unit, so power is read once.
    """
    hourly = power.groupBy(
        "site",
        F.col("mesh_id").cast("string").alias("mesh_id"),
        F.date_trunc("hour", "ts").alias("ts"),
    ).agg(F.sum("total_kwh").alias("kwh"))
    unit = Window.partitionBy(*ZONE_KEYS, "outdoor_unit")
    return (
        hourly.join(meter_choices(outdoor), ["site", "mesh_id"])
        .withColumn("best", F.min("choice").over(unit))
        .where("choice = best")
        .groupBy(*ZONE_KEYS, "ts")
        .agg(steady(F.sum(F.col("kwh") * F.col("load_share")), 4).alias("adjusted_power"))
    )


def standard_weather(weather: DataFrame) -> DataFrame:
    """Rename weather headings to the working names."""
    out = weather
    for name, aliases in WEATHER_ALIASES.items():
        found = next((a for a in aliases if a in out.columns), None)
        if found and found != name:
            out = out.withColumnRenamed(found, name)
    for time in ("datetime", "Datetime", "measured_at"):
        if time in out.columns and "ts" not in out.columns:
            out = out.withColumnRenamed(time, "ts")
    return out


def hourly_weather(weather: DataFrame) -> DataFrame:
    """Hourly mean of every weather measure present."""
    measures = [c for c in WEATHER_ALIASES if c in weather.columns]
    return weather.groupBy("site", F.date_trunc("hour", "ts").alias("ts")).agg(
        *[steady_mean(F.col(c)).alias(c) for c in measures]
    )


def with_holiday(df: DataFrame, holidays: DataFrame = None) -> DataFrame:
    """is_holiday from a table of holiday dates; without one every day is 0."""
    if holidays is None:
        return df.withColumn("is_holiday", F.lit(0))
    days = holidays.select("date").distinct().withColumn("__h", F.lit(1))
    return (
        df.join(days, "date", "left")
        .withColumn("is_holiday", F.coalesce("__h", F.lit(0)))
        .drop("__h")
    )


def value_counts(df: DataFrame, keys, column: str) -> DataFrame:
    return df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))


def unmapped_report(df: DataFrame, column: str, kind: str, keys=()) -> DataFrame:
    """Labels that have no code, with counts; nulls are not labels."""
    return (
        df.where(F.col(column).isNotNull() & cat.lookup_code(F.col(column), kind).isNull())
        .groupBy(*keys, F.col(column).cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def date_span(df: DataFrame, keys=(), ts: str = "ts") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
