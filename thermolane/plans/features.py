"""The zone-by-hour feature table and features derived from it."""

from pyspark.sql import DataFrame, Window, functions as F

from thermolane.constants import ZONE_ORDER
from thermolane.functions.names import normalize_unit_names
from thermolane.functions.numeric import MEAN2_DIGITS, round_half_even, steady, wet_bulb
from thermolane.functions.temporal import calendar_columns, hour_of_week
from thermolane.operators import ordered, rollup
from thermolane.sources.staging import stage

ZONE = ["site", "zone"]


def zone_features(
    readings: DataFrame,
    power: DataFrame,
    weather: DataFrame,
    equipment: DataFrame,
    holidays: DataFrame = None,
    code_labels: bool = True,
    normalize_names: bool = True,
    durable: bool = True,
) -> DataFrame:
    """One row per (site, zone, hour) with settings, power, weather, calendar and lag.

    Readings shrink to unit hours in the first shuffle; everything after it is hourly. The
    unit hours feed both the zones and the hours of empty zones: `durable` stores them, so
    that raw readings are read once.
    """
    if normalize_names:
        readings = normalize_unit_names(readings, "unit")
        equipment = normalize_unit_names(equipment, "indoor_unit")
    units = rollup.unit_hours(rollup.coded(readings) if code_labels else readings)
    if durable:
        units = stage(units, "unit-hours")
    filled = rollup.zone_hours(rollup.with_zone(units, equipment))
    hours = units.select("site", "ts").distinct()
    empty = rollup.zones_without_readings(hours, equipment, filled)
    zones = rollup.with_status(filled.unionByName(empty))
    joined = zones.join(rollup.zone_power(power, equipment), [*ZONE, "ts"], "left").join(
        rollup.hourly_weather(rollup.standard_weather(weather)), ["site", "ts"], "left"
    )
    return finish(rollup.with_holiday(calendar_columns(joined), holidays))


def finish(table: DataFrame) -> DataFrame:
    """Lag of the room temperature, then one decimal for temperatures."""
    lagged = ordered.lag_or_self(table, "indoor_temp", ZONE, "ts", "indoor_temp_lag1")
    rounded = {
        c: round_half_even(F.col(c), 1) for c in ("indoor_temp", "indoor_temp_lag1", "outdoor_temp")
    }
    rest = [c for c in lagged.columns if c not in ("ts", "date")]
    return lagged.withColumns(rounded).select("ts", "date", *rest)


def report_order(table: DataFrame, zones=ZONE_ORDER) -> DataFrame:
    """Zones in report order (unknown ones last), newest hour first."""
    place = F.array_position(F.array(*[F.lit(z) for z in zones]), F.col("zone"))
    rank = F.when(place > 0, place).otherwise(len(zones) + 1)
    return table.orderBy("site", rank, "zone", F.col("ts").desc())


def derived_features(table: DataFrame) -> DataFrame:
    """Lags, rolling means, differences, hour of week, on-run length and wet-bulb.

    All windows share one partitioning and order, so they take one shuffle and one sort. A
    zone has at most one row per calendar hour.
    """
    w = Window.partitionBy(*ZONE).orderBy("ts")
    out = {}
    for c in ("outdoor_temp", "outdoor_humidity", "adjusted_power"):
        if c not in table.columns:
            continue
        for k in (1, 24):
            out[f"{c}_lag{k}"] = F.lag(c, k).over(w)
        for n in (3, 24):
            out[f"{c}_rolling_mean{n}"] = steady(
                F.avg(c).over(w.rowsBetween(-(n - 1), 0)), MEAN2_DIGITS
            )
    out["hour_of_week"] = hour_of_week(F.col("ts"))
    out["temp_diff_outdoor_indoor"] = steady(F.col("outdoor_temp") - F.col("indoor_temp_lag1"))
    out["temp_diff_indoor_setpoint"] = steady(F.col("indoor_temp_lag1") - F.col("set_temp"))
    if "outdoor_humidity" in table.columns:
        out["wet_bulb_temp"] = steady(wet_bulb(F.col("outdoor_temp"), F.col("outdoor_humidity")))
    with_lags = table.withColumns(out)
    return ordered.run_lengths(with_lags, F.col("units_on") > 0, ZONE, "ts", "on_run_length")
