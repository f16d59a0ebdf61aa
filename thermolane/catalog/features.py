"""Hourly rollups, the zone feature table and derived features."""

from pyspark.sql import functions as F

from thermolane.catalog import views as V
from thermolane.functions import categories as cat, temporal
from thermolane.functions.numeric import round_half_even, round_to_half, steady, wet_bulb
from thermolane.operators import cleaning, ordered, rollup
from thermolane.plans import features as plan
from thermolane.plans.master import equipment

QUERIES, SQL = {}, {}


def _equipment(spark, d):
    return equipment(V.master_units(spark, d), split_names=(), split_units={})


def _unit_hours(spark, d):
    hours = rollup.unit_hours(rollup.coded(V.readings(spark, d)))
    return rollup.with_zone(hours, _equipment(spark, d))


def _power(spark, d):
    return cleaning.add_total_kwh(V.power(spark, d))


_HOURS = "WITH " + (V.READINGS_SQL + V.POWER_SQL + V.EQUIPMENT_SQL).lstrip() + V.hours_sql()

QUERIES["zone_feature_table"] = lambda s, d: V.features(s, d)
SQL["zone_feature_table"] = V.features_sql() + " SELECT * FROM features"

QUERIES["unit_hour_rollup"] = _unit_hours
SQL["unit_hour_rollup"] = _HOURS + " SELECT * FROM unit_hours"

QUERIES["zone_hour_features"] = lambda s, d: rollup.with_status(
    rollup.zone_hours(_unit_hours(s, d))
)
SQL["zone_hour_features"] = _HOURS + " SELECT *, status AS operation_status FROM zone_hours"

QUERIES["samples_per_unit_hour"] = lambda s, d: rollup.max_samples_per_unit_hour(
    _unit_hours(s, d)
)
SQL["samples_per_unit_hour"] = (
    _HOURS + " SELECT site, zone, max(samples) AS max_samples FROM unit_hours GROUP BY 1, 2"
)

QUERIES["zone_power_join"] = lambda s, d: (
    rollup.zone_hours(_unit_hours(s, d))
    .select("site", "zone", "ts", "units_on")
    .join(rollup.zone_power(_power(s, d), _equipment(s, d)), ["site", "zone", "ts"], "left")
)
SQL["zone_power_join"] = _HOURS + """
SELECT z.site, z.zone, z.ts, z.units_on, p.adjusted_power
FROM zone_hours z LEFT JOIN zone_power p USING (site, zone, ts)"""

QUERIES["weather_hourly_mean"] = lambda s, d: rollup.hourly_weather(
    rollup.standard_weather(
        V.weather(s, d).withColumnsRenamed(
            {"ts": "datetime", "outdoor_temp": "temperature C", "outdoor_humidity": "humidity"}
        )
    )
)
SQL["weather_hourly_mean"] = f"""WITH {(V.EVENTS_SQL + V.WEATHER_SQL).lstrip()}
SELECT site, date_trunc('hour', ts) AS ts, {V.cut('avg(outdoor_temp)')} AS outdoor_temp,
       {V.cut('avg(outdoor_humidity)')} AS outdoor_humidity,
       {V.cut('avg(solar_radiation)')} AS solar_radiation
FROM weather GROUP BY 1, 2"""


def _skeleton(spark, d):
    """Every site gets one more zone, whose unit never reports."""
    r = V.readings(spark, d)
    silent = r.select(
        "site",
        F.lit("Z9").alias("zone"),
        F.lit("x").alias("outdoor_unit"),
        F.concat(F.lit("silent-"), "site").alias("indoor_unit"),
        F.lit(1.0).alias("load_share"),
    ).distinct()
    hours = r.select("site", F.date_trunc("hour", "ts").alias("ts")).distinct()
    zones = _equipment(spark, d).unionByName(silent)
    return rollup.with_status(rollup.zones_without_readings(hours, zones, r))


QUERIES["skeleton_hours"] = _skeleton
SQL["skeleton_hours"] = f"""WITH {V.READINGS_SQL.lstrip()}
SELECT DISTINCT site, 'Z9' AS zone, date_trunc('hour', ts) AS ts, CAST(NULL AS DOUBLE) AS set_temp,
       CAST(NULL AS DOUBLE) AS indoor_temp, 0 AS units_on, 0 AS mode, 0 AS fan_speed, 0 AS status,
       0 AS operation_status
FROM readings"""

_DERIVED = [
    f"{c}_{x}"
    for c in ("outdoor_temp", "outdoor_humidity", "adjusted_power")
    for x in ("lag1", "lag24", "rolling_mean3", "rolling_mean24")
]
QUERIES["lag_rolling_features"] = lambda s, d: plan.derived_features(V.features(s, d)).select(
    "site",
    "zone",
    "ts",
    *_DERIVED,
    "hour_of_week",
    "temp_diff_outdoor_indoor",
    "temp_diff_indoor_setpoint",
)


def _derived_sql(c):
    w = "PARTITION BY site, zone ORDER BY ts"
    rolling = ", ".join(
        V.cut2(f"avg({c}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")
        + f" AS {c}_rolling_mean{n}"
        for n in (3, 24)
    )
    return (
        f"lag({c}, 1) OVER ({w}) AS {c}_lag1, lag({c}, 24) OVER ({w}) AS {c}_lag24, {rolling}"
    )


SQL["lag_rolling_features"] = (
    V.features_sql()
    + " SELECT site, zone, ts, "
    + ", ".join(_derived_sql(c) for c in ("outdoor_temp", "outdoor_humidity", "adjusted_power"))
    + f""", day_of_week * 24 + hour AS hour_of_week,
 {V.cut('outdoor_temp - indoor_temp_lag1')} AS temp_diff_outdoor_indoor,
 {V.cut('indoor_temp_lag1 - set_temp')} AS temp_diff_indoor_setpoint
FROM features"""
)

QUERIES["on_run_length"] = lambda s, d: ordered.run_lengths(
    V.features(s, d), F.col("units_on") > 1, ["site", "zone"], "ts", "on_run_length"
).select("site", "zone", "ts", "units_on", "on_run_length")
SQL["on_run_length"] = V.features_sql() + """,
marked AS (
  SELECT site, zone, ts, units_on,
         sum(CASE WHEN units_on > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY site, zone ORDER BY ts) AS brk
  FROM features)
SELECT site, zone, ts, units_on,
       CAST(sum(CASE WHEN units_on > 1 THEN 1 ELSE 0 END)
            OVER (PARTITION BY site, zone, brk ORDER BY ts) AS INTEGER) AS on_run_length
FROM marked"""

QUERIES["wet_bulb"] = lambda s, d: (
    rollup.hourly_weather(V.weather(s, d))
    .withColumn("wet_bulb_temp", steady(wet_bulb(F.col("outdoor_temp"), F.col("outdoor_humidity"))))
    .select("site", "ts", "outdoor_temp", "outdoor_humidity", "wet_bulb_temp")
)
SQL["wet_bulb"] = f"""WITH {(V.EVENTS_SQL + V.WEATHER_SQL).lstrip()},
h AS (SELECT site, date_trunc('hour', ts) AS ts, {V.cut('avg(outdoor_temp)')} AS t,
             {V.cut('avg(outdoor_humidity)')} AS u FROM weather GROUP BY 1, 2)
SELECT site, ts, t AS outdoor_temp, u AS outdoor_humidity,
  {V.cut('''t * atan(0.151977::DOUBLE * sqrt(u + 8.313659::DOUBLE)) + atan(t + u)
    - atan(u - 1.676331::DOUBLE) + 0.00391838::DOUBLE * pow(u, 1.5::DOUBLE)
    * atan(0.023101::DOUBLE * u) - 4.686035::DOUBLE''')} AS wet_bulb_temp
FROM h"""

QUERIES["calendar_features"] = lambda s, d: (
    temporal.calendar_columns(V.events(s, d).select("event_id", "ts"))
    .withColumn("month_label", temporal.month_label(F.col("month")))
    .withColumn("hour_of_week", temporal.hour_of_week(F.col("ts")))
)
SQL["calendar_features"] = """
SELECT event_id, ts, CAST(ts AS DATE) AS date, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month,
       CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, month(ts) || '月' AS month_label,
       CAST((isodow(ts) - 1) * 24 + hour(ts) AS INTEGER) AS hour_of_week
FROM events"""

QUERIES["rounding_half_even"] = lambda s, d: V.table(s, d, "lineitem").select(
    "l_orderkey",
    "l_linenumber",
    round_half_even(F.col("l_extendedprice") / 4, 1).alias("one_decimal"),
    round_to_half(F.col("l_quantity") / 4).alias("half_step"),
)
SQL["rounding_half_even"] = f"""
SELECT l_orderkey, l_linenumber, {V.one_decimal('l_extendedprice / 4')} AS one_decimal,
       {V.half('l_quantity / 4')} AS half_step
FROM lineitem"""


def _holidays(spark, d):
    """Holidays: days on which orders were placed for a top price."""
    o = V.table(spark, d, "orders")
    days = o.where("o_totalprice > 400000").select(F.to_date("o_orderdate").alias("date"))
    rows = V.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date")
    )
    return rollup.with_holiday(rows, days)


QUERIES["holiday_flag"] = _holidays
SQL["holiday_flag"] = """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN CAST(l_shipdate AS DATE) IN
         (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 400000)
       THEN 1 ELSE 0 END AS is_holiday
FROM lineitem"""

QUERIES["unit_membership"] = lambda s, d: rollup.with_zone(
    V.readings(s, d).select("event_id", "site", "unit"), _equipment(s, d)
)
SQL["unit_membership"] = (
    "WITH " + (V.READINGS_SQL + V.EQUIPMENT_SQL).lstrip() + """
SELECT r.event_id, r.site, r.unit, e.zone
FROM readings r JOIN (SELECT DISTINCT site, zone, indoor_unit FROM equipment) e
  ON e.site = r.site AND e.indoor_unit = r.unit"""
)

QUERIES["effective_on"] = lambda s, d: V.features(s, d).select(
    "site",
    "zone",
    "ts",
    cat.effective_on(F.col("units_on"), F.col("status")).alias("is_on"),
    cat.effective_on(F.col("units_on"), cat.units_label(F.col("units_on"))).alias("is_on_label"),
)
SQL["effective_on"] = V.features_sql() + """
SELECT site, zone, ts, units_on > 0 AND status > 0 AS is_on, units_on > 0 AS is_on_label
FROM features"""

QUERIES["off_spans"] = lambda s, d: ordered.off_spans(
    V.features(s, d), cat.effective_on(F.col("units_on") - 1, F.col("status")), ["site", "zone"]
)
SQL["off_spans"] = V.features_sql() + """,
m AS (SELECT site, zone, ts, units_on - 1 > 0 AND status > 0 AS on_,
             lead(ts) OVER (PARTITION BY site, zone ORDER BY ts) AS nxt,
             sum(CASE WHEN units_on - 1 > 0 AND status > 0 THEN 1 ELSE 0 END)
               OVER (PARTITION BY site, zone ORDER BY ts) AS grp
      FROM features)
SELECT site, zone, min(ts) AS span_start, max(coalesce(nxt, ts)) AS span_end, count(*) AS off_rows
FROM m WHERE NOT on_ GROUP BY site, zone, grp"""

QUERIES["median_interval"] = lambda s, d: ordered.sampling_interval(
    V.features(s, d), ["site", "zone"]
)
SQL["median_interval"] = V.features_sql() + """,
g AS (SELECT site, zone, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY site, zone ORDER BY ts)) AS us
      FROM features)
SELECT site, zone, CASE WHEN median(us / 1e6) > 0 THEN median(us / 1e6) ELSE 3600.0::DOUBLE END
  AS interval_seconds
FROM g GROUP BY 1, 2"""
