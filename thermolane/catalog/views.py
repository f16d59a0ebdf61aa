"""The given tables seen as sensor data, in Spark and in SQL.

Every row of the source tables is used. A user is a unit; zones and sites are groups of
users; `props.k` supplies set points, modes and gaps.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from thermolane.constants import CATEGORY_CODES, DEFAULT_CODES
from thermolane.operators.cleaning import add_total_kwh
from thermolane.operators.matching import before_forecast, in_forecast
from thermolane.operators.rollup import hourly_weather
from thermolane.plans.features import zone_features
from thermolane.plans.master import equipment
from thermolane.sources.staging import stage

#: The plan is made on the day three days before the last one that the data has.
FORECAST_FROM_SQL = "(SELECT date_trunc('day', max(ts)) - INTERVAL 3 DAY FROM events)"


def once(build):
    """Keep the frame a view builds (its plan, not its data) for later calls of a session."""
    kept = {}

    def view(spark, sf_dir, *args):
        key = (id(spark), sf_dir, *args)
        if key not in kept or kept[key][0] is not spark:
            kept[key] = (spark, build(spark, sf_dir, *args))
        return kept[key][1]

    return view


@once
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@once
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.col("user_id") % 5
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.concat(F.lit("S"), (zone % 2).cast("string")).alias("site"),
        F.concat(F.lit("Z"), zone.cast("string")).alias("zone"),
    )


EVENTS_SQL = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(props->>'$.k' AS INTEGER) AS k,
         'S' || ((user_id % 5) % 2) AS site, 'Z' || (user_id % 5) AS zone
  FROM events
)"""


@once
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control log: labels as text, with unknown labels and nulls."""
    e = events(spark, sf_dir)
    k = F.col("k")
    return e.select(
        "event_id",
        "ts",
        "site",
        "zone",
        F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("unit"),
        F.when(k % 11 != 0, F.col("value")).alias("indoor_temp"),
        F.when(k % 17 != 0, 10 + k * 0.25).alias("outdoor_temp"),
        (16 + k % 15).cast("double").alias("set_temp"),
        F.when(F.col("event_type") == "error", "OFF").otherwise("ON").alias("on_off"),
        F.element_at(F.array(*[F.lit(x) for x in ("off", "COOL", " Heat", "FAN")]), k % 4 + 1).alias(
            "mode"
        ),
        F.when(F.col("event_type") == "click", "Low")
        .when(F.col("event_type") == "view", "High")
        .when(F.col("event_type") == "signup", "medium")
        .when(F.col("event_type") == "purchase", "Turbo")
        .alias("fan_speed"),
    )


READINGS_SQL = (
    EVENTS_SQL
    + """,
readings AS (
  SELECT event_id, ts, site, zone, 'U-' || user_id AS unit,
         CASE WHEN k % 11 <> 0 THEN value END AS indoor_temp,
         CASE WHEN k % 17 <> 0 THEN 10 + k * 0.25::DOUBLE END AS outdoor_temp,
         CAST(16 + k % 15 AS DOUBLE) AS set_temp,
         CASE WHEN event_type = 'error' THEN 'OFF' ELSE 'ON' END AS on_off,
         CASE k % 4 WHEN 0 THEN 'off' WHEN 1 THEN 'COOL' WHEN 2 THEN ' Heat' ELSE 'FAN' END AS mode,
         CASE event_type WHEN 'click' THEN 'Low' WHEN 'view' THEN 'High'
              WHEN 'signup' THEN 'medium' WHEN 'purchase' THEN 'Turbo' END AS fan_speed
  FROM ev
)"""
)


@once
def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(
        "event_id",
        "ts",
        "site",
        (F.col("user_id") % 20).alias("mesh_id"),
        (F.col("event_id") % 3).alias("pm_addr_id"),
        F.col("value").alias("phase_a"),
        F.col("k").cast("double").alias("phase_b"),
        F.when(F.col("k") % 7 != 0, F.lit(1.5)).alias("phase_c"),
    )


POWER_SQL = """,
power AS (
  SELECT event_id, ts, site, user_id % 20 AS mesh_id, event_id % 3 AS pm_addr_id,
         value AS phase_a, CAST(k AS DOUBLE) AS phase_b,
         CASE WHEN k % 7 <> 0 THEN 1.5::DOUBLE END AS phase_c
  FROM ev
)"""

TOTAL_KWH_SQL = "(coalesce(phase_a, 0) + coalesce(phase_b, 0) + coalesce(phase_c, 0))"


@once
def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather samples of a site."""
    return events(spark, sf_dir).select(
        "site",
        "ts",
        F.col("value").alias("outdoor_temp"),
        (F.col("k") * 1.0).alias("outdoor_humidity"),
        (F.col("k") * 8.0).alias("solar_radiation"),
    )


WEATHER_SQL = """,
weather AS (
  SELECT site, ts, value AS outdoor_temp, k * 1.0::DOUBLE AS outdoor_humidity,
         k * 8.0::DOUBLE AS solar_radiation
  FROM ev
)"""


@once
def master_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equipment master: one row per indoor unit. Outdoor ids name a meter, some with a suffix."""
    users = events(spark, sf_dir).select("site", "zone", "user_id").distinct()
    m = F.col("user_id") % 20
    suffix = F.when(m.between(5, 9), "-1,").when(m >= 15, "-2").otherwise("")
    return users.select(
        "site",
        F.concat(F.lit(" "), F.col("zone")).alias("zone"),
        F.concat(m.cast("string"), suffix).alias("outdoor_unit"),
        F.concat(F.lit("U-"), F.col("user_id").cast("string")).alias("indoor_unit"),
        F.when(m < 5, F.lit(0.5)).alias("load_share"),
    )


EQUIPMENT_SQL = """,
equipment AS (
  SELECT DISTINCT site, zone,
         (user_id % 20) || CASE WHEN user_id % 20 BETWEEN 5 AND 9 THEN '-1'
                                WHEN user_id % 20 >= 15 THEN '-2' ELSE '' END AS outdoor_unit,
         'U-' || user_id AS indoor_unit,
         CASE WHEN user_id % 20 < 5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS load_share
  FROM ev
)"""

# Settings as (zone, month label, start, end, comfort_min, comfort_max, setpoint_min,
# setpoint_max, fan candidates, operation type).
SETTINGS = [
    ("Z0", "1月", "08:00", "18:00:00 x", 20.0, 24.0, 19.0, 27.0, "Low, High", "cool"),
    ("Z1", "1月", None, "21:30", 21.0, None, None, 26.0, None, "HEAT"),
    ("Z2", "1月", "09:30", None, None, None, 20.0, None, "auto,Turbo", "FAN"),
    ("Z3", "1月", "bad", "17:00", 22.0, 25.0, 21.0, 28.0, "Medium", None),
    ("Z0", "2月", "07:00", "19:00", 23.0, 26.0, 21.0, 28.0, "Low", "HEAT"),
    ("Z4", "13月", "07:00", "19:00", 23.0, 26.0, 21.0, 28.0, "Low", "HEAT"),
]
SETTING_COLUMNS = (
    "zone, month_label, start_time, end_time, comfort_min, comfort_max, setpoint_min, "
    "setpoint_max, fan_candidates, operation_type"
)


def _sql_value(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"


SETTING_VALUES = ", ".join("(" + ", ".join(_sql_value(v) for v in row) + ")" for row in SETTINGS)


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings master: the fixed rows for every site that has the zone."""
    fixed = spark.sql(f"SELECT * FROM VALUES {SETTING_VALUES} AS t({SETTING_COLUMNS})")
    zones = events(spark, sf_dir).select("site", "zone").distinct()
    return zones.join(fixed, "zone")


SETTINGS_SQL = f""",
fixed_settings({SETTING_COLUMNS}) AS (VALUES {SETTING_VALUES}),
settings AS (
  SELECT z.site, f.* FROM (SELECT DISTINCT site, zone FROM ev) z JOIN fixed_settings f USING (zone)
)"""


@once
def run_day(spark: SparkSession, sf_dir: str):
    """The day of the planning run: the forecast covers it and the three days after."""
    last = F.date_trunc("day", F.max("ts")) - F.expr("INTERVAL 3 DAY")
    return events(spark, sf_dir).agg(last.alias("day")).first().day


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather of the last four days, per site."""
    return hourly_weather(in_forecast(weather(spark, sf_dir), run_day(spark, sf_dir)))


def cut(x: str, digits: int = 8) -> str:
    """The library's `steady` in SQL."""
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits} + 0.0::DOUBLE)"


def cut2(x: str) -> str:
    """The library's cut for means of means in SQL."""
    return cut(x, 11)


def one_decimal(x: str) -> str:
    return f"(round_even(({x}) * 10.0::DOUBLE, 0) / 10.0::DOUBLE)"


def half(x: str) -> str:
    return f"(round_even(({x}) * 2.0::DOUBLE, 0) / 2.0::DOUBLE)"


def code(column: str, kind: str, fill_nulls: bool = True) -> str:
    """Category code in SQL."""
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CATEGORY_CODES[kind].items())
    known = f"CASE upper(trim({column})) {whens} ELSE {DEFAULT_CODES[kind]} END"
    return known if fill_nulls else f"CASE WHEN {column} IS NOT NULL THEN {known} END"


def mode_of(source: str, keys: str, column: str) -> str:
    """Commonest value per key, lowest on ties, in SQL."""
    return f"""(
  SELECT {keys}, {column} FROM (
    SELECT {keys}, {column},
           row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {column}) AS rn
    FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}, {column})
  WHERE rn = 1)"""


def forecast_sql() -> str:
    return f""",
forecast AS (
  SELECT site, date_trunc('hour', ts) AS ts, {cut('avg(outdoor_temp)')} AS outdoor_temp,
         {cut('avg(outdoor_humidity)')} AS outdoor_humidity,
         {cut('avg(solar_radiation)')} AS solar_radiation
  FROM weather WHERE ts >= {FORECAST_FROM_SQL} GROUP BY 1, 2
)"""


def features(spark: SparkSession, sf_dir: str, history_only: bool = False) -> DataFrame:
    """The zone feature table; `history_only` leaves the forecast days out."""
    def cut_off(df):
        return before_forecast(df, run_day(spark, sf_dir)) if history_only else df

    return zone_features(
        cut_off(readings(spark, sf_dir)).drop("zone"),
        add_total_kwh(cut_off(power(spark, sf_dir))),
        cut_off(weather(spark, sf_dir)),
        equipment(master_units(spark, sf_dir), split_names=(), split_units={}),
        normalize_names=False,
    )


@once
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored feature table of the history days, as the feature job leaves it.

    Written once per session and source folder.
    """
    return stage(features(spark, sf_dir, history_only=True), "features")


def hours_sql() -> str:
    """unit_hours, zone_hours and zone_power as CTEs over readings, power and equipment."""
    keys = "site, zone, ts, unit"
    zkeys = "site, zone, ts"
    return f""",
coded AS (
  SELECT r.site, e.zone, date_trunc('hour', r.ts) AS ts, r.unit, r.set_temp, r.indoor_temp,
         {code('r.on_off', 'on_off')} AS on_off, {code('r.mode', 'mode')} AS mode,
         {code('r.fan_speed', 'fan_speed')} AS fan_speed
  FROM readings r JOIN (SELECT DISTINCT site, zone, indoor_unit FROM equipment) e
    ON r.site = e.site AND r.unit = e.indoor_unit
),
unit_hours AS (
  SELECT b.site, b.zone, b.ts, b.unit, s.set_temp, b.indoor_temp, b.on_off, m.mode, f.fan_speed,
         b.samples
  FROM (SELECT {keys}, {cut('avg(indoor_temp)')} AS indoor_temp, max(on_off) AS on_off,
               count(*) AS samples FROM coded GROUP BY {keys}) b
  LEFT JOIN {mode_of('coded', keys, 'set_temp')} s USING ({keys})
  LEFT JOIN {mode_of('coded', keys, 'mode')} m USING ({keys})
  LEFT JOIN {mode_of('coded', keys, 'fan_speed')} f USING ({keys})
),
zone_hours AS (
  SELECT b.site, b.zone, b.ts, s.set_temp, b.indoor_temp, b.units_on, b.mode, f.fan_speed,
         CASE WHEN b.units_on <= 0 THEN 0 WHEN b.mode = 1 THEN 1 WHEN b.mode = 2 THEN 2 ELSE 3 END
           AS status
  FROM (SELECT {zkeys}, {cut2('avg(indoor_temp)')} AS indoor_temp,
               CAST(sum(on_off) AS INTEGER) AS units_on, arg_min(mode, unit) AS mode
        FROM unit_hours GROUP BY {zkeys}) b
  LEFT JOIN {mode_of('unit_hours', zkeys, 'set_temp')} s USING ({zkeys})
  LEFT JOIN {mode_of('unit_hours', zkeys, 'fan_speed')} f USING ({zkeys})
),
meters AS (SELECT DISTINCT site, CAST(mesh_id AS VARCHAR) AS mesh FROM power),
outdoor AS (
  SELECT site, zone, outdoor_unit, max(load_share) AS load_share FROM equipment GROUP BY 1, 2, 3
),
resolved AS (
  SELECT o.site, o.zone, o.load_share,
         CASE WHEN x.mesh IS NOT NULL THEN x.mesh
              WHEN contains(o.outdoor_unit, '-') THEN b.mesh END AS mesh
  FROM outdoor o
  LEFT JOIN meters x ON x.site = o.site AND x.mesh = o.outdoor_unit
  LEFT JOIN meters b ON b.site = o.site AND b.mesh = split_part(o.outdoor_unit, '-', 1)
),
zone_power AS (
  SELECT r.site, r.zone, date_trunc('hour', p.ts) AS ts,
         {cut('sum(' + TOTAL_KWH_SQL + ' * r.load_share)', 4)} AS adjusted_power
  FROM power p JOIN resolved r ON p.site = r.site AND CAST(p.mesh_id AS VARCHAR) = r.mesh
  GROUP BY 1, 2, 3
)"""


def features_sql(history_only: bool = False) -> str:
    """All CTEs up to `features`, starting with WITH."""
    where = f" WHERE ts < {FORECAST_FROM_SQL}" if history_only else ""
    base = READINGS_SQL + POWER_SQL + WEATHER_SQL + EQUIPMENT_SQL
    if history_only:
        # The forecast reads all weather, the history what came before it.
        base = base.replace("readings AS (", "readings_all AS (", 1)
        base = base.replace("power AS (", "power_all AS (", 1)
        base += f""",
readings AS (SELECT * FROM readings_all{where}),
power AS (SELECT * FROM power_all{where})"""
    return (
        "WITH "
        + base.lstrip()
        + hours_sql()
        + f""",
hourly_weather AS (
  SELECT site, date_trunc('hour', ts) AS ts, {cut('avg(outdoor_temp)')} AS outdoor_temp,
         {cut('avg(outdoor_humidity)')} AS outdoor_humidity,
         {cut('avg(solar_radiation)')} AS solar_radiation
  FROM weather{where} GROUP BY 1, 2
),
lagged AS (
  SELECT z.*, p.adjusted_power, w.outdoor_temp, w.outdoor_humidity, w.solar_radiation,
         coalesce(lag(z.indoor_temp) OVER (PARTITION BY z.site, z.zone ORDER BY z.ts),
                  z.indoor_temp) AS lag1
  FROM zone_hours z
  LEFT JOIN zone_power p USING (site, zone, ts)
  LEFT JOIN hourly_weather w USING (site, ts)
),
features AS (
  SELECT ts, CAST(ts AS DATE) AS date, site, zone, set_temp, {one_decimal('indoor_temp')} AS indoor_temp,
         units_on, mode, fan_speed, status, status AS operation_status, adjusted_power,
         {one_decimal('outdoor_temp')} AS outdoor_temp, outdoor_humidity, solar_radiation,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(month(ts) AS INTEGER) AS month,
         CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, 0 AS is_holiday,
         {one_decimal('lag1')} AS indoor_temp_lag1
  FROM lagged
)"""
    )
