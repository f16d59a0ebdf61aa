"""Similar days, pattern choice and plans."""

from pyspark.sql import functions as F

from thermolane.catalog import views as V
from thermolane.constants import PLAN_SETTINGS
from thermolane.functions import categories as cat, temporal
from thermolane.operators import cleaning, matching, ordered, reshape, statistics
from thermolane.plans import master, planner
from thermolane.plans.planner import PlanOptions

QUERIES, SQL = {}, {}

ZONES = ["Z0", "Z1", "Z2", "Z3", "Z4"]
HOURS = (6, 21)
BLOCKS = PlanOptions(hour_range=HOURS)
DAYS = PlanOptions(block_hours=None, use_mode_priority=True)
OPEN = PlanOptions(use_operating_hours=True)


def _equipment(spark, d):
    return master.equipment(V.master_units(spark, d), split_names=(), split_units={})


def _types(spark, d):
    return master.operation_types(V.settings(spark, d), split_names=(), split_units={})


def _settings(spark, d):
    zones = V.events(spark, d).select("site", "zone")
    return master.zone_settings(zones, V.settings(spark, d), 1, split_names=(), split_units={})


def _history(spark, d):
    return planner.pattern_history(V.history(spark, d), V.forecast(spark, d))


def _scores(spark, d):
    return matching.day_scores(
        matching.daily_weather(_history(spark, d)), matching.forecast_days(V.forecast(spark, d))
    )


def _candidates(spark, d, options=DAYS):
    return planner.similar_day_candidates(
        _history(spark, d),
        planner.working_forecast(V.forecast(spark, d), options),
        _types(spark, d),
        options,
    )


def _plan(spark, d, options):
    plan = planner.plan_zones(
        V.history(spark, d),
        V.forecast(spark, d),
        _equipment(spark, d),
        _types(spark, d),
        _settings(spark, d),
        options,
    )
    return plan.withColumn("numb_units_on", F.col("numb_units_on").cast("double"))


def _matched(spark, d, options):
    hist, fc = _history(spark, d), planner.working_forecast(V.forecast(spark, d), options)
    patterns = planner.chosen_patterns(hist, fc, _types(spark, d), options)
    return planner.matched_hours(hist, fc, patterns, _settings(spark, d), options)


def _candidate_hours(spark, d):
    return matching.candidate_hours(
        _history(spark, d), _candidates(spark, d), matching.forecast_days(V.forecast(spark, d))
    )


def _block_hours(spark, d):
    fc = planner.working_forecast(V.forecast(spark, d), BLOCKS)
    return matching.block_hours(
        _history(spark, d), _candidates(spark, d, BLOCKS), matching.forecast_blocks(fc, 2)
    )


def _mode_list(op):
    return (
        f"CASE {op} WHEN 'COOL' THEN [1, 3] WHEN 'HEAT' THEN [2, 3] WHEN 'FAN' THEN [3] "
        f"WHEN 'OFF' THEN [0] END"
    )


def candidates_sql(hours=None) -> str:
    """CTEs up to `cand` (similar days after the mode filter) and `fc` (working forecast)."""
    cond = f"WHERE hour(ts) >= {hours[0]} AND hour(ts) < {hours[1]}" if hours else ""

    def z(x, name):
        return (
            f"CASE WHEN {name}_sd > 0 THEN ({x} - {name}_mean) / {name}_sd ELSE 0.0::DOUBLE END"
        )

    return (
        V.features_sql(history_only=True)
        + V.forecast_sql()
        + V.SETTINGS_SQL
        + f""",
hist AS (
  SELECT site, zone, ts, date, hour, set_temp, units_on, mode, fan_speed, adjusted_power,
         indoor_temp, outdoor_temp, solar_radiation
  FROM features
  WHERE indoor_temp IS NOT NULL AND adjusted_power > 0 AND outdoor_temp IS NOT NULL
    AND solar_radiation IS NOT NULL
),
fc AS (SELECT site, ts, CAST(ts AS DATE) AS fc_date, hour(ts) AS hour, outdoor_temp,
              solar_radiation FROM forecast {cond}),
daily AS (
  SELECT site, zone, date, {V.cut2('avg(outdoor_temp)')} AS temp,
         {V.cut2('avg(solar_radiation)')} AS solar
  FROM hist GROUP BY 1, 2, 3
),
daily_z AS (
  SELECT *, avg(temp) OVER w AS temp_mean, stddev_samp(temp) OVER w AS temp_sd,
         avg(solar) OVER w AS solar_mean, stddev_samp(solar) OVER w AS solar_sd
  FROM daily WINDOW w AS (PARTITION BY site, zone)
),
fc_days AS (
  SELECT site, fc_date, {V.cut2('avg(outdoor_temp)')} AS fc_temp,
         {V.cut2('avg(solar_radiation)')} AS fc_solar, count(DISTINCT hour) AS fc_n
  FROM fc GROUP BY 1, 2
),
scores AS (
  SELECT d.*, f.fc_date, f.fc_temp, f.fc_solar, f.fc_n,
         {V.cut(f"abs({z('temp', 'temp')} - {z('fc_temp', 'temp')}) + "
                f"abs({z('solar', 'solar')} - {z('fc_solar', 'solar')})")} AS score
  FROM daily_z d JOIN fc_days f USING (site)
),
top_days AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY site, zone, fc_date ORDER BY score NULLS LAST, date) AS rnk
    FROM scores) WHERE rnk <= 20
),
ops AS (
  SELECT site, zone, CAST(replace(month_label, '月', '') AS INTEGER) AS month,
         upper(trim(operation_type)) AS op
  FROM settings
  WHERE operation_type IS NOT NULL
    AND CAST(replace(month_label, '月', '') AS INTEGER) BETWEEN 1 AND 12
),
typed AS (
  SELECT t.*, o.op, {_mode_list('o.op')} AS allowed,
         CASE o.op WHEN 'COOL' THEN 1 WHEN 'HEAT' THEN 2 WHEN 'FAN' THEN 3 WHEN 'OFF' THEN 0 END AS target
  FROM top_days t LEFT JOIN ops o
    ON o.site = t.site AND o.zone = t.zone AND o.month = month(t.fc_date)
),
fit AS (
  SELECT t.*, EXISTS (SELECT 1 FROM hist h WHERE h.site = t.site AND h.zone = t.zone
                      AND h.date = t.date AND list_contains(t.allowed, h.mode)) AS fits
  FROM typed t
),
cand AS (
  SELECT * FROM (SELECT *, max(CASE WHEN fits THEN 1 ELSE 0 END)
                   OVER (PARTITION BY site, zone, fc_date) AS any_fits FROM fit)
  WHERE allowed IS NULL OR fits OR any_fits = 0
)"""
    )


def day_patterns_sql(priority=True) -> str:
    pr = "CASE WHEN target IS NOT NULL AND mode <> target THEN 1 ELSE 0 END" if priority else "0"
    firsts = ", ".join(
        f"arg_min({c}, ROW({pr}, adjusted_power, ts)) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in matching.PATTERN_COLUMNS
    )
    return f""",
coverage AS (
  SELECT c.site, c.zone, c.fc_date, c.date, c.rnk, c.op, c.allowed, c.target, c.fc_n,
         {V.cut2('avg(h.adjusted_power)')} AS avg_power, count(DISTINCT h.hour) AS available
  FROM cand c JOIN hist h USING (site, zone, date)
  JOIN (SELECT DISTINCT site, fc_date, hour FROM fc) f
    ON f.site = c.site AND f.fc_date = c.fc_date AND f.hour = h.hour
  GROUP BY ALL
),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, zone, fc_date
           ORDER BY fc_n - available, avg_power, rnk) AS rn FROM coverage) WHERE rn = 1
),
patterns AS (
  SELECT site, zone, fc_date, hour, {firsts},
         arg_min(ts, ROW({pr}, adjusted_power, ts)) AS hist_ts
  FROM (SELECT h.*, b.fc_date, b.allowed, b.target FROM hist h JOIN best b USING (site, zone, date)
        JOIN (SELECT DISTINCT site, fc_date, hour FROM fc) f
          ON f.site = b.site AND f.fc_date = b.fc_date AND f.hour = h.hour)
  WHERE allowed IS NULL OR list_contains(allowed, mode)
  GROUP BY site, zone, fc_date, hour
)"""


def block_patterns_sql() -> str:
    def gap(fc, hist, sd):
        return (
            f"CASE WHEN {sd} > 0 THEN abs({fc} - {hist}) / {sd} ELSE abs({fc} - {hist}) END"
        )

    return f""",
fc_hours AS (
  SELECT *, hour - row_number() OVER (PARTITION BY site, fc_date ORDER BY hour) AS island
  FROM (SELECT DISTINCT site, fc_date, hour FROM fc)
),
fc_pos AS (
  SELECT *, (row_number() OVER (PARTITION BY site, fc_date, island ORDER BY hour) - 1) // 2 AS chunk
  FROM fc_hours
),
fc_block AS (
  SELECT site, fc_date, hour,
         min(hour) OVER (PARTITION BY site, fc_date, island, chunk) AS block_start
  FROM fc_pos
),
block_weather AS (
  SELECT site, fc_date, block_start, {V.cut2('avg(outdoor_temp)')} AS bt,
         {V.cut2('avg(solar_radiation)')} AS bs, count(DISTINCT hour) AS bn
  FROM fc JOIN fc_block USING (site, fc_date, hour) GROUP BY 1, 2, 3
),
block_rows AS (
  SELECT h.*, c.fc_date, c.rnk, c.target, b.block_start
  FROM cand c JOIN hist h USING (site, zone, date)
  JOIN fc_block b ON b.site = c.site AND b.fc_date = c.fc_date AND b.hour = h.hour
  WHERE c.allowed IS NULL OR list_contains(c.allowed, h.mode)
),
block_days AS (
  SELECT site, zone, fc_date, block_start, date, rnk, avg(outdoor_temp) AS t,
         stddev_samp(outdoor_temp) AS tsd, avg(solar_radiation) AS s,
         stddev_samp(solar_radiation) AS ssd, {V.cut2('avg(adjusted_power)')} AS avg_power,
         count(DISTINCT hour) AS n
  FROM block_rows GROUP BY 1, 2, 3, 4, 5, 6
),
distances AS (
  SELECT d.site, d.zone, d.fc_date, d.block_start, d.date, d.rnk, d.avg_power,
    {V.cut(f'''(CASE WHEN block_start >= 17 OR block_start < 7 THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END)
      * {gap('bt', 't', 'tsd')}
      + (CASE WHEN block_start >= 17 OR block_start < 7 THEN 0.0::DOUBLE ELSE 0.3::DOUBLE END)
      * {gap('bs', 's', 'ssd')}''')} AS distance
  FROM block_days d JOIN block_weather w USING (site, fc_date, block_start)
  WHERE d.n = w.bn
),
best_block AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site, zone, fc_date, block_start
    ORDER BY distance NULLS LAST, avg_power, rnk) AS rn FROM distances) WHERE rn = 1
),
patterns AS (
  SELECT * EXCLUDE (rn, ts), ts AS hist_ts FROM (
    SELECT r.*, row_number() OVER (PARTITION BY r.site, r.zone, r.fc_date, r.hour
      ORDER BY CASE WHEN target IS NOT NULL AND mode <> target THEN 1 ELSE 0 END,
               adjusted_power, ts) AS rn
    FROM block_rows r JOIN best_block b USING (site, zone, fc_date, block_start, date))
  WHERE rn = 1
)"""


def _hour_sql(column, default):
    return (
        f"coalesce(TRY_CAST(split_part(split_part(coalesce({column}, '{default}'), ' ', 1), ':', 1)"
        f" AS INTEGER), {int(default[:2])})"
    )


def matched_sql(operating=False) -> str:
    inside = "f.hour >= w.open_hour AND f.hour < w.close_hour" if operating else "true"
    return f""",
open_hours AS (
  SELECT z.site, z.zone, coalesce({_hour_sql('s.start_time', '07:00')}, 7) AS open_hour,
         coalesce({_hour_sql('s.end_time', '20:00')}, 20) AS close_hour
  FROM (SELECT DISTINCT site, zone FROM ev) z
  LEFT JOIN (SELECT * FROM settings WHERE month_label = '1月') s USING (site, zone)
),
matched AS (
  SELECT z.site, z.zone, f.fc_date, f.hour, f.ts AS datetime,
         f.outdoor_temp AS forecast_outdoor_temp, f.solar_radiation AS forecast_solar_radiation,
         p.set_temp, p.units_on, p.mode, p.fan_speed, p.adjusted_power, p.indoor_temp,
         p.outdoor_temp, p.solar_radiation, p.hist_ts,
         CASE WHEN NOT ({inside}) THEN 'outside_hours' WHEN p.hist_ts IS NOT NULL THEN 'success'
              ELSE 'no_pattern' END AS outcome
  FROM (SELECT DISTINCT site, zone FROM hist) z JOIN fc f USING (site)
  JOIN open_hours w ON w.site = z.site AND w.zone = z.zone
  LEFT JOIN patterns p ON p.site = z.site AND p.zone = z.zone AND p.fc_date = f.fc_date
    AND p.hour = f.hour
)"""


_LABELS = {
    "mode": "CASE coalesce({c}, 0) WHEN 0 THEN 'OFF' WHEN 1 THEN 'COOL' WHEN 2 THEN 'HEAT' "
    "WHEN 3 THEN 'FAN' END",
    "fan": "CASE coalesce({c}, 0) WHEN 0 THEN 'AUTO' WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' "
    "WHEN 3 THEN 'HIGH' WHEN 4 THEN 'TOP' END",
}


def plan_sql(hours=None) -> str:
    """CTE `plan`; `raw_plan` is the plan before the idle-mode fix."""
    nulls = ""
    if hours:
        nulls = f"""
  UNION ALL
  SELECT f.ts, z.site, z.zone, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, f.outdoor_temp,
         f.solar_radiation, NULL, NULL, NULL
  FROM (SELECT DISTINCT site, zone FROM hist) z JOIN forecast f USING (site)
  WHERE hour(f.ts) < {hours[0]} OR hour(f.ts) >= {hours[1]}"""
    bad = """coalesce(mode IN ('COOL', 'HEAT')
              AND (ac_on_off = 'OFF' OR numb_units_on = 0 OR numb_units_on IS NULL), false)"""
    return f""",
caps AS (SELECT site, zone, CAST(count(*) AS INTEGER) AS cap FROM equipment GROUP BY 1, 2),
raw_plan AS (
  SELECT datetime, site, zone, set_temp, {_LABELS['mode'].format(c='mode')} AS mode,
         {_LABELS['fan'].format(c='fan_speed')} AS fan_speed,
         CAST(least(coalesce(units_on, 0), coalesce(cap, 0)) AS DOUBLE) AS numb_units_on,
         CASE WHEN least(coalesce(units_on, 0), coalesce(cap, 0)) > 0 THEN 'ON' ELSE 'OFF' END AS ac_on_off,
         adjusted_power AS power, indoor_temp, hist_ts AS hist_datetime_used,
         forecast_outdoor_temp, forecast_solar_radiation, outdoor_temp AS hist_outdoor_temp,
         solar_radiation AS hist_solar_radiation, indoor_temp AS hist_indoor_temp
  FROM matched LEFT JOIN caps USING (site, zone) WHERE outcome = 'success'{nulls}
),
plan AS (
  SELECT * REPLACE (CASE WHEN {bad} THEN 'FAN' ELSE mode END AS mode,
                    CASE WHEN {bad} THEN 'AUTO' ELSE fan_speed END AS fan_speed,
                    CASE WHEN {bad} THEN 0.0 ELSE power END AS power)
  FROM raw_plan
)"""


_BLOCK_PLAN = candidates_sql(HOURS) + block_patterns_sql() + matched_sql() + plan_sql(HOURS)
_DAY_PLAN = candidates_sql() + day_patterns_sql() + matched_sql() + plan_sql()
_OPEN_MATCHED = candidates_sql() + block_patterns_sql() + matched_sql(operating=True)

QUERIES["valid_patterns"] = lambda s, d: cleaning.valid_patterns(V.history(s, d)).select(
    "site", "zone", "ts", "indoor_temp", "adjusted_power", "outdoor_temp", "solar_radiation"
)
SQL["valid_patterns"] = candidates_sql() + """
SELECT site, zone, ts, indoor_temp, adjusted_power, outdoor_temp, solar_radiation FROM hist"""

QUERIES["daily_weather_zscore"] = lambda s, d: _scores(s, d).select(
    "site", "zone", "date", "fc_date", "temp", "solar", "fc_temp", "fc_solar", "score"
)
SQL["daily_weather_zscore"] = candidates_sql() + """
SELECT site, zone, date, fc_date, temp, solar, fc_temp, fc_solar, score FROM scores"""

QUERIES["similar_days_topn"] = lambda s, d: matching.similar_days(_scores(s, d), 20).drop("modes")
SQL["similar_days_topn"] = candidates_sql() + """
SELECT site, zone, fc_date, date, rnk AS rank, score FROM top_days"""

QUERIES["operation_type_filter"] = lambda s, d: _candidates(s, d).select(
    "site", "zone", "fc_date", "date", "rank", "operation_type"
)
SQL["operation_type_filter"] = candidates_sql() + """
SELECT site, zone, fc_date, date, rnk AS rank, op AS operation_type FROM cand"""

QUERIES["candidate_day_coverage"] = lambda s, d: matching.day_coverage(_candidate_hours(s, d))
SQL["candidate_day_coverage"] = candidates_sql() + day_patterns_sql() + """
SELECT site, zone, fc_date, date, rnk AS rank, avg_power, available AS available_hours,
       fc_n - available AS missing_hours, available / fc_n AS coverage_rate
FROM coverage"""

QUERIES["best_complete_day"] = lambda s, d: matching.whole_day_patterns(
    matching.best_day_hours(_candidate_hours(s, d)), prefer_target=True
)
SQL["best_complete_day"] = candidates_sql() + day_patterns_sql() + " SELECT * FROM patterns"

QUERIES["hour_blocks"] = lambda s, d: ordered.hour_blocks(
    V.events(s, d)
    .select("user_id", F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))
    .distinct(),
    ["user_id", "date"],
    2,
)
SQL["hour_blocks"] = """
WITH h AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS date, hour(ts) AS hour FROM events),
i AS (SELECT *, hour - row_number() OVER (PARTITION BY user_id, date ORDER BY hour) AS island FROM h),
p AS (SELECT *, (row_number() OVER (PARTITION BY user_id, date, island ORDER BY hour) - 1) // 2 AS chunk
      FROM i)
SELECT user_id, date, hour, min(hour) OVER (PARTITION BY user_id, date, island, chunk) AS block_start
FROM p"""

QUERIES["best_hour_block"] = lambda s, d: matching.best_blocks(
    matching.best_block_hours(_block_hours(s, d))
)
SQL["best_hour_block"] = candidates_sql(HOURS) + block_patterns_sql() + """
SELECT site, zone, fc_date, block_start, date, rnk AS rank, distance, avg_power FROM best_block"""

QUERIES["plan_long"] = lambda s, d: _plan(s, d, BLOCKS)
SQL["plan_long"] = _BLOCK_PLAN + " SELECT * FROM plan"

QUERIES["plan_long_whole_days"] = lambda s, d: _plan(s, d, DAYS)
SQL["plan_long_whole_days"] = _DAY_PLAN + " SELECT * FROM plan"

QUERIES["plan_wide"] = lambda s, d: reshape.plan_wide(_plan(s, d, BLOCKS), ZONES)
SQL["plan_wide"] = (
    _BLOCK_PLAN
    + "SELECT site, datetime, forecast_outdoor_temp, forecast_solar_radiation, "
    + ", ".join(
        f"any_value({c}) FILTER (WHERE zone = '{z}') AS \"{z}_{c}\""
        for z in ZONES
        for c in PLAN_SETTINGS
    )
    + " FROM plan GROUP BY 1, 2, 3, 4"
)

QUERIES["plan_roundtrip"] = lambda s, d: reshape.plan_long(
    reshape.plan_wide(_plan(s, d, DAYS), ZONES), ZONES
)
SQL["plan_roundtrip"] = (
    _DAY_PLAN
    + f"""
SELECT b.*, z.zone, {', '.join('p.' + c for c in PLAN_SETTINGS)}
FROM (SELECT DISTINCT site, datetime, forecast_outdoor_temp, forecast_solar_radiation FROM plan) b
CROSS JOIN (VALUES {', '.join(f"('{z}')" for z in ZONES)}) z(zone)
LEFT JOIN plan p ON p.site = b.site AND p.datetime = b.datetime AND p.zone = z.zone"""
)

_UNIT_PLAN = f""",
longs AS (
  SELECT b.site, b.datetime, z.zone, p.ac_on_off, p.mode, p.set_temp, p.fan_speed
  FROM (SELECT DISTINCT site, datetime FROM plan) b
  CROSS JOIN (VALUES {', '.join(f"('{z}')" for z in ZONES)}) z(zone)
  LEFT JOIN plan p ON p.site = b.site AND p.datetime = b.datetime AND p.zone = z.zone
),
unit_plan AS (
  SELECT l.site, l.datetime, e.indoor_unit AS unit, coalesce(ac_on_off, 'OFF') AS "OnOFF",
         CASE WHEN coalesce(ac_on_off, 'OFF') = 'OFF' THEN 'OFF' ELSE coalesce(mode, 'OFF') END AS "Mode",
         set_temp AS "SetTemp", fan_speed AS "FanSpeed"
  FROM longs l JOIN (SELECT DISTINCT site, zone, indoor_unit FROM equipment) e USING (site, zone)
)"""


def _unit_plan(spark, d):
    rows = reshape.plan_long(reshape.plan_wide(_plan(spark, d, BLOCKS), ZONES), ZONES)
    return reshape.unit_plan(rows, _equipment(spark, d), ZONES)


QUERIES["unit_plan"] = _unit_plan
SQL["unit_plan"] = _BLOCK_PLAN + _UNIT_PLAN + " SELECT * FROM unit_plan"


def _zone_unit_plan(spark, d):
    """Wide unit plan of one representative panel per zone, built from all equipment."""
    panels = (
        _equipment(spark, d)
        .groupBy("site", "zone")
        .agg(F.min("indoor_unit").alias("first_unit"))
        .select("site", "zone", F.concat(F.lit("P-"), "zone").alias("indoor_unit"))
    )
    plan = _plan(spark, d, BLOCKS)
    return reshape.unit_plan_wide(
        reshape.unit_plan(plan, panels, ZONES), [f"P-{z}" for z in ZONES]
    )


QUERIES["unit_plan_wide"] = _zone_unit_plan
SQL["unit_plan_wide"] = (
    _BLOCK_PLAN
    + ' SELECT site, strftime(datetime, \'%Y/%m/%d %H:%M\') AS "Date Time", '
    + ", ".join(
        f"any_value({x}) FILTER (WHERE zone = '{z}') AS \"P-{z}_{n}\""
        for z in ZONES
        for n, x in (
            ("OnOFF", "coalesce(ac_on_off, 'OFF')"),
            (
                "Mode",
                "CASE WHEN coalesce(ac_on_off, 'OFF') = 'OFF' THEN 'OFF' "
                "ELSE coalesce(mode, 'OFF') END",
            ),
            ("SetTemp", "set_temp"),
            ("FanSpeed", "fan_speed"),
        )
    )
    + " FROM plan GROUP BY 1, 2"
)

QUERIES["plan_run_stats"] = lambda s, d: planner.run_statistics(_matched(s, d, OPEN))
SQL["plan_run_stats"] = _OPEN_MATCHED + """
SELECT site, zone, count(*) AS total_hours,
       count(*) FILTER (WHERE outcome = 'outside_hours') AS outside_op_hours,
       count(*) FILTER (WHERE outcome = 'no_pattern') AS no_similar_patterns,
       count(*) FILTER (WHERE outcome = 'success') AS success,
       CASE WHEN count(*) FILTER (WHERE outcome <> 'outside_hours') > 0
            THEN count(*) FILTER (WHERE outcome = 'success')
                 / count(*) FILTER (WHERE outcome <> 'outside_hours') * 100.0::DOUBLE
            ELSE 0.0 END AS success_rate
FROM matched GROUP BY 1, 2"""

QUERIES["plan_corrections"] = lambda s, d: planner.correction_counts(
    planner.plan_rows(_matched(s, d, DAYS), _equipment(s, d))
)
SQL["plan_corrections"] = _DAY_PLAN + """
SELECT site, zone, count(*) AS corrections FROM raw_plan
WHERE mode IN ('COOL', 'HEAT') AND (ac_on_off = 'OFF' OR numb_units_on = 0)
GROUP BY 1, 2"""

QUERIES["plan_zone_counts"] = lambda s, d: (
    _plan(s, d, DAYS).groupBy("site", "zone").agg(F.count(F.lit(1)).alias("hours"))
)
SQL["plan_zone_counts"] = (
    _DAY_PLAN + " SELECT site, zone, count(*) AS hours FROM plan GROUP BY 1, 2"
)

QUERIES["operating_hours_filter"] = lambda s, d: (
    _matched(s, d, OPEN)
    .where("outcome <> 'outside_hours'")
    .select("site", "zone", "datetime", "outcome", F.col("hist_ts").alias("hist_datetime_used"))
)
SQL["operating_hours_filter"] = _OPEN_MATCHED + """
SELECT site, zone, datetime, outcome, hist_ts AS hist_datetime_used
FROM matched WHERE outcome <> 'outside_hours'"""

QUERIES["hour_range_null_rows"] = lambda s, d: (
    _plan(s, d, BLOCKS).where(F.col("ac_on_off").isNull())
)
SQL["hour_range_null_rows"] = _BLOCK_PLAN + " SELECT * FROM plan WHERE ac_on_off IS NULL"


def _recent(spark, d):
    """Ship dates as history; return flag A plays the zone whose history is limited."""
    rows = V.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "A", " Area 1").otherwise("Area 3").alias("zone"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )
    newest = (
        V.table(spark, d, "orders")
        .agg(F.max(F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 7 HOURS")))
        .scalar()
    )
    return cleaning.recent_history(rows, newest, "area 1", 12)


QUERIES["recency_filter"] = _recent
SQL["recency_filter"] = """
WITH r AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_returnflag = 'A' THEN ' Area 1' ELSE 'Area 3' END AS zone,
                  l_shipdate AS ts FROM lineitem)
SELECT * FROM r
WHERE NOT (lower(trim(zone)) = 'area 1' AND ts <
  (SELECT max(o_orderdate) + INTERVAL 7 HOUR - INTERVAL 12 MONTH FROM orders))"""

QUERIES["label_formats"] = lambda s, d: (
    statistics.label_codes(
        _plan(s, d, BLOCKS).select("site", "zone", "datetime", "mode", "numb_units_on"),
        "mode",
        "mode_code",
    )
    .withColumn("date_time", temporal.plan_time(F.col("datetime")))
    .withColumn("state", cat.units_label(F.col("numb_units_on")))
    .withColumn(
        "file_kind",
        temporal.schedule_file_parts(
            F.concat(
                F.lit("plans/zone_schedule_"), F.date_format("datetime", "yyyyMMdd"), F.lit("_1.csv")
            )
        )[0],
    )
    .withColumn(
        "file_date",
        temporal.schedule_file_parts(
            F.concat(F.lit("unit_schedule_"), F.date_format("datetime", "yyyyMMdd"), F.lit("_0"))
        )[1],
    )
)
SQL["label_formats"] = _BLOCK_PLAN + """
SELECT site, zone, datetime, mode, numb_units_on,
       coalesce((SELECT count(DISTINCT q.mode) FROM plan q WHERE q.mode < p.mode)
                + CASE WHEN p.mode IS NULL THEN -1 ELSE 0 END, -1) AS mode_code,
       strftime(datetime, '%Y/%m/%d %H:%M') AS date_time,
       CASE WHEN numb_units_on > 0 THEN 'ON' ELSE 'OFF' END AS state,
       'zone' AS file_kind, CAST(datetime AS DATE) AS file_date
FROM plan p"""

QUERIES["project_report_columns"] = lambda s, d: cleaning.time_first(
    cleaning.without_columns_like(reshape.plan_wide(_plan(s, d, DAYS), ZONES)), "datetime"
)
SQL["project_report_columns"] = (
    _DAY_PLAN
    + "SELECT site, datetime, CAST(datetime AS DATE) AS date, forecast_outdoor_temp, "
    + "forecast_solar_radiation, "
    + ", ".join(
        f"any_value({c}) FILTER (WHERE zone = '{z}') AS \"{z}_{c}\""
        for z in ZONES
        for c in PLAN_SETTINGS
        if not any(p in f"_{c}" for p in ("_hist_", "_power", "_indoor_temp"))
    )
    + " FROM plan GROUP BY 1, 2, 3, 4, 5"
)
