"""Cleaning operators and category codes."""

from pyspark.sql import functions as F

from thermolane.catalog import views as V
from thermolane.constants import AC_COLUMNS
from thermolane.functions import categories as cat, names
from thermolane.operators import cleaning, ordered, rollup
from thermolane.plans import preprocess

QUERIES, SQL = {}, {}

_R = "WITH " + V.READINGS_SQL.lstrip()
_P = "WITH " + (V.EVENTS_SQL + V.POWER_SQL).lstrip()


def _hourly_readings(spark, d):
    return V.readings(spark, d).withColumn("hour_ts", F.date_trunc("hour", "ts"))


QUERIES["clean_dedup_prefer_on"] = lambda s, d: cleaning.drop_duplicates_prefer_on(
    _hourly_readings(s, d), ["hour_ts", "unit"], F.col("event_id")
)
SQL["clean_dedup_prefer_on"] = _R + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, date_trunc('hour', ts) AS hour_ts,
         row_number() OVER (PARTITION BY date_trunc('hour', ts), unit
           ORDER BY CASE WHEN on_off = 'ON' THEN 1 ELSE 0 END DESC, event_id DESC) AS rn
  FROM readings) WHERE rn = 1"""

QUERIES["clean_outlier_sequential"] = lambda s, d: cleaning.drop_outliers(
    V.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    ),
    ["l_extendedprice", "l_quantity"],
    1.5,
)
SQL["clean_outlier_sequential"] = """
WITH a AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem
  WHERE abs(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))
        <= 1.5 * (SELECT stddev_samp(l_extendedprice) FROM lineitem))
SELECT * FROM a WHERE abs(l_quantity - (SELECT avg(l_quantity) FROM a))
                      <= 1.5 * (SELECT stddev_samp(l_quantity) FROM a)"""


def _interpolated(spark, d, keys):
    rows = V.readings(spark, d).select("event_id", "ts", "unit", "indoor_temp")
    out = ordered.interpolate_linear(rows, "indoor_temp", keys, ["ts", "event_id"])
    return out.withColumn("indoor_temp", F.rint(F.col("indoor_temp") * 1e8) / 1e8)


def _interpolation_sql(partition):
    return _R + f""",
n AS (SELECT event_id, ts, unit, indoor_temp AS x, row_number() OVER w AS i FROM readings
      WINDOW w AS ({partition} ORDER BY ts, event_id)),
g AS (SELECT *, last_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi,
             last_value(x IGNORE NULLS) OVER b AS px,
             first_value(CASE WHEN x IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni,
             first_value(x IGNORE NULLS) OVER a AS nx
      FROM n
      WINDOW b AS ({partition} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             a AS ({partition} ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, ts, unit,
       round_even(1e8 * coalesce(x, CASE WHEN nx IS NULL THEN px
         WHEN px IS NOT NULL THEN px + (nx - px) * (i - pi) / (ni - pi) END), 0) / 1e8 AS indoor_temp
FROM g"""


QUERIES["clean_interpolate"] = lambda s, d: _interpolated(s, d, ["unit"])
SQL["clean_interpolate"] = _interpolation_sql("PARTITION BY unit")

QUERIES["clean_interpolate_whole_frame"] = lambda s, d: _interpolated(s, d, [])
SQL["clean_interpolate_whole_frame"] = _interpolation_sql("")

QUERIES["conditional_ffill"] = lambda s, d: ordered.fill_forward_when(
    V.readings(s, d).select("event_id", "ts", "unit", "indoor_temp", "on_off"),
    ["indoor_temp"],
    F.col("on_off") == "OFF",
    ["unit"],
    ["ts", "event_id"],
)
SQL["conditional_ffill"] = _R + """
SELECT event_id, ts, unit, on_off,
       CASE WHEN bool_or(on_off = 'OFF' AND indoor_temp IS NULL) OVER (PARTITION BY unit)
            THEN last_value(indoor_temp IGNORE NULLS) OVER (PARTITION BY unit ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            ELSE indoor_temp END AS indoor_temp
FROM readings"""

QUERIES["clean_power_total"] = lambda s, d: cleaning.add_total_kwh(
    cleaning.drop_duplicates_keep_first(
        V.power(s, d).withColumn("hour_ts", F.date_trunc("hour", "ts")),
        ["hour_ts", "mesh_id"],
        F.col("event_id"),
    )
).fillna(0, ["phase_a", "phase_c"])
SQL["clean_power_total"] = _P + f"""
SELECT event_id, ts, site, mesh_id, pm_addr_id, coalesce(phase_a, 0) AS phase_a, phase_b,
       coalesce(phase_c, 0) AS phase_c, hour_ts, {V.TOTAL_KWH_SQL} AS total_kwh
FROM (SELECT *, date_trunc('hour', ts) AS hour_ts,
             row_number() OVER (PARTITION BY date_trunc('hour', ts), mesh_id ORDER BY event_id) AS rn
      FROM power) WHERE rn = 1"""

QUERIES["category_map_default"] = lambda s, d: V.readings(s, d).select(
    "event_id",
    cat.category_code(F.col("on_off"), "on_off").alias("on_off_code"),
    cat.category_code(F.col("mode"), "mode").alias("mode_code"),
    cat.category_code(F.col("fan_speed"), "fan_speed", True).alias("fan_code"),
    cat.category_code(F.col("fan_speed"), "fan_speed").cast("double").alias("fan_code_or_null"),
)
SQL["category_map_default"] = _R + f"""
SELECT event_id, {V.code('on_off', 'on_off')} AS on_off_code, {V.code('mode', 'mode')} AS mode_code,
       {V.code('fan_speed', 'fan_speed')} AS fan_code,
       CAST({V.code('fan_speed', 'fan_speed', False)} AS DOUBLE) AS fan_code_or_null
FROM readings"""

QUERIES["category_unmapped_report"] = lambda s, d: rollup.unmapped_report(
    V.readings(s, d), "fan_speed", "fan_speed", ["site", "zone"]
)
SQL["category_unmapped_report"] = _R + """
SELECT site, zone, fan_speed AS label, count(*) AS n FROM readings
WHERE upper(trim(fan_speed)) NOT IN ('AUTO', 'LOW', 'MEDIUM', 'HIGH', 'TOP')
GROUP BY 1, 2, 3"""

QUERIES["category_value_counts"] = lambda s, d: rollup.value_counts(
    V.readings(s, d), ["site", "zone"], "mode"
)
SQL["category_value_counts"] = _R + """
SELECT site, zone, mode, count(*) AS n FROM readings GROUP BY 1, 2, 3"""


def _names(spark, d):
    """Part names with full-width letters, wide blanks and several dashes."""
    raw = F.concat(
        F.translate("p_name", "abcdefgh ", "ａｂｃｄｅｆｇｈ　"),
        F.lit("–"),
        F.col("p_size").cast("string"),
        F.lit("ー−"),
        F.col("p_brand"),
    )
    rows = V.table(spark, d, "part").select("p_partkey", raw.alias("unit"))
    return names.normalize_unit_names(rows, "unit")


QUERIES["name_normalize"] = _names
SQL["name_normalize"] = """
SELECT p_partkey, replace(p_name, ' ', '') || '-' || p_size || '--' || p_brand AS unit FROM part"""


def _zone_names(spark, d):
    p = V.table(spark, d, "part")
    label = F.when(F.col("p_size") % 7 == 0, F.col("p_size").cast("string")).otherwise(
        F.concat(F.lit("12 "), F.col("p_name"), F.lit(" 3-"), F.col("p_brand"))
    )
    return p.select("p_partkey", names.zone_from_name(label).alias("zone"))


QUERIES["zone_from_name"] = _zone_names
SQL["zone_from_name"] = """
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'Unknown'
       ELSE regexp_extract(p_name, '([A-Za-z]+(?:\\s+[A-Za-z]+)*)', 1) END AS zone
FROM part"""


CODED = {"mode": "mode", "fan_speed": "fan_speed"}


def _zone_named(spark, d):
    """Units named after their fan speed; those without one tell no zone."""
    name = F.concat("event_id", F.col("fan_speed"))
    return V.readings(spark, d).select("event_id", name.alias("unit"), "mode", F.col("on_off").alias("fan_speed"))


def _zone_coded(spark, d):
    """Codes per zone taken from the unit name; rows of zone Unknown keep their labels out."""
    rows = cleaning.zone_category_codes(_zone_named(spark, d), CODED)
    zone = names.zone_from_name(F.col("unit"))
    code = F.when(zone != "Unknown", F.col("mode").cast("int"))
    return rows.select("event_id", zone.alias("zone_name"), F.coalesce(code, F.lit(-1)).alias("code"))


QUERIES["zone_specific_codes"] = _zone_coded
SQL["zone_specific_codes"] = _R + f"""
SELECT event_id, coalesce(fan_speed, 'Unknown') AS zone_name,
       CASE WHEN fan_speed IS NULL THEN -1 ELSE {V.code('mode', 'mode')} END AS code
FROM readings"""

QUERIES["zone_category_report"] = lambda s, d: cleaning.zone_category_report(_zone_named(s, d), CODED)
SQL["zone_category_report"] = _R + f""",
cells AS (
  SELECT fan_speed AS zone, 'mode' AS "column", mode AS value, {V.code('mode', 'mode')} AS code,
         upper(trim(mode)) NOT IN ('OFF', 'COOL', 'HEAT', 'FAN') AS unmapped FROM readings
  UNION ALL
  SELECT fan_speed, 'fan_speed', on_off, {V.code('on_off', 'fan_speed')},
         upper(trim(on_off)) NOT IN ('AUTO', 'LOW', 'MEDIUM', 'HIGH', 'TOP') FROM readings
)
SELECT zone, "column", value, count(*) AS rows, code, unmapped FROM cells
WHERE zone IS NOT NULL AND value IS NOT NULL GROUP BY ALL"""

QUERIES["code_to_label"] = lambda s, d: V.events(s, d).select(
    "event_id",
    cat.code_label(F.col("k") % 6, "mode").alias("mode_label"),
    cat.code_label(F.col("k") % 6, "fan_speed").alias("fan_label"),
)
SQL["code_to_label"] = "WITH " + V.EVENTS_SQL.lstrip() + """
SELECT event_id,
       CASE k % 6 WHEN 0 THEN 'OFF' WHEN 1 THEN 'COOL' WHEN 2 THEN 'HEAT' WHEN 3 THEN 'FAN'
                  ELSE CAST(k % 6 AS VARCHAR) END AS mode_label,
       CASE k % 6 WHEN 0 THEN 'AUTO' WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'HIGH'
                  WHEN 4 THEN 'TOP' ELSE CAST(k % 6 AS VARCHAR) END AS fan_label
FROM ev"""

QUERIES["candidate_codes"] = lambda s, d: V.readings(s, d).select(
    "event_id",
    F.array_join(
        cat.candidate_codes(F.array("fan_speed", "mode"), "fan_speed").cast("array<string>"), ","
    ).alias("fan_codes"),
    F.array_join(
        cat.candidate_codes(F.array("fan_speed"), "mode", ("HEAT", "none")).cast("array<string>"),
        ",",
    ).alias("mode_codes"),
)
SQL["candidate_codes"] = _R + """
SELECT event_id, CASE fan_speed WHEN 'Low' THEN '1' WHEN 'medium' THEN '2' WHEN 'High' THEN '3'
                      ELSE '0,1,2,3,4' END AS fan_codes, '2' AS mode_codes
FROM readings"""

QUERIES["codes_subset"] = lambda s, d: (
    V.events(s, d)
    .groupBy("user_id")
    .agg(F.collect_set(F.col("k") % 6).alias("codes"))
    .select(
        "user_id",
        cat.codes_are_defined(F.col("codes"), "fan_speed").alias("fan_ok"),
        cat.codes_are_defined(F.col("codes"), "mode").alias("mode_ok"),
    )
)
SQL["codes_subset"] = "WITH " + V.EVENTS_SQL.lstrip() + """
SELECT user_id, max(k % 6) <= 4 AS fan_ok, max(k % 6) <= 3 AS mode_ok FROM ev GROUP BY 1"""

QUERIES["required_key_filter"] = lambda s, d: cleaning.require_filled(
    V.table(s, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, "  ")
        .when(F.col("c_custkey") % 7 != 0, F.col("c_name"))
        .alias("c_name"),
        "c_nationkey",
    ),
    ["c_custkey", "c_name"],
)
SQL["required_key_filter"] = """
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0"""

QUERIES["on_only"] = lambda s, d: cleaning.in_period(
    V.readings(s, d).where("on_off = 'ON'"), "2024-01-05 06:00:00", "2024-01-20 00:00:00"
).select("event_id", "unit", "ts")
SQL["on_only"] = _R + """
SELECT event_id, unit, ts FROM readings
WHERE on_off = 'ON' AND ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20'"""


def _raw(spark, d):
    """Readings under raw headings, times as text."""
    back = {v: k for k, v in AC_COLUMNS.items()}
    r = V.readings(spark, d).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return r.drop("site", "zone").withColumnsRenamed(back)


QUERIES["preprocess_ac"] = lambda s, d: preprocess.clean_control_log(
    preprocess.standardize(_raw(s, d), AC_COLUMNS), F.col("event_id"), sigmas=1.7
)
_CLEAN_AC = """,
local_rows AS (
  SELECT date_trunc('minute', ts + INTERVAL 9 HOUR) AS ts, event_id, unit, indoor_temp, outdoor_temp,
         set_temp, on_off, mode, fan_speed FROM readings
),
uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ts, unit
      ORDER BY CASE WHEN on_off = 'ON' THEN 1 ELSE 0 END DESC, event_id DESC) AS rn
    FROM local_rows) WHERE rn = 1
),
in1 AS (
  SELECT * FROM uniq WHERE abs(indoor_temp - (SELECT avg(indoor_temp) FROM uniq))
                           <= 1.7 * (SELECT stddev_samp(indoor_temp) FROM uniq)
),
in2 AS (
  SELECT * FROM in1 WHERE abs(outdoor_temp - (SELECT avg(outdoor_temp) FROM in1))
                          <= 1.7 * (SELECT stddev_samp(outdoor_temp) FROM in1)
)"""
SQL["preprocess_ac"] = _R + _CLEAN_AC + " SELECT *, CAST(ts AS DATE) AS date FROM in2"

QUERIES["preprocess_pm"] = lambda s, d: preprocess.clean_power_log(
    V.power(s, d), F.col("event_id"), sigmas=1.5
)
SQL["preprocess_pm"] = _P + f""",
uniq AS (
  SELECT * EXCLUDE (rn), {V.TOTAL_KWH_SQL} AS total_kwh FROM (
    SELECT * REPLACE (date_trunc('minute', ts + INTERVAL 9 HOUR) AS ts),
           row_number() OVER (PARTITION BY date_trunc('minute', ts + INTERVAL 9 HOUR), mesh_id
             ORDER BY event_id) AS rn
    FROM power) WHERE rn = 1
)
SELECT *, CAST(ts AS DATE) AS date FROM uniq
WHERE abs(total_kwh - (SELECT avg(total_kwh) FROM uniq))
      <= 1.5 * (SELECT stddev_samp(total_kwh) FROM uniq)"""
