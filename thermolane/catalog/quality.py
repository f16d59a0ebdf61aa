"""Correlations, quality reports, distributions and output checks."""

from pyspark.sql import functions as F

from thermolane.catalog import views as V
from thermolane.constants import BASE_FEATURES, CORRELATION_TARGETS
from thermolane.operators import cleaning, rollup, statistics as st

QUERIES, SQL = {}, {}

_PAIRS = [
    (t, f)
    for t in CORRELATION_TARGETS
    for f in [*BASE_FEATURES, *CORRELATION_TARGETS]
    if f != t
]


def _corr_sql(t, f):
    both = f"{t} IS NOT NULL AND {f} IS NOT NULL"
    spread = " AND ".join(f"stddev_pop({c}) FILTER (WHERE {both}) > 0" for c in (t, f))
    return (
        f"SELECT '{t}' AS target, '{f}' AS feature, "
        f"CASE WHEN {spread} THEN {V.cut(f'abs(corr({f}, {t}))')} END AS corr FROM features"
    )


_CORR = V.features_sql() + ", c AS (" + " UNION ALL ".join(_corr_sql(t, f) for t, f in _PAIRS) + ")"

QUERIES["feature_target_corr"] = lambda s, d: st.correlations(
    V.features(s, d), BASE_FEATURES, CORRELATION_TARGETS
)
SQL["feature_target_corr"] = _CORR + " SELECT * FROM c"

QUERIES["top_correlated"] = lambda s, d: st.top_correlated(
    st.correlations(V.features(s, d), BASE_FEATURES, CORRELATION_TARGETS), 5
)
SQL["top_correlated"] = _CORR + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY corr DESC NULLS LAST, feature)
  AS rank FROM c) WHERE rank <= 5"""

_PROFILE = ["site", "zone", "indoor_temp", "units_on", "adjusted_power", "solar_radiation"]
_TYPES = ["string", "string", "double", "int", "double", "double"]
QUERIES["quality_profile"] = lambda s, d: st.quality_profile(V.features(s, d).select(*_PROFILE))
SQL["quality_profile"] = (
    V.features_sql()
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS total_rows, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"{V.cut(f'100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL) / count(*)', 4)} "
        f"AS null_percent FROM features"
        for c, t in zip(_PROFILE, _TYPES)
    )
)


QUERIES["quality_summary"] = lambda s, d: st.quality_summary(
    V.features(s, d).select(*_PROFILE)
).withColumn("zones", F.array_join("zones", ","))
SQL["quality_summary"] = (
    V.features_sql()
    + f""" SELECT count(*) AS total_rows, {len(_PROFILE)} AS total_columns,
  array_to_string(list_filter([{', '.join(f"CASE WHEN count(*) > count({c}) THEN '{c}' END" for c in _PROFILE)}], lambda x: x IS NOT NULL), ',')
    AS columns_with_nulls,
  (SELECT string_agg(zone, ',' ORDER BY zone) FROM (SELECT DISTINCT zone FROM features WHERE zone IS NOT NULL)) AS zones
FROM features"""
)


def _merge_quality(spark, d):
    """Zone hours of all readings against power of one phase group, so that gaps exist."""
    features = V.features(spark, d)
    power = features.where(F.col("adjusted_power") > 150)
    return st.merge_quality(features, power)


QUERIES["merge_quality"] = _merge_quality
SQL["merge_quality"] = V.features_sql() + """,
p AS (SELECT site, zone, ts, adjusted_power FROM features WHERE adjusted_power > 150),
j AS (SELECT f.site, f.zone, f.ts, f.indoor_temp, p.adjusted_power
      FROM features f LEFT JOIN p USING (site, zone, ts)),
l AS (SELECT site, zone, count(*) AS zone_rows,
             count(*) FILTER (WHERE adjusted_power IS NULL) AS missing_power,
             count(*) FILTER (WHERE indoor_temp IS NULL) AS missing_indoor,
             min(ts) FILTER (WHERE adjusted_power IS NULL) AS missing_from,
             max(ts) FILTER (WHERE adjusted_power IS NULL) AS missing_to,
             min(ts) AS zf, max(ts) AS zt FROM j GROUP BY 1, 2),
r AS (SELECT site, zone, count(*) AS power_rows, min(ts) AS pf, max(ts) AS pt FROM p GROUP BY 1, 2)
SELECT site, zone, zone_rows, coalesce(power_rows, 0) AS power_rows, missing_power, missing_indoor,
       missing_from, missing_to,
       CASE WHEN pf IS NOT NULL AND greatest(zf, pf) <= least(zt, pt) THEN greatest(zf, pf) END AS overlap_from,
       CASE WHEN pf IS NOT NULL AND greatest(zf, pf) <= least(zt, pt) THEN least(zt, pt) END AS overlap_to
FROM l LEFT JOIN r USING (site, zone)"""

QUERIES["unit_distribution"] = lambda s, d: st.distribution(
    V.readings(s, d).withColumn("ts", F.date_trunc("hour", "ts")), ["site", "ts"], "indoor_temp"
)
SQL["unit_distribution"] = "WITH " + V.READINGS_SQL.lstrip() + f""",
v AS (SELECT site, date_trunc('hour', ts) AS ts, indoor_temp AS v
      FROM readings WHERE indoor_temp IS NOT NULL)
SELECT site, ts, min(v) AS v_min, {V.cut('quantile_cont(v, 0.25)')} AS q1,
       {V.cut('quantile_cont(v, 0.5)')} AS median, {V.cut('quantile_cont(v, 0.75)')} AS q3,
       max(v) AS v_max
FROM v GROUP BY 1, 2"""

QUERIES["date_span"] = lambda s, d: rollup.date_span(V.readings(s, d), ["site", "unit"])
SQL["date_span"] = "WITH " + V.READINGS_SQL.lstrip() + """
SELECT site, unit, min(ts) AS first_ts, max(ts) AS last_ts FROM readings GROUP BY 1, 2"""


def _grid(spark, d):
    """Every zone should have an output for every hour of its site's days."""
    r = V.readings(spark, d)
    days = r.select("site", F.to_date("ts").alias("date")).distinct()
    zones = r.select("site", "zone").distinct()
    expected = zones.join(days, "site").withColumn(
        "hour", F.explode(F.sequence(F.lit(0), F.lit(23)))
    )
    present = r.select("site", "zone", F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))
    return expected, present


KEYS = ["site", "zone", "date", "hour"]
_GRID = "WITH " + V.READINGS_SQL.lstrip() + """,
e AS (SELECT site, zone, date, unnest(range(24)) AS hour
      FROM (SELECT DISTINCT site, zone FROM readings)
      JOIN (SELECT DISTINCT site, CAST(ts AS DATE) AS date FROM readings) USING (site)),
p AS (SELECT DISTINCT site, zone, CAST(ts AS DATE) AS date, hour(ts) AS hour FROM readings)"""

QUERIES["output_completeness"] = lambda s, d: st.missing_outputs(*_grid(s, d), KEYS)
SQL["output_completeness"] = _GRID + " SELECT e.* FROM e ANTI JOIN p USING (site, zone, date, hour)"

QUERIES["output_flags"] = lambda s, d: st.output_flags(*_grid(s, d), KEYS, ["site", "date"])
SQL["output_flags"] = _GRID + """
SELECT e.site, e.date, count(*) AS expected, count(p.zone) AS present,
       count(*) = count(p.zone) AS all_present
FROM e LEFT JOIN p USING (site, zone, date, hour) GROUP BY 1, 2"""

QUERIES["report_hours"] = lambda s, d: cleaning.in_hours(
    V.features(s, d).select("site", "zone", "ts", "units_on"), 8, 19
)
SQL["report_hours"] = V.features_sql() + """
SELECT site, zone, ts, units_on FROM features WHERE hour >= 8 AND hour < 19"""
