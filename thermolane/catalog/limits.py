"""Monthly statistics, control limits and master updates, on line items as readings."""

from pyspark.sql import functions as F

from thermolane.catalog import views as V
from thermolane.operators import reshape, statistics as st
from thermolane.plans import limits as plan

QUERIES, SQL = {}, {}

BRANDS = [f"B{i}" for i in range(1, 13)]


def _readings(spark, d):
    """A supplier is a unit; ship mode flags play the switch and the fan label."""
    li = V.table(spark, d, "lineitem")
    return li.select(
        F.concat(F.lit("U"), F.col("l_suppkey").cast("string")).alias("unit"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.when(F.col("l_linestatus") == "O", "ON").otherwise("OFF").alias("on_off"),
        (F.col("l_quantity") / 2).alias("set_temp"),
        F.when(F.col("l_linenumber") != 4, F.col("l_extendedprice") / 1000).alias("indoor_temp"),
        F.element_at(F.array(*[F.lit(x) for x in ("Low", "High", "Top")]), F.col("l_linenumber") % 3 + 1)
        .alias("speed"),
        "l_linenumber",
    ).withColumn("fan_speed", F.when(F.col("l_linenumber") != 6, F.col("speed"))).drop(
        "speed", "l_linenumber"
    )


def _areas(spark, d):
    """A unit's area is its supplier's nation; suppliers of one nation have no area."""
    s, n = V.table(spark, d, "supplier"), V.table(spark, d, "nation")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("unit"),
        F.when(F.col("n_nationkey") != 3, F.col("n_name")).alias("area"),
    )


_BASE = """WITH r AS (
  SELECT 'U' || l_suppkey AS unit, month(l_shipdate) AS month, l_quantity / 2 AS set_temp,
         CASE WHEN l_linenumber <> 4 THEN l_extendedprice / 1000 END AS indoor_temp,
         CASE WHEN l_linenumber = 6 THEN 'Unknown' WHEN l_linenumber % 3 = 0 THEN 'Low'
              WHEN l_linenumber % 3 = 1 THEN 'High' ELSE 'Top' END AS fan_speed
  FROM lineitem WHERE l_linestatus = 'O'
),
areas AS (
  SELECT 'U' || s_suppkey AS unit, n_name AS area FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE n_nationkey <> 3
)"""


def _stats(cols):
    return ", ".join(
        f"{V.one_decimal(V.cut(f'{fn}({v})'))} AS {v}_{s}"
        for v in cols
        for fn, s in (("avg", "mean"), ("stddev_samp", "std"))
    )


_MONTHLY = f""",
monthly AS (
  SELECT unit, CAST(month AS INTEGER) AS month, {_stats(('indoor_temp', 'set_temp'))},
         count(*) AS samples
  FROM r GROUP BY 1, 2
)"""
_LIMITS = f""",
lim AS (
  SELECT *, {V.half('set_temp_mean + set_temp_std')} AS set_temp_upper,
         {V.half('set_temp_mean - set_temp_std')} AS set_temp_lower,
         {V.half('indoor_temp_mean + indoor_temp_std')} AS indoor_temp_upper,
         {V.half('indoor_temp_mean - indoor_temp_std')} AS indoor_temp_lower
  FROM monthly
),
area_lim AS (
  SELECT month, area, """ + ", ".join(
    f"{V.half(V.cut(f'avg({c})'))} AS {c}"
    for c in ("indoor_temp_lower", "indoor_temp_upper", "set_temp_upper", "set_temp_lower")
) + """
  FROM lim JOIN areas USING (unit) GROUP BY 1, 2
)"""
_SPEEDS = """,
grid AS (
  SELECT unit, fan_speed, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT unit FROM r) CROSS JOIN (SELECT DISTINCT fan_speed FROM r)
  LEFT JOIN (SELECT unit, fan_speed, count(*) AS n FROM r GROUP BY 1, 2) USING (unit, fan_speed)
),
top3 AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY unit ORDER BY n DESC, fan_speed) AS INTEGER)
    AS rank FROM grid) WHERE rank <= 3
),
votes AS (
  SELECT area, fan_speed, count(*) AS votes, min(ROW(unit, rank)) AS first_seen
  FROM top3 JOIN areas USING (unit) GROUP BY 1, 2
),
area_speed AS (
  SELECT a.area, coalesce(v.fan_speed, 'Low') AS fan_candidates
  FROM (SELECT DISTINCT area FROM votes) a
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY area ORDER BY votes DESC, first_seen) AS rn
             FROM votes WHERE fan_speed <> 'Unknown') v
    ON v.area = a.area AND v.rn = 1
)"""


def _on(spark, d):
    return st.on_only(_readings(spark, d))


def _monthly(spark, d):
    return st.monthly_statistics(_on(spark, d), ["indoor_temp", "set_temp"])


QUERIES["monthly_statistics"] = _monthly
SQL["monthly_statistics"] = _BASE + _MONTHLY + " SELECT * FROM monthly"


def _by_brand(spark, d):
    """The same statistics with the part's brand group as unit: a fixed set of columns."""
    brand = F.concat(
        F.lit("B"), (F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 12 + 1).cast("string")
    )
    li = V.table(spark, d, "lineitem").join(
        V.table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), brand.alias("unit")),
        "l_partkey",
    )
    rows = li.select(
        "unit",
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.when(F.col("l_linestatus") == "O", "ON").otherwise("OFF").alias("on_off"),
        (F.col("l_quantity") / 2).alias("set_temp"),
        (F.col("l_extendedprice") / 1000).alias("indoor_temp"),
        F.when(F.col("l_linenumber") > 3, "High").otherwise("Low").alias("fan_speed"),
    )
    return plan.monthly_report(rows, BRANDS)


_BRAND = """WITH p AS (
  SELECT 'B' || (CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) % 12 + 1) AS unit, p_partkey
  FROM part),
r AS (SELECT unit, month(l_shipdate) AS month, l_quantity / 2 AS set_temp,
             l_extendedprice / 1000 AS indoor_temp,
             CASE WHEN l_linenumber > 3 THEN 'High' ELSE 'Low' END AS fan_speed
      FROM lineitem JOIN p ON l_partkey = p_partkey WHERE l_linestatus = 'O')"""


def _pivot_sql(value, default="NULL"):
    cells = ", ".join(
        f"coalesce(max(v) FILTER (WHERE unit = '{b}'), {default}) AS \"{b}\"" for b in BRANDS
    )
    return (
        _BRAND
        + f""",
s AS (SELECT unit, month, {value} AS v FROM r GROUP BY 1, 2)
SELECT m.month, m.month || '月' AS month_label, {cells}
FROM (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month) m LEFT JOIN s USING (month) GROUP BY 1"""
    )


QUERIES["monthly_mean_pivot"] = lambda s, d: _by_brand(s, d)["indoor_temp_mean"]
SQL["monthly_mean_pivot"] = _pivot_sql(V.one_decimal(V.cut("avg(indoor_temp)")))
QUERIES["monthly_std"] = lambda s, d: _by_brand(s, d)["set_temp_std"]
SQL["monthly_std"] = _pivot_sql(V.one_decimal(V.cut("stddev_samp(set_temp)")))
QUERIES["monthly_counts"] = lambda s, d: _by_brand(s, d)["samples"]
SQL["monthly_counts"] = _pivot_sql("count(*)", "0")

QUERIES["monthly_report"] = lambda s, d: _by_brand(s, d)["fan_speed"]
SQL["monthly_report"] = (
    _BRAND
    + """,
g AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month, fan_speed
      FROM (SELECT DISTINCT fan_speed FROM r))
SELECT g.month, g.fan_speed, count(r.unit) AS frequency, """
    + ", ".join(f"count(*) FILTER (WHERE r.unit = '{b}') AS \"{b}\"" for b in BRANDS)
    + " FROM g LEFT JOIN r ON r.month = g.month AND r.fan_speed = g.fan_speed GROUP BY 1, 2"
)

QUERIES["fan_frequency"] = lambda s, d: st.fan_speed_counts(
    _on(s, d).withColumn("unit", F.when(F.col("unit") != "U1", F.col("unit")))
)
SQL["fan_frequency"] = _BASE + """,
c AS (SELECT month, fan_speed, CASE WHEN unit <> 'U1' THEN unit END AS unit, count(*) AS n
      FROM r GROUP BY 1, 2, 3),
g AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month, fan_speed
      FROM (SELECT DISTINCT fan_speed FROM r))
SELECT g.month, g.fan_speed, coalesce(t.f, 0) AS frequency, c.unit, coalesce(c.n, 0) AS n
FROM g LEFT JOIN (SELECT month, fan_speed, CAST(sum(n) AS BIGINT) AS f FROM c GROUP BY 1, 2) t
  ON t.month = g.month AND t.fan_speed = g.fan_speed
LEFT JOIN c ON c.month = g.month AND c.fan_speed = g.fan_speed AND c.unit IS NOT NULL"""

QUERIES["control_limits"] = lambda s, d: st.unit_limits(_monthly(s, d))
SQL["control_limits"] = _BASE + _MONTHLY + _LIMITS + " SELECT * FROM lim"

QUERIES["unit_area_join"] = lambda s, d: st.with_area(
    st.unit_limits(_monthly(s, d)), _areas(s, d)
).select("unit", "month", "area", "set_temp_upper")
SQL["unit_area_join"] = _BASE + _MONTHLY + _LIMITS + """
SELECT unit, month, area, set_temp_upper FROM lim JOIN areas USING (unit)"""

QUERIES["area_limits"] = lambda s, d: st.area_limits(
    st.with_area(st.unit_limits(_monthly(s, d)), _areas(s, d))
)
SQL["area_limits"] = _BASE + _MONTHLY + _LIMITS + " SELECT * FROM area_lim"

QUERIES["top3_speeds"] = lambda s, d: st.top_speeds(_on(s, d))
SQL["top3_speeds"] = _BASE + _SPEEDS + " SELECT * FROM top3"

QUERIES["top_speed_per_area"] = lambda s, d: st.area_speeds(
    st.with_area(st.top_speeds(_on(s, d)), _areas(s, d))
)
SQL["top_speed_per_area"] = _BASE + _SPEEDS + " SELECT * FROM area_speed"

_NEW_LIMITS = """,
updates AS (
  SELECT s.area AS zone, m.month || '月' AS month_label, l.indoor_temp_lower AS comfort_min,
         l.indoor_temp_upper AS comfort_max, l.set_temp_lower AS setpoint_min,
         l.set_temp_upper AS setpoint_max, s.fan_candidates
  FROM area_speed s CROSS JOIN (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month) m
  LEFT JOIN area_lim l ON l.area = s.area AND l.month = m.month
)"""

QUERIES["limits_to_master"] = lambda s, d: plan.master_updates(_readings(s, d), _areas(s, d))
SQL["limits_to_master"] = (
    _BASE + _MONTHLY + _LIMITS + _SPEEDS + _NEW_LIMITS + " SELECT * FROM updates"
)


def _master(spark, d):
    """Master rows of every nation and month; nation 3 has no update and keeps its values."""
    n = V.table(spark, d, "nation")
    return n.withColumn("m", F.explode(F.sequence(F.lit(1), F.lit(12)))).select(
        F.col("n_name").alias("zone"),
        F.concat(F.col("m").cast("string"), F.lit("月")).alias("month_label"),
        F.lit(1.5).alias("comfort_min"),
        (F.col("n_nationkey") * 1.0).alias("comfort_max"),
        F.lit("Old").alias("fan_candidates"),
    )


QUERIES["master_update_merge"] = lambda s, d: plan.updated_master(
    _master(s, d), _readings(s, d), _areas(s, d)
)
SQL["master_update_merge"] = (
    _BASE
    + _MONTHLY
    + _LIMITS
    + _SPEEDS
    + _NEW_LIMITS
    + """,
master AS (
  SELECT n_name AS zone, m.month || '月' AS month_label, n_nationkey * 1.0::DOUBLE AS old_max
  FROM nation CROSS JOIN (SELECT unnest(range(1, 13)) AS month) m
)
SELECT zone, month_label,
       CASE WHEN u.hit THEN u.comfort_min ELSE 1.5::DOUBLE END AS comfort_min,
       CASE WHEN u.hit THEN u.comfort_max ELSE old_max END AS comfort_max,
       CASE WHEN u.hit THEN u.fan_candidates ELSE 'Old' END AS fan_candidates,
       CASE WHEN u.hit THEN u.setpoint_min END AS setpoint_min,
       CASE WHEN u.hit THEN u.setpoint_max END AS setpoint_max
FROM master LEFT JOIN (SELECT *, true AS hit FROM updates) u USING (zone, month_label)"""
)
