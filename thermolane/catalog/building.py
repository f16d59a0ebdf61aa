"""Building matrix, last values, time split, regression and what-if scores."""

from pyspark.sql import functions as F

from thermolane.catalog import views as V
from thermolane.functions.categories import category_code
from thermolane.operators import cleaning, learning, ordered, reshape
from thermolane.plans import building as plan
from thermolane.sources.staging import stage

QUERIES, SQL = {}, {}

# A panel groups the users of a zone: a building has a fixed set of panels and meters.
PANELS = {"S0": ["Z0", "Z2", "Z4"], "S1": ["Z1", "Z3"]}
ALL_PANELS = ["Z0", "Z1", "Z2", "Z3", "Z4"]
ODUS = [f"{m}-{a}" for m in (0, 1) for a in (0, 1, 2)]


def _indoor(spark, d, unit="zone"):
    r = V.readings(spark, d)
    return plan.indoor_hours(
        r.withColumn("unit", F.col(unit)).withColumns(
            {c: category_code(F.col(c), c, True) for c in ("on_off", "mode", "fan_speed")}
        )
    )


def _outdoor(spark, d):
    p = cleaning.add_total_kwh(V.power(spark, d))
    return plan.outdoor_hours(p.withColumn("mesh_id", F.col("mesh_id") % 2))


def _base(unit="zone", mesh="(mesh_id % 2)"):
    return "WITH " + (V.READINGS_SQL + V.POWER_SQL).lstrip() + f""",
coded AS (
  SELECT site, date_trunc('hour', ts) AS ts, {unit} AS unit, set_temp, indoor_temp,
         {V.code('on_off', 'on_off')} AS on_off, {V.code('mode', 'mode')} AS mode,
         {V.code('fan_speed', 'fan_speed')} AS fan_speed
  FROM readings
),
ih AS (
  SELECT b.*, m.mode, f.fan_speed, o.on_off
  FROM (SELECT site, ts, unit, {V.cut('avg(set_temp)')} AS set_temp,
               {V.cut('avg(indoor_temp)')} AS indoor_temp FROM coded GROUP BY 1, 2, 3) b
  LEFT JOIN {V.mode_of('coded', 'site, ts, unit', 'mode')} m USING (site, ts, unit)
  LEFT JOIN {V.mode_of('coded', 'site, ts, unit', 'fan_speed')} f USING (site, ts, unit)
  LEFT JOIN {V.mode_of('coded', 'site, ts, unit', 'on_off')} o USING (site, ts, unit)
),
oh AS (
  SELECT site, date_trunc('hour', ts) AS ts, {mesh} || '-' || pm_addr_id AS odu,
         {V.cut('sum(' + V.TOTAL_KWH_SQL + ')', 4)} AS total_kwh
  FROM power GROUP BY 1, 2, 3
)"""


_BASE = _base()


def _labels_as_doubles(df):
    """Labels can be null; as doubles both engines show null the same way."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("mode", "fan_speed", "on_off")})


# Every unit and meter, not panels.
QUERIES["indoor_hours"] = lambda s, d: _labels_as_doubles(_indoor(s, d, "unit"))
SQL["indoor_hours"] = _base("unit") + """
SELECT * REPLACE (mode::DOUBLE AS mode, fan_speed::DOUBLE AS fan_speed, on_off::DOUBLE AS on_off) FROM ih"""
QUERIES["outdoor_hours"] = lambda s, d: plan.outdoor_hours(cleaning.add_total_kwh(V.power(s, d)))
SQL["outdoor_hours"] = _base(mesh="mesh_id") + " SELECT * FROM oh"


def _doubles(df):
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) if t == "int" else f"`{c}`" for c, t in df.dtypes])


def _cells(source, metrics, units, column):
    return ", ".join(
        f"CAST(any_value({m}) FILTER (WHERE {column} = '{u}') AS DOUBLE) AS \"{m}__{u}\""
        for m in metrics
        for u in units
    )


QUERIES["sensor_matrix_wide"] = lambda s, d: _doubles(
    plan.wide_hours(_indoor(s, d), _outdoor(s, d), ALL_PANELS, ODUS)
)
SQL["sensor_matrix_wide"] = (
    _BASE
    + f""",
a AS (SELECT site, ts, {_cells('ih', plan.INDOOR, ALL_PANELS, 'unit')} FROM ih GROUP BY 1, 2),
b AS (SELECT site, ts, {_cells('oh', ['total_kwh'], ODUS, 'odu')} FROM oh GROUP BY 1, 2)
SELECT * FROM a FULL JOIN b USING (site, ts)"""
)

_FILLED = (
    _BASE
    + """,
full_hours AS (
  SELECT site, ts FROM ih WHERE on_off IS NOT NULL GROUP BY site, ts
  HAVING count(*) = (SELECT count(DISTINCT unit) FROM ih x WHERE x.site = ih.site)
),
kept AS (SELECT ih.* FROM ih JOIN full_hours USING (site, ts)),
filled AS (
  SELECT site, ts, unit, set_temp, mode, fan_speed, on_off,
         CASE WHEN bool_or(on_off = 0 AND indoor_temp IS NULL) OVER (PARTITION BY site, unit)
              THEN last_value(indoor_temp IGNORE NULLS) OVER (PARTITION BY site, unit ORDER BY ts
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              ELSE indoor_temp END AS indoor_temp
  FROM kept
)"""
)
QUERIES["building_matrix_long"] = lambda s, d: plan.filled_hours(_indoor(s, d))
SQL["building_matrix_long"] = _FILLED + " SELECT * FROM filled"

QUERIES["building_matrix"] = lambda s, d: _doubles(
    plan.building_matrix(_indoor(s, d), _outdoor(s, d), ALL_PANELS, ODUS, drop_columns=False)
)
SQL["building_matrix"] = (
    _FILLED
    + f""",
a AS (SELECT site, ts, {_cells('filled', plan.INDOOR, ALL_PANELS, 'unit')} FROM filled GROUP BY 1, 2),
b AS (SELECT site, ts, {_cells('oh', ['total_kwh'], ODUS, 'odu')} FROM oh GROUP BY 1, 2)
SELECT a.*, {', '.join(f'coalesce("total_kwh__{o}", 0.0::DOUBLE) AS "total_kwh__{o}"' for o in ODUS)}
FROM a LEFT JOIN b USING (site, ts)"""
)



def _matrix_without_gaps(spark, d):
    """The matrix without the columns that hold a null, one row per cell."""
    wide = plan.building_matrix(_indoor(spark, d), _outdoor(spark, d), ALL_PANELS, ODUS)
    cells = [c for c in wide.columns if c not in ("site", "ts")]
    return _doubles(wide).unpivot(["site", "ts"], cells, "name", "value")


QUERIES["building_matrix_complete"] = _matrix_without_gaps
SQL["building_matrix_complete"] = (
    _FILLED
    + ", cells AS ("
    + " UNION ALL ".join(
        f"SELECT h.site, h.ts, '{m}__{u}' AS name, CAST(f.{m} AS DOUBLE) AS value "
        f"FROM full_hours h LEFT JOIN filled f ON f.site = h.site AND f.ts = h.ts AND f.unit = '{u}'"
        for m in plan.INDOOR
        for u in ALL_PANELS
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT h.site, h.ts, 'total_kwh__{o}', coalesce(oh.total_kwh, 0.0::DOUBLE) "
        f"FROM full_hours h LEFT JOIN oh ON oh.site = h.site AND oh.ts = h.ts AND oh.odu = '{o}'"
        for o in ODUS
    )
    + """)
SELECT * FROM cells WHERE name NOT IN (SELECT name FROM cells WHERE value IS NULL)"""
)

QUERIES["last_value_pivot"] = lambda s, d: reshape.last_values(
    V.readings(s, d).withColumn("ts", F.date_trunc("hour", "ts")),
    "indoor_temp",
    "zone",
    ALL_PANELS,
    "event_id",
)
SQL["last_value_pivot"] = "WITH " + V.READINGS_SQL.lstrip() + """
SELECT site, date_trunc('hour', ts) AS ts, """ + ", ".join(
    f"arg_max(indoor_temp, event_id) FILTER (WHERE zone = '{z}') AS \"indoor_temp__{z}\""
    for z in ALL_PANELS
) + " FROM readings WHERE indoor_temp IS NOT NULL GROUP BY 1, 2"

QUERIES["chronological_split"] = lambda s, d: ordered.chronological_split(
    V.readings(s, d).select("event_id", "ts", "unit"), ["ts", "event_id"]
)
SQL["chronological_split"] = "WITH " + V.READINGS_SQL.lstrip() + """
SELECT event_id, ts, unit, row_number() OVER (ORDER BY ts, event_id)
         <= floor(0.8 * (SELECT count(*) FROM readings)) AS is_train
FROM readings"""


def _targets(spark, d):
    return _outdoor(spark, d).groupBy("site", "ts").agg(
        (F.rint(F.sum("total_kwh") * 1e4) / 1e4).alias("site_kwh")
    )


def _inputs(spark, d):
    zones = _indoor(spark, d)
    return zones.groupBy("site", "ts").agg(
        F.sum("on_off").cast("double").alias("on_off__site"),
        (F.rint(F.avg("set_temp") * 1e11) / 1e11).alias("set_temp__site"),
        F.max("mode").cast("double").alias("mode__site"),
        F.max("fan_speed").cast("double").alias("fan_speed__site"),
        (F.rint(F.avg("indoor_temp") * 1e11) / 1e11).alias("indoor_temp__site"),
    )


QUERIES["feature_target_join"] = lambda s, d: plan.features_and_targets(
    _inputs(s, d), _targets(s, d)
)
SQL["feature_target_join"] = _BASE + f"""
SELECT * FROM (
  SELECT site, ts, CAST(sum(on_off) AS DOUBLE) AS "on_off__site", {V.cut2('avg(set_temp)')} AS "set_temp__site",
         CAST(max(mode) AS DOUBLE) AS "mode__site", CAST(max(fan_speed) AS DOUBLE) AS "fan_speed__site",
         {V.cut2('avg(indoor_temp)')} AS "indoor_temp__site"
  FROM ih GROUP BY 1, 2)
JOIN (SELECT site, ts, {V.cut('sum(total_kwh)', 4)} AS site_kwh FROM oh GROUP BY 1, 2) USING (site, ts)
WHERE "indoor_temp__site" IS NOT NULL"""

FEATURES = ["on_off__site", "set_temp__site", "mode__site", "fan_speed__site", "outdoor_temp"]
TARGETS = ["site_kwh", "indoor_temp__site"]


def _training(spark, d):
    weather = V.hourly_weather(V.weather(spark, d)).select("site", "ts", "outdoor_temp")
    rows = plan.features_and_targets(
        _inputs(spark, d).join(weather, ["site", "ts"], "left"), _targets(spark, d)
    )
    split = ordered.chronological_split(rows, ["ts", "site"])
    return stage(split, "training")


def _fit(rows):
    return learning.fit_targets(rows.where("is_train"), FEATURES, TARGETS, trees=5, depth=4)


def _regression(spark, d):
    rows = _training(spark, d)
    return learning.scores(_fit(rows).transform(rows.where("NOT is_train")), TARGETS)


QUERIES["multi_target_regression"] = _regression


def _what_if(spark, d):
    """Predicted energy and room temperature of forecast hours under uniform settings."""
    model = _fit(_training(spark, d))
    cases = learning.what_if(V.forecast(spark, d), FEATURES, set_temp=26, mode=1, fan=1)
    return model.transform(cases).select(
        "site",
        "ts",
        "set_temp_uniform",
        "mode_uniform",
        "fan_uniform",
        "units_on_uniform",
        *[f"pred_{t}" for t in TARGETS],
    )


QUERIES["what_if_scores"] = _what_if

SCENARIOS = [(26.0, 1, 1, None), (22.0, 2, 3, 0), (18.0, 3, 0, 99), (24.5, 1, 2, -4)]
UNIT_FEATURES = [f"{m}__{u}" for u in ALL_PANELS for m in ("on_off", "set_temp", "mode", "fan_speed")]


def _scenario_rows(spark, d):
    cases = learning.scenario_rows(V.forecast(spark, d), [*UNIT_FEATURES, "outdoor_temp", "absent"], SCENARIOS)
    return cases.withColumn("units_on_asked", F.col("units_on_asked").cast("double"))


QUERIES["what_if_rows"] = _scenario_rows
SQL["what_if_rows"] = (
    "WITH " + (V.EVENTS_SQL + V.WEATHER_SQL).lstrip() + V.forecast_sql() + f""",
asked(scenario, set_temp, mode, fan, asked) AS (VALUES {', '.join(
    f"({i}, {t}::DOUBLE, {m}, {f}, {'NULL' if k is None else k}::INTEGER)" for i, (t, m, f, k) in enumerate(SCENARIOS)
)}),
clamped AS (SELECT *, least(greatest(coalesce(asked, {len(ALL_PANELS)}), 0), {len(ALL_PANELS)}) AS k FROM asked)
SELECT site, ts, scenario, set_temp AS set_temp_uniform, mode AS mode_uniform, fan AS fan_uniform,
       asked::DOUBLE AS units_on_asked, k AS units_on_uniform,
       {', '.join(
           f'(CASE WHEN {i} < k THEN 1.0 ELSE 0.0 END)::DOUBLE AS "on_off__{u}", set_temp AS "set_temp__{u}", '
           f'mode::DOUBLE AS "mode__{u}", fan::DOUBLE AS "fan_speed__{u}"' for i, u in enumerate(ALL_PANELS)
       )},
       coalesce(outdoor_temp, 0.0::DOUBLE) AS outdoor_temp, 0.0::DOUBLE AS absent
FROM forecast, clamped"""
)
