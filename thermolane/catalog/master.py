"""Equipment and setting dimensions."""

from pyspark.sql import functions as F

from thermolane.catalog import views as V
from thermolane.operators import reshape
from thermolane.plans import master

QUERIES, SQL = {}, {}

# Zone Z1 is split by unit in these queries; units of Z1 in neither part are left out.
SPLIT = {"split_names": ["Z1"], "split_units": {"Z1_a": ["U-1", "U-6"], "Z1_b": ["U-11"]}}


def _zones(spark, d):
    return V.events(spark, d).select("site", "zone")


QUERIES["equipment_split"] = lambda s, d: master.equipment(V.master_units(s, d), **SPLIT)
_E = "WITH " + (V.EVENTS_SQL + V.EQUIPMENT_SQL + V.SETTINGS_SQL).lstrip()
_SPLIT_SQL = _E + """,
split AS (
  SELECT * REPLACE (CASE WHEN zone <> 'Z1' THEN zone WHEN indoor_unit IN ('U-1', 'U-6') THEN 'Z1_a'
                         WHEN indoor_unit = 'U-11' THEN 'Z1_b' END AS zone)
  FROM equipment
)"""
SQL["equipment_split"] = _SPLIT_SQL + " SELECT * FROM split WHERE zone IS NOT NULL"


def _nested(spark, d):
    """Equipment as nested values: zone -> {outdoor unit -> (load share, [indoor unit])}."""
    return master.equipment(V.master_units(spark, d), **SPLIT).select(
        "site",
        "zone",
        F.create_map(
            "outdoor_unit", F.struct("load_share", F.array("indoor_unit").alias("indoor_units"))
        ).alias("outdoor_units"),
    )


QUERIES["master_explode"] = lambda s, d: reshape.equipment_rows(_nested(s, d))
SQL["master_explode"] = SQL["equipment_split"]

QUERIES["unit_cap"] = lambda s, d: master.unit_counts(
    master.equipment(V.master_units(s, d), split_names=(), split_units={})
)
SQL["unit_cap"] = _E + """
SELECT site, zone, CAST(count(*) AS INTEGER) AS max_units FROM equipment GROUP BY 1, 2"""


def _dimensions(spark, d, month):
    out = master.candidate_settings(
        master.zone_settings(_zones(spark, d), V.settings(spark, d), month, split_names=(), split_units={})
    )
    for c in ("fan_candidates", "mode_candidates", "fan_codes", "mode_codes"):
        out = out.withColumn(c, F.array_join(F.col(c).cast("array<string>"), "|"))
    return out


QUERIES["settings_defaults"] = lambda s, d: _dimensions(s, d, 1)
QUERIES["month_dimensions"] = lambda s, d: _dimensions(s, d, 7)
SQL["settings_defaults"] = _E + """
SELECT z.site, z.zone,
  split_part(CASE WHEN h THEN coalesce(start_time, '07:00') END, ' ', 1) AS start_time,
  split_part(CASE WHEN h THEN coalesce(end_time, '20:00') END, ' ', 1) AS end_time,
  CASE WHEN h THEN coalesce(comfort_min, 22.0::DOUBLE) END AS comfort_min,
  CASE WHEN h THEN coalesce(comfort_max, 25.0::DOUBLE) END AS comfort_max,
  CASE WHEN h THEN coalesce(setpoint_min, 22.0::DOUBLE) END AS setpoint_min,
  CASE WHEN h THEN coalesce(setpoint_max, 28.0::DOUBLE) END AS setpoint_max,
  CASE WHEN h THEN coalesce((comfort_min + comfort_max) / 2, 25.0::DOUBLE) END AS target_room_temp,
  CASE WHEN h THEN replace(coalesce(fan_candidates, 'Low'), ',', '|') END AS fan_candidates,
  CASE WHEN h THEN 'COOL|HEAT|FAN' END AS mode_candidates,
  CASE z.zone WHEN 'Z0' THEN '1|3' WHEN 'Z1' THEN '1' WHEN 'Z2' THEN '0' WHEN 'Z3' THEN '2'
              ELSE '0|1|2|3|4' END AS fan_codes,
  CASE WHEN h THEN '1|2|3' ELSE '0|1|2|3' END AS mode_codes
FROM (SELECT DISTINCT site, zone FROM ev) z
LEFT JOIN (SELECT *, true AS h FROM settings WHERE month_label = '1月') s USING (site, zone)"""
SQL["month_dimensions"] = _E + """
SELECT DISTINCT site, zone, '07:00' AS start_time, '20:00' AS end_time, 22.0::DOUBLE AS comfort_min,
  25.0::DOUBLE AS comfort_max, 22.0::DOUBLE AS setpoint_min, 28.0::DOUBLE AS setpoint_max,
  25.0::DOUBLE AS target_room_temp, 'Low|Medium|High' AS fan_candidates,
  'COOL|HEAT|FAN' AS mode_candidates, '1|2|3' AS fan_codes, '1|2|3' AS mode_codes
FROM ev"""

QUERIES["operation_types"] = lambda s, d: master.operation_types(
    V.settings(s, d), split_names=["Z0"], split_units={"Z0_a": [], "Z0_b": []}
)
SQL["operation_types"] = _E + """
SELECT site, unnest(CASE WHEN zone = 'Z0' THEN ['Z0_a', 'Z0_b'] ELSE [zone] END) AS zone,
       CAST(replace(month_label, '月', '') AS INTEGER) AS month, upper(trim(operation_type)) AS operation_type
FROM settings WHERE operation_type IS NOT NULL AND month_label <> '13月'"""

QUERIES["comfort_range"] = lambda s, d: master.with_comfort_range(
    V.events(s, d).select("event_id", "site", "zone", F.month("ts").alias("month")),
    V.settings(s, d),
)
SQL["comfort_range"] = _E + """
SELECT e.event_id, e.site, e.zone, CAST(month(e.ts) AS INTEGER) AS month,
       coalesce(s.comfort_min, 22.0::DOUBLE) AS comfort_min,
       coalesce(s.comfort_max, 25.0::DOUBLE) AS comfort_max
FROM ev e LEFT JOIN settings s
  ON s.site = e.site AND s.zone = e.zone AND s.month_label = month(e.ts) || '月'"""
