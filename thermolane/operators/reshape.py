"""Long <-> wide. Tables are stored long; wide forms are exports of one site's columns."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from thermolane.constants import PLAN_SETTINGS, ZONE_ORDER
from thermolane.functions.temporal import month_label, plan_time
from thermolane.sources.staging import stage

_BASE = ["site", "datetime", "forecast_outdoor_temp", "forecast_solar_radiation"]


def plan_zones(plan: DataFrame) -> list[str]:
    """The zones of a plan: those of the report in its order, then others by name.

    The driver sees zone names, which become columns; one aggregate over the plan finds them.
    """
    found = {r.zone for r in plan.where(F.col("zone").isNotNull()).select("zone").distinct().collect()}
    return [z for z in ZONE_ORDER if z in found] + sorted(found - set(ZONE_ORDER))


def plan_wide(plan: DataFrame, zones=None) -> DataFrame:
    """One row per time; columns `{zone}_{setting}`.

    Every zone of the plan has its columns, unless `zones` names the zones to show, in order.
    """
    return (
        plan.groupBy(*_BASE)
        .pivot("zone", list(plan_zones(plan) if zones is None else zones))
        .agg(*[F.first(s).alias(s) for s in PLAN_SETTINGS])
    )


def zones_of(wide: DataFrame, zones=None):
    """Zones that have a column in a wide plan: in the order of `zones`, or of the report and then as they stand."""
    found = dict.fromkeys(
        c.removesuffix(f"_{s}") for c in wide.columns if c not in _BASE for s in PLAN_SETTINGS if c.endswith(f"_{s}")
        and not any(len(t) > len(s) and c.endswith(f"_{t}") for t in PLAN_SETTINGS)
    )
    if zones is not None:
        return [z for z in zones if z in found]
    return [z for z in ZONE_ORDER if z in found] + [z for z in found if z not in ZONE_ORDER]


def plan_long(wide: DataFrame, zones=None) -> DataFrame:
    """One row per time and zone (all that have columns, or those of `zones`).

    Settings differ in type, so structs are exploded.
    """
    types = dict(wide.dtypes)

    def setting(zone, name):
        column = f"{zone}_{name}"
        if column in types:
            return F.col(f"`{column}`").alias(name)
        kind = next((t for c, t in types.items() if c.endswith(f"_{name}")), "string")
        return F.lit(None).cast(kind).alias(name)

    rows = [
        F.struct(F.lit(z).alias("zone"), *[setting(z, s) for s in PLAN_SETTINGS])
        for z in zones_of(wide, zones)
    ]
    return wide.select(*_BASE, F.explode(F.array(*rows)).alias("r")).select(*_BASE, "r.*")


def unit_plan(plan: DataFrame, equipment: DataFrame, zones=ZONE_ORDER) -> DataFrame:
    """Settings of every indoor unit at every plan time, long.

    `plan` has a row per time and zone (see `plan_long`). A unit in several zones follows
    the last of them in zone order.

    Units in the same zones have the same settings, so these are chosen once per set of zones
    and time. The rows per unit and time come out of one join with them and are never grouped or sorted.
    """
    order = F.coalesce(
        F.array_position(F.array(*[F.lit(z) for z in zones]), F.col("zone")), F.lit(0)
    )
    units = stage(
        equipment.groupBy("site", F.col("indoor_unit").alias("unit")).agg(
            F.array_sort(F.collect_set("zone")).alias("zones")
        ),
        "unit-zones",
    )
    groups = units.select("site", "zones").distinct().withColumn("zone", F.explode("zones"))
    state = F.coalesce(F.col("ac_on_off"), F.lit("OFF"))
    rows = plan.join(groups, ["site", "zone"]).select(
        "site",
        "datetime",
        "zones",
        F.struct(order.alias("o"), F.col("zone").alias("z")).alias("__place"),
        F.struct(
            state.alias("OnOFF"),
            F.when(state == "OFF", "OFF")
            .otherwise(F.coalesce(F.col("mode"), F.lit("OFF")))
            .alias("Mode"),
            F.col("set_temp").alias("SetTemp"),
            F.col("fan_speed").alias("FanSpeed"),
        ).alias("__set"),
    )
    chosen = stage(
        rows.groupBy("site", "datetime", "zones").agg(F.max_by("__set", "__place").alias("s")),
        "zone-settings",
    )
    # A unit becomes a row per time: many tasks share the few bytes of the units.
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        units.repartition(tasks, "site", "unit")
        .join(chosen, ["site", "zones"])
        .select("site", "datetime", "unit", "s.*")
    )


def unit_plan_wide(units: DataFrame, names) -> DataFrame:
    """Unit plan of one site with columns `{unit}_OnOFF`, `_Mode`, `_SetTemp`, `_FanSpeed`."""
    settings = ["OnOFF", "Mode", "SetTemp", "FanSpeed"]
    return (
        units.groupBy("site", plan_time(F.col("datetime")).alias("Date Time"))
        .pivot("unit", list(names))
        .agg(*[F.first(s).alias(s) for s in settings])
    )


def sensor_matrix(hours: DataFrame, metrics, unit: str, names) -> DataFrame:
    """Columns `{metric}__{unit}`, one row per (site, ts)."""
    wide = hours.groupBy("site", "ts").pivot(unit, list(names)).agg(
        *[F.first(m).alias(m) for m in metrics]
    )
    if len(metrics) == 1:
        return wide.select(
            "site", "ts", *[F.col(f"`{n}`").alias(f"{metrics[0]}__{n}") for n in names]
        )
    return wide.select(
        "site",
        "ts",
        *[F.col(f"`{n}_{m}`").alias(f"{m}__{n}") for m in metrics for n in names],
    )


def last_values(df: DataFrame, value: str, unit: str, names, source) -> DataFrame:
    """Last value per (site, ts, unit) in source order, pivoted to `{value}__{unit}`."""
    last = df.where(F.col(value).isNotNull()).groupBy("site", "ts", unit).agg(
        F.max_by(value, source).alias(value)
    )
    return sensor_matrix(last, [value], unit, names)


def month_by_unit(stat: DataFrame, value: str, names, fill=None) -> DataFrame:
    """Twelve rows 1月-12月 with one column per unit; months without data stay null or `fill`."""
    months = stat.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    wide = stat.groupBy("month").pivot("unit", list(names)).agg(F.first(value))
    out = months.join(wide, "month", "left")
    if fill is not None:
        out = out.fillna(fill, list(names))
    return out.withColumn("month_label", month_label(F.col("month")))


def equipment_rows(nested: DataFrame) -> DataFrame:
    """zone -> {outdoor unit -> (load_share, indoor_units[])} to one row per indoor unit."""
    return (
        nested.select("site", "zone", F.explode("outdoor_units").alias("outdoor_unit", "o"))
        .select(
            "site",
            "zone",
            "outdoor_unit",
            F.col("o.load_share").alias("load_share"),
            F.explode("o.indoor_units").alias("indoor_unit"),
        )
        .dropDuplicates(["site", "zone", "outdoor_unit", "indoor_unit"])
    )


def columns_without_nulls(df: DataFrame) -> DataFrame:
    """Drop every column that has a null: one aggregate job, then a projection."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if row[c] == 0])


def coalesce_all(df: DataFrame, columns, value) -> DataFrame:
    return reduce(
        lambda d, c: d.withColumn(c, F.coalesce(F.col(f"`{c}`"), F.lit(value))), columns, df
    )
