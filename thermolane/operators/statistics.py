"""Monthly statistics, control limits, correlations, distributions and quality reports."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window, functions as F

from thermolane.functions.numeric import round_half_even, round_to_half, steady, steady_mean
from thermolane.functions.temporal import month_label
from thermolane.operators.ordered import row_positions
from thermolane.sources.staging import stage

NO_LABEL = "Unknown"
DEFAULT_SPEED = "Low"


def on_only(readings: DataFrame) -> DataFrame:
    """Readings of running units, with month of year (years pooled) and a fan label."""
    return (
        readings.where(F.col("on_off") == "ON")
        .withColumn("month", F.month("ts"))
        .withColumn("fan_speed", F.coalesce("fan_speed", F.lit(NO_LABEL)))
    )


def monthly_statistics(on: DataFrame, values) -> DataFrame:
    """Mean and sample deviation per unit and month, one decimal, and the sample count.

    One pass for all values: every aggregate combines map-side, so a unit with a third of
    the readings costs one row per task in the shuffle.
    """
    aggs = []
    for v in values:
        aggs.append(round_half_even(steady_mean(F.col(v)), 1).alias(f"{v}_mean"))
        aggs.append(round_half_even(steady(F.stddev_samp(v)), 1).alias(f"{v}_std"))
    return (
        on.where(F.col("unit").isNotNull())
        .groupBy("unit", "month")
        .agg(*aggs, F.count(F.lit(1)).alias("samples"))
    )


def fan_speed_counts(on: DataFrame) -> DataFrame:
    """Readings per month, fan speed and unit, with the month's total for the speed.

    Every speed has a row in each of the twelve months (count 0, unit null) so the report is
    complete. The totals include readings without a unit name.

    Raw readings are counted once, map-side first, and the counts stored. Totals (a row per month
    and speed) come from the counts; the counts are joined to them from the side that adaptive
    execution can split, and the months in which no unit used a speed are a grid of their own.
    """
    keys = ["month", "fan_speed"]
    counts = stage(on.groupBy(*keys, "unit").agg(F.count(F.lit(1)).alias("n")), "fan-counts")
    totals = counts.groupBy(*keys).agg(
        F.sum("n").alias("frequency"), F.count_if(F.col("unit").isNotNull()).alias("units")
    )
    named = counts.where(F.col("unit").isNotNull()).join(totals.drop("units"), keys)
    speeds = totals.select("fan_speed").distinct()
    grid = speeds.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    empty = grid.join(totals.where("units > 0"), keys, "left_anti").join(totals, keys, "left").select(
        *keys,
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        F.lit(None).cast("string").alias("unit"),
        F.lit(0).cast("bigint").alias("n"),
    )
    return named.select(*keys, "frequency", "unit", "n").unionByName(empty)


def unit_limits(monthly: DataFrame) -> DataFrame:
    """mean - sd and mean + sd of set point and room, to the nearest half degree."""
    limits = {}
    for v in ("set_temp", "indoor_temp"):
        mean, sd = F.col(f"{v}_mean"), F.col(f"{v}_std")
        limits[f"{v}_upper"] = round_to_half(mean + sd)
        limits[f"{v}_lower"] = round_to_half(mean - sd)
    return monthly.withColumns(limits)


def with_area(df: DataFrame, unit_area: DataFrame) -> DataFrame:
    """Attach the area of each unit; units without an area go."""
    areas = unit_area.where(F.col("area").isNotNull()).select("unit", "area").distinct()
    return df.join(areas, "unit")


def area_limits(limits: DataFrame) -> DataFrame:
    """Mean of the unit limits per month and area, to the nearest half degree."""
    names = ["indoor_temp_lower", "indoor_temp_upper", "set_temp_upper", "set_temp_lower"]
    return limits.groupBy("month", "area").agg(
        *[round_to_half(steady_mean(F.col(n))).alias(n) for n in names]
    )


def top_speeds(on: DataFrame, top: int = 3) -> DataFrame:
    """The `top` commonest fan speeds of each unit over all months, ties by name.

    Speeds a unit never used count 0 and can fill a place. A unit with fewer than `top`
    speeds finds its fillers among the first 2 * `top` names, so that short list is enough.
    """
    counts = on.where(F.col("unit").isNotNull()).groupBy("unit", "fan_speed").agg(
        F.count(F.lit(1)).alias("n")
    )
    first_names = counts.select("fan_speed").distinct().orderBy("fan_speed").limit(2 * top)
    fillers = first_names.agg(F.collect_list("fan_speed")).scalar()
    unused = (
        counts.select("unit")
        .distinct()
        .withColumn("fan_speed", F.explode(fillers))
        .join(counts, ["unit", "fan_speed"], "left_anti")
        .withColumn("n", F.lit(0).cast("bigint"))
    )
    w = Window.partitionBy("unit").orderBy(F.col("n").desc(), "fan_speed")
    return (
        counts.unionByName(unused)
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= top)
    )


def area_speeds(tops: DataFrame) -> DataFrame:
    """The speed most units of an area have among their top speeds; none -> "Low".

    Ties go to the speed met first in (unit, rank) order.
    """
    votes = tops.groupBy("area", "fan_speed").agg(
        F.count(F.lit(1)).alias("votes"), F.min(F.struct("unit", "rank")).alias("first")
    )
    usable = F.col("fan_speed") != NO_LABEL
    order = F.when(usable, F.struct((-F.col("votes")).alias("v"), F.col("first")))
    return votes.groupBy("area").agg(
        F.coalesce(F.min_by("fan_speed", order), F.lit(DEFAULT_SPEED)).alias("fan_candidates")
    )


def limits_for_master(
    limits: DataFrame, speeds: DataFrame, areas: DataFrame
) -> DataFrame:
    """New master values for each of the twelve months of each area."""
    grid = areas.select("area").distinct().withColumn(
        "month", F.explode(F.sequence(F.lit(1), F.lit(12)))
    )
    return (
        grid.join(limits, ["month", "area"], "left")
        .join(speeds, "area", "left")
        .select(
            F.col("area").alias("zone"),
            month_label(F.col("month")).alias("month_label"),
            F.col("indoor_temp_lower").alias("comfort_min"),
            F.col("indoor_temp_upper").alias("comfort_max"),
            F.col("set_temp_lower").alias("setpoint_min"),
            F.col("set_temp_upper").alias("setpoint_max"),
            "fan_candidates",
        )
    )


def update_master(master: DataFrame, updates: DataFrame) -> DataFrame:
    """Overwrite matched (zone, month) rows, nulls included; other rows stay as they are."""
    values = [c for c in updates.columns if c not in ("zone", "month_label")]
    new = updates.select(
        "zone",
        "month_label",
        *[F.col(c).alias(f"__new_{c}") for c in values],
        F.lit(True).alias("__hit"),
    )
    joined = master.join(new, ["zone", "month_label"], "left")
    old = {v: F.col(v) if v in master.columns else F.lit(None) for v in values}
    joined = joined.withColumns(
        {v: F.when(F.col("__hit"), F.col(f"__new_{v}")).otherwise(old[v]) for v in values}
    )
    return joined.drop("__hit", *[f"__new_{v}" for v in values])


def correlations(df: DataFrame, features, targets) -> DataFrame:
    """Absolute correlation of every feature with every target; null where one is constant.

    Pairs are unpivoted and aggregated by name. Partial aggregation leaves one row per pair
    and task; a pair skips rows where either value is null.
    """
    pairs = [
        (t, f)
        for t in targets
        if t in df.columns
        for f in dict.fromkeys([*features, *targets])
        if f in df.columns and f != t
    ]
    if not pairs:
        raise ValueError("none of the features and targets is a column of the table")
    rows = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("target"),
                        F.lit(f).alias("feature"),
                        F.col(f).cast("double").alias("x"),
                        F.col(t).cast("double").alias("y"),
                    )
                    for t, f in pairs
                ]
            )
        ).alias("p")
    ).select("p.*")
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    x, y = F.when(both, F.col("x")), F.when(both, F.col("y"))
    return rows.groupBy("target", "feature").agg(
        steady(
            F.abs(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))
        ).alias("corr")
    )


def top_correlated(corr: DataFrame, top: int = 5) -> DataFrame:
    w = Window.partitionBy("target").orderBy(F.col("corr").desc_nulls_last(), "feature")
    return corr.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def quality_profile(df: DataFrame) -> DataFrame:
    """Rows, nulls, null share and type of every column, from one aggregate."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(t).alias("data_type"),
                    F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"),
                )
                for c, t in df.dtypes
            ]
        ).alias("cols"),
    )
    return row.select(
        F.col("n").alias("total_rows"), F.explode("cols").alias("c")
    ).select(
        "c.column_name",
        "c.data_type",
        "total_rows",
        "c.null_count",
        steady(100.0 * F.col("c.null_count") / F.col("total_rows"), 4).alias("null_percent"),
    )


def quality_summary(df: DataFrame, zone: str = "zone") -> DataFrame:
    """One row: how many rows and columns, columns with nulls, and the zones by name.

    A frame without the zone column has no zones. Zones are counted as a set per task first.
    """
    some = [F.when(F.count_if(F.col(f"`{c}`").isNull()) > 0, F.lit(c)) for c in df.columns]
    zones = F.collect_set(zone) if zone in df.columns else F.array().cast("array<string>")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.array_join(F.array_compact(F.array(*some)), ",").alias("columns_with_nulls"),
        F.array_sort(zones).alias("zones"),
    )


def merge_quality(zones: DataFrame, power: DataFrame) -> DataFrame:
    """How well power covers the zone hours: nulls, their span, and the common range."""
    joined = zones.select("site", "zone", "ts", "indoor_temp").join(
        power.select("site", "zone", "ts", "adjusted_power"), ["site", "zone", "ts"], "left"
    )
    missing = F.col("adjusted_power").isNull()
    left = joined.groupBy("site", "zone").agg(
        F.count(F.lit(1)).alias("zone_rows"),
        F.count_if(missing).alias("missing_power"),
        F.min(F.when(missing, F.col("ts"))).alias("missing_from"),
        F.max(F.when(missing, F.col("ts"))).alias("missing_to"),
        F.count_if(F.col("indoor_temp").isNull()).alias("missing_indoor"),
        F.min("ts").alias("zone_from"),
        F.max("ts").alias("zone_to"),
    )
    right = power.groupBy("site", "zone").agg(
        F.count(F.lit(1)).alias("power_rows"),
        F.min("ts").alias("power_from"),
        F.max("ts").alias("power_to"),
    )
    start, end = F.greatest("zone_from", "power_from"), F.least("zone_to", "power_to")
    common = F.col("power_from").isNotNull() & (start <= end)
    return left.join(right, ["site", "zone"], "left").select(
        "site",
        "zone",
        "zone_rows",
        F.coalesce("power_rows", F.lit(0)).alias("power_rows"),
        "missing_power",
        "missing_indoor",
        "missing_from",
        "missing_to",
        F.when(common, start).alias("overlap_from"),
        F.when(common, end).alias("overlap_to"),
    )


QUARTILES = ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))


def distribution(df: DataFrame, keys, value: str, bucket=None) -> DataFrame:
    """Minimum, quartiles and maximum of `value` across units, per key; between two ranks linear.

    Exact on the values as they are. Values are ranked over balanced ranges (see
    `operators.ordered`), so that no key, however many values it has, sits in one task; of all
    rows only those at the two ranks next to each quartile go on.
    """
    filled = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"))
    ranked = row_positions(filled, keys, ["v"], bucket, name="rank")
    sizes = filled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("v_min"), F.max("v").alias("v_max")
    )
    sizes = stage(sizes, "sizes")
    renamed = sizes.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    joined = ranked.join(renamed, same)

    def place(p):
        return p * (F.col("n") - 1) + 1

    near = [F.col("rank").isin(F.floor(place(p)), F.ceil(place(p))) for p, _ in QUARTILES]
    ends = joined.where(reduce(or_, near)).groupBy(*keys, "n", "v_min", "v_max").agg(
        *[F.max(F.when(F.col("rank") == F.floor(place(p)), F.col("v"))).alias(f"{q}_low") for p, q in QUARTILES],
        *[F.max(F.when(F.col("rank") == F.ceil(place(p)), F.col("v"))).alias(f"{q}_high") for p, q in QUARTILES],
    )

    def quartile(p, q):
        low, high = F.col(f"{q}_low"), F.col(f"{q}_high")
        return steady(low + (high - low) * (place(p) - F.floor(place(p)))).alias(q)

    return ends.select(*keys, "v_min", *[quartile(p, q) for p, q in QUARTILES], "v_max")


def label_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Alphabetical codes 0, 1, ... of a category's labels; null -> -1."""
    labels = df.where(F.col(column).isNotNull()).select(column).distinct()
    places = row_positions(labels, [], [column], name="__code")
    return (
        df.join(places, column, "left")
        .withColumn(name, F.coalesce(F.col("__code").cast("int") - 1, F.lit(-1)))
        .select(*df.columns, name)
    )


def missing_outputs(expected: DataFrame, present: DataFrame, keys) -> DataFrame:
    """Expected keys that have no output."""
    return expected.select(*keys).distinct().join(
        present.select(*keys).distinct(), list(keys), "left_anti"
    )


def output_flags(expected: DataFrame, present: DataFrame, keys, by) -> DataFrame:
    """Per `by`: how many expected keys exist, and whether all do."""
    have = present.select(*keys).distinct().withColumn("__have", F.lit(True))
    found = F.coalesce(F.col("__have"), F.lit(False))
    return (
        expected.select(*keys)
        .distinct()
        .join(have, list(keys), "left")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("expected"),
            F.count_if(found).alias("present"),
            F.bool_and(found).alias("all_present"),
        )
    )
