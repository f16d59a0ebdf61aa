"""Building-level matrix: hourly settings of every unit beside the energy of every meter."""

from pyspark.sql import DataFrame, functions as F

from thermolane.functions.names import outdoor_id
from thermolane.functions.numeric import steady, steady_mean
from thermolane.operators import reshape
from thermolane.operators.ordered import fill_forward_when
from thermolane.sources.staging import stage

INDOOR = ["set_temp", "indoor_temp", "mode", "fan_speed", "on_off"]
FILLED = ["set_temp", "mode", "fan_speed", "indoor_temp"]


_SPAN, _LARGEST = 2**32, 2**31 - 1


def _whole(x):
    """Text as a whole number, null where it is none."""
    return x.cast("string").try_cast("double").cast("int")


def whole_number_mode(x):
    """Commonest whole number (text that is no number is skipped), lowest on ties.

    For groups of few rows; `indoor_hours` counts instead.
    """
    return F.mode(_whole(x), True)


def indoor_hours(readings: DataFrame) -> DataFrame:
    """Hourly means of set point and room, and the commonest whole-number mode, fan speed and switch.

    Readings are summed by hour and combination of labels, then by label, so that hash
    aggregation with plain counters does all the work; the commonest label is the largest
    (count, lowest value) packed into one number.
    """
    keys, labels, values = ["site", "ts", "unit"], ["mode", "fan_speed", "on_off"], ["set_temp", "indoor_temp"]
    combined = readings.groupBy(
        "site", F.date_trunc("hour", "ts").alias("ts"), "unit", *[_whole(F.col(c)).alias(c) for c in labels]
    ).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(v).alias(f"{v}_sum") for v in values],
        *[F.count(v).alias(f"{v}_n") for v in values],
    )
    sums = [f"{v}_{s}" for v in values for s in ("sum", "n")]

    def vote(i, label):
        # The sums travel with the first label only.
        carried = [F.when(F.lit(i == 0), F.col(c)).alias(c) for c in sums]
        return F.struct(F.lit(i).alias("label"), F.col(label).alias("value"), "n", *carried)

    votes = combined.select(*keys, F.explode(F.array(*[vote(i, c) for i, c in enumerate(labels)])).alias("x"))
    counted = votes.select(*keys, "x.*").groupBy(*keys, "label", "value").agg(*[F.sum(c).alias(c) for c in ("n", *sums)])
    packed = F.when(F.col("value").isNotNull(), F.col("n") * _SPAN + (_LARGEST - F.col("value").cast("bigint")))
    hours = counted.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.max(F.when(F.col("label") == i, packed)).alias(c) for i, c in enumerate(labels)],
    )
    return hours.select(
        *keys,
        *[steady(F.col(f"{v}_sum") / F.when(F.col(f"{v}_n") > 0, F.col(f"{v}_n"))).alias(v) for v in values],
        *[(_LARGEST - F.pmod(F.col(c), F.lit(_SPAN))).cast("int").alias(c) for c in labels],
    )


def outdoor_hours(power: DataFrame) -> DataFrame:
    return power.groupBy(
        "site",
        F.date_trunc("hour", "ts").alias("ts"),
        outdoor_id(F.col("mesh_id"), F.col("pm_addr_id")).alias("odu"),
    ).agg(steady(F.sum("total_kwh"), 4).alias("total_kwh"))


def wide_hours(indoor: DataFrame, outdoor: DataFrame, units, odus) -> DataFrame:
    """Full outer join of the indoor and outdoor matrices on the hour."""
    left = reshape.sensor_matrix(indoor, INDOOR, "unit", units)
    right = reshape.sensor_matrix(outdoor, ["total_kwh"], "odu", odus)
    return left.join(right, ["site", "ts"], "full")


def complete_hours(indoor: DataFrame) -> DataFrame:
    """Hours of a site in which every one of its units has a switch state."""
    known = indoor.where(F.col("on_off").isNotNull())
    units = indoor.groupBy("site").agg(F.count_distinct("unit").alias("units"))
    return (
        known.groupBy("site", "ts")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(units, "site")
        .where(F.col("n") == F.col("units"))
        .select("site", "ts")
    )


def filled_hours(indoor: DataFrame) -> DataFrame:
    """Null policy, long: complete hours only, then forward fill of columns with a gap
    while the unit is off. Works per (site, unit), so no task sees a whole building."""
    rows = indoor.join(complete_hours(indoor), ["site", "ts"], "left_semi")
    return fill_forward_when(
        rows, FILLED, F.col("on_off") == 0, ["site", "unit"], ["ts"], F.trunc("ts", "month")
    )


def building_matrix(
    indoor: DataFrame, outdoor: DataFrame, units, odus, drop_columns: bool = True
) -> DataFrame:
    """Wide matrix of one building after the null policy.

    Missing energy is 0. `drop_columns` removes columns that still hold a null: the matrix is
    stored, one aggregate over it finds them, and the rest is read without them.
    """
    left = reshape.sensor_matrix(filled_hours(indoor), INDOOR, "unit", units)
    right = reshape.sensor_matrix(outdoor, ["total_kwh"], "odu", odus)
    kwh = [c for c in right.columns if c.startswith("total_kwh__")]
    wide = reshape.coalesce_all(left.join(right, ["site", "ts"], "left"), kwh, 0.0)
    return reshape.columns_without_nulls(stage(wide, "matrix")) if drop_columns else wide


def features_and_targets(features: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows whose time has both, without nulls."""
    return features.join(targets, ["site", "ts"]).dropna()
