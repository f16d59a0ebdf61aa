"""Similar-day search and pattern choice.

Frames used here, all keyed by (site, zone):
  history    hourly patterns: ts, date, hour, set_temp, units_on, mode, fan_speed,
             adjusted_power, indoor_temp, outdoor_temp, solar_radiation
  forecast   hourly weather of a site: site, ts, outdoor_temp, solar_radiation
  candidates (site, zone, fc_date, date, rank): similar days of a forecast day

A forecast has a few days, so the day-to-day comparison grows with the history days, and the
per-zone frames are hourly: nothing here holds raw readings.
"""

from pyspark.sql import DataFrame, Window, functions as F

from thermolane.functions import categories as cat
from thermolane.functions.numeric import (
    MEAN2_DIGITS,
    hour_mask,
    popcount,
    steady,
    steady_mean,
    zscore,
)
from thermolane.operators.ordered import hour_blocks

ZONE = ["site", "zone"]
CASE = ["site", "zone", "fc_date"]


#: Fixed value: calendar days of a forecast, the day of the run first.
FORECAST_DAYS = 4


def in_forecast(df: DataFrame, run_day, days: int = FORECAST_DAYS, ts: str = "ts") -> DataFrame:
    """Rows of the forecast window of a run: from the start of its day, so many days."""
    start = F.date_trunc("day", F.lit(run_day).cast("timestamp"))
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.make_dt_interval(F.lit(days))))


def before_forecast(df: DataFrame, run_day, ts: str = "ts") -> DataFrame:
    """The history of a run: rows before the start of its day."""
    return df.where(F.col(ts) < F.date_trunc("day", F.lit(run_day).cast("timestamp")))


def with_day_and_hour(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns({date: F.to_date("ts"), "hour": F.hour("ts")})


def daily_weather(history: DataFrame) -> DataFrame:
    """Daily mean weather and the modes seen, with the zone's mean and deviation over days."""
    zone = Window.partitionBy(*ZONE)
    daily = history.groupBy(*ZONE, "date").agg(
        steady_mean(F.col("outdoor_temp"), MEAN2_DIGITS).alias("temp"),
        steady_mean(F.col("solar_radiation"), MEAN2_DIGITS).alias("solar"),
        F.collect_set("mode").alias("modes"),
    )
    spread = {}
    for c in ("temp", "solar"):
        spread[f"{c}_mean"] = F.avg(c).over(zone)
        spread[f"{c}_sd"] = F.stddev_samp(c).over(zone)
    return daily.withColumns(spread)


def forecast_days(forecast: DataFrame) -> DataFrame:
    """Mean weather, first hour and the set of hours of each forecast day."""
    rows = with_day_and_hour(forecast, "fc_date")
    return rows.groupBy("site", "fc_date").agg(
        steady_mean(F.col("outdoor_temp"), MEAN2_DIGITS).alias("fc_temp"),
        steady_mean(F.col("solar_radiation"), MEAN2_DIGITS).alias("fc_solar"),
        F.hour(F.min("ts")).alias("first_hour"),
        hour_mask(F.col("hour")).alias("fc_hours"),
    )


def day_scores(daily: DataFrame, days: DataFrame, weighted: bool = False) -> DataFrame:
    """Distance of every history day from every forecast day of its site, in z units."""
    pairs = daily.join(days, "site")

    def gap(day, fc, name):
        m, sd = F.col(f"{name}_mean"), F.col(f"{name}_sd")
        return F.abs(zscore(F.col(day), m, sd) - zscore(F.col(fc), m, sd))

    temp, solar = gap("temp", "fc_temp", "temp"), gap("solar", "fc_solar", "solar")
    if weighted:
        w = cat.weather_weights(F.col("first_hour"))
        score = w["temperature"] * temp + w["solar"] * solar
    else:
        score = temp + solar
    return pairs.withColumn("score", steady(score))


def similar_days(scores: DataFrame, top: int) -> DataFrame:
    """The `top` nearest days per forecast day; equal scores keep the earlier date.

    Spark applies the rank limit before any shuffle the ranking needs (window group limit),
    so a long history sends on `top` rows per task.
    """
    w = Window.partitionBy(*CASE).orderBy(F.col("score").asc_nulls_last(), "date")
    return (
        scores.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= top)
        .select(*CASE, "date", "rank", "score", "modes")
    )


def with_operation_type(candidates: DataFrame, operation_types: DataFrame) -> DataFrame:
    """Attach the operation type of the zone in the forecast month, and what it allows.

    `operation_types` has (site, zone, month, operation_type); None switches the filter off.
    """
    if operation_types is None:
        typed = candidates.withColumn("operation_type", F.lit(None).cast("string"))
    else:
        typed = candidates.withColumn("month", F.month("fc_date")).join(
            operation_types.select(*ZONE, "month", "operation_type"),
            [*ZONE, "month"],
            "left",
        ).drop("month")
    kind = F.col("operation_type")
    return typed.withColumns({"allowed": cat.allowed_modes(kind), "target": cat.target_mode(kind)})


def days_of_allowed_mode(candidates: DataFrame) -> DataFrame:
    """Keep days that have an allowed mode; if a forecast day would lose all, keep all."""
    fits = F.coalesce(F.arrays_overlap("modes", "allowed"), F.lit(False))
    return (
        candidates.withColumn("__fits", fits)
        .withColumn("__any", F.max("__fits").over(Window.partitionBy(*CASE)))
        .where("allowed IS NULL OR __fits OR NOT __any")
        .drop("__fits", "__any")
    )


def mode_is_allowed():
    return F.expr("allowed IS NULL OR array_contains(allowed, mode)")


def candidate_hours(history: DataFrame, candidates: DataFrame, days: DataFrame) -> DataFrame:
    """Pattern rows of every candidate day at the forecast hours, with the day's coverage.

    Adds avg_power, available_hours, missing_hours and coverage_rate of the row's day. One
    repartition by forecast day serves these windows and the later choice; such a partition
    holds at most `top` days of 24 hourly rows.
    """
    wanted = candidates.join(days.select("site", "fc_date", "fc_hours"), ["site", "fc_date"])
    rows = (
        wanted.drop("modes", "score")
        .join(history, [*ZONE, "date"])
        .where("getbit(CAST(fc_hours AS BIGINT), hour) = 1")
    )
    day = Window.partitionBy(*CASE, "date")
    required = popcount(F.col("fc_hours"))
    return (
        rows.repartition(*CASE)
        .withColumn(
            "avg_power", steady(F.avg("adjusted_power").over(day), MEAN2_DIGITS)
        )
        .withColumn("available_hours", popcount(hour_mask(F.col("hour")).over(day)))
        .withColumn("missing_hours", required - F.col("available_hours"))
        .withColumn("coverage_rate", F.col("available_hours") / required)
    )


def day_coverage(hours: DataFrame) -> DataFrame:
    """One row per candidate day: mean power, missing hours and coverage."""
    return hours.select(
        *CASE, "date", "rank", "avg_power", "available_hours", "missing_hours", "coverage_rate"
    ).dropDuplicates([*CASE, "date"])


def best_day_hours(hours: DataFrame) -> DataFrame:
    """Rows of the complete day of lowest power; without one, of the day missing fewest hours."""
    w = Window.partitionBy(*CASE).orderBy("missing_hours", "avg_power", "rank")
    return hours.withColumn("__place", F.dense_rank().over(w)).where("__place = 1").drop("__place")


PATTERN_COLUMNS = [
    "set_temp",
    "units_on",
    "mode",
    "fan_speed",
    "adjusted_power",
    "indoor_temp",
    "outdoor_temp",
    "solar_radiation",
]


def whole_day_patterns(best_hours: DataFrame, prefer_target: bool = False) -> DataFrame:
    """One pattern per hour of the chosen day, from its rows of an allowed mode.

    Each column takes its first non-null value by (preferred mode, power), so one hour may
    mix two rows, as the source rule has it.
    """
    rows = best_hours.where(mode_is_allowed())
    other = (
        F.coalesce((F.col("mode") != F.col("target")).cast("int"), F.lit(0))
        if prefer_target
        else F.lit(0)
    )
    place = F.struct(other.alias("p"), F.col("adjusted_power"), F.col("ts"))
    return rows.groupBy(*CASE, "hour").agg(
        *[
            F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c)
            for c in [*PATTERN_COLUMNS, "ts"]
        ]
    ).withColumnRenamed("ts", "hist_ts")


def forecast_blocks(forecast: DataFrame, size: int) -> DataFrame:
    """Hour blocks of each forecast day with their mean weather and weights.

    One row per (site, fc_date, hour).
    """
    rows = with_day_and_hour(forecast, "fc_date")
    hours = rows.groupBy("site", "fc_date", "hour").agg(
        F.sum("outdoor_temp").alias("t_sum"),
        F.count("outdoor_temp").alias("t_n"),
        F.sum("solar_radiation").alias("s_sum"),
        F.count("solar_radiation").alias("s_n"),
    )
    block = Window.partitionBy("site", "fc_date", "block_start")
    return hour_blocks(hours, ["site", "fc_date"], size).select(
        "site",
        "fc_date",
        "hour",
        "block_start",
        steady(F.sum("t_sum").over(block) / F.sum("t_n").over(block), MEAN2_DIGITS).alias("block_temp"),
        steady(F.sum("s_sum").over(block) / F.sum("s_n").over(block), MEAN2_DIGITS).alias("block_solar"),
        F.count(F.lit(1)).over(block).cast("int").alias("block_hours"),
    )


def block_hours(history: DataFrame, candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """Allowed pattern rows of candidate days that cover a whole block, with the distance.

    Adds distance (weather of the day's block to the forecast block) and avg_power. A block
    of one row has no deviation, so the plain difference counts. One repartition by block
    serves these windows and the later choice; such a partition holds at most `top` days of
    a block's hourly rows.
    """
    rows = (
        candidates.select(*CASE, "date", "rank", "allowed", "target")
        .join(history, [*ZONE, "date"])
        .where(mode_is_allowed())
        .join(blocks, ["site", "fc_date", "hour"])
        .repartition(*CASE, "block_start")
    )
    day = Window.partitionBy(*CASE, "block_start", "date")

    def gap(forecast, column):
        diff = F.abs(F.col(forecast) - F.avg(column).over(day))
        sd = F.stddev_samp(column).over(day)
        return F.when(sd > 0, diff / sd).otherwise(diff)

    w = cat.weather_weights(F.col("block_start"))
    return (
        rows.withColumn("__covered", popcount(hour_mask(F.col("hour")).over(day)))
        .withColumn("__t", gap("block_temp", "outdoor_temp"))
        .withColumn("__s", gap("block_solar", "solar_radiation"))
        .withColumn("avg_power", steady(F.avg("adjusted_power").over(day), MEAN2_DIGITS))
        .where(F.col("__covered") == F.col("block_hours"))
        .withColumn(
            "distance", steady(w["temperature"] * F.col("__t") + w["solar"] * F.col("__s"))
        )
        .drop("__covered", "__t", "__s")
    )


def best_block_hours(rows: DataFrame) -> DataFrame:
    """Rows of the nearest day of every block; equal distances go to lower power, then rank."""
    w = Window.partitionBy(*CASE, "block_start").orderBy(
        F.col("distance").asc_nulls_last(), "avg_power", "rank"
    )
    return rows.withColumn("__place", F.dense_rank().over(w)).where("__place = 1").drop("__place")


def best_blocks(best_hours: DataFrame) -> DataFrame:
    """One row per block: the chosen day with its distance and power."""
    return best_hours.select(
        *CASE, "block_start", "date", "rank", "distance", "avg_power"
    ).dropDuplicates([*CASE, "block_start"])


def block_patterns(best_hours: DataFrame) -> DataFrame:
    """One row per forecast hour from the chosen blocks: target mode first, then low power."""
    other = F.coalesce((F.col("mode") != F.col("target")).cast("int"), F.lit(0))
    w = Window.partitionBy(*CASE, "block_start", "hour").orderBy(other, "adjusted_power", "ts")
    return (
        best_hours.withColumn("__rn", F.row_number().over(w))
        .where("__rn = 1")
        .select(*CASE, "hour", *PATTERN_COLUMNS, F.col("ts").alias("hist_ts"))
    )
