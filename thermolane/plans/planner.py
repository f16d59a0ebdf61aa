"""Plan settings for a forecast period from similar past days or hour blocks."""

from dataclasses import dataclass
from typing import Optional, Tuple

from pyspark.sql import DataFrame, functions as F

from thermolane import constants as C
from thermolane.functions import categories as cat
from thermolane.operators import cleaning, matching
from thermolane.plans.master import operating_hours, unit_counts

ZONE = ["site", "zone"]


@dataclass(frozen=True)
class PlanOptions:
    """block_hours=None chooses whole days; a number >= 2 chooses hour blocks of that size."""

    block_hours: Optional[int] = C.BLOCK_HOURS
    hour_range: Optional[Tuple[int, int]] = None
    use_operating_hours: bool = False
    use_mode_priority: bool = False
    similar_days: int = C.SIMILAR_DAYS
    weighted_days: bool = False

    def __post_init__(self):
        if self.block_hours is not None and self.block_hours < 2:
            raise ValueError(f"block_hours must be None or >= 2, got {self.block_hours}")
        if self.hour_range is not None:
            first, stop = self.hour_range
            if not (0 <= first < 24 and 0 < stop <= 24 and first < stop):
                raise ValueError(f"hour_range must be (0-23, 1-24) and rising, got {first}, {stop}")


def pattern_history(features: DataFrame, forecast: DataFrame) -> DataFrame:
    """Valid pattern hours, with old rows of the recent-only zone removed."""
    newest = forecast.agg(F.max("ts").alias("m")).scalar()
    recent = cleaning.recent_history(
        cleaning.valid_patterns(features), newest, C.RECENT_ONLY_ZONE, C.RECENT_MONTHS
    )
    return matching.with_day_and_hour(recent).select(
        *ZONE, "ts", "date", "hour", *matching.PATTERN_COLUMNS
    )


def working_forecast(forecast: DataFrame, options: PlanOptions) -> DataFrame:
    if options.hour_range is None:
        return forecast
    return cleaning.in_hours(forecast, *options.hour_range)


def similar_day_candidates(
    history: DataFrame, forecast: DataFrame, operation_types: DataFrame, options: PlanOptions
) -> DataFrame:
    scores = matching.day_scores(
        matching.daily_weather(history), matching.forecast_days(forecast), options.weighted_days
    )
    top = matching.similar_days(scores, options.similar_days)
    return matching.days_of_allowed_mode(matching.with_operation_type(top, operation_types))


def chosen_patterns(
    history: DataFrame, forecast: DataFrame, operation_types: DataFrame, options: PlanOptions
) -> DataFrame:
    """One pattern per (site, zone, fc_date, hour) that has one."""
    candidates = similar_day_candidates(history, forecast, operation_types, options)
    if options.block_hours is None:
        hours = matching.candidate_hours(history, candidates, matching.forecast_days(forecast))
        return matching.whole_day_patterns(
            matching.best_day_hours(hours), options.use_mode_priority
        )
    blocks = matching.forecast_blocks(forecast, options.block_hours)
    rows = matching.block_hours(history, candidates, blocks)
    return matching.block_patterns(matching.best_block_hours(rows))


def matched_hours(
    history: DataFrame,
    forecast: DataFrame,
    patterns: DataFrame,
    settings: DataFrame = None,
    options: PlanOptions = PlanOptions(),
) -> DataFrame:
    """Every (zone, forecast row) of the site with its pattern, if any, and its outcome.

    outcome: `success`, `no_pattern`, or `outside_hours` (zone closed at that hour).
    """
    zones = history.select(*ZONE).distinct()
    hours = forecast.selectExpr(
        "site",
        "to_date(ts) AS fc_date",
        "hour(ts) AS hour",
        "ts AS datetime",
        "outdoor_temp AS forecast_outdoor_temp",
        "solar_radiation AS forecast_solar_radiation",
    )
    joined = zones.join(hours, "site").join(
        patterns, [*ZONE, "fc_date", "hour"], "left"
    )
    found = F.col("hist_ts").isNotNull()
    if options.use_operating_hours:
        joined = joined.join(operating_hours(settings), ZONE, "left")
        opened = F.coalesce("open_hour", F.lit(C.DEFAULT_OPEN_HOUR))
        closed = F.coalesce("close_hour", F.lit(C.DEFAULT_CLOSE_HOUR))
        inside = (F.col("hour") >= opened) & (F.col("hour") < closed)
    else:
        inside = F.lit(True)
    return joined.withColumn(
        "outcome",
        F.when(~inside, "outside_hours").when(found, "success").otherwise("no_pattern"),
    )


def plan_rows(matched: DataFrame, equipment: DataFrame) -> DataFrame:
    """Plan rows of the hours with a pattern; running units never exceed the installed ones."""
    capped = matched.where(F.col("outcome") == "success").join(
        unit_counts(equipment), ZONE, "left"
    )
    code = F.coalesce(F.col("mode"), F.lit(0)), F.coalesce(F.col("fan_speed"), F.lit(0))
    return capped.select(
        "*",
        F.expr("least(coalesce(units_on, 0), coalesce(max_units, 0))").alias("numb_units_on"),
        cat.code_label(code[0], "mode").alias("mode_label"),
        cat.code_label(code[1], "fan_speed").alias("fan_label"),
    ).selectExpr(
        "datetime",
        *ZONE,
        "set_temp",
        "mode_label AS mode",
        "fan_label AS fan_speed",
        "numb_units_on",
        "CASE WHEN numb_units_on > 0 THEN 'ON' ELSE 'OFF' END AS ac_on_off",
        "adjusted_power AS power",
        "indoor_temp",
        "hist_ts AS hist_datetime_used",
        "forecast_outdoor_temp",
        "forecast_solar_radiation",
        "outdoor_temp AS hist_outdoor_temp",
        "solar_radiation AS hist_solar_radiation",
        "indoor_temp AS hist_indoor_temp",
    )


def null_rows(plan: DataFrame, zones: DataFrame, outside: DataFrame) -> DataFrame:
    """Rows with null settings for forecast hours outside the planned range."""
    rows = zones.join(
        outside.selectExpr(
            "site",
            "ts AS datetime",
            "outdoor_temp AS forecast_outdoor_temp",
            "solar_radiation AS forecast_solar_radiation",
        ),
        "site",
    )
    have = set(rows.columns)
    return rows.selectExpr(
        *[
            c if c in have else f"CAST(NULL AS {kind}) AS {c}"
            for c, kind in plan.dtypes
        ]
    )


def needs_fix():
    """Cooling or heating while no unit runs."""
    return F.expr(
        "coalesce(mode IN ('COOL', 'HEAT') "
        "AND (ac_on_off = 'OFF' OR numb_units_on = 0 OR numb_units_on IS NULL), false)"
    )


def fix_idle_modes(plan: DataFrame) -> DataFrame:
    """Cooling or heating without a running unit becomes fan, automatic, no power."""
    bad = needs_fix()
    new = {"mode": "FAN", "fan_speed": "AUTO", "power": 0.0}
    return plan.withColumns({c: F.when(bad, v).otherwise(F.col(c)) for c, v in new.items()})


def correction_counts(plan: DataFrame) -> DataFrame:
    return plan.where(needs_fix()).groupBy(*ZONE).agg(F.count(F.lit(1)).alias("corrections"))


def run_statistics(matched: DataFrame) -> DataFrame:
    """Hours per zone by outcome and the share of success within opening hours, in percent."""

    def count(outcome):
        return F.count_if(F.col("outcome") == outcome)

    valid = F.col("total_hours") - F.col("outside_op_hours")
    return (
        matched.groupBy(*ZONE)
        .agg(
            F.count(F.lit(1)).alias("total_hours"),
            count("outside_hours").alias("outside_op_hours"),
            count("no_pattern").alias("no_similar_patterns"),
            count("success").alias("success"),
        )
        .withColumn(
            "success_rate",
            F.when(valid > 0, F.col("success") / valid * 100.0).otherwise(F.lit(0.0)),
        )
    )


def in_plan_order(plan: DataFrame, zones=C.ZONE_ORDER) -> DataFrame:
    """Plan rows by time, then zone in report order (unknown zones last)."""
    place = F.array_position(F.array(*[F.lit(z) for z in zones]), F.col("zone"))
    rank = F.when(place > 0, place).otherwise(len(zones) + 1)
    return plan.orderBy("site", "datetime", rank, "zone")


def plan_zones(
    features: DataFrame,
    forecast: DataFrame,
    equipment: DataFrame,
    operation_types: DataFrame = None,
    settings: DataFrame = None,
    options: PlanOptions = PlanOptions(),
) -> DataFrame:
    """The plan of all zones in one query: one row per zone and forecast time, long.

    `features` is read several times (daily means, candidate hours, chosen hours): pass a
    stored table, as the feature job writes it.
    """
    history = pattern_history(features, forecast)
    working = working_forecast(forecast, options)
    patterns = chosen_patterns(history, working, operation_types, options)
    matched = matched_hours(history, working, patterns, settings, options)
    plan = plan_rows(matched, equipment)
    if options.hour_range is not None:
        first, stop = options.hour_range
        outside = forecast.where((F.hour("ts") < first) | (F.hour("ts") >= stop))
        plan = plan.unionByName(null_rows(plan, history.select(*ZONE).distinct(), outside))
    return fix_idle_modes(plan)
