"""Multi-target regression and what-if scoring with Spark ML."""

import json

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from thermolane.functions.numeric import steady


def fit_targets(train: DataFrame, features, targets, trees=600, depth=6, step=0.05, seed=42):
    """One boosted-tree model per target. Each fit is distributed over the rows."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="__x", handleInvalid="keep")
    ]
    for t in targets:
        stages.append(
            GBTRegressor(
                featuresCol="__x",
                labelCol=t,
                predictionCol=f"pred_{t}",
                maxIter=trees,
                maxDepth=depth,
                stepSize=step,
                subsamplingRate=0.8,
                seed=seed,
                checkpointInterval=10,
            )
        )
    return Pipeline(stages=stages).fit(train)


def scores(predictions: DataFrame, targets) -> DataFrame:
    """R2 and mean absolute error of every target in one aggregate."""

    def row(t):
        err = F.col(t) - F.col(f"pred_{t}")
        spread = F.var_pop(t) * F.count(t)
        return F.struct(
            F.lit(t).alias("target"),
            F.when(spread > 0, steady(1 - F.sum(err * err) / spread)).alias("r2"),
            steady(F.avg(F.abs(err))).alias("mae"),
            F.count(F.lit(1)).alias("rows"),
        )

    return predictions.agg(F.array(*[row(t) for t in targets]).alias("r")).select(
        F.explode("r").alias("r")
    ).select("r.*")


SCENARIO = "scenario int, set_temp double, mode int, fan int, asked int"


def scenario_rows(forecast: DataFrame, features, scenarios) -> DataFrame:
    """Feature rows of a forecast under each scenario: the same settings for every unit.

    A scenario is (set_temp, mode, fan, units_on): of the units, in the order of the features, the
    first `units_on` run; fewer than 0 means none, None or more than there are means all.
    Feature names are `{metric}__{unit}` or columns of the forecast; other features, and missing
    weather, are 0. Scenarios are a short list, so they are exploded from a literal.
    """
    switches = [f for f in features if f.startswith("on_off__")]
    cases = F.from_json(
        F.lit(json.dumps([{"scenario": i, "set_temp": float(t), "mode": int(m), "fan": int(f), "asked": None if k is None else int(k)}
                          for i, (t, m, f, k) in enumerate(scenarios)])),
        f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in SCENARIO.split(', '))}>>",
    )
    rows = forecast.withColumn("__case", F.explode(cases))
    running = F.least(F.greatest(F.coalesce(F.col("__case.asked"), F.lit(len(switches))), F.lit(0)), F.lit(len(switches)))
    uniform = {"set_temp__": "set_temp", "mode__": "mode", "fan_speed__": "fan"}

    def value(name):
        if name in switches:
            return (F.lit(switches.index(name)) < F.col("__running")).cast("double")
        for prefix, setting in uniform.items():
            if name.startswith(prefix):
                return F.col(f"__case.{setting}").cast("double")
        return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0)) if name in forecast.columns else F.lit(0.0)

    return rows.withColumn("__running", running).select(
        "site",
        "ts",
        "__case.scenario",
        F.col("__case.set_temp").alias("set_temp_uniform"),
        F.col("__case.mode").alias("mode_uniform"),
        F.col("__case.fan").alias("fan_uniform"),
        F.col("__case.asked").alias("units_on_asked"),
        F.col("__running").alias("units_on_uniform"),
        *[value(f).alias(f) for f in features],
    )


def what_if(
    forecast: DataFrame, features, set_temp: float, mode: int, fan: int, units_on: int = None
) -> DataFrame:
    """The rows of one scenario (see `scenario_rows`)."""
    return scenario_rows(forecast, features, [(set_temp, mode, fan, units_on)]).drop("scenario", "units_on_asked")
