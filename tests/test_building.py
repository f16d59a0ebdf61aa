from datetime import datetime

import pytest
from pyspark.sql import functions as F

from thermolane.operators import learning, reshape
from thermolane.plans import building
from tests.conftest import rows

INDOOR = "site string, ts timestamp, unit string, set_temp double, indoor_temp double, mode int, fan_speed int, on_off int"


@pytest.fixture(scope="module")
def indoor(frame):
    def row(h, unit, indoor, on):
        return ("S", f"2024-01-01 {h:02d}:00:00", unit, 22.0, indoor, 1, 1, on)

    return frame(INDOOR, row(1, "a", 20.0, 1), row(1, "b", 18.0, 1), row(2, "a", None, 0), row(2, "b", None, 1),
                 row(3, "a", 21.0, 1), row(4, "a", 25.0, 1), row(4, "b", 19.0, None))


def test_null_policy(indoor):
    # 03:00 lacks unit b, 04:00 lacks its switch; a's gap is while off, b's is not.
    got = rows(building.filled_hours(indoor).select(F.hour("ts"), "unit", "indoor_temp"), "ts", "unit")
    assert got == [(1, "a", 20.0), (1, "b", 18.0), (2, "a", 20.0), (2, "b", None)]


def test_matrix_drops_columns_with_nulls(frame, indoor):
    outdoor = frame("site string, ts timestamp, odu string, total_kwh double", ("S", "2024-01-01 01:00:00", "1-1", 3.0))
    out = building.building_matrix(indoor, outdoor, ["a", "b"], ["1-1"])
    assert "indoor_temp__a" in out.columns and "indoor_temp__b" not in out.columns
    assert rows(out.select("total_kwh__1-1"), "ts") == [(3.0,), (0.0,)]


def test_whole_number_mode_reads_text(frame):
    df = frame("k int, x string", (1, "2"), (1, "1"), (1, "ON"), (2, "x"))
    got = rows(df.groupBy("k").agg(building.whole_number_mode(F.col("x"))), "k")
    assert got == [(1, 1), (2, None)]


def test_last_value_per_time(frame):
    df = frame("site string, ts timestamp, unit string, x double, n int", ("S", "2024-01-01", "a", 1.0, 1),
               ("S", "2024-01-01", "a", 2.0, 2), ("S", "2024-01-01", "a", None, 3))
    assert rows(reshape.last_values(df, "x", "unit", ["a", "b"], "n").drop("site")) == [(datetime(2024, 1, 1), 2.0, None)]


def test_nested_equipment_becomes_rows(spark):
    nested = spark.sql("""SELECT 'S' AS site, 'z' AS zone, map(
        '1', named_struct('load_share', 0.5D, 'indoor_units', array('a', 'b', 'a')),
        '2', named_struct('load_share', 1.0D, 'indoor_units', array('c'))) AS outdoor_units""")
    got = rows(reshape.equipment_rows(nested), "indoor_unit")
    assert got == [("S", "z", "1", 0.5, "a"), ("S", "z", "1", 0.5, "b"), ("S", "z", "2", 1.0, "c")]


def test_regression_learns_and_scores(spark):
    df = spark.range(400).select(
        F.lit("S").alias("site"), F.lit("2024-01-01").cast("timestamp").alias("ts"),
        (F.col("id") % 2).cast("double").alias("on_off__a"), (F.col("id") % 7).cast("double").alias("outdoor_temp"),
    ).withColumn("kwh", F.col("on_off__a") * 10 + F.col("outdoor_temp"))
    names = ["on_off__a", "outdoor_temp"]
    model = learning.fit_targets(df, names, ["kwh"], trees=8, depth=4, step=0.5)
    score = learning.scores(model.transform(df), ["kwh"]).first()
    assert score.target == "kwh" and score.r2 > 0.95 and score.rows == 400
    cases = learning.what_if(df.limit(1), [*names, "other"], 26, 1, 1, units_on=0)
    assert rows(cases.select("on_off__a", "units_on_uniform", "other")) == [(0.0, 0, 0.0)]
    power = {k: model.transform(learning.what_if(df.limit(1), names, 26, 1, 1, units_on=k)).first().pred_kwh for k in (0, 1)}
    assert power[1] > power[0] + 5
