from datetime import datetime

import pytest
from pyspark.sql import functions as F

from thermolane.operators import rollup
from thermolane.plans import features
from tests.conftest import rows

READING = "site string, unit string, ts timestamp, set_temp double, indoor_temp double, on_off string, mode string, fan_speed string"
HOUR = "2024-01-01 08:{:02d}:00"


def reading(unit, minute, set_temp, indoor, on, mode, fan, hour=HOUR):
    return ("S", unit, hour.format(minute), set_temp, indoor, on, mode, fan)


def test_commonest_values_take_the_lowest_on_ties(frame):
    df = frame(READING,
               reading("a", 1, 22.0, None, "ON", "HEAT", "Low"), reading("a", 2, 20.0, None, "OFF", "COOL", "High"),
               reading("a", 3, 22.0, None, "OFF", "HEAT", None), reading("a", 4, 20.0, None, "OFF", "COOL", "High"),
               reading("b", 1, None, 20.0, "OFF", "FAN", "Low"))
    out = rollup.unit_hours(rollup.coded(df))
    got = rows(out.select("unit", "set_temp", "indoor_temp", "on_off", "mode", "fan_speed", "samples"), "unit")
    assert got == [("a", 20.0, None, 1, 1, 3, 4), ("b", None, 20.0, 0, 3, 1, 1)]


def test_a_null_mode_stays_null(frame):
    df = frame(READING, reading("a", 1, 22.0, 20.0, "ON", None, None))
    out = rollup.unit_hours(rollup.coded(df, fill_nulls=False))
    assert rows(out.select("mode", "fan_speed")) == [(None, None)]


def test_zone_hour_counts_units_and_takes_the_first_units_mode(frame):
    df = frame("site string, zone string, unit string, ts timestamp, set_temp double, indoor_temp double, on_off int, mode int, fan_speed int",
               ("S", "z", "b", "2024-01-01 08:00:00", 21.0, 20.0, 1, 2, 1), ("S", "z", "a", "2024-01-01 08:00:00", 23.0, 22.0, 1, 1, 3),
               ("S", "z", "c", "2024-01-01 08:00:00", 23.0, None, 0, 3, 1))
    got = rows(rollup.with_status(rollup.zone_hours(df)).drop("site", "zone", "ts"))
    assert got == [(23.0, 21.0, 2, 1, 1, 1, 1)]


def test_meters_match_exactly_else_by_base_id(frame):
    power = frame("site string, mesh_id int, ts timestamp, total_kwh double",
                  ("S", 49, "2024-01-01 08:10:00", 1.0), ("S", 49, "2024-01-01 08:20:00", 2.0), ("S", 50, "2024-01-01 08:00:00", 8.0))
    outdoor = frame("site string, zone string, outdoor_unit string, indoor_unit string, load_share double",
                    ("S", "A", "49-1", "u1", 1.0), ("S", "A", "49-1", "u2", 1.0), ("S", "B", "50", "u3", 0.5),
                    ("S", "C", "51", "u4", 1.0), ("T", "D", "49", "u5", 1.0))
    got = rows(rollup.zone_power(power, outdoor).select("zone", "adjusted_power"), "zone")
    assert got == [("A", 3.0), ("B", 4.0)]


def test_an_own_meter_wins_over_the_base_at_every_hour(frame):
    power = frame("site string, mesh_id string, ts timestamp, total_kwh double",
                  ("S", "49", "2024-01-01 08:00:00", 1.0), ("S", "49-1", "2024-01-01 09:00:00", 5.0))
    outdoor = frame("site string, zone string, outdoor_unit string, load_share double", ("S", "A", "49-1", 1.0))
    got = rows(rollup.zone_power(power, outdoor).select("ts", "adjusted_power"))
    assert got == [(datetime(2024, 1, 1, 9), 5.0)]


@pytest.fixture(scope="module")
def table(frame):
    readings = frame(READING,
                     reading("Ｕ 1", 1, 22.0, 20.04, "ON", "COOL", "Low"),
                     reading("U1", 2, 22.0, 20.06, "OFF", "cool", "Low"),
                     reading("U1", 1, 23.0, 21.25, "OFF", "HEAT", "Top", "2024-01-06 09:{:02d}:00"),
                     reading("stray", 1, 23.0, 1.0, "ON", "HEAT", "Top", "2024-01-06 10:{:02d}:00"))
    power = frame("site string, mesh_id int, ts timestamp, total_kwh double", ("S", 7, "2024-01-01 08:00:00", 4.0))
    weather = frame("site string, datetime timestamp, humidity double, `temperature C` double".replace("`temperature C`", "t"),
                    ("S", "2024-01-01 08:00:00", 50.0, 5.25)).withColumnRenamed("t", "temperature C")
    equipment = frame("site string, zone string, outdoor_unit string, indoor_unit string, load_share double",
                      ("S", "Area 1", "7", "U1", 1.0), ("S", "Empty", "8", "U9", 1.0))
    holidays = frame("date date", ("2024-01-01",))
    return features.zone_features(readings, power, weather, equipment, holidays)


def test_feature_table(table):
    got = rows(table.where("zone = 'Area 1'").select(
        "ts", "set_temp", "indoor_temp", "indoor_temp_lag1", "units_on", "mode", "status", "adjusted_power",
        "outdoor_temp", "is_holiday", "is_weekend"), "ts")
    assert got == [
        (datetime(2024, 1, 1, 8), 22.0, 20.0, 20.0, 1, 1, 1, 4.0, 5.2, 1, 0),
        (datetime(2024, 1, 6, 9), 23.0, 21.2, 20.0, 0, 2, 0, None, None, 0, 1)]


def test_zone_without_readings_has_every_hour_of_its_site(table):
    got = rows(table.where("zone = 'Empty'").select("ts", "set_temp", "units_on", "mode", "status"), "ts")
    assert [r[0].hour for r in got] == [8, 9, 10]
    assert {r[1:] for r in got} == {(None, 0, 0, 0)}


def test_report_order(frame):
    df = frame("site string, zone string, ts timestamp", ("S", "new", "2024-01-01"), ("S", "Area 3", "2024-01-01"),
               ("S", "Area 1", "2024-01-01"), ("S", "Area 1", "2024-01-02"))
    got = [(r.zone, r.ts.day) for r in features.report_order(df).collect()]
    assert got == [("Area 1", 2), ("Area 1", 1), ("Area 3", 1), ("new", 1)]


def test_a_hot_unit_reaches_one_row_per_hour(spark):
    """A third of all readings belong to one unit hour; counts stay whole."""
    df = spark.range(30000).select(
        F.lit("S").alias("site"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("unit"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"), (F.col("id") % 4).cast("double").alias("set_temp"),
        F.lit(1.0).alias("indoor_temp"), F.lit(1).alias("on_off"), F.lit(1).alias("mode"), F.lit(0).alias("fan_speed"))
    out = rollup.unit_hours(df)
    assert rows(out.where("unit = 'hot'").select("samples", "set_temp")) == [(10000, 0.0)]
    assert out.agg(F.sum("samples")).first()[0] == 30000
