from datetime import datetime

from pyspark.sql import functions as F

from thermolane.constants import AC_COLUMNS
from thermolane.operators import cleaning
from thermolane.plans import preprocess
from tests.conftest import rows


def test_duplicates_keep_on_and_the_last(frame):
    df = frame("ts int, unit string, on_off string, src int",
               (1, "a", "OFF", 1), (1, "a", "on", 2), (1, "a", "OFF", 3), (2, "a", "OFF", 4), (2, "a", None, 5))
    out = cleaning.drop_duplicates_prefer_on(df, ["ts", "unit"], F.col("src"))
    assert rows(out.select("ts", "src"), "ts") == [(1, 2), (2, 5)]
    first = cleaning.drop_duplicates_keep_first(df, ["ts", "unit"], F.col("src"))
    assert rows(first.select("ts", "src"), "ts") == [(1, 1), (2, 4)]


def test_outliers_are_sequential_and_drop_nulls(frame):
    data = [(float(i % 3), float(i)) for i in range(20)] + [(100.0, 1000.0), (None, 1.0)]
    df = frame("a double, b double", *data)
    out = cleaning.drop_outliers(df, ["a", "b", "absent"], 2.0)
    # 1000 leaves with its row in the first pass, so it does not widen the second.
    assert rows(out.agg(F.count("*"), F.max("b"))) == [(20, 19.0)]


def test_single_row_has_no_deviation(frame):
    df = frame("a double", (1.0,))
    assert cleaning.drop_outliers(df, ["a"], 5.0).count() == 0
    same = frame("a double", (1.0,), (1.0,))
    assert cleaning.drop_outliers(same, ["a"], 5.0).count() == 2


def test_required_fields(frame):
    df = frame("k int, n string", (1, "a"), (2, " "), (3, None), (None, "b"))
    assert rows(cleaning.require_filled(df, ["k", "n", "absent"])) == [(1, "a")]


def test_recent_history_limits_one_zone(frame):
    df = frame("zone string, ts timestamp",
               (" Area 1", "2023-01-31 09:00:00"), ("area 1", "2023-01-31 10:00:00"),
               ("Area 3", "2020-01-01 00:00:00"), (None, "2020-01-01 00:00:00"))
    newest = F.lit("2024-01-31 10:00:00").cast("timestamp")
    out = cleaning.recent_history(df, newest, "area 1", 12)
    assert out.count() == 3


def test_period_hours_and_projection(frame):
    df = frame("ts timestamp, a_hist_x int, b int", ("2024-01-01 08:00:00", 1, 2), ("2024-01-02 19:00:00", 1, 2))
    assert cleaning.in_period(df, end="2024-01-01 08:00:00").count() == 1
    assert cleaning.in_hours(df, 8, 19).count() == 1
    assert cleaning.time_first(cleaning.without_columns_like(df)).columns == ["ts", "date", "b"]


def test_control_log(frame):
    df = frame("ts string, unit string, on_off string, indoor_temp double, n int",
               ("2024-01-01 00:00:10", "a", "OFF", 20.0, 1), ("2024-01-01 00:00:50", "a", "ON", 21.0, 2),
               ("2024-01-01 00:01:00", "a", "ON", None, 3), ("2024-01-01T09:02:00+09:00", "a", "ON", 22.0, 4))
    out = preprocess.clean_control_log(df, F.col("n"))
    assert out.columns[:2] == ["ts", "date"]
    assert rows(out.select("ts", "n"), "ts") == [
        (datetime(2024, 1, 1, 9, 0), 2), (datetime(2024, 1, 1, 9, 2), 4)]


def test_power_log_ignores_the_address(frame):
    df = frame("ts string, mesh_id int, pm_addr_id int, phase_a double, phase_b double, n int",
               ("2024-01-01 00:00:10", 1, 1, None, 5.0, 1), ("2024-01-01 00:00:20", 1, 2, 9.0, 9.0, 2),
               ("2024-01-01 00:01:00", 1, 1, 2.0, 2.0, 3))
    out = preprocess.clean_power_log(df, F.col("n"))
    assert rows(out.select("n", "phase_a", "total_kwh"), "n") == [(1, 0.0, 5.0), (3, 2.0, 4.0)]


def test_raw_headings(frame):
    raw = frame("Datetime string, x int", ("2024-01-01", 1)).withColumnRenamed("x", "A/C Name")
    assert preprocess.standardize(raw, AC_COLUMNS).columns == ["ts", "unit"]
