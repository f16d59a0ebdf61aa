import pytest
from pyspark.sql import functions as F

from thermolane.operators import statistics as st
from thermolane.plans import limits, master
from tests.conftest import rows

READING = "unit string, ts timestamp, on_off string, set_temp double, indoor_temp double, fan_speed string"


@pytest.fixture(scope="module")
def readings(frame):
    return frame(READING,
                 ("a", "2023-01-05", "ON", 22.0, 20.0, "Low"), ("a", "2024-01-05", "ON", 23.0, 21.0, "High"),
                 ("a", "2024-02-05", "ON", 25.0, None, None), ("a", "2024-02-06", "OFF", 99.0, 99.0, "Top"),
                 ("b", "2024-01-05", "ON", 20.0, 19.0, "High"), (None, "2024-01-05", "ON", 1.0, 1.0, "Low"))


def test_months_pool_years_and_ignore_off(readings):
    got = rows(st.monthly_statistics(st.on_only(readings), ["set_temp"]), "unit", "month")
    assert got == [("a", 1, 22.5, 0.7, 2), ("a", 2, 25.0, None, 1), ("b", 1, 20.0, None, 1)]


def test_report_tables(readings):
    t = limits.monthly_report(readings, ["a", "b"])
    mean = rows(t["set_temp_mean"].select("month_label", "a", "b"), "month")
    assert mean[0] == ("1月", 22.5, 20.0) and mean[11] == ("12月", None, None) and len(mean) == 12
    assert rows(t["samples"].select("a", "b"), "month")[:3] == [(2, 1), (1, 0), (0, 0)]
    fans = {(r.month, r.fan_speed): (r.frequency, r.a, r.b) for r in t["fan_speed"].collect()}
    assert len(fans) == 36
    assert fans[(1, "Low")] == (2, 1, 0) and fans[(1, "High")] == (2, 1, 1) and fans[(2, "Unknown")] == (1, 1, 0)


def test_limits_round_to_half_and_skip_unknown_spread(readings):
    lim = st.unit_limits(st.monthly_statistics(st.on_only(readings), ["set_temp", "indoor_temp"]))
    got = rows(lim.select("unit", "month", "set_temp_lower", "set_temp_upper", "indoor_temp_upper"), "unit", "month")
    assert got == [("a", 1, 22.0, 23.0, 21.0), ("a", 2, None, None, None), ("b", 1, None, None, None)]


def test_top_speeds_count_unused_speeds(readings):
    got = rows(st.top_speeds(st.on_only(readings)).select("unit", "rank", "fan_speed", "n"), "unit", "rank")
    assert got == [("a", 1, "High", 1), ("a", 2, "Low", 1), ("a", 3, "Unknown", 1),
                   ("b", 1, "High", 1), ("b", 2, "Low", 0), ("b", 3, "Unknown", 0)]


def test_area_speed_votes(frame):
    tops = frame("area string, unit string, rank int, fan_speed string",
                 ("x", "u1", 1, "High"), ("x", "u1", 2, "Unknown"), ("x", "u2", 1, "Low"), ("x", "u2", 2, "Unknown"), ("y", "u3", 1, "Unknown"))
    assert rows(st.area_speeds(tops), "area") == [("x", "High"), ("y", "Low")]


def test_master_rows_are_overwritten_with_nulls_too(frame, readings):
    master_rows = frame("zone string, month_label string, comfort_min double, fan_candidates string",
                        ("A", "1月", 1.0, "x"), ("A", "3月", 1.0, "x"), ("B", "1月", 1.0, "x"))
    areas = frame("unit string, area string", ("a", "A"), ("b", None))
    out = limits.updated_master(master_rows, readings, areas)
    got = rows(out.select("zone", "month_label", "comfort_min", "setpoint_max", "fan_candidates"), "zone", "month_label")
    assert got == [("A", "1月", 20.0, 23.0, "High"), ("A", "3月", None, None, "High"), ("B", "1月", 1.0, None, "x")]


def test_equipment_splits_and_cleans(frame):
    m = frame("site string, zone string, outdoor_unit string, indoor_unit string",
              ("S", " Area 2", "49-1,", "D-8北2"), ("S", "エリア2", "50", "D-2北1"), ("S", "Area 2", "50", "other"),
              ("S", "Area 1 ", "51", "u"), ("S", None, "51", "v"), ("S", "Area 1", None, "w"))
    got = rows(master.equipment(m).drop("site", "load_share"), "zone")
    assert got == [("Area 1", "51", "u"), ("Area2_1", "49-1", "D-8北2"), ("Area2_2", "50", "D-2北1")]


def test_settings_reach_both_parts_and_have_defaults(frame):
    zones = frame("site string, zone string", ("S", "Area2_1"), ("S", "Area2_2"), ("S", "Area 9"))
    settings = frame("site string, zone string, month_label string, start_time string, end_time string, comfort_min double, comfort_max double, setpoint_min double, setpoint_max double, fan_candidates string, operation_type string",
                     ("S", "Area 2", "1月", "09:00:00 x", None, 20.0, 23.0, None, 27.0, "Low,High", "cool"))
    one = master.zone_settings(zones, settings, 1)
    got = rows(one.select("zone", "start_time", "end_time", "target_room_temp", "setpoint_min", "fan_candidates"), "zone")
    part = ("09:00:00", "20:00", 21.5, 22.0, ["Low", "High"])
    assert got == [("Area 9", None, None, None, None, None), ("Area2_1", *part), ("Area2_2", *part)]
    assert rows(master.operating_hours(one).select("open_hour", "close_hour"), "zone") == [(7, 20), (9, 20), (9, 20)]
    other = master.zone_settings(zones, settings, 5)
    assert {tuple(r) for r in other.select("start_time", "target_room_temp").collect()} == {("07:00", 25.0)}
    types = rows(master.operation_types(settings).select("zone", "month", "operation_type"), "zone")
    assert types == [("Area2_1", 1, "COOL"), ("Area2_2", 1, "COOL")]


def test_correlation_skips_constants_and_null_pairs(frame):
    df = frame("t double, a double, b double", (1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (None, 9.0, 5.0))
    corr = st.correlations(df, ["a", "b", "absent"], ["t"])
    assert rows(corr.select("feature", "corr"), "feature") == [("a", 1.0), ("b", None)]
    assert rows(st.top_correlated(corr, 1).select("feature")) == [("a",)]
    with pytest.raises(ValueError):
        st.correlations(df, ["x"], ["y"])


def test_profile_distribution_and_codes(frame):
    df = frame("k int, v double, l string", *[(1, float(i), "b" if i % 2 else "a") for i in range(5)], (1, None, None))
    p = {r.column_name: (r.total_rows, r.null_count, r.null_percent) for r in st.quality_profile(df).collect()}
    assert p["v"] == (6, 1, 16.6667) and p["k"] == (6, 0, 0.0)
    assert rows(st.distribution(df, ["k"], "v")) == [(1, 0.0, 1.0, 2.0, 3.0, 4.0)]
    assert {(r.l, r.c) for r in st.label_codes(df, "l", "c").collect()} == {("a", 0), ("b", 1), (None, -1)}


def test_missing_outputs(frame):
    want = frame("f string, d int", ("x", 1), ("x", 2), ("y", 1))
    have = frame("f string, d int", ("x", 1), ("x", 1), ("y", 1))
    assert rows(st.missing_outputs(want, have, ["f", "d"])) == [("x", 2)]
    assert rows(st.output_flags(want, have, ["f", "d"], ["f"]), "f") == [("x", 2, 1, False), ("y", 1, 1, True)]
    assert want.where(F.lit(False)).count() == 0
