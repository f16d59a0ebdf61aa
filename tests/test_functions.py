from datetime import date, datetime

from pyspark.sql import functions as F

from thermolane.functions import categories as cat, names, numeric, temporal
from tests.conftest import rows


def test_rounding_is_half_even(frame):
    df = frame("x double", (0.25,), (0.35,), (22.25,), (22.75,), (-0.25,))
    got = rows(df.select(numeric.round_half_even(F.col("x"), 1), numeric.round_to_half(F.col("x"))))
    assert got == [(0.2, 0.0), (0.4, 0.5), (22.2, 22.0), (22.8, 23.0), (-0.2, -0.0)]


def test_zscore_without_spread_is_zero(frame):
    df = frame("x double, m double, s double", (5.0, 1.0, 2.0), (5.0, 1.0, 0.0), (5.0, 1.0, None))
    z = numeric.zscore(F.col("x"), F.col("m"), F.col("s"))
    assert rows(df.select(z)) == [(2.0,), (0.0,), (0.0,)]


def test_null_safe_sum_and_hour_mask(frame):
    df = frame("a int, b int, h int", (1, None, 0), (None, None, 23), (2, 3, 23))
    assert rows(df.select(numeric.null_safe_sum(["a", "b"]))) == [(1.0,), (0.0,), (5.0,)]
    assert rows(df.agg(numeric.popcount(numeric.hour_mask(F.col("h"))))) == [(2,)]


def test_wet_bulb_matches_published_value(frame):
    df = frame("t double, u double", (20.0, 50.0))
    assert abs(rows(df.select(numeric.wet_bulb(F.col("t"), F.col("u"))))[0][0] - 13.7) < 0.1


def test_category_codes_and_defaults(frame):
    df = frame("f string, m string", (" high ", "cool"), ("Turbo", "dry"), (None, None), ("2", "1"))
    got = rows(
        df.select(
            cat.category_code(F.col("f"), "fan_speed"),
            cat.category_code(F.col("m"), "mode"),
            cat.category_code(F.col("f"), "fan_speed", True),
        )
    )
    assert got == [(3, 1, 3), (0, 3, 0), (None, None, 0), (0, 3, 0)]


def test_numeric_codes_pass_through(frame):
    df = frame("m int", (2,), (9,), (None,))
    assert rows(df.select(cat.category_code(F.col("m"), "mode"))) == [(2,), (3,), (None,)]


def test_labels_candidates_and_allowed_modes(frame):
    df = frame("c int, l array<string>, op string", (1, ["low", "x"], "cool"), (9, ["x"], "dry"))
    got = rows(
        df.select(
            cat.code_label(F.col("c"), "fan_speed"),
            cat.candidate_codes(F.col("l"), "fan_speed", ["HIGH"]),
            cat.allowed_modes(F.col("op")),
            cat.target_mode(F.col("op")),
        )
    )
    assert got == [("LOW", [1], [1, 3], 1), ("9", [3], None, None)]


def test_label_list_and_flags(frame):
    df = frame("t string, x string", ("Low, High ,", "2"), (None, "x"))
    got = rows(df.select(cat.label_list(F.col("t")), cat.on_off_flag(F.col("x"))))
    assert got == [(["Low", "High", ""], 1), (None, 0)]


def test_status_and_effective_on(frame):
    df = frame("u int, m int, s string", (0, 1, "ON"), (2, 1, "on"), (1, 0, "1"), (1, 2, None))
    got = rows(
        df.select(
            cat.status_code(F.col("u"), F.col("m")), cat.effective_on(F.col("u"), F.col("s"))
        )
    )
    assert got == [(0, False), (1, True), (3, True), (2, False)]


def test_weather_weights_by_hour(frame):
    df = frame("h int", (6,), (7,), (16,), (17,))
    got = rows(df.select(cat.weather_weights(F.col("h")).alias("w")).select("w.*"))
    assert got == [(1.0, 0.0), (0.7, 0.3), (0.7, 0.3), (1.0, 0.0)]


def test_local_times(frame):
    df = frame("t string", ("2024-01-01 00:30:00",), ("2024-01-01T00:30:45+00:00",), ("bad",))
    got = rows(df.select(temporal.assume_local(F.col("t")), temporal.local_minute(F.col("t"))))
    assert got == [
        (datetime(2023, 12, 31, 15, 30), datetime(2024, 1, 1, 9, 30)),
        (datetime(2024, 1, 1, 0, 30, 45), datetime(2024, 1, 1, 9, 30)),
        (None, None),
    ]


def test_calendar_and_labels(frame):
    df = frame("ts timestamp", ("2024-01-07 23:10:00",))
    got = rows(temporal.calendar_columns(df).select("date", "day_of_week", "hour", "month", "is_weekend"))
    assert got == [(date(2024, 1, 7), 6, 23, 1, 1)]
    m = frame("l string", ("12月",), ("13月",), ("x",), (None,))
    assert rows(m.select(temporal.month_number(F.col("l")))) == [(12,), (None,), (None,), (None,)]
    assert rows(df.select(temporal.plan_time(F.col("ts")))) == [("2024/01/07 23:10",)]


def test_clock_hour_and_file_names(frame):
    df = frame("c string, f string", ("09:30", "a/unit_schedule_20240131_01.csv"), ("x", "zone_20240131"))
    kind, day = temporal.schedule_file_parts(F.col("f"))
    got = rows(df.select(temporal.clock_hour(F.col("c"), 7), kind, day))
    assert got == [(9, "unit", date(2024, 1, 31)), (7, None, None)]


def test_unit_names_take_one_form(frame):
    df = frame("unit string", ("Ｄ－８　北2",), ("D–8 北2",), ("Dー8北２",), ("G-21",), (None,))
    got = [r[0] for r in names.normalize_unit_names(df, "unit").collect()]
    assert sorted(got, key=str) == sorted(["D-8北2"] * 3 + ["G-21", None], key=str)


def test_zone_names_ids_and_headings(frame):
    df = frame("n string, o string", ("Meeting Room 2", "49-1,"), ("12", " 49 "), (None, None))
    got = rows(df.select(names.zone_from_name(F.col("n")), names.clean_outdoor_unit(F.col("o"))))
    assert got == [("Meeting Room", "49-1"), ("Unknown", "49"), ("Unknown", None)]
    assert names.warehouse_name("A/C ON/OFF") == "AC_ON_OFF"
    assert names.warehouse_name("Outdoor Temp.") == "Outdoor_Temp"
