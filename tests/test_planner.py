from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from thermolane.operators import matching, reshape
from thermolane.plans import planner
from thermolane.plans.planner import PlanOptions
from tests.conftest import rows

FEATURE = ("site string, zone string, ts timestamp, set_temp double, units_on int, mode int, fan_speed int, "
           "adjusted_power double, indoor_temp double, outdoor_temp double, solar_radiation double")
FORECAST = "site string, ts timestamp, outdoor_temp double, solar_radiation double"
EQUIPMENT = "site string, zone string, outdoor_unit string, indoor_unit string, load_share double"


def hour(day, h, temp=10.0, solar=100.0, power=5.0, mode=1, units=1, zone="Area 1", set_temp=22.0):
    ts = f"2024-01-{day:02d} {h:02d}:00:00"
    return ("S", zone, ts, set_temp, units, mode, 1, power, 21.0, temp, solar)


@pytest.fixture(scope="module")
def equipment(frame):
    return frame(EQUIPMENT, ("S", "Area 1", "1", "u1", 1.0), ("S", "Area 1", "1", "u2", 1.0))


@pytest.fixture(scope="module")
def forecast(frame):
    return frame(FORECAST, *[("S", f"2024-02-01 {h:02d}:00:00", 10.0 + h / 10, 100.0) for h in (8, 9, 10, 13)])


def types(frame, op):
    return frame("site string, zone string, month int, operation_type string", ("S", "Area 1", 2, op))


def used(plan):
    return [(r.datetime.hour, r.hist_datetime_used.day) for r in plan.orderBy("datetime").collect()]


def test_options_are_checked():
    for bad in ({"block_hours": 1}, {"hour_range": (8, 8)}, {"hour_range": (-1, 5)}, {"hour_range": (5, 25)}):
        with pytest.raises(ValueError):
            PlanOptions(**bad)


def test_similar_days_keep_the_earlier_on_ties(frame, forecast):
    hist = frame(FEATURE, *[hour(d, 8, temp=t) for d, t in ((1, 10.0), (2, 14.0), (3, 10.0), (4, 30.0))])
    history = planner.pattern_history(hist, forecast)
    scores = matching.day_scores(matching.daily_weather(history), matching.forecast_days(forecast))
    got = rows(matching.similar_days(scores, 3).select("rank", "date"), "rank")
    assert got == [(1, date(2024, 1, 1)), (2, date(2024, 1, 3)), (3, date(2024, 1, 2))]


def test_weighted_days_ignore_the_sun_in_the_evening(frame):
    fc = frame(FORECAST, ("S", "2024-02-01 18:00:00", 10.0, 0.0))
    hist = frame(FEATURE, hour(1, 18, temp=10.0, solar=900.0), hour(2, 18, temp=11.0, solar=0.0), hour(3, 18, temp=30.0, solar=400.0))
    daily, days = matching.daily_weather(planner.pattern_history(hist, fc)), matching.forecast_days(fc)
    first = lambda w: matching.similar_days(matching.day_scores(daily, days, w), 1).first().date.day
    assert (first(False), first(True)) == (2, 1)


def test_no_complete_day_takes_fewest_missing_then_power(frame, forecast, equipment):
    hist = frame(FEATURE, hour(1, 8, power=1.0), hour(2, 8, power=9.0), hour(2, 9, power=9.0), hour(3, 8, power=4.0), hour(3, 9, power=4.0))
    plan = planner.plan_zones(hist, forecast, equipment, options=PlanOptions(block_hours=None))
    assert used(plan) == [(8, 3), (9, 3)]


def test_complete_day_of_lowest_power_wins(frame, forecast, equipment):
    hist = frame(FEATURE, *[hour(d, h, power=p) for d, p in ((1, 6.0), (2, 5.0)) for h in (8, 9, 10, 13)], hour(3, 8, power=0.1))
    plan = planner.plan_zones(hist, forecast, equipment, options=PlanOptions(block_hours=None))
    assert used(plan) == [(8, 2), (9, 2), (10, 2), (13, 2)]


def test_a_day_without_a_blocks_hour_is_no_candidate_for_it(frame, forecast, equipment):
    hist = frame(FEATURE, hour(1, 8, temp=10.8), hour(2, 8, temp=20.0), hour(2, 9, temp=21.0), hour(1, 10, temp=11.0), hour(2, 10, temp=40.0))
    plan = planner.plan_zones(hist, forecast, equipment, options=PlanOptions(block_hours=2))
    assert used(plan) == [(8, 2), (9, 2), (10, 1)]


def test_mode_filter_and_its_fallback(frame, forecast, equipment):
    hist = frame(FEATURE, hour(1, 13, mode=2), hour(2, 13, mode=3, temp=11.0))
    cool = planner.plan_zones(hist, forecast, equipment, types(frame, "COOL"))
    assert used(cool) == [(13, 2)]
    # No day has an allowed mode: all days stay candidates, and the row filter then finds nothing.
    history = planner.pattern_history(hist, forecast)
    days = planner.similar_day_candidates(history, forecast, types(frame, "OFF"), PlanOptions())
    assert days.count() == 2
    assert planner.plan_zones(hist, forecast, equipment, types(frame, "OFF")).count() == 0


def test_block_mode_prefers_the_target_mode_in_an_hour(frame, forecast, equipment):
    hist = frame(FEATURE, hour(1, 13, mode=3, power=1.0, set_temp=25.0), hour(1, 13, mode=1, power=7.0, set_temp=24.0))
    plan = planner.plan_zones(hist, forecast, equipment, types(frame, "COOL"))
    assert [r.set_temp for r in plan.collect()] == [24.0]


def test_whole_day_takes_the_first_known_value_of_each_column(frame, forecast, equipment):
    hist = frame(FEATURE, hour(1, 8, power=1.0, set_temp=None, mode=1), hour(1, 8, power=2.0, set_temp=24.0, mode=2))
    plan = planner.plan_zones(hist, forecast, equipment, options=PlanOptions(block_hours=None))
    assert rows(plan.select("set_temp", "mode", "power")) == [(24.0, "COOL", 1.0)]


def test_units_are_capped_and_idle_modes_fixed(frame, forecast, equipment):
    hist = frame(FEATURE, hour(1, 8, units=9), hour(1, 9, units=0), hour(1, 10, units=0, mode=3))
    got = rows(planner.plan_zones(hist, forecast, equipment).select("mode", "fan_speed", "numb_units_on", "ac_on_off", "power"), "power", "mode")
    assert got == [("FAN", "AUTO", 0, "OFF", 0.0), ("COOL", "LOW", 2, "ON", 5.0), ("FAN", "LOW", 0, "OFF", 5.0)]
    unknown = planner.plan_zones(hist, forecast, equipment.where("false"))
    assert {r.numb_units_on for r in unknown.collect()} == {0}


def test_hours_outside_the_range_have_null_settings(frame, forecast, equipment):
    hist = frame(FEATURE, *[hour(1, h) for h in (8, 9, 10, 13)])
    plan = planner.plan_zones(hist, forecast, equipment, options=PlanOptions(hour_range=(9, 11)))
    got = rows(plan.select(F.hour("datetime"), "mode", "forecast_outdoor_temp"), "datetime")
    assert got == [(8, None, 10.8), (9, "COOL", 10.9), (10, "COOL", 11.0), (13, None, 11.3)]


def test_opening_hours_and_statistics_add_up(frame, forecast):
    hist = planner.pattern_history(frame(FEATURE, hour(1, 8), hour(1, 9), hour(1, 10)), forecast)
    settings = frame("site string, zone string, start_time string, end_time string", ("S", "Area 1", "09:00", "20:00"))
    options = PlanOptions(use_operating_hours=True)
    patterns = planner.chosen_patterns(hist, forecast, None, options)
    matched = planner.matched_hours(hist, forecast, patterns, settings, options)
    got = rows(planner.run_statistics(matched).drop("site", "zone"))
    assert got == [(4, 1, 1, 2, 2 / 3 * 100.0)]
    assert matched.count() == forecast.count()


def test_old_rows_of_the_recent_only_zone_are_left_out(frame, forecast, equipment):
    old = [("S", z, "2023-01-31 08:00:00", 22.0, 1, 1, 1, 5.0, 21.0, 10.0, 100.0) for z in ("Area 1", "Area 3")]
    hist = planner.pattern_history(frame(FEATURE, *old), forecast)
    assert [r.zone for r in hist.collect()] == ["Area 3"]


def test_wide_and_back_is_the_same_plan(frame, forecast, equipment):
    hist = frame(FEATURE, *[hour(1, h, zone=z) for h in (8, 9) for z in ("Area 1", "Area 3")])
    both = equipment.unionByName(frame(EQUIPMENT, ("S", "Area 3", "2", "u3", 1.0)))
    plan = planner.plan_zones(hist, forecast, both)
    wide = reshape.plan_wide(plan)
    assert reshape.zones_of(wide.drop("Area 3_mode")) == reshape.zones_of(wide)
    back = reshape.plan_long(wide).where("ac_on_off IS NOT NULL").select(*plan.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, plan.collect()))


def test_plan_order(frame):
    df = frame("site string, datetime timestamp, zone string", ("S", "2024-02-01 09:00:00", "Area 1"),
               ("S", "2024-02-01 08:00:00", "new"), ("S", "2024-02-01 08:00:00", "Area 3"), ("S", "2024-02-01 08:00:00", "Area2_1"))
    assert [r.zone for r in planner.in_plan_order(df).collect()] == ["Area2_1", "Area 3", "new", "Area 1"]


def test_unit_plan(frame):
    plan = frame("site string, datetime timestamp, zone string, ac_on_off string, mode string, set_temp double, fan_speed string",
                 ("S", "2024-02-01 08:00:00", "Area 1", "ON", "COOL", 22.0, "LOW"),
                 ("S", "2024-02-01 08:00:00", "Area 3", None, "HEAT", 25.0, None))
    equipment = frame(EQUIPMENT, ("S", "Area 1", "1", "u1", 1.0), ("S", "Area 1", "1", "shared", 1.0), ("S", "Area 3", "2", "shared", 1.0))
    units = reshape.unit_plan(plan, equipment)
    got = rows(units.drop("site", "datetime"), "unit")
    assert got == [("shared", "OFF", "OFF", 25.0, None), ("u1", "ON", "COOL", 22.0, "LOW")]
    wide = reshape.unit_plan_wide(units, ["u1", "shared"]).first()
    assert wide["Date Time"] == "2024/02/01 08:00" and wide["u1_OnOFF"] == "ON" and wide["shared_Mode"] == "OFF"


def test_rows_per_unit_and_time_are_not_grouped(frame):
    plan = frame("site string, datetime timestamp, zone string, ac_on_off string, mode string, set_temp double, fan_speed string",
                 *[("S", f"2024-02-01 {h:02d}:00:00", z, "ON", "COOL", t, "LOW") for h in (8, 9) for z, t in (("Area 1", 22.0), ("Area 3", 25.0), ("new", 20.0))],
                 ("S", "2024-02-01 10:00:00", "Area 3", "ON", "HEAT", 26.0, "LOW"), ("T", "2024-02-01 08:00:00", "Area 1", "ON", "FAN", 21.0, "LOW"))
    equipment = frame(EQUIPMENT, ("S", "Area 1", "1", "u1", 1.0), ("S", "Area 1", "2", "u1", 1.0), ("S", "Area 3", "2", "u2", 1.0),
                      ("S", "new", "2", "u2", 1.0), ("S", "Area 1", "2", None, 1.0), ("T", "Area 1", "1", "u1", 1.0),
                      ("S", "empty", "1", "u3", 1.0), (None, "Area 1", "1", "u4", 1.0), ("S", None, "1", "u5", 1.0))
    units = reshape.unit_plan(plan, equipment)
    got = sorted(((r.site, r.unit, r.datetime.hour, r.SetTemp) for r in units.collect()), key=str)
    assert got == sorted([("S", None, 8, 22.0), ("S", None, 9, 22.0), ("S", "u1", 8, 22.0), ("S", "u1", 9, 22.0), ("S", "u2", 8, 25.0),
                          ("S", "u2", 9, 25.0), ("S", "u2", 10, 26.0), ("T", "u1", 8, 21.0)], key=str)
    assert "Aggregate" not in units._jdf.queryExecution().optimizedPlan().toString()


def test_a_long_history_keeps_only_top_days(spark, forecast):
    """Every day is compared; a zone with nearly all rows still yields exactly the nearest days."""
    start = datetime(2020, 1, 1, 8)
    n = 1400
    days = spark.range(n).select(
        F.lit("S").alias("site"), F.when(F.col("id") % 100 == 0, "Area 4").otherwise("Area 3").alias("zone"),
        (F.lit(start) + F.make_dt_interval(F.col("id").cast("int"))).alias("ts"), F.lit(22.0).alias("set_temp"),
        F.lit(1).alias("units_on"), F.lit(1).alias("mode"), F.lit(1).alias("fan_speed"), F.lit(5.0).alias("adjusted_power"),
        F.lit(21.0).alias("indoor_temp"), (F.col("id") % 37).cast("double").alias("outdoor_temp"), F.lit(100.0).alias("solar_radiation"))
    history = planner.pattern_history(days, forecast)
    top = planner.similar_day_candidates(history, forecast, None, PlanOptions())
    got = [r.date for r in top.where("zone = 'Area 3'").orderBy("rank").collect()]
    warm = [(start + timedelta(days=i)).date() for i in range(n) if i % 37 == 11 and i % 100]
    assert got == warm[:20]
