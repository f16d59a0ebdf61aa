"""Operators whose plans and sizes must follow the input."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from thermolane.constants import PLAN_SETTINGS
from thermolane.operators import cleaning, learning, matching, ordered, reshape, statistics as st
from thermolane.plans import building
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_twice_the_input_has_twice_the_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_BYTES", 4096)
    found, buckets = {}, {}
    for size in (1, 2):
        path = str(tmp_path / str(size))
        for part in range(size):
            spark.range(part * 20000, (part + 1) * 20000, 1, 1).select(F.lit("u").alias("unit"), F.hash("id").alias("x"), "id").write.mode("append").parquet(path)
        df = spark.read.parquet(path)
        found[size] = ordered.ranges(df)
        buckets[size] = ordered.with_buckets(df, ["unit"], ["id"]).select("__bucket").distinct().count()
        placed = ordered.row_positions(df, ["unit"], ["id"])
        assert placed.where("pos <> id + 1").count() == 0
    assert found[1] > 20 and found[2] in range(2 * found[1] - 2, 2 * found[1] + 3)
    assert buckets[2] > 1.8 * buckets[1] and buckets[1] > 0.9 * found[1]


def test_split_counts_what_it_has_stored(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("n"), F.lit("clash").alias("pos"))
    out = ordered.chronological_split(df, ["n"])
    assert out.columns == ["n", "pos", "is_train"]
    assert rows(out.groupBy("is_train").agg(F.count("*"), F.max("n")), "is_train") == [(False, 200, 999), (True, 800, 799)]


def test_quartiles_are_of_the_values_themselves(frame):
    df = frame("k string, v double", ("a", 1.04), ("a", 1.06), ("a", 1.12), ("b", 5.0), ("c", None), (None, 1.0), (None, 2.0), ("d", 1.0), ("d", 1.0), ("d", 1.0), ("d", 9.0))
    got = {r.k: tuple(r)[1:] for r in st.distribution(df, ["k"], "v").collect()}
    assert got == {"a": (1.04, 1.05, 1.06, 1.09, 1.12), "b": (5.0,) * 5, None: (1.0, 1.25, 1.5, 1.75, 2.0), "d": (1.0, 1.0, 1.0, 3.0, 9.0)}
    assert st.distribution(df.limit(0), ["k"], "v").collect() == []


def test_quartiles_of_one_large_key(spark):
    df = spark.range(30001).select(F.lit(1).alias("k"), ((F.col("id") * 7919) % 30001 / 8).alias("v"))
    assert rows(st.distribution(df, ["k"], "v")) == [(1, 0.0, 937.5, 1875.0, 2812.5, 3750.0)]
    assert "ObjectHashAggregate" not in plan_of(st.distribution(df, ["k"], "v"))


def test_commonest_labels_by_counting(frame):
    df = frame(
        "site string, ts timestamp, unit string, set_temp double, indoor_temp double, mode string, fan_speed int, on_off int",
        ("S", "2024-01-01 01:10:00", "a", 20.0, None, "2", 3, 1), ("S", "2024-01-01 01:20:00", "a", 22.0, None, "1", None, 0),
        ("S", "2024-01-01 01:30:00", "a", None, None, "x", -5, 0), ("S", "2024-01-01 02:30:00", "a", 1.0, 2.0, None, None, 1),
        ("S", "2024-01-01 01:30:00", None, 7.0, 8.0, "3.0", 2147483647, None),
    )
    got = building.indoor_hours(df)
    want = [
        ("S", datetime(2024, 1, 1, 1), None, 7.0, 8.0, 3, 2147483647, None),
        ("S", datetime(2024, 1, 1, 1), "a", 21.0, None, 1, -5, 0),
        ("S", datetime(2024, 1, 1, 2), "a", 1.0, 2.0, None, None, 1),
    ]
    assert rows(got, "ts", "unit") == want
    plan = plan_of(got)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_fan_counts_have_every_month(frame):
    df = frame("month int, fan_speed string, unit string", (1, "Low", "a"), (1, "Low", "a"), (1, "Low", None), (2, "Low", None), (3, "High", "b"))
    got = {(r.month, r.fan_speed, r.unit): (r.frequency, r.n) for r in st.fan_speed_counts(df).collect()}
    assert got[1, "Low", "a"] == (3, 2) and got[2, "Low", None] == (1, 0) and got[3, "High", "b"] == (1, 1)
    assert len(got) == 24 and got[12, "High", None] == (0, 0)


def test_forecast_window_follows_the_run(frame):
    df = frame("ts timestamp, v int", ("2024-05-01 23:59:59", 0), ("2024-05-02 00:00:00", 1), ("2024-05-05 23:00:00", 2), ("2024-05-06 00:00:00", 3))
    assert rows(matching.in_forecast(df, datetime(2024, 5, 2, 13)).select("v"), "v") == [(1,), (2,)]
    assert rows(matching.in_forecast(df, date(2024, 5, 2), days=5).select("v"), "v") == [(1,), (2,), (3,)]
    assert rows(matching.before_forecast(df, date(2024, 5, 2)).select("v"), "v") == [(0,)]


def test_similar_days_of_shifted_data_are_shifted(spark, tmp_path):
    days = 371  # whole weeks
    spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(days))).write.parquet(str(tmp_path / "events.parquet"))
    query = entry.queries()["similar_days_topn"]
    here = sorted(tuple(r) for r in query(spark, SF_DIR).select("site", "zone", "rank", "fc_date", "date").collect())
    there = query(spark, str(tmp_path)).select("site", "zone", "rank", "fc_date", "date").collect()
    gap = timedelta(days=days)
    assert here and here == sorted((*r[:3], r.fc_date - gap, r.date - gap) for r in there)


@pytest.mark.parametrize(("asked", "running"), [(None, 2), (-1, 0), (1, 1), (9, 2)])
def test_scenarios_clamp_the_units(frame, asked, running):
    forecast = frame("site string, ts timestamp, outdoor_temp double", ("S", "2024-01-01", None))
    row = learning.scenario_rows(forecast, ["on_off__a", "on_off__b", "mode__a", "outdoor_temp"], [(21.5, 1, 2, asked)]).first()
    assert (row.units_on_uniform, row.on_off__a + row.on_off__b, row.mode__a, row.outdoor_temp) == (running, running, 1.0, 0.0)


def test_zones_outside_the_report_are_kept(frame):
    plan = reshape_plan(frame)
    wide = reshape.plan_wide(plan)
    assert reshape.zones_of(wide) == ["Area 1", "Area 3", "Lobby_mode"]
    back = reshape.plan_long(wide).where("ac_on_off IS NOT NULL")
    assert sorted(r.zone for r in back.collect()) == ["Area 1", "Area 3", "Lobby_mode"]
    assert reshape.zones_of(reshape.plan_wide(plan, ["Area 3"])) == ["Area 3"]


def reshape_plan(frame):
    kinds = {s: "double" if s in ("set_temp", "power") else "string" for s in PLAN_SETTINGS}
    schema = "site string, datetime timestamp, forecast_outdoor_temp double, forecast_solar_radiation double, zone string, "
    schema += ", ".join(f"{s} {k}" for s, k in kinds.items())
    rest = [1.0 if k == "double" else "x" for k in kinds.values()]
    return frame(schema, *[("S", "2024-02-01 08:00:00", 1.0, 2.0, z, *rest) for z in ("Lobby_mode", "Area 3", "Area 1")])


def test_quality_summary_lists_zones_and_columns(frame):
    df = frame("zone string, v double, w int", ("b", None, 1), ("a", 1.0, 1), (None, 1.0, 1), ("a", 2.0, 1))
    assert rows(st.quality_summary(df)) == [(4, 3, "zone,v", ["a", "b"])]
    assert rows(st.quality_summary(df.drop("zone"))) == [(4, 2, "v", [])]


def test_categories_by_zone_and_their_report(frame):
    df = frame("unit string, mode string, fan string", ("12 Hall 1", "cool", "x"), ("12 Hall 2", "cool", None), ("7", "cool", "LOW"), (None, "heat", "LOW"))
    columns = {"mode": "mode", "fan": "fan_speed"}
    got = rows(cleaning.zone_category_codes(df, columns), F.col("unit").asc_nulls_first())
    assert got == [(None, "heat", "LOW"), ("12 Hall 1", "1", "0"), ("12 Hall 2", "1", None), ("7", "cool", "LOW")]
    report = rows(cleaning.zone_category_report(df, columns), "column")
    assert report == [("Hall", "fan", "x", 1, 0, True), ("Hall", "mode", "cool", 2, 1, False)]
