import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from thermolane import streaming
from thermolane.plans import ingest
from thermolane.sources import readers, writers
from thermolane.sources.staging import stage, staging_root
from tests.conftest import rows


def test_csv_folder_keeps_file_order_and_strips_marks(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "ac-control-2.csv").write_text("﻿name,v\nx,3\nx,4\n", encoding="utf-8")
    (tmp_path / "ac-control-1.csv").write_text("﻿name,v\nx,1\nx,2\n", encoding="utf-8")
    (tmp_path / "skip.txt").write_text("name,v\nx,9\n")
    df = readers.read_csv_folder(spark, str(tmp_path))
    assert df.columns == ["name", "v", "source_file", "source"]
    assert [r.v for r in df.orderBy("source").collect()] == ["1", "2", "3", "4"]
    routed = readers.with_data_type(df).select("data_type").distinct()
    assert rows(routed) == [("ac_control",)]


def test_facilities_from_file_names(frame):
    df = frame("source_file string", ("x/MASTER_Store1.xlsx",), ("MASTER_Store1.csv",), ("MASTER_B_2.xlsx",), ("other.csv",))
    assert rows(readers.facilities(df), "facility_id") == [("B_2",), ("Store1",)]


def test_local_range_includes_both_ends_and_reaches_the_scan(spark, frame, tmp_path):
    df = frame("Datetime timestamp, v int", ("2024-01-01 14:59:59", 1), ("2024-01-01 15:00:00", 2),
               ("2024-01-02 14:59:59", 3), ("2024-01-02 15:00:00", 4))
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    out = readers.read_local_range(table, "2024-01-02 00:00:00", "2024-01-02 23:59:59")
    assert rows(out, "v") == [(datetime(2024, 1, 2), 2), (datetime(2024, 1, 2, 23, 59, 59), 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Datetime" in plan and "LessThanOrEqual(Datetim" in plan
    writers.write_partitioned(df, str(tmp_path / "p"), "Datetime")
    parts = spark.read.schema("Datetime timestamp, v int, part string").parquet(str(tmp_path / "p"))
    pruned = readers.read_local_range(parts, "2024-01-02 09:00:00", "2024-01-02 23:59:59")
    assert rows(pruned, "v") == [(datetime(2024, 1, 2, 23, 59, 59), 3)]
    scan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in scan and "2024-01-02" in scan
    with pytest.raises(ValueError):
        readers.read_local_range(table, "2024-01-03", "2024-01-02")


def test_weather_sunshine_absent_or_null(spark, frame):
    doc = {"days": [{"datetime": "2024-01-01", "hours": [
        {"datetime": "08:00:00", "temp": 5.5, "humidity": 40, "solarradiation": None},
        {"datetime": "09:00:00", "temp": None, "humidity": 41.5},
        {"datetime": "bad", "solarradiation": 7}]}, {"datetime": "2024-01-02", "hours": []}]}
    df = spark.createDataFrame([("S", json.dumps(doc))], "site string, body string")
    got = rows(readers.weather_rows(df), F.col("ts").asc_nulls_last())
    assert got == [("S", datetime(2024, 1, 1, 8), 5.5, 40.0, None), ("S", datetime(2024, 1, 1, 9), None, 41.5, 0.0),
                   ("S", None, None, None, 7.0)]


def test_weather_files(spark, tmp_path):
    doc = {"days": [{"datetime": "2024-01-01", "hours": [{"datetime": "08:00:00", "temp": 1}]}]}
    (tmp_path / "w.json").write_text(json.dumps(doc, indent=2))
    got = rows(readers.read_weather(spark, str(tmp_path), "S"))
    assert got == [("S", datetime(2024, 1, 1, 8), 1.0, None, 0.0)]


def test_cached_result_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert readers.cached_or(spark, str(tmp_path / "c"), build).count() == 3
    assert calls == [1]


KEYS = ["unit", "ts"]


def batch(frame, *data):
    return frame("unit string, ts timestamp, v int", *data)


def test_upsert_replaces_adds_and_is_idempotent(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.upsert(batch(frame, ("a", "2024-01-01 01:00:00", 1), ("a", "2024-01-02 01:00:00", 2)), path, KEYS, "ts")
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "part=2024-01-01").iterdir()}
    new = batch(frame, ("a", "2024-01-02 01:00:00", 20), ("b", "2024-01-02 01:00:00", 3))
    for _ in range(2):
        writers.upsert(new, path, KEYS, "ts")
    assert rows(writers.read_upserted(spark, path).select("unit", "v"), "v") == [("a", 1), ("b", 3), ("a", 20)]
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "part=2024-01-01").iterdir()}
    assert before == after, "an untouched partition was rewritten"
    with pytest.raises(ValueError):
        writers.upsert(new, path, ["unit", "absent", "ts"], "ts")
    with pytest.raises(ValueError):
        writers.upsert(new, path, ["unit"], "ts")


def test_upsert_keeps_copies_inside_a_batch(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.upsert(batch(frame, ("a", "2024-01-01", 1)), path, KEYS, "ts")
    writers.upsert(batch(frame, ("a", "2024-01-01", 2), ("a", "2024-01-01", 2)), path, KEYS, "ts")
    assert rows(writers.read_upserted(spark, path).select("v")) == [(2,), (2,)]


def test_upsert_keeps_columns_a_batch_lacks(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    wide = frame("unit string, ts timestamp, v int, w int", ("a", "2024-01-01", 1, 7), ("b", "2024-01-01", 1, 8))
    writers.upsert(wide, path, KEYS, "ts")
    writers.upsert(batch(frame, ("a", "2024-01-01", 2)), path, KEYS, "ts")
    assert rows(writers.read_upserted(spark, path).select("unit", "v", "w"), "unit") == [("a", 2, None), ("b", 1, 8)]


def test_early_local_hours_are_replaced(spark, tmp_path):
    """00:00-08:59 local time falls on the previous UTC day; loading twice must not double it."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "AC-Control_1.csv").write_text(
        "A/C Name,Datetime,Indoor Temp.,A/C ON/OFF\nu1,2024-01-02 00:30:00,20.5,ON\nu1,2024-01-02 09:30:00,x,OFF\n ,2024-01-02 09:30:00,1,ON\nu1,never,1,ON\n")
    (folder / "ac-power-meter.csv").write_text(
        "Mesh ID,PM Addr ID,Datetime,Phase A\n49,1,2024-01-02 00:30:00,7\n,1,2024-01-02 00:30:00,7\n")
    for _ in range(2):
        ingest.ingest_folder(spark, str(folder), str(tmp_path / "w"))
    control = writers.read_upserted(spark, str(tmp_path / "w" / "ac_control_raw"))
    assert rows(control.select("Datetime", "Indoor_Temp"), "Datetime") == [
        (datetime(2024, 1, 1, 15, 30), 20.5), (datetime(2024, 1, 2, 0, 30), None)]
    power = writers.read_upserted(spark, str(tmp_path / "w" / "power_meter_raw"))
    assert rows(power.select("Mesh_ID", "Phase_A")) == [(49, 7)]


def test_partition_units(frame):
    df = frame("ts timestamp", ("2024-03-05 07:08:09",))
    got = [writers.with_partition(df, "ts", u).first().part for u in ("DAY", "HOUR", "MONTH")]
    assert got == ["2024-03-05", "2024-03-05-07", "2024-03-01"]
    with pytest.raises(ValueError):
        writers.with_partition(df, "ts", "YEAR")


def test_table_modes(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sinks LOCATION '{tmp_path}/db'")
    for mode, size in (("replace", 3), ("append", 6), ("replace", 3)):
        writers.write_table(spark.range(3), "sinks.t", mode)
        assert readers.read_table(spark, "sinks.t").count() == size
    with pytest.raises(Exception, match="already exists"):
        writers.write_table(spark.range(3), "sinks.t", "fail")
    spark.sql("DROP DATABASE sinks CASCADE")


def test_csv_keeps_blanks_and_newest_comes_first(spark, frame, tmp_path):
    df = frame("ts timestamp, s string", ("2024-01-01", " a "), ("2024-01-02", "b"))
    writers.write_newest_first(df, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert [r.s for r in back.collect()] == ["b", " a "]


def test_plan_outputs_of_a_run_replace_themselves(spark, tmp_path):
    for _ in range(2):
        writers.write_plans(spark.range(1), spark.range(2), spark.range(3), str(tmp_path), "r1")
    for kind, n in (("zone_schedule", 1), ("zone_schedule_long", 2), ("unit_schedule", 3)):
        assert spark.read.parquet(f"{tmp_path}/{kind}").count() == n


def test_stage_is_a_stored_table(spark):
    out = stage(spark.range(5), "numbers")
    assert staging_root(spark) in out.inputFiles()[0] and out.count() == 5


def test_extract_report_names_facilities_without_rows(frame):
    known = frame("facility_id string", ("x",), ("y",))
    idu = frame("facility_id string", ("x",), ("x",), ("y",))
    odu = frame("facility_id string", ("x",))
    assert rows(ingest.extract_report(known, idu, odu), "facility_id") == [("x", 2, 1, True), ("y", 1, 0, False)]


def test_stream_takes_new_files_and_drops_copies(spark, frame, tmp_path):
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    schema = "unit string, ts timestamp, v int"
    for data in ([("a", "2024-01-01 01:00:00", 1)], [("a", "2024-01-01 01:00:00", 1), ("b", "2024-01-01 02:00:00", 2)]):
        frame(schema, *data).write.mode("append").parquet(src)
        stream = streaming.read_stream(spark, src, schema)
        streaming.ingest_stream(stream, out, ck, KEYS, "ts").awaitTermination()
    assert rows(writers.read_upserted(spark, out).select("unit", "v"), "unit") == [("a", 1), ("b", 2)]
