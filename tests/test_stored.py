"""Stored tables: versions, schema growth, one-step changes; CSV by column name; streams with corrections."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from thermolane import streaming
from thermolane.functions import temporal
from thermolane.plans import ingest, preprocess
from thermolane.sources import readers, stored, writers
from tests.conftest import rows

KEYS = ["unit", "ts"]
OLD = ("a", "2024-01-01 01:00:00", 1)


def batch(frame, *data, extra=""):
    return frame("unit string, ts timestamp, v int" + extra, *data)


def values(spark, path, *columns):
    return rows(writers.read_upserted(spark, path).select("unit", "v", *columns), "unit", "v")


def test_a_new_column_becomes_part_of_the_table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.upsert(batch(frame, OLD, ("b", "2024-02-01", 2)), path, KEYS, "ts")
    writers.upsert(batch(frame, ("a", "2024-01-01 01:00:00", 5, "x"), extra=", w string"), path, KEYS, "ts")
    assert values(spark, path, "w") == [("a", 5, "x"), ("b", 2, None)]
    writers.upsert(batch(frame, ("b", "2024-02-01", 3)), path, KEYS, "ts")
    assert values(spark, path, "w") == [("a", 5, "x"), ("b", 3, None)]


def test_types_widen_to_the_table_only(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.upsert(frame("unit string, ts timestamp, v bigint", ("a", "2024-01-01", 1)), path, KEYS, "ts")
    writers.upsert(frame("unit string, ts timestamp, v int", ("b", "2024-01-01", 2)), path, KEYS, "ts")
    assert dict(writers.read_upserted(spark, path).dtypes)["v"] == "bigint" and values(spark, path) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError, match="column v"):
        writers.upsert(frame("unit string, ts timestamp, v string", ("b", "2024-01-01", "x")), path, KEYS, "ts")
    assert values(spark, path) == [("a", 1), ("b", 2)]


def test_a_failure_before_the_swap_leaves_the_old_state(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.upsert(batch(frame, OLD), path, KEYS, "ts")
    new = batch(frame, ("a", "2024-01-01 01:00:00", 9, 7), ("c", "2024-01-03", 3, 7), extra=", w int")
    with monkeypatch.context() as broken:
        broken.setattr(stored, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            writers.upsert(new, path, KEYS, "ts")
    assert (tmp_path / "t" / "part=2024-01-03").is_dir(), "the rows were written"
    assert values(spark, path) == [("a", 1)] and "w" not in writers.read_upserted(spark, path).columns
    writers.upsert(new, path, KEYS, "ts")
    assert values(spark, path, "w") == [("a", 9, 7), ("c", 3, 7)]


def test_readers_of_a_state_keep_it(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.upsert(batch(frame, OLD, ("b", "2024-01-02", 2)), path, KEYS, "ts")
    before = writers.read_upserted(spark, path)
    writers.upsert(batch(frame, ("a", "2024-01-01 01:00:00", 9)), path, KEYS, "ts")
    assert rows(before.select("v"), "v") == [(1,), (2,)]
    assert rows(stored.read(spark, path, 1).select("v"), "v") == [(1,), (2,)]
    gone = stored.forget_before(spark, path)
    assert len(gone) == 1 and gone[0].startswith("part=2024-01-01/table_version=0000000001")
    assert values(spark, path) == [("a", 9), ("b", 2)]
    with pytest.raises(ValueError):
        stored.read(spark, path, 1)


def test_two_writers_of_one_change(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.upsert(batch(frame, OLD), path, KEYS, "ts")
    now = stored.state(spark, path)
    with pytest.raises(RuntimeError, match="another writer"):
        stored.commit(spark, path, now)
    assert values(spark, path) == [("a", 1)] and not list((tmp_path / "t" / "_manifests").glob("*tmp*"))


def test_a_plain_partitioned_folder_is_taken_over(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(batch(frame, OLD, ("b", "2024-01-02", 2)), path, "ts")
    assert values(spark, path) == [("a", 1), ("b", 2)]
    writers.upsert(batch(frame, ("a", "2024-01-01 01:00:00", 9)), path, KEYS, "ts")
    assert values(spark, path) == [("a", 9), ("b", 2)]


def test_null_keys_empty_batches_and_rows_without_time(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        writers.upsert(batch(frame, (None, "2024-01-01", 4)), path, KEYS, "ts")
    assert values(spark, path) == [(None, 4)]
    writers.upsert(batch(frame, OLD).limit(0), path, KEYS, "ts")
    assert values(spark, path) == [(None, 4)]
    with pytest.raises(ValueError, match="without a time"):
        writers.upsert(batch(frame, ("a", None, 1)), path, KEYS, "ts")


def test_batches_are_taken_once_and_the_newest_stays(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    take = lambda n, *data: writers.upsert(batch(frame, *data), path, KEYS, "ts", newest_by=["v"], batch_of=("s", n))
    assert take(0, OLD, ("a", "2024-01-01 01:00:00", 3), ("b", "2024-01-01", 1))
    assert not take(0, ("z", "2024-01-01", 1))
    assert take(1, ("a", "2024-01-01 01:00:00", 2), ("b", "2024-01-01", 8))
    assert values(spark, path) == [("a", 3), ("b", 8)]


def land(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_csv_columns_go_by_name(spark, tmp_path):
    land(tmp_path / "a", "1 [x]{y}.csv", "﻿name,v\nx,1\n")
    land(tmp_path / "b", "2+%41.csv", 'v,name,"extra, more"\n2,y,e\n')
    land(tmp_path / "b", "3.csv", "name\nz\n")
    land(tmp_path / "b", "empty.csv", "")
    land(tmp_path / "b", "4.csv", "name,v\n")
    df = readers.read_csv_folder(spark, str(tmp_path))
    assert df.columns == ["name", "v", "extra, more", "source_file", "source"]
    assert rows(df.drop("source_file", "source"), "name") == [("x", "1", None), ("y", "2", "e"), ("z", None, None)]
    typed = readers.read_csv_folder(spark, str(tmp_path), "v int, w double, name string")
    assert rows(typed.drop("source_file", "source"), "name") == [(1, None, "x"), (2, None, "y"), (None, None, "z")]


def test_csv_without_files_and_headings_given_twice(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_csv_folder(spark, str(tmp_path / "none"))
    none = readers.read_csv_folder(spark, str(tmp_path / "none"), "v int")
    assert none.columns == ["v", "source_file", "source"] and none.count() == 0
    assert readers.column_names('a,b,a,"x,y",,a') == ["a", "b", "a.1", "x,y", "_c4", "a.2"]


def test_ingest_of_mixed_headers_folders_and_time_names(spark, tmp_path):
    land(tmp_path / "in" / "ac-control", "1.csv", "A/C Name,Datetime,Indoor Temp.\nu1,2024/1/2 9:30,20.5\nu1,never,1\n")
    land(tmp_path / "in" / "ac-control", "2.csv", "日時,A/C ON/OFF,A/C Name\n2024年1月3日 9時30分,ON,u1\n")
    land(tmp_path / "in" / "other", "3.csv", "A/C Name,Datetime\nu9,2024-01-02 09:30\n")
    ingest.ingest_folder(spark, str(tmp_path / "in"), str(tmp_path / "w"))
    control = writers.read_upserted(spark, str(tmp_path / "w" / "ac_control_raw"))
    got = rows(control.select("AC_Name", "Datetime", "Indoor_Temp", "AC_ON_OFF"), "Datetime")
    assert got == [("u1", datetime(2024, 1, 2, 0, 30), 20.5, None), ("u1", datetime(2024, 1, 3, 0, 30), None, "ON")]
    assert rows(spark.read.parquet(str(tmp_path / "w" / "ac_control_rejects"))) == [("never", 1)]


def test_ingest_reads_the_files_once(spark, tmp_path, monkeypatch):
    """The table's change and the rejects work on what the parser made of the files, not on the files."""
    land(tmp_path / "in" / "ac-control", "1.csv", "A/C Name,Datetime\nu1,2024/1/2 9:30\nu1, never \nu1,never\nu1,\n")
    read, change, rejects = [], writers.upsert, ingest._rejects
    monkeypatch.setattr(writers, "upsert", lambda df, *a, **k: (read.append(df), change(df, *a, **k))[1])
    monkeypatch.setattr(ingest, "_rejects", lambda df: (read.append(df), rejects(df))[1])
    ingest.ingest_folder(spark, str(tmp_path / "in"), str(tmp_path / "w"))
    assert len(read) == 2 and all(f.endswith(".parquet") for df in read for f in df.inputFiles())
    assert rows(spark.read.parquet(str(tmp_path / "w" / "ac_control_rejects"))) == [("never", 2)]


TIMES = {
    "2024-01-05 10:20:30": "2024-01-05 10:20:30", "2024-1-5 1:02": "2024-01-05 01:02:00", "2024-01-05T10:20:30Z": "2024-01-05 10:20:30",
    "2024-01-05 10:20:30.5+09:00": "2024-01-05 01:20:30.5", "2024/1/5 1:02:03": "2024-01-05 01:02:03", "2024.1.5": "2024-01-05 00:00:00",
    "2024/01/05T10:20:30+09:00": "2024-01-05 01:20:30", "2024年1月5日 10時20分": "2024-01-05 10:20:00", "2024年01月05日": "2024-01-05 00:00:00",
    "20240105": "2024-01-05 00:00:00", "20240105102030": "2024-01-05 10:20:30", "20240105T102030Z": "2024-01-05 10:20:30",
    "1/5/2024 10:20": "2024-01-05 10:20:00", "5 Jan 2024 10:20:11": "2024-01-05 10:20:11", "05-jan-2024": "2024-01-05 00:00:00",
    "January 5, 2024 1:02": "2024-01-05 01:02:00", "2024/01/05 1:02 pm": "2024-01-05 13:02:00", "2024/1/5 12:30 AM": "2024-01-05 00:30:00",
    "2024": "2024-01-01 00:00:00", " 2024/01/05 00:00 ": "2024-01-05 00:00:00", "2024/13/45 10:20": None, "20241345": None, "99/99/2024": None,
    "10:20": None, "never": None, "": None, None: None,
}


def test_times_in_many_forms(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    got = {r.t: r.p for r in df.select("t", temporal.parse_time(F.col("t")).cast("string").alias("p")).collect()}
    assert got == TIMES
    forms = {r.t: r.f for r in df.select("t", temporal.time_form(F.col("t")).alias("f")).collect()}
    assert {forms[t] for t, p in TIMES.items() if p} == set(temporal.TIME_FORMS)


def test_local_times_without_an_offset_are_shifted(spark):
    df = spark.createDataFrame([("05-jan-2024",), ("2024/01/05 10:20:30 +0000",), ("20240105 102030Z",)], "t string")
    got = [r.t for r in df.select(temporal.assume_local(F.col("t")).cast("string").alias("t")).collect()]
    assert got == ["2024-01-04 15:00:00", "2024-01-05 10:20:30", "2024-01-05 10:20:30"]


def test_time_column_by_name(frame):
    df = frame("unit string, x string", ("u", "2024-01-05")).withColumnRenamed("x", "Log DateTime")
    assert preprocess.standardize(df, {"A/C Name": "unit"}).columns == ["unit", "ts"]


def run_stream(spark, frame, tmp_path, schema, start, *files):
    for data in files:
        frame(schema, *data).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        start(streaming.read_stream(spark, str(tmp_path / "src"), schema)).awaitTermination()


def test_stream_takes_late_and_corrected_rows(spark, frame, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    run_stream(
        spark, frame, tmp_path, "unit string, ts timestamp, v int, version int",
        lambda s: streaming.ingest_stream(s, out, ck, KEYS, "ts", newest_by=["version"]),
        [("a", "2024-03-01", 1, 1), ("b", "2024-03-09", 1, 1), ("b", "2024-03-09", 2, 2)],
        [("a", "2024-03-01", 5, 3), ("late", "2023-01-01", 7, 1)],
        [("a", "2024-03-01", 4, 2)],
    )
    assert values(spark, out) == [("a", 5), ("b", 2), ("late", 7)]
    assert list(stored.state(spark, out).taken.values()) == [2], "one query, three batches"


def test_a_replayed_batch_changes_nothing(spark, frame, tmp_path):
    out, ck = tmp_path / "out", tmp_path / "ck"
    schema = "unit string, ts timestamp, v int"
    start = lambda s: streaming.ingest_stream(s, str(out), str(ck), KEYS, "ts")
    run_stream(spark, frame, tmp_path, schema, start, [("a", "2024-03-01", 1)])
    writers.upsert(batch(frame, ("a", "2024-03-01", 50)), str(out), KEYS, "ts")  # a correction by hand
    for name in ("0", ".0.crc"):  # as if the stream had failed before it noted the batch as done
        (ck / "commits" / name).unlink(missing_ok=True)
    run_stream(spark, frame, tmp_path, schema, start, [("b", "2024-03-01", 2)])
    assert values(spark, str(out)) == [("a", 50), ("b", 2)]


def test_open_hours_are_stored_and_replaced(spark, frame, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "unit string, ts timestamp, v double"
    start = lambda s: streaming.hourly_stream(s, ["unit"], "v", out, ck, open_hours=True)
    run_stream(spark, frame, tmp_path, schema, start, [("a", "2024-03-01 01:10:00", 1.0), ("a", "2024-03-01 03:59:00", 4.0)])
    run_stream(spark, frame, tmp_path, schema, start, [("a", "2024-03-01 03:10:00", 2.0), ("a", "2024-03-01 04:00:00", 8.0)])
    got = rows(writers.read_upserted(spark, out).select("ts", "v", "samples"), "ts")
    assert got == [(datetime(2024, 3, 1, 1), 1.0, 1), (datetime(2024, 3, 1, 3), 6.0, 2), (datetime(2024, 3, 1, 4), 8.0, 1)]


def test_stream_hourly_has_every_hour_of_the_events(spark, frame, tmp_path):
    from thermolane.catalog import ingest as queries

    events = frame(
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
        (1, "2024-03-01 01:10:00", 21, "view", 1.0, "{}"), (2, "2024-03-01 03:59:00", 1, "view", 4.0, "{}"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = rows(queries.QUERIES["stream_hourly"](spark, str(tmp_path)).select("mesh_id", "ts", "value", "samples"), "ts")
    assert got == [(1, datetime(2024, 3, 1, 1), 1.0, 1), (1, datetime(2024, 3, 1, 3), 4.0, 1)]


def test_hours_are_stored_when_closed(spark, frame, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "unit string, ts timestamp, v double"
    start = lambda s: streaming.hourly_stream(s, ["unit"], "v", out, ck)
    run_stream(spark, frame, tmp_path, schema, start, [("a", "2024-03-01 01:10:00", 1.0), ("a", "2024-03-01 01:50:00", 2.0), ("a", "2024-03-01 03:59:00", 4.0)])
    assert stored.state(spark, out) is None or writers.read_upserted(spark, out).count() == 0
    run_stream(spark, frame, tmp_path, schema, start, [("a", "2024-03-01 01:20:00", 8.0), ("a", "2024-03-01 04:00:00", 1.0)])
    got = rows(writers.read_upserted(spark, out).select("ts", "v", "samples"), "ts")
    assert got == [(datetime(2024, 3, 1, 1), 11.0, 3)]
    run_stream(spark, frame, tmp_path, schema, start, [("a", "2024-03-01 01:30:00", 99.0), ("a", "2024-03-01 06:30:00", 1.0)])
    got = rows(writers.read_upserted(spark, out).select("ts", "v", "samples"), "ts")
    assert got == [(datetime(2024, 3, 1, 1), 11.0, 3), (datetime(2024, 3, 1, 3), 4.0, 1)]
