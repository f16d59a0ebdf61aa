"""Scans, sinks, upserts, extracts and streams."""

import uuid

from pyspark.sql import functions as F

from thermolane import streaming
from thermolane.catalog import views as V
from thermolane.constants import AC_COLUMNS, POWER_COLUMNS
from thermolane.functions import names, temporal
from thermolane.plans import ingest
from thermolane.sources import readers, writers
from thermolane.sources.staging import staging_root

QUERIES, SQL = {}, {}


def _folder(spark, name):
    return f"{staging_root(spark)}/thermolane/{name}-{uuid.uuid4().hex}"


def _orders(spark, d):
    return V.table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
    )


_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders"


def _csv_parts(spark, d):
    """Orders written as CSV parts in two folders, read back as one frame."""
    path = _folder(spark, "csv")
    rows = _orders(spark, d)
    for side in (0, 1):
        writers.write_csv(
            rows.where(F.col("o_custkey") % 2 == side), f"{path}/MASTER_Store{side}.csv"
        )
    return readers.read_csv_folder(spark, path, rows.schema), path, rows.schema


def _scan(spark, d):
    """Counts per facility, the facility taken from the folder name."""
    df = _csv_parts(spark, d)[0]
    name = F.regexp_extract("source_file", r"(MASTER_[^/]+)/", 1)
    return (
        df.withColumn("facility_id", readers.facility_of(name))
        .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "facility_id")
    )


QUERIES["scan_multi_file_union"] = _scan
SQL["scan_multi_file_union"] = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, 'Store' || (o_custkey % 2) AS facility_id
FROM orders"""


def _scan_one(spark, d):
    _, path, schema = _csv_parts(spark, d)
    return readers.read_csv(spark, f"{path}/MASTER_Store1.csv", schema)


QUERIES["scan_single_csv"] = _scan_one
SQL["scan_single_csv"] = _ORDERS + " WHERE o_custkey % 2 = 1"


def _mixed(spark, d):
    """Orders landed under three headers: two column orders, and one with a column more."""
    path = _folder(spark, "mixed")
    orders = V.table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    plain = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    for k, names in enumerate((plain, plain[::-1], ["o_orderpriority", *plain])):
        writers.write_csv(orders.where(F.col("o_orderkey") % 3 == k).select(names), f"{path}/in {k}")
    df = readers.read_csv_folder(spark, path)
    kinds = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "timestamp"}
    return df.select(*[F.col(c).cast(k) for c, k in kinds.items()], "o_orderpriority")


QUERIES["scan_mixed_headers"] = _mixed
SQL["scan_mixed_headers"] = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority
FROM orders"""


def _facilities(spark, d):
    df = _csv_parts(spark, d)[0]
    files = df.select(F.regexp_extract("source_file", r"(MASTER_[^/]+)/", 1).alias("source_file"))
    return readers.facilities(files)


QUERIES["facility_discovery"] = _facilities
SQL["facility_discovery"] = "SELECT DISTINCT 'Store' || (o_custkey % 2) AS facility_id FROM orders"


def _sinks(spark, d):
    """Partitioned write, append, and read of the stored result through the cache path."""
    path = _folder(spark, "sink")
    rows = _orders(spark, d)
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")

    def build():
        writers.write_partitioned(
            rows.where(early), f"{path}/t", "o_orderdate", "MONTH", ["o_custkey"]
        )
        writers.write_partitioned(
            rows.where(~early), f"{path}/t", "o_orderdate", "MONTH", ["o_custkey"], mode="append"
        )
        return writers.read_upserted(spark, f"{path}/t")

    readers.cached_or(spark, f"{path}/cached", build)
    return readers.cached_or(spark, f"{path}/cached", build)


QUERIES["sink_modes_roundtrip"] = _sinks
SQL["sink_modes_roundtrip"] = _ORDERS


def _table_modes(spark, d):
    """Replace, then append to a catalog table, and read it by name."""
    name = f"orders_{uuid.uuid4().hex}"
    path = _folder(spark, "table")
    rows = _orders(spark, d)
    spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
        f"o_orderdate TIMESTAMP) USING parquet LOCATION '{path}'"
    )
    first = F.col("o_orderkey") % 3 == 0
    writers.write_table(rows.where(first), name, "append")
    writers.write_table(rows.where(~first), name, "append")
    return readers.read_table(spark, name)


QUERIES["table_append"] = _table_modes
SQL["table_append"] = _ORDERS

QUERIES["sql_named_params"] = lambda s, d: readers.query(
    s,
    "SELECT * EXCEPT (o_totalprice), o_totalprice * :rate AS price FROM {t} "
    "WHERE o_totalprice >= :low AND o_orderdate < CAST(:stop AS TIMESTAMP)",
    {"rate": 2, "low": 100000.0, "stop": "1998-06-01"},
    t=_orders(s, d),
)
SQL["sql_named_params"] = """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice * 2 AS price FROM orders
WHERE o_totalprice >= 100000 AND o_orderdate < TIMESTAMP '1998-06-01'"""


def _upsert(spark, d):
    """All orders, then a batch of repriced orders, the batch twice."""
    path = _folder(spark, "upsert")
    rows = _orders(spark, d)
    keys = ["o_orderkey", "o_orderdate"]
    writers.upsert(rows, path, keys, "o_orderdate", "MONTH")
    batch = rows.where(F.col("o_totalprice") > 400000).withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    for _ in range(2):
        writers.upsert(batch, path, keys, "o_orderdate", "MONTH")
    return writers.read_upserted(spark, path)


QUERIES["upsert_by_keys"] = _upsert
SQL["upsert_by_keys"] = """
SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 400000 THEN -o_totalprice ELSE o_totalprice END
  AS o_totalprice, o_orderdate FROM orders"""

def _upsert_new_column(spark, d):
    """Orders without their priority, then a batch of dear orders that has it."""
    path = _folder(spark, "upsert")
    rows = _orders(spark, d)
    keys = ["o_orderkey", "o_orderdate"]
    writers.upsert(rows, path, keys, "o_orderdate", "MONTH")
    batch = V.table(spark, d, "orders").where("o_totalprice > 300000").select(
        "o_orderpriority", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_totalprice"
    )
    for _ in range(2):
        writers.upsert(batch, path, keys, "o_orderdate", "MONTH")
    return writers.read_upserted(spark, path).withColumn("o_custkey", F.col("o_custkey").cast("double"))


QUERIES["upsert_new_column"] = _upsert_new_column
SQL["upsert_new_column"] = """
SELECT o_orderkey, CASE WHEN o_totalprice <= 300000 THEN o_custkey::DOUBLE END AS o_custkey, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice > 300000 THEN o_orderpriority END AS o_orderpriority
FROM orders"""

QUERIES["upsert_merge_rows"] = lambda s, d: writers.merged_rows(
    _orders(s, d),
    _orders(s, d).where("o_totalprice > 300000").withColumn("o_custkey", F.lit(-1).cast("bigint")),
    ["o_orderkey"],
)
SQL["upsert_merge_rows"] = """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN -1 ELSE o_custkey END AS o_custkey,
       o_totalprice, o_orderdate FROM orders"""


def _warehouse_control(spark, d):
    r = V.readings(spark, d)
    return r.select(
        F.concat(F.lit("F-"), "site").alias("facility_id"),
        F.col("unit").alias("AC_Name"),
        F.col("ts").alias("Datetime"),
        F.col("indoor_temp").alias("Indoor_Temp"),
        F.col("set_temp").alias("AC_Set_Temperature"),
        F.col("on_off").alias("AC_ON_OFF"),
        F.col("mode").alias("AC_Mode"),
        F.col("fan_speed").alias("AC_Fan_Speed"),
    )


def _warehouse_power(spark, d):
    p = V.power(spark, d)
    return p.select(
        F.concat(F.lit("F-"), "site").alias("facility_id"),
        F.col("mesh_id").alias("Mesh_ID"),
        F.col("pm_addr_id").alias("PM_Addr_ID"),
        F.col("ts").alias("Datetime"),
        F.col("phase_a").alias("Phase_A"),
        F.col("phase_b").alias("Phase_B"),
        F.col("phase_c").alias("Phase_C"),
    )


RANGE = ("2024-01-10 00:00:00", "2024-01-20 23:59:59")
_IN_RANGE = """ts >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 9 HOUR
  AND ts <= TIMESTAMP '2024-01-20 23:59:59' - INTERVAL 9 HOUR"""


def _extracts(spark, d):
    return ingest.facility_extracts(_warehouse_control(spark, d), _warehouse_power(spark, d), *RANGE)


def _codes_as_double(df):
    """Codes can be null; as doubles both engines show null the same way."""
    for c in ("ac_on_off", "ac_mode", "ac_fan_speed"):
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


QUERIES["range_extract_local_tz"] = lambda s, d: _codes_as_double(_extracts(s, d)[0])
SQL["range_extract_local_tz"] = "WITH " + V.READINGS_SQL.lstrip() + f"""
SELECT 'F-' || site AS facility_id, date_trunc('second', ts + INTERVAL 9 HOUR) AS measured_at,
       unit AS idu_id, set_temp AS ac_set_temperature, indoor_temp AS indoor_temperature,
       CASE upper(on_off) WHEN 'OFF' THEN 0.0::DOUBLE WHEN 'ON' THEN 1 END AS ac_on_off,
       CASE upper(mode) WHEN 'OFF' THEN 0.0::DOUBLE WHEN 'COOL' THEN 1 WHEN 'HEAT' THEN 2
                        WHEN 'FAN' THEN 3 END AS ac_mode,
       CASE upper(fan_speed) WHEN 'AUTO' THEN 0.0::DOUBLE WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2
                             WHEN 'HIGH' THEN 3 WHEN 'TOP' THEN 4 END AS ac_fan_speed
FROM readings WHERE {_IN_RANGE}"""

QUERIES["outdoor_extract"] = lambda s, d: _extracts(s, d)[1]
SQL["outdoor_extract"] = "WITH " + (V.EVENTS_SQL + V.POWER_SQL).lstrip() + f"""
SELECT 'F-' || site AS facility_id, date_trunc('second', ts + INTERVAL 9 HOUR) AS measured_at,
       mesh_id || '-' || pm_addr_id AS odu_id, {V.TOTAL_KWH_SQL} AS total_kwh
FROM power WHERE {_IN_RANGE}"""


def _facility_extract(spark, d):
    """Extracts of all facilities written in one job each, and the report over what was written."""
    path = _folder(spark, "extract")
    indoor, outdoor = _extracts(spark, d)
    ingest.write_extracts(indoor, outdoor, path)
    back = [spark.read.option("header", True).csv(f"{path}/{k}") for k in ("idu", "odu")]
    known = indoor.select("facility_id").distinct()
    silent = known.select(F.concat("facility_id", F.lit("-x")).alias("facility_id"))
    return ingest.extract_report(known.unionByName(silent), *back)


QUERIES["facility_extract"] = _facility_extract
SQL["facility_extract"] = "WITH " + V.EVENTS_SQL.lstrip() + f""",
n AS (SELECT 'F-' || site AS facility_id, count(*) AS n FROM ev WHERE {_IN_RANGE} GROUP BY 1)
SELECT facility_id, n AS idu_rows, n AS odu_rows, true AS complete FROM n
UNION ALL SELECT facility_id || '-x', 0, 0, false FROM n"""


#: Forms of a time in raw logs, and the unit to which each keeps it.
_FORMS = [
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", "microsecond"),
    ("yyyy/M/d H:mm:ss.SSSSSS", "microsecond"),
    ("yyyy/M/d h:mm a", "minute"),
    ("yyyy年M月d日 H時m分s秒", "second"),
    ("yyyyMMdd HHmmss", "second"),
    ("M/d/yyyy H:mm:ss", "second"),
    ("d MMM yyyy HH:mm:ss", "second"),
    ("MMM d, yyyy HH:mm:ss", "second"),
    ("yyyy.MM.dd HH:mm:ss", "second"),
]
_NO_TIMES = ["not a time", "2024/13/45 10:00", "10:20"]


def _raw_control(spark, d):
    """Raw headings: times as text in many forms, one in five with an offset, some bad or blank."""
    r = V.readings(spark, d)
    n, k = F.col("event_id") % 5, (F.col("event_id") % len(_FORMS)).cast("int")
    text = F.coalesce(*[F.when(k == i, F.date_format("ts", form)) for i, (form, _) in enumerate(_FORMS)])
    bad = F.element_at(F.array(*map(F.lit, _NO_TIMES)), (F.col("event_id") % 3 + 1).cast("int"))
    iso = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    time = F.when(n == 0, F.concat(iso, F.lit("+00:00"))).when(n == 1, bad).otherwise(text)
    back = {v: k for k, v in AC_COLUMNS.items()}
    return (
        r.withColumn("unit", F.when(F.col("event_id") % 7 == 3, " ").otherwise(F.col("unit")))
        .withColumn("ts", time)
        .withColumn("Site Energy Level", F.col("event_id").cast("string"))
        .select("unit", "ts", "indoor_temp", "set_temp", "on_off", "mode", "Site Energy Level")
        .withColumn("unwanted", F.lit("x"))
        .withColumnsRenamed(back)
    )


QUERIES["standardize_raw"] = lambda s, d: ingest.to_warehouse(_raw_control(s, d), "ac_control")
_UNIT_SQL = f"CASE event_id % {len(_FORMS)} " + " ".join(f"WHEN {i} THEN '{u}'" for i, (_, u) in enumerate(_FORMS)) + " END"
_STANDARD = "WITH " + V.READINGS_SQL.lstrip() + """,
std AS (
  SELECT unit AS "AC_Name",
         CASE WHEN event_id % 5 = 0 THEN ts ELSE date_trunc(""" + _UNIT_SQL + """, ts) - INTERVAL 9 HOUR END AS "Datetime",
         indoor_temp AS "Indoor_Temp", set_temp AS "AC_Set_Temperature", on_off AS "AC_ON_OFF",
         mode AS "AC_Mode", event_id AS "Site_Energy_Level"
  FROM readings WHERE event_id % 5 <> 1 AND event_id % 7 <> 3
)"""
SQL["standardize_raw"] = _STANDARD + " SELECT * FROM std"


QUERIES["standardize_rejects"] = lambda s, d: ingest.rejected_times(_raw_control(s, d))
SQL["standardize_rejects"] = f"""
SELECT ({_NO_TIMES})[1 + event_id % 3] AS text, count(*) AS rows FROM events WHERE event_id % 5 = 1 GROUP BY 1"""


def _raw_ingest(spark, d):
    """CSV files under two headers landed in folders, loaded twice by the job, and read back."""
    path = _folder(spark, "landing")
    raw = _raw_control(spark, d)
    early = F.col("`Site Energy Level`").cast("bigint") % 2 == 0
    writers.write_csv(raw.where(early), f"{path}/in/ac-control-a")
    writers.write_csv(raw.where(~early).drop("unwanted").select([f"`{c}`" for c in raw.columns[::-1] if c != "unwanted"]), f"{path}/in/ac-control-b")
    writers.write_csv(raw.limit(1), f"{path}/in/other")
    for _ in range(2):
        ingest.ingest_folder(spark, f"{path}/in", f"{path}/w")
    return writers.read_upserted(spark, f"{path}/w/ac_control_raw")


QUERIES["raw_ingest"] = _raw_ingest
SQL["raw_ingest"] = _STANDARD + " SELECT * FROM std"


def _power_headings(spark, d):
    back = {v: k for k, v in POWER_COLUMNS.items()}
    p = V.power(spark, d).drop("site", "event_id")
    return p.select(*[F.col(c).cast("string").alias(back[c]) for c in p.columns])


QUERIES["standardize_raw_power"] = lambda s, d: ingest.to_warehouse(
    _power_headings(s, d), "power_meter"
).withColumn("Phase_C", F.col("Phase_C").cast("double"))
SQL["standardize_raw_power"] = "WITH " + (V.EVENTS_SQL + V.POWER_SQL).lstrip() + """
SELECT mesh_id AS "Mesh_ID", pm_addr_id AS "PM_Addr_ID", ts - INTERVAL 9 HOUR AS "Datetime",
       CAST(trunc(phase_a) AS BIGINT) AS "Phase_A", CAST(phase_b AS BIGINT) AS "Phase_B",
       trunc(phase_c) AS "Phase_C"
FROM power"""

QUERIES["route_files"] = lambda s, d: readers.with_data_type(
    V.readings(s, d).select(
        "event_id",
        F.concat(
            F.lit("in/"), F.coalesce("fan_speed", F.lit("none")), F.lit("/"),
            F.when(F.col("set_temp") < 20, "AC-Control")
            .when(F.col("set_temp") < 24, "x-Power-y")
            .when(F.col("set_temp") < 26, "AC制御")
            .otherwise("other"),
            F.lit("-1.csv"),
        ).alias("source_file"),
    )
).select("event_id", "data_type")
SQL["route_files"] = "WITH " + V.READINGS_SQL.lstrip() + """
SELECT event_id, CASE WHEN set_temp < 20 THEN 'ac_control' WHEN set_temp < 24 THEN 'power_meter'
                      WHEN set_temp < 26 THEN 'ac_control' END AS data_type
FROM readings"""


def _weather_json(spark, d):
    """Weather documents rebuilt from events: one document with one hour per event."""
    w = V.events(spark, d)
    fields = [
        F.date_format("ts", "HH:mm:ss.SSSSSS").alias("datetime"),
        F.when(F.col("k") % 11 != 0, F.col("value")).alias("temp"),
        F.col("k").alias("humidity"),
    ]
    solar = F.when(F.col("k") % 3 == 0, F.lit(None)).otherwise(F.col("k") * 8)
    with_solar = F.to_json(
        F.struct(*fields, solar.alias("solarradiation")), {"ignoreNullFields": "false"}
    )
    hour = F.when(F.col("k") % 4 == 0, F.to_json(F.struct(*fields))).otherwise(with_solar)
    head, middle, tail = (F.lit(x) for x in ('{"days": [{"datetime": "', '", "hours": [', "]}]}"))
    day = F.date_format("ts", "yyyy-MM-dd")
    return w.select("site", F.concat(head, day, middle, hour, tail).alias("body"))


QUERIES["weather_json_flatten"] = lambda s, d: readers.weather_rows(_weather_json(s, d))
SQL["weather_json_flatten"] = "WITH " + V.EVENTS_SQL.lstrip() + """
SELECT site, ts, CASE WHEN k % 11 <> 0 THEN value END AS outdoor_temp,
       CAST(k AS DOUBLE) AS outdoor_humidity,
       CASE WHEN k % 4 = 0 THEN 0.0::DOUBLE WHEN k % 3 = 0 THEN NULL ELSE k * 8.0::DOUBLE END
         AS solar_radiation
FROM ev"""

QUERIES["assume_local_time"] = lambda s, d: V.events(s, d).select(
    "event_id",
    temporal.local_minute(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("local_ts"),
    names.outdoor_id(F.col("user_id"), F.col("k")).alias("odu_id"),
    temporal.floor_time(F.col("ts"), "second").alias("second_ts"),
)
SQL["assume_local_time"] = "WITH " + V.EVENTS_SQL.lstrip() + """
SELECT event_id, date_trunc('minute', ts + INTERVAL 9 HOUR) AS local_ts, user_id || '-' || k AS odu_id,
       date_trunc('second', ts) AS second_ts FROM ev"""


def _stream(spark, d):
    schema = V.table(spark, d, "events").schema
    raw = streaming.read_stream(spark, f"{d}/events.parque[t]", schema)
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") % 20).alias("mesh_id"),
        "value",
    )


def _stream_ingest(spark, d):
    path = _folder(spark, "stream")
    q = streaming.ingest_stream(
        _stream(spark, d), f"{path}/table", f"{path}/checkpoint", ["event_id", "ts"], "ts"
    )
    q.awaitTermination()
    return writers.read_upserted(spark, f"{path}/table")


QUERIES["stream_ingest"] = _stream_ingest
SQL["stream_ingest"] = "SELECT event_id, ts, user_id % 20 AS mesh_id, value FROM events"


def _stream_corrections(spark, d):
    """Events in four files, one a batch: most; corrections; rows that come late; outdated copies."""
    path = _folder(spark, "stream")
    e = V.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    k = F.col("event_id")
    late, fixed = k % 10 == 3, k % 7 == 0
    files = [
        e.where(~late).withColumn("version", F.lit(1)),
        e.where(fixed).withColumns({"version": F.lit(2), "value": -F.col("value")}),
        e.where(late).withColumn("version", F.lit(1)),
        e.where(k % 14 == 0).withColumns({"version": F.lit(0), "value": F.lit(0.0)}),
    ]
    for rows in files:
        rows.write.mode("append").parquet(f"{path}/in")
        stream = streaming.read_stream(spark, f"{path}/in", rows.schema)
        q = streaming.ingest_stream(
            stream, f"{path}/table", f"{path}/checkpoint", ["event_id", "ts"], "ts", newest_by=["version"]
        )
        q.awaitTermination()
    return writers.read_upserted(spark, f"{path}/table")


QUERIES["stream_corrections"] = _stream_corrections
SQL["stream_corrections"] = """
SELECT event_id, ts, CASE WHEN event_id % 7 = 0 THEN -value ELSE value END AS value,
       CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS version FROM events"""


def _stream_hourly(spark, d):
    path = _folder(spark, "stream")
    q = streaming.hourly_stream(
        _stream(spark, d), ["mesh_id"], "value", f"{path}/table", f"{path}/checkpoint", open_hours=True
    )
    q.awaitTermination()
    out = writers.read_upserted(spark, f"{path}/table")
    return out.withColumn("value", F.rint(F.col("value") * 1e4) / 1e4)


QUERIES["stream_hourly"] = _stream_hourly
SQL["stream_hourly"] = """
SELECT user_id % 20 AS mesh_id, date_trunc('hour', ts) AS ts,
       round_even(sum(value) * 1e4, 0) / 1e4 AS value, count(*) AS samples
FROM events GROUP BY 1, 2"""
