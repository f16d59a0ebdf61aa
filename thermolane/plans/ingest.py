"""Raw CSV logs to warehouse tables, and facility extracts from them."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from thermolane import constants as C
from thermolane.functions.categories import strict_code
from thermolane.functions.names import outdoor_id, warehouse_name
from thermolane.functions.numeric import null_safe_sum
from thermolane.functions.temporal import assume_local, parse_time, time_text
from thermolane.operators.cleaning import require_filled
from thermolane.sources import readers, writers
from thermolane.sources.staging import stage

#: The time as it stands in the file, beside the columns of the table.
_TEXT = "__time_text"
SCHEMAS = {"ac_control": C.AC_CONTROL_SCHEMA, "power_meter": C.POWER_METER_SCHEMA}


def to_warehouse(raw: DataFrame, data_type: str) -> DataFrame:
    """Known columns under warehouse names and types; times in UTC; keys filled.

    The time column is found by its name, and its times are read in any of the known forms (see
    `functions.temporal`); a time without an offset is local. Text that does not fit its type becomes null, and
    rows without a full key go.
    """
    return require_filled(raw.select(*_warehouse_columns(raw, data_type)), C.RAW_KEYS[data_type])


def _warehouse_columns(raw: DataFrame, data_type: str) -> list[Column]:
    types = {f.name: f.dataType for f in SCHEMAS[data_type].fields}
    when = time_text(raw)
    columns = [] if when is None else [assume_local(when).alias("Datetime")]
    for heading in raw.columns:
        name = warehouse_name(heading)
        if name != "Datetime" and name in types or (data_type == "ac_control" and name.endswith(C.LEVEL_SUFFIX)):
            columns.append(_typed(heading, types.get(name, T.LongType())).alias(name))
    return columns


def _typed(heading: str, kind: T.DataType):
    x = F.col(f"`{heading}`")
    if isinstance(kind, T.LongType):
        return x.cast("string").try_cast("double").cast("bigint")
    return x.cast("string").try_cast(kind)


def ingest_folder(spark: SparkSession, landing: str, warehouse: str) -> None:
    """Load every CSV log below `landing` into the raw tables below `warehouse`.

    Files are routed by name or folder, and columns matched by heading, so files of one type
    may differ in the order and number of their columns. Loading the same files again changes
    nothing. Times that could not be read are counted in `<type>_rejects`.

    The files are read and their times parsed once; what the parser made of them is stored, and the
    table's change, which looks at its batch several times, and the rejects read that.
    """
    headers = stage(readers.with_data_type(readers.csv_headers(spark, landing)), "headers")
    for data_type in SCHEMAS:
        try:
            raw = readers.read_by_header(spark, headers.where(F.col("data_type") == data_type))
        except FileNotFoundError:
            continue
        raw = raw.drop("source", "source_file")
        when = _checked_time_text(raw)
        typed = stage(raw.select(*_warehouse_columns(raw, data_type), F.trim(when).alias(_TEXT)), "typed")
        rows = require_filled(typed.drop(_TEXT), C.RAW_KEYS[data_type])
        writers.upsert(rows, f"{warehouse}/{data_type}_raw", C.RAW_KEYS[data_type], "Datetime")
        rejects = _rejects(typed.select(F.col(_TEXT).alias("text"), "Datetime"))
        rejects.write.mode("overwrite").parquet(f"{warehouse}/{data_type}_rejects")


def rejected_times(raw: DataFrame) -> DataFrame:
    """(text, rows): filled times that no form reads, and in how many rows each stands."""
    text = F.trim(_checked_time_text(raw)).alias("text")
    return _rejects(raw.select(text).withColumn("Datetime", parse_time(F.col("text"))))


def _checked_time_text(raw: DataFrame) -> Column:
    when = time_text(raw)
    if when is None:
        raise ValueError(f"no time column among {raw.columns}")
    return when


def _rejects(times: DataFrame) -> DataFrame:
    bad = times.where((F.col("text") != "") & F.col("Datetime").isNull())
    return bad.groupBy("text").agg(F.count(F.lit(1)).alias("rows"))


def indoor_extract(raw: DataFrame) -> DataFrame:
    """Indoor-unit readings under extract names, to the second, labels as codes."""
    keep = [c for c in ("facility_id",) if c in raw.columns]
    return raw.select(
        *keep,
        F.date_trunc("second", "Datetime").alias("measured_at"),
        F.col("AC_Name").alias("idu_id"),
        F.col("AC_Set_Temperature").alias("ac_set_temperature"),
        F.col("Indoor_Temp").alias("indoor_temperature"),
        strict_code(F.col("AC_ON_OFF"), "on_off").alias("ac_on_off"),
        strict_code(F.col("AC_Mode"), "mode").alias("ac_mode"),
        strict_code(F.col("AC_Fan_Speed"), "fan_speed").alias("ac_fan_speed"),
    )


def outdoor_extract(raw: DataFrame) -> DataFrame:
    """Outdoor-unit energy: id `mesh-addr` and the sum of the phases, to the second."""
    keep = [c for c in ("facility_id",) if c in raw.columns]
    phases = [c for c in raw.columns if c.startswith("Phase")]
    return raw.select(
        *keep,
        F.date_trunc("second", "Datetime").alias("measured_at"),
        outdoor_id(F.col("Mesh_ID"), F.col("PM_Addr_ID")).alias("odu_id"),
        null_safe_sum(phases).alias("total_kwh"),
    )


def facility_extracts(control: DataFrame, power: DataFrame, start: str, end: str):
    """Indoor and outdoor extracts of all facilities for a local time range."""
    return (
        indoor_extract(readers.read_local_range(control, start, end)),
        outdoor_extract(readers.read_local_range(power, start, end)),
    )


def write_extracts(indoor: DataFrame, outdoor: DataFrame, path: str) -> None:
    """CSV per facility, one job for all facilities."""
    for kind, df in (("idu", indoor), ("odu", outdoor)):
        df.write.mode("overwrite").partitionBy("facility_id").option("header", True).csv(
            f"{path}/{kind}"
        )


def extract_report(facilities: DataFrame, indoor: DataFrame, outdoor: DataFrame) -> DataFrame:
    """Rows per facility; a facility without indoor or outdoor rows is not complete."""

    def sizes(df, name):
        return df.groupBy("facility_id").agg(F.count(F.lit(1)).alias(name))

    return (
        facilities.join(sizes(indoor, "idu_rows"), "facility_id", "left")
        .join(sizes(outdoor, "odu_rows"), "facility_id", "left")
        .select(
            "facility_id",
            F.coalesce("idu_rows", F.lit(0)).alias("idu_rows"),
            F.coalesce("odu_rows", F.lit(0)).alias("odu_rows"),
            (F.col("idu_rows").isNotNull() & F.col("odu_rows").isNotNull()).alias("complete"),
        )
    )
