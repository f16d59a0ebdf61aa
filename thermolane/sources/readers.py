"""Scans: CSV folders, tables, SQL with parameters, ranges, weather JSON, cached results."""

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from thermolane.constants import LOCAL_ZONE, WEATHER_JSON
from thermolane.functions.names import strip_bom
from thermolane.sources.writers import partition_name


def read_csv(spark: SparkSession, path, schema=None) -> DataFrame:
    """CSV with a header. Without a schema every column is text (no inference pass)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return strip_bom(reader.csv(path))


def csv_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(source_file, header): the first line of every CSV file below a folder that has one.

    One distributed pass over the text; each task hands on one line per file.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    first = lines.where("block = 0").withColumn("nth", F.monotonically_increasing_id())
    found = first.groupBy("source_file").agg(F.min_by("value", "nth").alias("header"))
    return found.withColumn("header", F.regexp_replace("header", "^\ufeff", ""))


def column_names(header: str) -> list[str]:
    """The names in a header line. A name used before gets its count, a blank one its place."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header]), [])):
        name = name or f"_c{i}"
        same = sum(1 for n in names if n == name or n.rpartition(".")[0] == name and n.rpartition(".")[2].isdigit())
        names.append(f"{name}.{same}" if same else name)
    return names


def read_by_header(spark: SparkSession, headers: DataFrame, schema=None) -> DataFrame:
    """The rows of CSV files given as (source_file, header), columns matched by name.

    Files with the same header are one scan under its own column order; the scans are united by
    name, and a column that a file lacks is null. Columns stand in the order in which they
    first appear, files sorted by path. The names of the files come to the driver, as they do
    in every file scan; rows do not. With a schema, its columns alone are read.
    """
    groups = (
        headers.groupBy("header").agg(F.sort_array(F.collect_list("source_file")).alias("files"))
        .orderBy(F.element_at("files", 1)).collect()
    )
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    types = {f.name: f.dataType for f in schema} if schema is not None else {}
    scans = []
    for group in groups:
        names = column_names(group.header)
        own = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        paths = [_literal_path(f) for f in group.files]
        scan = spark.read.option("header", True).schema(own).csv(paths)
        kept = [f"`{n}`" for n in names if schema is None or n in types]
        scans.append(
            scan.select(
                *kept,
                F.col("_metadata.file_path").alias("source_file"),
                F.struct(
                    F.col("_metadata.file_path").alias("f"),
                    F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("r"),
                ).alias("source"),
            )
        )
    if not scans:
        if schema is None:
            raise FileNotFoundError("no CSV file with a header")
        place = "source_file string, source struct<f: string, b: bigint, r: bigint>"
        return spark.createDataFrame([], T.StructType([*schema.fields, *T.StructType.fromDDL(place).fields]))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    present = [c for c in union.columns if c not in ("source_file", "source")]
    if schema is not None:
        columns = [(F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    else:
        columns = [F.col(f"`{c}`") for c in present]
    return union.select(*columns, "source_file", "source")


def _literal_path(uri: str) -> str:
    """A file's URI as a path in which no character is a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def read_csv_folder(spark: SparkSession, path: str, schema=None, glob: str = "*.csv") -> DataFrame:
    """All CSV files below a folder as one frame by column name, with their place for tie rules.

    `source` = (file, block start, row order): sorting by it gives file order.
    """
    return read_by_header(spark, csv_headers(spark, path, glob), schema)


def with_data_type(df: DataFrame, path: str = "source_file") -> DataFrame:
    """Route rows by file name, else by the file's folder: control logs, power logs, or null."""

    def kind(name):
        return F.when(name.contains("ac-control") | name.contains("ac制御"), "ac_control").when(
            name.contains("ac-power-meter") | name.contains("power"), "power_meter"
        )

    steps = F.split(F.lower(F.col(path)), "/")
    return df.withColumn("data_type", F.coalesce(kind(F.try_element_at(steps, F.lit(-1))), kind(F.try_element_at(steps, F.lit(-2)))))


def facility_of(path):
    """Facility id in a master file name such as `MASTER_Store1.xlsx`, else null."""
    found = F.regexp_extract(F.substring_index(path, "/", -1), r"^MASTER_(.+?)\.[^.]+$", 1)
    return F.when(found != "", found)


def facilities(files: DataFrame, path: str = "source_file") -> DataFrame:
    found = files.select(facility_of(F.col(path)).alias("facility_id"))
    return found.where(F.col("facility_id").isNotNull()).distinct()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def query(spark: SparkSession, sql: str, params: dict = None, **tables) -> DataFrame:
    """SQL with named parameters (`:name`) and tables given as frames (`{name}`)."""
    return spark.sql(sql, args=params or {}, **tables)


def read_local_range(
    df: DataFrame,
    start: str,
    end: str,
    ts: str = "Datetime",
    zone: str = LOCAL_ZONE,
    unit: str = "DAY",
) -> DataFrame:
    """Rows between two local times, both included, with the time in local zone.

    The bounds are converted, not the column, so the filter reaches the scan. A table with
    storage partitions (`part`, by `unit` of the UTC time) reads only those of the range.
    """
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    low = F.to_utc_timestamp(F.lit(start).cast("timestamp"), zone)
    high = F.to_utc_timestamp(F.lit(end).cast("timestamp"), zone)
    kept = df.where(F.col(ts).between(low, high))
    if "part" in df.columns:
        kept = kept.where(
            F.col("part").between(partition_name(low, unit), partition_name(high, unit))
        )
    rest = [c for c in df.columns if c not in (ts, "part")]
    return kept.select(F.from_utc_timestamp(ts, zone).alias(ts), *rest)


def weather_rows(payload: DataFrame, column: str = "body", keep=("site",)) -> DataFrame:
    """Hourly rows of weather documents {days: [{datetime, hours: [{...}]}]}.

    An absent sunshine key gives 0; an explicit null stays null.
    """
    days = payload.select(*keep, F.explode(F.from_json(column, WEATHER_JSON)["days"]).alias("d"))
    hours = days.select(*keep, F.col("d.datetime").alias("day"), F.explode("d.hours").alias("h"))
    absent = ~F.map_contains_key("h", "solarradiation")
    return hours.select(
        *keep,
        F.try_to_timestamp(F.concat_ws(" ", "day", F.try_element_at("h", F.lit("datetime")))).alias(
            "ts"
        ),
        _number("temp").alias("outdoor_temp"),
        _number("humidity").alias("outdoor_humidity"),
        F.when(absent, F.lit(0.0)).otherwise(_number("solarradiation")).alias("solar_radiation"),
    )


def _number(key: str):
    return F.try_element_at("h", F.lit(key)).try_cast("double")


def read_weather(spark: SparkSession, path, site: str) -> DataFrame:
    """Landed weather documents of one site, one JSON document per file."""
    body = spark.read.text(path, wholetext=True).select(
        F.lit(site).alias("site"), F.col("value").alias("body")
    )
    return weather_rows(body)


def cached_or(spark: SparkSession, path: str, build) -> DataFrame:
    """The stored table at `path`; if there is none, build it, store it and read it back."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
