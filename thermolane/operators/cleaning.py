"""Row filters, de-duplication, outliers and phase totals."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from thermolane.functions.categories import category_code, lookup_code
from thermolane.functions.names import zone_from_name
from thermolane.functions.numeric import null_safe_sum


def drop_duplicates_prefer_on(df: DataFrame, keys, source: Column) -> DataFrame:
    """One row per key: the ON row, and of equals the last in source order.

    The rank filter is applied map-side before the shuffle (window group limit), so any
    number of copies of one key leaves one row per task.
    """
    on = (F.upper(F.trim(F.col("on_off").cast("string"))) == "ON").cast("int")
    w = Window.partitionBy(*keys).orderBy(F.coalesce(on, F.lit(0)).desc(), source.desc())
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def drop_duplicates_keep_first(df: DataFrame, keys, source: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(source.asc())
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def drop_outliers(df: DataFrame, columns, sigmas: float) -> DataFrame:
    """Keep rows with |x - mean| <= sigmas * sd, one column after the other.

    The statistics of a column come from the rows that survived the columns before it. Null
    readings fail the test and go; so does a single row, whose sample deviation is null.
    Mean and deviation are one scalar subquery per column (one narrow aggregate scan).
    """
    for c in columns:
        if c not in df.columns:
            continue
        stats = df.agg(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd"))
        mean, sd = stats.select("mean").scalar(), stats.select("sd").scalar()
        df = df.where(F.abs(F.col(c) - mean) <= sigmas * sd)
    return df


def require_filled(df: DataFrame, columns) -> DataFrame:
    """Drop rows whose required fields are null or blank."""
    for c in columns:
        if c in df.columns:
            df = df.where(
                F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
            )
    return df


def add_total_kwh(df: DataFrame) -> DataFrame:
    """Add total_kwh, the null-safe sum of every phase column."""
    phases = [c for c in df.columns if c.lower().startswith("phase")]
    return df.withColumn("total_kwh", null_safe_sum(phases))


def valid_patterns(features: DataFrame) -> DataFrame:
    """Hours that can serve as a pattern: known weather and room, and power drawn."""
    return features.where(
        "indoor_temp IS NOT NULL AND adjusted_power > 0 "
        "AND outdoor_temp IS NOT NULL AND solar_radiation IS NOT NULL"
    )


def recent_history(
    history: DataFrame, newest: Column, zone_name: str, months: int
) -> DataFrame:
    """Drop rows of one zone that are more than `months` older than `newest`."""
    old = F.col("ts") < newest - F.make_ym_interval(F.lit(0), F.lit(months))
    named = F.lower(F.trim("zone")) == zone_name
    return history.where(~F.coalesce(named & old, F.lit(False)))


def in_period(df: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    """Rows from `start` to `end`, both included, either may be missing."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end).cast("timestamp"))
    return df


def in_hours(df: DataFrame, first: int, stop: int, ts: str = "ts") -> DataFrame:
    """Rows with first <= hour < stop."""
    return df.where((F.hour(ts) >= first) & (F.hour(ts) < stop))


def time_first(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Put the time and its date in front."""
    rest = [c for c in df.columns if c not in (ts, "date")]
    return df.select(ts, F.to_date(ts).alias("date"), *rest)


def without_columns_like(df: DataFrame, parts=("_hist_", "_power", "_indoor_temp")) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns if not any(p in c for p in parts)])


def zone_category_codes(df: DataFrame, columns: dict, name: str = "unit") -> DataFrame:
    """Codes of categories by zone: `columns` maps a column to its kind (see `functions.categories`).

    The zone is taken from the unit's name. Unknown labels get the kind's default; nulls stay
    null. Rows whose name tells no zone keep their labels, as text, where codes are text too.
    """
    known = zone_from_name(F.col(name)) != "Unknown"
    coded = {
        c: F.when(known, category_code(F.col(c), kind).cast("string")).otherwise(F.col(c).cast("string"))
        for c, kind in columns.items()
    }
    return df.withColumns(coded)


def zone_category_report(df: DataFrame, columns: dict, name: str = "unit") -> DataFrame:
    """(zone, column, value, rows, code, unmapped): what `zone_category_codes` does to each label.

    One pass: labels are counted map-side by zone, so the report has a row per zone and label.
    Rows whose name tells no zone, and nulls, are not mapped and not reported.
    """
    zone = zone_from_name(F.col(name)).alias("zone")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(zone, F.explode(cells).alias("x")).select("zone", "x.*")
        .where((F.col("zone") != "Unknown") & F.col("value").isNotNull())
        .groupBy("zone", "column", "value").agg(F.count(F.lit(1)).alias("rows"))
    )

    def by_column(f):
        return F.coalesce(*[F.when(F.col("column") == c, f(F.col("value"), kind)) for c, kind in columns.items()])

    return counts.withColumns(
        {"code": by_column(category_code), "unmapped": by_column(lambda x, kind: lookup_code(x, kind).isNull())}
    )
