"""Ordered work on series of any length.

A plain window over `partitionBy(unit)` puts a whole unit in one task, and one unit may hold
a third of all readings. The functions here split a series into time buckets, work inside
each (key, bucket) in parallel, and pass what crosses a bucket edge through a summary with
one row per (key, bucket). The answer is the one the unsplit window gives.

`order` must be a full order of the rows of a key. `bucket` must rise with it. Without a
bucket the rows are cut into ranges of about equal size, so that no key, no time and no group
of copies can make a task large; that takes one more shuffle. Pass a time bucket where its
size is known, such as the day of de-duplicated readings (1,440 minutes per unit).
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from thermolane.sources.staging import stage

_BUCKET = "__bucket"
#: Stored bytes of input for one range: a few times that in memory, which one task sorts without spilling.
RANGE_BYTES = 32 << 20
#: Catalyst's size of inputs that it does not know.
_UNKNOWN = 2**63 - 1


def with_buckets(df: DataFrame, keys, order, bucket: Column = None) -> DataFrame:
    """Add the bucket column: the given expression, or balanced ranges of (keys, order).

    Their number grows with the input, and is never below the shuffle partitions (which adaptive
    execution may coalesce). Range limits come from a sample, so the ranged rows are stored: every later reader sees
    the same buckets, also after a lost executor.
    """
    if bucket is not None:
        return df.withColumn(_BUCKET, bucket)
    wanted = [ranges(df)] if ranges(df) > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    ranged = df.repartitionByRange(*wanted, *keys, *order).withColumn(_BUCKET, F.spark_partition_id())
    return stage(ranged, "ranges")


def ranges(df: DataFrame) -> int:
    """How many ranges the input asks for: its stored bytes, as Catalyst knows them, by RANGE_BYTES.

    Inputs whose size Catalyst does not know (rows handed over by the driver) count as none.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return -(-sum(s for s in sizes if s < _UNKNOWN) // RANGE_BYTES)


def _edges(bucketed: DataFrame, keys, order, value: str):
    """Rows with their place in the bucket and nearest values there, and the bucket summary."""
    here = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    # Looking ahead is looking back in reverse order: a frame that ends at the last row would
    # be scanned again for every row.
    back = Window.partitionBy(*keys, _BUCKET).orderBy(F.col("__place").desc())
    reading = F.when(
        F.col(value).isNotNull(), F.struct(F.col("__place"), F.col(value).alias("v"))
    )
    rows = (
        bucketed.withColumn("__place", F.row_number().over(here).cast("long"))
        .withColumn(
            "__prev",
            F.last(reading, ignorenulls=True).over(
                here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .withColumn(
            "__next",
            F.last(reading, ignorenulls=True).over(
                back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    )
    summary = rows.groupBy(*keys, _BUCKET).agg(
        F.max("__place").alias("__n"),
        F.min(reading).alias("__first"),
        F.max(reading).alias("__last"),
    )
    return rows, summary


def _carry(summary: DataFrame, keys) -> DataFrame:
    """Offset of each bucket, the last value before it and the first value after it."""
    line = Window.partitionBy(*keys).orderBy(_BUCKET)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = (
        Window.partitionBy(*keys)
        .orderBy(F.col(_BUCKET).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def shifted(edge):
        return F.when(
            F.col(edge).isNotNull(),
            F.struct(
                (F.col("__offset") + F.col(f"{edge}.__place")).alias("__place"),
                F.col(f"{edge}.v").alias("v"),
            ),
        )

    return (
        summary.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn("__before", F.last(shifted("__last"), ignorenulls=True).over(before))
        .withColumn("__after", F.last(shifted("__first"), ignorenulls=True).over(after))
        .select(*keys, _BUCKET, "__offset", "__before", "__after")
    )


def _join_buckets(rows: DataFrame, summary: DataFrame, keys) -> DataFrame:
    """Attach the summary of its (key, bucket) to every row; null keys match null keys."""
    names = [*keys, _BUCKET]
    renamed = summary.withColumnsRenamed({k: f"__of_{k}" for k in names})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in names])
    return rows.join(renamed, on).drop(*[f"__of_{k}" for k in names])


def interpolate_linear(
    df: DataFrame, value: str, keys, order, bucket: Column = None
) -> DataFrame:
    """Fill nulls of `value` on the straight line between neighbours, by row position.

    Leading nulls stay null and trailing nulls take the last value. `keys=[]` treats the
    whole frame as one series.
    """
    rows, summary = _edges(with_buckets(df, keys, order, bucket), keys, order, value)
    joined = _join_buckets(rows, _carry(summary, keys), keys)
    place = F.col("__offset") + F.col("__place")

    def global_place(edge, carried):
        return F.coalesce(
            F.col("__offset") + F.col(f"{edge}.__place"), F.col(f"{carried}.__place")
        )

    p_at, n_at = global_place("__prev", "__before"), global_place("__next", "__after")
    p_v = F.coalesce(F.col("__prev.v"), F.col("__before.v"))
    n_v = F.coalesce(F.col("__next.v"), F.col("__after.v"))
    line = p_v + (n_v - p_v) * (place - p_at) / (n_at - p_at)
    filled = F.coalesce(
        F.col(value), F.when(n_v.isNull(), p_v).when(p_v.isNotNull(), line)
    )
    return joined.withColumn(value, filled).select(*df.columns)


def fill_forward_when(
    df: DataFrame, values, trigger: Column, keys, order, bucket: Column = None
) -> DataFrame:
    """Forward-fill each of `values` in every series with a null of it where `trigger` holds.

    One such cell makes the whole series be filled; a series without one keeps its nulls.
    All columns share one window pass and one summary.
    """
    marked = with_buckets(df, keys, order, bucket)
    here = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.struct(*order)
    rows, edges, carried = marked, [], []
    line = Window.partitionBy(*keys).orderBy(_BUCKET)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    for v in values:
        known = F.col(v).isNotNull()
        rows = rows.withColumn(f"__prev_{v}", F.last(v, ignorenulls=True).over(so_far))
        edges.append(F.max_by(v, F.when(known, place)).alias(f"__last_{v}"))
        edges.append(F.max(F.coalesce(trigger & ~known, F.lit(False))).alias(f"__hit_{v}"))
        carried.append(F.last(f"__last_{v}", ignorenulls=True).over(before).alias(f"__before_{v}"))
        carried.append(
            F.max(f"__hit_{v}").over(Window.partitionBy(*keys)).alias(f"__fill_{v}")
        )
    summary = marked.groupBy(*keys, _BUCKET).agg(*edges).select(*keys, _BUCKET, *carried)
    joined = _join_buckets(rows, summary, keys)

    def filled(v):
        value = F.coalesce(F.col(v), F.col(f"__prev_{v}"), F.col(f"__before_{v}"))
        return F.when(F.col(f"__fill_{v}"), value).otherwise(F.col(v)).alias(v)

    return joined.select(*[filled(c) if c in values else F.col(c) for c in df.columns])


def row_positions(
    df: DataFrame, keys, order, bucket: Column = None, name: str = "pos"
) -> DataFrame:
    """1-based row number along `order`, without a single-task sort."""
    here = Window.partitionBy(*keys, _BUCKET).orderBy(*order)
    bucketed = with_buckets(df, keys, order, bucket)
    rows = bucketed.withColumn("__place", F.row_number().over(here).cast("long"))
    sizes = bucketed.groupBy(*keys, _BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = (
        Window.partitionBy(*keys)
        .orderBy(_BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *keys, _BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    joined = _join_buckets(rows, offsets, keys)
    return joined.withColumn(name, F.col("__offset") + F.col("__place")).select(
        *df.columns, name
    )


def chronological_split(
    df: DataFrame, order, bucket: Column = None, share: float = 0.8
) -> DataFrame:
    """Add `is_train`: true for the first floor(share * n) rows along `order`."""
    bucketed = with_buckets(df, [], order, bucket)
    placed = row_positions(bucketed, [], order, F.col(_BUCKET), name="__pos")
    size = bucketed.agg(F.count(F.lit(1)).alias("n")).scalar()
    flagged = placed.withColumn("is_train", F.col("__pos") <= F.floor(size * share))
    return flagged.select(*df.columns, "is_train")


# The operators below run on hourly tables: one row per (key, hour), so a key has at most
# as many rows as the calendar has hours (87,600 in ten years) and one task can sort it.


def lag_or_self(df: DataFrame, value: str, keys, order: str, name: str) -> DataFrame:
    """Previous value in the series; the value itself where there is none."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(name, F.coalesce(F.lag(value, 1).over(w), F.col(value)))


def run_lengths(df: DataFrame, on: Column, keys, order: str, name: str) -> DataFrame:
    """Rows since the present run of `on` began; 0 outside a run."""
    w = Window.partitionBy(*keys).orderBy(order)
    flag = F.coalesce(on, F.lit(False))
    breaks = F.sum((~flag).cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = Window.partitionBy(*keys, "__break").orderBy(order)
    return (
        df.withColumn("__break", breaks)
        .withColumn("__on", flag.cast("int"))
        .withColumn(
            name,
            F.sum("__on")
            .over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            .cast("int"),
        )
        .drop("__break", "__on")
    )


def off_spans(df: DataFrame, on: Column, keys, order: str = "ts") -> DataFrame:
    """Contiguous OFF spans: from the first OFF time to the next ON time.

    The last span of a series ends at the last row of the series.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    flag = F.coalesce(on, F.lit(False))
    started = (F.lag("__on", 1, True).over(w) & ~F.col("__on")).cast("int")
    rows = (
        df.select(*keys, order, flag.alias("__on"))
        .withColumn("__span", F.sum(started).over(w))
        .withColumn("__after", F.lead(order).over(w))
    )
    return (
        rows.where(~F.col("__on"))
        .groupBy(*keys, "__span")
        .agg(
            F.min(order).alias("span_start"),
            F.max(F.coalesce("__after", order)).alias("span_end"),
            F.count(F.lit(1)).alias("off_rows"),
        )
        .drop("__span")
    )


def sampling_interval(df: DataFrame, keys, order: str = "ts") -> DataFrame:
    """Median seconds between neighbouring rows; one hour where unknown or not positive."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = F.unix_micros(order) - F.unix_micros(F.lag(order, 1).over(w))
    middle = F.median(F.col("__step") / 1e6)
    return (
        df.select(*keys, step.alias("__step"))
        .groupBy(*keys)
        .agg(
            F.when(middle > 0, middle).otherwise(F.lit(3600.0)).alias("interval_seconds")
        )
    )


def hour_blocks(hours: DataFrame, keys, size: int, hour: str = "hour") -> DataFrame:
    """Number runs of consecutive hours and cut each run into blocks of `size` hours.

    Hours 8, 9, 10, 13 with size 2 give the blocks [8, 9], [10] and [13].
    """
    w = Window.partitionBy(*keys).orderBy(hour)
    island = F.col(hour) - F.row_number().over(w)
    inside = Window.partitionBy(*keys, "__island").orderBy(hour)
    return (
        hours.withColumn("__island", island)
        .withColumn("__block", F.floor((F.row_number().over(inside) - 1) / size))
        .withColumn(
            "block_start",
            F.min(hour).over(Window.partitionBy(*keys, "__island", "__block")),
        )
        .drop("__island", "__block")
    )
