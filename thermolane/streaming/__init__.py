"""Structured Streaming forms of the daily ingest and the hourly rollup."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from thermolane.sources import stored
from thermolane.sources.writers import upsert


def read_stream(spark: SparkSession, path: str, schema, glob: str = "*.parquet", **options):
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.parquet(path)


def _merge(path: str, checkpoint: str, keys, ts: str, newest_by=None):
    """What a stream does with a batch: merge it into the stored table, once.

    The table's manifest records the number of the last batch of every query, in the same step
    as the rows, so that a batch replayed after a failure is skipped.
    """

    def merge(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.persist()
        try:
            rows = batch if newest_by else stored.newest(batch, keys, [])
            upsert(rows, path, keys, ts, newest_by=newest_by, batch_of=(query or checkpoint, number))
        finally:
            batch.unpersist()

    return merge


def ingest_stream(
    stream: DataFrame, path: str, checkpoint: str, keys, ts: str, newest_by=None
):
    """Merge every micro-batch into the stored table: late rows are added, corrected rows replace.

    One row per key stays. With `newest_by` (columns such as a version or a time of arrival) it is
    the row with the largest of these, in whatever order the rows come; without, that of the
    last batch that has the key. No row is dropped for being late: the table itself is the state.
    """
    return (
        stream.writeStream.foreachBatch(_merge(path, checkpoint, keys, ts, newest_by))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def hourly_stream(
    stream: DataFrame, keys, value: str, path: str, checkpoint: str, lateness: str = "2 hours",
    open_hours: bool = False,
):
    """Hourly sums per key of closed hours: an hour is stored once, when the watermark passes its end.

    The watermark is the largest time seen less `lateness`; later rows of a closed hour are
    dropped, and state is kept for open hours only. Open hours are stored, as they stand after
    each batch and replaced by the next, only with `open_hours`.
    """
    hourly = (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 hour").alias("w"), *keys)
        .agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("samples"))
        .select(*keys, F.col("w.start").alias("ts"), value, "samples")
    )
    return (
        hourly.writeStream.foreachBatch(_merge(path, checkpoint, [*keys, "ts"], "ts"))
        .option("checkpointLocation", checkpoint)
        .outputMode("update" if open_hours else "append")
        .trigger(availableNow=True)
        .start()
    )
