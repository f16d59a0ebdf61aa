"""Contiguous shards of near equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import stage


def shard_by_bytes(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): rows in order of id, cut into ``shards`` runs of equal bytes.

    A row's size is the UTF-8 length of its text plus 1 (null: 1). Texts are reduced to size and CRC
    before anything moves. The narrow rows are range-partitioned and stored with their partition
    number; the totals of the partitions, a row each, are summed up in order; within a partition runs a
    window. A row goes to the shard in which its middle byte falls. Rows with equal ids are ordered by
    size, CRC and a second hash; ``slot`` counts from 0 within the shard. Null ids come first. An empty
    table gives an empty result. Other columns are ignored.
    """
    narrow = df.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.encode(text_col, "utf-8"), F.lit(b""))).alias("crc"),
        F.xxhash64(text_col).alias("h"),
    )
    # The last key spreads rows that are equal in all others; which of them is first changes nothing.
    order = ["id", "size", "crc", "h", "tie"]
    placed = stage(
        narrow.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
        "sizes",
    )
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = stage(
        totals.select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("total"),
        ),
        "starts",
    )
    within = Window.partitionBy("part").orderBy(*order)
    summed = placed.withColumn("run", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    summed = summed.withColumn("nth", F.row_number().over(within)).join(starts, "part")
    middle = F.expr(f"(2 * (bytes_before + run) - size) * {shards} div (2 * total)")
    dealt = stage(
        summed.select(
            "id", "size", "crc", F.least(middle, F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("nth") - 1).alias("place"),
        ),
        "dealt",
    )
    first = dealt.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return dealt.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("place") - F.col("first")).alias("slot"),
    )
