"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a grouped minimum and a join, so an edge table never grows and no component is ever
gathered in one place. Edges are written between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, stage


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(0x7FFFFFFF))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node.

    Null ends and loops are left out. Nodes may be of any ordered type.
    """
    x, y = F.col(a), F.col(b)
    pairs = edges.where(x.isNotNull() & y.isNotNull() & (x != y))
    now = stage(pairs.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = stage(
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = stage(
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "small",
        )
        discard(now, low, large, least)
        now, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
