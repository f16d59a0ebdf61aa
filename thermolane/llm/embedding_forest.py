"""Near-duplicate vectors by a forest of random-projection trees with spill.

Every tree cuts the vectors of a label again and again by the projection on a random direction, one
for each tree and level; every node has a threshold of its own. Rows near a cut go to both sides.
Vectors are compared only within leaves, in blocks of bounded size, and what passes the exact cosine
test is united. Vectors are read once for every ``LEVELS`` levels; between, rows carry projections.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from .components import connected_components
from .storage import discard, stage

QUANTILES = [round(i / 40, 3) for i in range(1, 40)]
#: Levels whose projections are taken in one pass over the vectors.
LEVELS = 8


@pandas_udf(ArrayType(DoubleType()))
def _unit(vectors: pd.Series) -> pd.Series:
    """Scaled to length 1; null where null, empty, zero, or with null or non-finite components."""

    def one(vector):
        v = np.asarray([] if vector is None else vector, np.float64)
        peak = np.abs(v).max(initial=0.0)  # taken out first, so that squares neither overflow nor vanish
        if not np.isfinite(peak) or peak == 0:
            return None
        v = v / peak
        return v / np.sqrt(v @ v)

    return vectors.map(one)


def _projections(trees: int, first_level: int):
    """Of unit vectors on the unit directions of all trees and ``LEVELS`` levels, tree by tree."""

    def project(vectors: pd.Series) -> pd.Series:
        sizes = vectors.map(len)
        out = pd.Series([None] * len(vectors), index=vectors.index, dtype=object)
        for dim in sizes.unique():
            directions = np.stack([
                np.random.default_rng([tree, level, int(dim)]).standard_normal(dim)
                for tree in range(trees) for level in range(first_level, first_level + LEVELS)
            ])
            directions /= np.linalg.norm(directions, axis=1, keepdims=True)
            rows = np.flatnonzero(sizes == dim)
            p = np.stack(vectors.iloc[rows].to_list()) @ directions.T
            for row, values in zip(rows, p, strict=True):
                out.iat[row] = values
        return out

    return pandas_udf(project, ArrayType(DoubleType()))


def _cut(spill: float):
    """(threshold, share of rows within spill of it) of the calmest cut between the tenths."""

    def choose(quantiles: pd.Series) -> pd.DataFrame:
        rows = []
        for q in quantiles:
            q = np.asarray(q)
            at = np.arange(3, len(q) - 3)
            near = (np.abs(q[None, :] - q[at][:, None]) <= spill).mean(1)
            cost = near + np.abs((at + 1) / (len(q) + 1) - 0.5) * 0.2
            best = int(np.argmin(cost))
            rows.append((float(q[at[best]]), float(near[best])))
        return pd.DataFrame(rows, columns=["t", "share"])

    return pandas_udf(choose, "struct<t: double, share: double>")


def _grow(vectors: DataFrame, trees: int, leaf: int, spill: float, max_depth: int) -> DataFrame:
    """(cid, leaf, blocks): the leaves of every vector, and into how many blocks a leaf is cut."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    blocks = F.ceil(F.col("n") / leaf).cast("int").alias("blocks")

    def projected(first_level: int, *columns) -> DataFrame:
        flat = vectors.select("cid", *columns, _projections(trees, first_level)("vec").alias("flat"))
        rows = flat.select("cid", *[c for c in flat.columns if c not in ("cid", "flat")], "flat", tree)
        return rows.withColumn("ps", F.slice("flat", F.col("tree") * LEVELS + 1, F.lit(LEVELS))).drop("flat")

    root = F.xxhash64(F.lit("root"), "label", "dim", "tree").alias("node")
    live = projected(0, "label", F.size("vec").alias("dim")).select("cid", "tree", root, "ps")
    live, done, choose = stage(live, "nodes"), [], _cut(spill)
    for depth in range(max_depth + 1):
        if depth and depth % LEVELS == 0:
            live = stage(live.drop("ps").join(projected(depth), ["cid", "tree"]), "nodes")
        p = F.get("ps", F.lit(depth % LEVELS))
        seen = live.groupBy("node").agg(F.count("*").alias("n"), F.percentile_approx(p, QUANTILES, 2000).alias("q"))
        seen = seen.withColumn("c", choose("q"))
        split = (F.col("n") > leaf) & (F.col("c.share") <= 0.5) & F.lit(depth < max_depth)
        cuts = stage(seen.select("node", "n", F.when(split, F.col("c.t")).alias("t")), "cuts")
        # Rows of leaves stay in their node, side null; the others go below their cut, above it, or both.
        sides = F.array_compact(F.array(F.when(p <= F.col("t") + spill, 0), F.when(p >= F.col("t") - spill, 1)))
        sides = F.explode(F.when(F.col("t").isNull(), F.array(F.lit(None).cast("int"))).otherwise(sides)).alias("side")
        dealt = live.join(cuts, "node").select("cid", "tree", "node", "ps", blocks, F.col("t").isNull().alias("ended"), sides)
        dealt = stage(
            dealt.select(
                "cid", "tree", F.when(F.col("ended"), F.col("node")).otherwise(F.xxhash64("node", "side")).alias("node"),
                F.when(~F.col("ended"), F.col("ps")).alias("ps"), "blocks", "ended",
            ),
            "nodes",
        )
        done.append(dealt.where("ended").select("cid", F.col("node").alias("leaf"), "blocks"))
        more = not cuts.where("t is not null").isEmpty()
        discard(live, cuts)
        if not more:
            break
        live = dealt.where("not ended").select("cid", "tree", "node", "ps")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _compare(threshold: float):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links of two blocks of a leaf (or within one): counts by vector, and a spanning forest."""
        pdf = pdf.reset_index(drop=True)
        n, leaf, first, second = len(pdf), pdf["leaf"][0], pdf["one"][0], pdf["two"][0]
        x, cid, size = np.stack(pdf["vec"].to_numpy()), pdf["cid"].to_numpy(), pdf["size"].to_numpy()
        block = pdf["block"].to_numpy()
        # A pair counts in the smallest leaf that it shares, so that no pair counts twice.
        ids, held = np.unique(np.concatenate(pdf["leaves"].to_numpy()), return_inverse=True)
        owner = np.repeat(np.arange(n), [len(v) for v in pdf["leaves"]])
        member = np.zeros((n, len(ids)), np.float32)
        member[owner, held] = 1
        earlier = member[:, ids < leaf]
        links, root = np.zeros(n, np.int64), np.arange(n)
        found = []
        for start in range(0, n, 256):
            end = min(n, start + 256)
            hit = x[start:end] @ x.T >= threshold
            hit &= np.arange(n)[None, :] != np.arange(start, end)[:, None]
            if first != second:
                hit &= block[None, :] != block[start:end, None]
            fresh = hit & (earlier[start:end] @ earlier.T < 0.5)
            links[start:end] = fresh @ size
            i, j = np.nonzero(hit)
            if len(i):  # the smallest neighbour of each row is enough for a first forest
                found.append((i + start, j))
        if found:
            i, j = (np.concatenate(v) for v in zip(*found, strict=True))
            while True:
                low = root.copy()
                np.minimum.at(low, i, root[j])
                low = low[low]
                if (low == root).all():
                    break
                root = low
        return pd.DataFrame({"cid": cid, "links": links, "low": cid[root]})

    return compare


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    trees: int = 8,
    leaf: int = 1024,
    spill: float = 0.02,
    max_depth: int = 48,
) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each input row.

    Rows are linked when their labels are equal and the cosine of their vectors, in double precision,
    is at least ``threshold``. Equal vectors form one class first, so copies are compared once and
    count with their number. ``spill`` is the half-width of the strip around a cut whose rows go to
    both sides; nodes of up to ``leaf`` classes, and nodes that no cut splits without spilling half of
    them, are leaves. A leaf is compared in blocks of about ``leaf`` classes.

    Null labels and ids, and vectors that are null, empty, zero or hold null or non-finite components,
    link with nothing. Vectors of different lengths link with nothing. A row with a null id has a null
    component and is not kept. An empty table gives an empty result. Other columns are ignored.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vec"),
    )
    one, two = F.xxhash64(F.lit(1), "label", "raw"), F.xxhash64(F.lit(2), "label", "raw")
    unit = stage(
        rows.withColumnRenamed("vec", "raw").withColumn("vec", _unit("raw")).select(
            "id", "label", "vec", one.alias("k1"), two.alias("k2"), F.col("vec").isNotNull().alias("sound")
        ),
        "vectors",
    )
    sound = F.col("sound") & F.col("id").isNotNull() & F.col("label").isNotNull()
    keyed = unit.withColumns({"k1": F.when(sound, F.col("k1")), "k2": F.when(sound, F.col("k2"))})
    classes = stage(
        keyed.where("k1 is not null")
        .groupBy("k1", "k2")
        .agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.any_value("label").alias("label"),
             F.any_value("vec").alias("vec"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    leaves = _grow(classes, trees, leaf, spill, max_depth)
    lists = leaves.groupBy("cid").agg(F.collect_set(F.struct("leaf", "blocks")).alias("held"))
    placed = (
        classes.join(lists, "cid")
        .select("cid", "size", "vec", F.col("held.leaf").alias("leaves"), F.explode("held").alias("h"))
        .select("cid", "size", "vec", "leaves", "h.leaf", "h.blocks",
                F.pmod(F.xxhash64("cid", F.lit("block")), F.col("h.blocks")).cast("int").alias("block"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    )
    found = stage(
        placed.groupBy("leaf", "one", "two").applyInPandas(_compare(threshold), "cid long, links long, low long"),
        "links",
    )
    groups = connected_components(found.where("cid != low"), "cid", "low")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    info = classes.select("cid", "k1", "k2", "rep", "size").join(counts, "cid", "left").join(
        groups.withColumnRenamed("node", "cid"), "cid", "left"
    ).withColumn("component", F.coalesce("component", "cid"))
    info = stage(info.drop("cid"), "class_info")
    lowest = info.groupBy("component").agg(F.min("rep").alias("component_id"))
    info = info.join(lowest, "component").select(
        "k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    component = F.coalesce("component_id", "id")
    return keyed.select("id", "k1", "k2").join(info, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
