"""The tree forest against brute force, on trees that do split."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermolane.llm.embedding_forest import near_duplicates

SCHEMA = "vec_id long, embedding array<double>, label string"


def brute(rows, threshold=0.93):
    """Links by the definition: (vec_id, vec_id) of equal labels, and the smallest id reachable."""
    def sound(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, float) / np.linalg.norm(v), lab) for i, v, lab in rows if lab is not None and sound(v)]
    links = {
        (a, b) for a, x, p in good for b, y, q in good
        if a != b and p == q and len(x) == len(y) and x @ y >= threshold
    }
    low = {i: i for i, _, _ in rows}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if low[b] < low[a]:
                low[a], changed = low[b], True
    return links, low


def planted(count, dim, cosine, seed):
    """Random vectors, every one with a partner at about the given cosine."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((count, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.standard_normal((count, dim))
    off -= (off * x).sum(1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    return np.concatenate([x, cosine * x + math.sqrt(1 - cosine**2) * off])


@pytest.mark.parametrize("leaf,dim,cosine", [(32, 32, 0.94), (128, 64, 0.932)])
def test_recall_of_planted_pairs(spark, leaf, dim, cosine):
    vectors = planted(600, dim, cosine, leaf)
    rows = [(i, [float(x) for x in v], "a") for i, v in enumerate(vectors)]
    links, _ = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.vec_id: r for r in near_duplicates(df, leaf=leaf).collect()}
    assert len(got) == len(rows)
    truth = {i: 0 for i in got}
    for a, _b in links:
        truth[a] += 1
    assert all(got[i].n_links <= truth[i] for i in got)  # nothing below the bound
    assert sum(r.n_links for r in got.values()) >= 0.9 * len(links) > 0


def test_awkward_rows(spark):
    near = [1.0, 0.1, 0.0]
    rows = [
        (1, [1.0, 0.0, 0.0], "a"), (2, near, "a"), (3, near, "a"), (4, near, "b"), (5, near, None),
        (6, None, "a"), (7, [], "a"), (8, [0.0, 0.0, 0.0], "a"), (9, [1.0, None, 0.0], "a"),
        (10, [float("nan"), 1.0, 0.0], "a"), (11, [float("inf"), 1.0, 0.0], "a"), (12, [1.0, 0.1], "a"),
        (13, [1e300, 1e299, 0.0], "a"), (14, [1e-300, 1e-301, 0.0], "a"), (3, near, "a"),
        (15, [0.0, 0.0, 1.0], "a"),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", cid int").withColumn("node", F.lit("x"))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect())
    linked = [(1, 5, 1, True), (2, 5, 1, False), (3, 5, 1, False), (3, 5, 1, False), (13, 5, 1, False), (14, 5, 1, False)]
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 15)]
    assert got == sorted(linked + alone)


def test_a_group_that_no_cut_splits(spark):
    """Many near vectors are compared in blocks; a long chain is one component."""
    angles = [0.0005 * i for i in range(300)]
    rows = [(i, [math.cos(a), math.sin(a)], "a") for i, a in enumerate(angles)] + [(900, None, None)]
    links, low = brute(rows)
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), leaf=64, max_depth=3).collect()}
    assert sum(r.n_links for r in got.values()) == len(links)
    assert {i: r.component_id for i, r in got.items()} == low


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
