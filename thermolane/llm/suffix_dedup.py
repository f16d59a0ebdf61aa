"""Exact removal of repeated 50-byte strings by a sparse suffix array over the corpus.

Suffixes start at anchors, chosen by content: in every string of the given length the k-mer of least
hash is one, so equal strings have equal anchors. Suffixes whose leading k-mer occurs in one document
only are dropped; the rest carry the bytes around them, are range-partitioned by sampled splitters of
their leading k-mer, sorted in each bucket, and compared with their neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import stage
from .textbytes import _MIX, _powers, in_pieces, joined, mixed

#: Leading bytes that a suffix is dealt by.
LEAD = 24
TAG_SHIFT = 40
#: Suffixes compared at once within a bucket; a group of one k-mer is never cut.
CHUNK = 20_000
#: Strings compared at once, and rows hashed at once, within such a group.
STRINGS, BLOCK = 1 << 20, 1 << 14
NO_HASH = np.uint64(2**64 - 1)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on."""
    up, down = _powers(len(data))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_MIX[data] * up)])
    return mixed((total[size:] - total[:-size]) * down[: len(data) - size + 1])


def _slide(values: np.ndarray, width: int, f) -> np.ndarray:
    """f over ``width`` values from each place on."""
    step, out = 1, values
    while step * 2 <= width:
        out = f(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return f(out[: len(out) - rest], out[rest:]) if rest else out


def _anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of all anchors; every whole string of ``length`` bytes in a text has one."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    width = length - LEAD + 1
    h = _grams(data, LEAD)
    least = _slide(h, width, np.minimum)  # one per string
    # Strings over the end of a text (its separator is at ends - 1) do not count.
    inside = np.zeros(len(least) + 1, np.int32)
    first_bad = np.maximum(ends[1:] - length, ends[:-1])
    np.add.at(inside, np.minimum(first_bad, len(least)), 1)
    np.add.at(inside, np.minimum(ends[1:], len(least)), -1)
    least[np.cumsum(inside)[:-1] > 0] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    place = np.flatnonzero((_slide(padded, width, np.maximum)[: len(h)] == h) & (h != 0))
    return place, h[place]


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = batch.column(2).to_pylist()
            for i, j in in_pieces(texts):
                data, ends = joined(texts[i:j])
                place, h = _anchors(data, ends, length)
                row = np.searchsorted(ends, place, "right") - 1
                at = (place - ends[row]) | ((k[i:j][row] & 0xFFFF) << TAG_SHIFT)
                for a in range(0, len(row), 1 << 16):
                    b = a + (1 << 16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[a:b].view(np.int64)), pa.array(ids[i:j][row[a:b]]), pa.array(at[a:b])], ["s", "doc_id", "at"]
                    )

    return run


def _suffix_rows(length: int):
    """The bytes around each anchor that takes part: all strings that hold it."""
    reach = length - LEAD

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column("text")[k].as_py().encode("utf-8", "surrogatepass")
                at = batch.column("places")[k].values.to_numpy(zero_copy_only=False)
                s = batch.column("grams")[k].values.to_numpy(zero_copy_only=False)
                doc, tag = batch.column("doc_id")[k].as_py(), batch.column("tag")[k].as_py()
                for a in range(0, len(at), 4096):
                    some = at[a : a + 4096]
                    start = np.maximum(some - reach, 0)
                    around = [raw[x : y + length] for x, y in zip(start.tolist(), some.tolist(), strict=True)]
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s[a : a + 4096]), pa.array(np.full(n, doc)), pa.array(start | (tag << TAG_SHIFT)), pa.array(around, pa.binary())],
                        ["s", "doc_id", "start", "around"],
                    )

    return run


def _hits(s, owner, around, length) -> tuple[np.ndarray, np.ndarray]:
    """(edges, hit) of the strings of each row: is the string in a row of a smaller document?

    Strings are compared in passes by a hash of their own, so that a pass holds about STRINGS of them;
    only a flag for each string is kept.
    """
    sizes = np.fromiter(map(len, around), np.int64, len(around))
    strings = np.maximum(sizes - length + 1, 0)
    edges = np.concatenate([[0], np.cumsum(strings)])
    hit = np.zeros(int(edges[-1]), bool)
    passes = np.uint64(len(hit) // STRINGS + 1)
    for p in range(int(passes)):
        found: list[tuple] = []
        for a in range(0, len(around), BLOCK):
            some = slice(a, a + BLOCK)
            data = np.frombuffer(b"".join(around[some]), np.uint8)
            if len(data) < length:
                continue
            h = _grams(data, length)
            n = strings[some]
            row = np.repeat(np.arange(len(n)), n)
            within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            string = h[(np.cumsum(sizes[some]) - sizes[some])[row] + within] ^ mixed(s[some][row].view(np.uint64))
            mine = np.flatnonzero(string % passes == p)
            found.append((string[mine], owner[some][row[mine]], edges[a] + mine))
        if not found:
            continue
        string, who, place = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((who, string))
        new = np.concatenate([[True], string[order][1:] != string[order][:-1]])
        least = who[order][new][np.cumsum(new) - 1]
        hit[place[order]] = who[order] > least
    return edges, hit


def _repeats(s, doc, start, around, length) -> tuple:
    """(doc, from, to) of the runs in which each string also starts in a smaller document.

    Rows with the same k-mer and bytes are one for the comparison, that of their smallest document: in
    the others every string has started before.
    """
    keys = list(zip(s.tolist(), around, strict=True))
    number: dict[tuple, int] = {}
    same = np.fromiter((number.setdefault(k, len(number)) for k in keys), np.int64, len(keys))
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, same, doc)
    texts = [k[1] for k in number]
    edges, hit = _hits(np.array([k[0] for k in number], np.int64), least, texts, length)
    at = np.repeat(np.arange(len(texts)), np.diff(edges))
    joined_before = np.concatenate([[False], hit[:-1] & (at[1:] == at[:-1])]) if len(hit) else hit
    joined_after = np.concatenate([hit[1:] & (at[1:] == at[:-1]), [False]]) if len(hit) else hit
    first, last = np.flatnonzero(hit & ~joined_before), np.flatnonzero(hit & ~joined_after)
    # Runs of each distinct row go to the rows of its smallest document; later documents lose all of it.
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    later = np.flatnonzero((doc > least[same]) & (sizes[same] >= length))
    own = np.flatnonzero(doc == least[same])
    runs = np.bincount(at[first], minlength=len(texts)) if len(first) else np.zeros(len(texts), np.int64)
    begin = np.cumsum(runs) - runs
    n = runs[same[own]]
    rows = np.repeat(own, n)
    pick = np.repeat(begin[same[own]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    low = first - edges[at[first]] if len(first) else first
    high = last - edges[at[last]] + length if len(last) else last
    return (
        np.concatenate([doc[rows], doc[later]]),
        np.concatenate([start[rows] + low[pick], start[later]]),
        np.concatenate([start[rows] + high[pick], start[later] + sizes[same[later]]]),
    )


def _bucket_rows(length: int):
    def run(batches):
        """A bucket comes sorted by k-mer; it is compared in chunks that end between k-mers."""

        def done(part: pd.DataFrame):
            a, b, c = _repeats(part["s"].to_numpy(), part["doc_id"].to_numpy(), part["start"].to_numpy(), part["around"].tolist(), length)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], ["doc_id", "a", "b"])

        held = []
        rows = 0
        for batch in batches:
            held.append(batch.to_pandas())
            rows += batch.num_rows
            if rows >= CHUNK:
                part = pd.concat(held, ignore_index=True)
                keep = part["s"] == part["s"].iloc[-1]
                if not keep.all():
                    yield done(part[~keep])
                    part = part[keep]
                held, rows = [part], len(part)
        if held and rows:
            yield done(pd.concat(held, ignore_index=True))

    return run


def _cut_rows(batches):
    """Bytes and maximal runs removed, and the digest of what stays."""
    for batch in batches:
        out = []
        for k in range(batch.num_rows):
            raw = (batch.column("text")[k].as_py() or "").encode("utf-8", "surrogatepass")
            spans = batch.column("spans")[k].as_py() or []
            keep, at, runs, removed = hashlib.sha256(), 0, 0, 0
            end = -1
            for x in sorted(spans, key=lambda x: (x["a"], x["b"])):
                if x["a"] > end:
                    keep.update(raw[at : x["a"]])
                    runs += 1
                    removed += x["b"] - x["a"]
                    at = end = x["b"]
                elif x["b"] > end:
                    removed += x["b"] - end
                    at = end = x["b"]
            keep.update(raw[at:])
            out.append((len(raw), removed, runs, keep.hexdigest()))
        n, r, s, d = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(d, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256), one row for each input row.

    Removed is each byte covered by a string of ``length`` UTF-8 bytes that also starts in a document with
    a smaller id. Strings are judged on the input and never cross documents. Documents with equal texts
    are one group: all but its smallest id are removed whole, if long enough, and only that one is
    searched. Strings are compared by a 64-bit fingerprint among suffixes with equal anchors.

    Null texts are empty. A row with a null id neither removes nor loses anything. Rows that repeat an id
    do not remove each other's bytes. An empty table gives an empty result; other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    k1, k2, n = F.xxhash64("text"), F.xxhash64(F.lit(1), "text"), F.octet_length("text").cast("long")
    prints = stage(
        base.select("doc_id", k1.alias("k1"), k2.alias("k2"), n.alias("n"), F.when(n < length, F.sha2("text", 256)).alias("small")),
        "prints",
    )
    known = prints.where("doc_id is not null")
    groups = known.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    copies = stage(
        known.join(groups.where("rep < last"), ["k1", "k2", "n"]).where("doc_id > rep").select("doc_id", "k1", "n", "small"), "copies"
    )
    twice = copies.select("doc_id", "k1").distinct()
    first = base.where("doc_id is not null").withColumn("k1", k1).join(twice, ["doc_id", "k1"], "left_anti")
    rows = first.where(F.octet_length("text") >= length).select("doc_id", "k1", "text")
    anchors = rows.mapInArrow(_anchor_rows(length), "s long, doc_id long, at long")
    by_lead = Window.partitionBy("s")
    shared = anchors.withColumn("lo", F.min("doc_id").over(by_lead)).withColumn("hi", F.max("doc_id").over(by_lead))
    shared = shared.where("lo < hi").select("s", "doc_id", F.expr(f"shiftright(at, {TAG_SHIFT})").alias("tag"), F.expr(f"at & {(1 << TAG_SHIFT) - 1}").alias("at"))
    places = stage(
        shared.groupBy("doc_id", "tag").agg(F.collect_list("at").alias("places"), F.collect_list("s").alias("grams")), "places"
    )
    tagged = rows.withColumn("tag", F.col("k1").bitwiseAND(0xFFFF)).select("doc_id", "tag", "text")
    suffixes = tagged.join(places, ["doc_id", "tag"]).mapInArrow(
        _suffix_rows(length), "s long, doc_id long, start long, around binary"
    )
    buckets = suffixes.repartitionByRange("s").sortWithinPartitions("s")
    tag, low = F.expr(f"shiftright(a, {TAG_SHIFT})"), (1 << TAG_SHIFT) - 1
    spans = buckets.mapInArrow(_bucket_rows(length), "doc_id long, a long, b long").select(
        "doc_id", tag.alias("tag"), F.struct(F.expr(f"a & {low}").alias("a"), F.expr(f"b & {low}").alias("b")).alias("span")
    )
    spans = stage(spans.groupBy("doc_id", "tag").agg(F.collect_set("span").alias("spans")), "spans")
    cut = first.withColumn("tag", F.col("k1").bitwiseAND(0xFFFF)).join(spans, ["doc_id", "tag"], "left")
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    searched = cut.select("doc_id", "text", "spans").mapInArrow(_cut_rows, kinds)
    whole = F.col("n") >= length
    copied = copies.select(
        "doc_id", F.col("n").alias("n_bytes"), F.when(whole, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(0).cast("long").alias("n_spans"),
        F.coalesce("small", F.lit(hashlib.sha256().hexdigest())).alias("kept_sha256"),
    )
    zero = F.lit(0).cast("long")
    nameless = base.where("doc_id is null").select(
        "doc_id", n.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256")
    )
    return searched.unionByName(copied).unionByName(nameless).withColumnRenamed("doc_id", id_col)
