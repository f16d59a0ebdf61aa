"""How far the sources of a language diverge, by three-dimensional cube partitioning.

The work of comparing all groups over all terms is a cube: group x group x term. It is cut into cells of
(group block, group block, term block). A cell gets copies of the two slices of counts that it needs,
computes the partial divergences of its pairs, and the partial values are added up along the term axis.
No task ever holds more than two slices, whose sizes are parameters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import stage

#: Scale of the smoothed shares.
SCALE = 1_000_000_000
#: Counts of terms that a task holds before it adds them up; if half as many are left, it hands them on.
HELD = 1_000_000
#: Bytes of texts that are counted at once, and rows that are counted or handed on at once.
PIECE, ROWS = 4 << 20, 1 << 16
#: A-Z lower-cased, a-z and all bytes of other characters as they are, the rest of ASCII blank.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Characters of a text that are cut into terms at once.
SLICE = 1 << 22


def _terms(text: str) -> Iterator[bytes]:
    """The terms of a whole text, in UTF-8."""
    left = b""
    for at in range(0, len(text), SLICE):
        data = left + text[at : at + SLICE].encode("utf-8", "surrogatepass").translate(_TERMS)
        *whole, left = data.split(b" ")
        yield from filter(None, whole)
    if left:
        yield left


class _Groups(dict):
    """Numbers of the groups (lang, source), in the order in which a task meets them."""

    def __missing__(self, group: tuple[str, str]) -> int:
        self[group] = len(self)
        return self[group]

    def columns(self) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """The names of the languages, the sources of all groups, and the language number of every group."""
        langs = pa.array([g[0] for g in self], pa.string()).dictionary_encode()
        return langs.dictionary, pa.array([g[1] for g in self], pa.string()), langs.indices.to_numpy().astype(np.int64)


#: (terms, number of the term, number of the group, occurrences, documents): an entry per term and group.
_Part = tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _count_piece(langs: pa.Array, sources: pa.Array, texts: pa.Array, groups: _Groups) -> _Part:
    """The counts of some whole texts, each with a blank at its end, through one sort of (term, document)."""
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    width = len(source.dictionary)
    both, own = np.unique(lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy(), return_inverse=True)
    numbers = np.array([groups[lang.dictionary[int(g) // width].as_py(), source.dictionary[int(g) % width].as_py()] for g in both], np.int64)
    by_group = np.argsort(own, kind="stable")  # documents are numbered so that those of a group adjoin
    place = np.empty(len(own), np.int64)
    place[by_group] = np.arange(len(own))

    _, offsets, buffer = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
    data = np.frombuffer(buffer.to_pybytes().translate(_TERMS), np.uint8)[: ends[-1]]
    letter = data != 0x20
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    if letter[0]:
        edge = np.concatenate([[0], edge])
    first, after = edge[0::2], edge[1::2]
    starts = np.concatenate([[0], np.cumsum(after - first)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(starts), pa.py_buffer(data[letter])]).dictionary_encode()
    doc = np.repeat(place, np.diff(np.searchsorted(first, ends)))

    bits = len(own).bit_length()
    key = np.sort(words.indices.to_numpy().astype(np.int64) << bits | doc)
    new = np.flatnonzero(np.concatenate([key[:1] >= 0, key[1:] != key[:-1]]))  # occurrences of a term in a document
    term, group = key[new] >> bits, own[by_group][key[new] & ((1 << bits) - 1)]
    at = np.flatnonzero(np.concatenate([term[:1] >= 0, (term[1:] != term[:-1]) | (group[1:] != group[:-1])]))
    return words.dictionary, term[at], numbers[group[at]], np.diff(np.append(new[at], len(key))), np.diff(np.append(at, len(new)))


def _count_long(text: str, group: int) -> _Part:
    """The counts of a text that is cut into terms in slices."""
    found = Counter(_terms(text))
    n = np.fromiter(found.values(), np.int64, len(found))
    return pa.array(list(found), pa.binary()).cast(pa.string()), np.arange(len(n)), np.full(len(n), group), n, np.ones(len(n), np.int64)


def _merged(parts: list[_Part], lang: np.ndarray) -> _Part:
    """One part with an entry per term and group, those of a term and language together."""
    names = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    index = np.split(names.indices.to_numpy().astype(np.int64), np.cumsum([len(p[0]) for p in parts])[:-1])
    term = np.concatenate([i[p[1]] for i, p in zip(index, parts, strict=True)])
    group, n, docs = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4))
    key = (term * len(lang) + lang[group]) * len(lang) + group
    order = np.argsort(key)
    at = np.flatnonzero(np.concatenate([key[:1] >= 0, np.diff(key[order]) != 0]))
    first = order[at]
    sums = (np.add.reduceat(v[order], at) if len(at) else v for v in (n, docs))
    return names.dictionary, term[first], group[first], *sums


def _rows(part: _Part | None, groups: _Groups) -> Iterator[pa.RecordBatch]:
    """A row per language and term, and one with a null term per language that lists its groups."""
    langs, sources, lang = groups.columns()
    if part is None:
        group = np.argsort(lang, kind="stable")
        term = n = docs = np.zeros(len(group), np.int64)
        names = pa.nulls(1, pa.string())
    else:
        names, term, group, n, docs = part
    if not len(term):
        return
    own = lang[group]
    at = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (own[1:] != own[:-1])]))
    counts = pa.StructArray.from_arrays([sources.take(pa.array(group)), pa.array(n)], ["source", "n"])
    columns = {
        "lang": langs.take(pa.array(own[at])),
        "term": names.take(pa.array(term[at])),
        "n": pa.array(np.add.reduceat(n, at)),
        "docs": pa.array(np.add.reduceat(docs, at)),
        "counts": pa.ListArray.from_arrays(pa.array(np.append(at, len(term)).astype(np.int32)), counts),
    }
    rows = pa.RecordBatch.from_pydict(columns)
    for k in range(0, len(rows), ROWS):
        yield rows.slice(k, ROWS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``count_terms`` for a task's batches (lang, source, text) without nulls."""
    groups, parts, held = _Groups(), [], 0
    blank = [pa.scalar(t, pa.large_string()) for t in ("", " ")]

    def handed() -> Iterator[pa.RecordBatch]:
        nonlocal held
        if parts:
            yield from _rows(_merged(parts, groups.columns()[2]), groups)
        yield from _rows(None, groups)
        groups.clear()
        parts.clear()
        held = 0

    for batch in batches:
        lang, source = batch.column("lang"), batch.column("source")
        text = batch.column("text").cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            end = min(max(start + 1, int(np.searchsorted(ends, before + PIECE, "right"))), start + ROWS)
            if ends[start] - before > SLICE:
                end = start + 1
                part = _count_long(text[start].as_py(), groups[lang[start].as_py(), source[start].as_py()])
            else:
                texts = pc.binary_join_element_wise(text.slice(start, end - start), *blank)
                part = _count_piece(lang.slice(start, end - start), source.slice(start, end - start), texts, groups)
            start = end
            if len(part[1]):
                parts.append(part)
                held += len(part[1])
            if held >= HELD:  # entries that repeat are added up; if that leaves too many, they are handed on
                parts[:] = [_merged(parts, groups.columns()[2])]
                held = len(parts[0][1])
                if held >= HELD // 2:
                    yield from handed()
            if len(groups) >= ROWS:
                yield from handed()
    yield from handed()


def count_terms(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, term, n, docs, counts): occurrences and documents of a term, and its occurrences by source.

    To be added up: tasks add up before the shuffle, and hand on at a fixed number of terms held. Rows with
    a null term list the groups. Nulls count as ''.
    """
    cols = df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    return cols.mapInArrow(_count, "lang string, term string, n long, docs long, counts array<struct<source: string, n: long>>")


def _share(n: str, total: str, terms: str):
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact for counts of any long; in longs where they hold it."""
    top = f"cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))"
    wide = f"{top} div cast({total} + 2 * {terms} as decimal(20,0))"
    return F.expr(f"if({n} < {(1 << 63) // SCALE - 2}, {SCALE}L * ({n} + 2) div ({total} + 2 * {terms}), {wide}) + 1")


def _cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of the pairs of one cell: rows with place -1 tell a group's share of unseen terms."""
    lang, i, j, _ = key
    heads = rows[rows.place < 0].sort_values("grp")
    width = int(heads.width.iloc[0])
    seen = rows[rows.place >= 0]

    def slice_of(block):
        own = heads[heads.block == block]
        numbers = own.grp.to_numpy()
        shares = np.repeat(own.p.to_numpy()[:, None], width, axis=1)
        part = seen[seen.block == block]
        shares[np.searchsorted(numbers, part.grp.to_numpy()), part.place.to_numpy()] = part.p.to_numpy()
        return numbers, shares

    left, p = slice_of(i)
    right, q = (left, p) if i == j else slice_of(j)
    out = []
    for k, a in enumerate(left):
        others = slice(k + 1, None) if i == j else slice(None)
        b, x = right[others], q[others]
        gap = p[k] - x
        out.append(pd.DataFrame({"a": a, "b": b, "value": (gap * gap // (p[k] + x)).sum(axis=1)}))
    done = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "value": []})
    return done.assign(lang=lang)[["lang", "a", "b", "value"]]


def audit_sources(
    df: DataFrame, min_docs: int = 10, top: int = 10, group_block: int = 8, term_block: int = 8192,
    lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank) over the groups (lang, source) that occur.

    Terms are runs of letters A-Z (lower-cased), a-z and of characters beyond ASCII. A language keeps the
    V terms that occur in at least ``min_docs`` of its documents. A group with count n of a term and N
    occurrences of kept terms has the share p = 1 + floor(1e9 * (n + 2) / (N + 2 V)) of it; the language
    has q likewise. f(p, q) = floor((p - q)^2 / (p + q)), all in whole numbers.

    Part ``pair``: every other source of the language, value the sum of f over all kept terms (0 without
    any). Part ``term``: the kept terms that the group has more of than the language, value f, the first
    ``top`` of them. Rank from 1 by value, largest first, then by item in UTF-8.

    Null text, lang and source count as ''. Groups without terms take part. Repeated rows are documents of
    their own. Texts are read whole; an empty table gives no rows; other columns are ignored. A cell holds
    at most 2 x ``group_block`` x about ``term_block`` shares, a row of the staged counts all sources of a term.
    """
    by_term = Window.partitionBy("lang", "term")
    # Summed and judged before the sources are taken apart; everything by term goes through this one shuffle.
    counts = (
        count_terms(df, lang_col, source_col, text_col)
        .withColumns({"n_lang": F.sum("n").over(by_term), "docs": F.sum("docs").over(by_term)})
        .where((F.col("docs") >= min_docs) | F.col("term").isNull())
        .select("lang", "term", "n_lang", F.inline("counts"))
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.max("n_lang").alias("n_lang"))
    )
    kept = stage(
        counts.groupBy("lang", "term").agg(F.max("n_lang").alias("n_lang"), F.collect_list(F.struct("source", "n")).alias("counts")), "kept"
    )
    sizes = kept.where("term is not null").groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    totals = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per group; numbered within the language.
    by_lang = Window.partitionBy("lang")
    groups = stage(
        totals.join(sizes, "lang", "left")
        .na.fill(0, ["v", "total_lang"])
        .withColumn("grp", F.row_number().over(by_lang.orderBy("source")) - 1)
        .withColumn("blocks", F.ceil(F.count("*").over(by_lang) / F.lit(group_block)).cast("int"))
        .withColumn("block", F.expr(f"grp div {group_block}").cast("int"))
        .withColumn("slabs", F.greatest(F.lit(1), F.ceil(F.col("v") / F.lit(term_block))).cast("int"))
        .withColumn("p_none", F.when(F.col("v") > 0, _share("0", "total", "v")).otherwise(0)),
        "groups",
    )
    kept = kept.where("term is not null")
    pairs = _pairs(kept, groups)
    terms = (
        kept.select("lang", "term", "n_lang", F.inline("counts")).join(groups, ["lang", "source"])
        .select("lang", "source", "term", _share("n", "total", "v").alias("p"), _share("n_lang", "total_lang", "v").alias("q"))
        .where("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(cols).unionByName(terms.withColumn("part", F.lit("term")).select(cols))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language, through the cells."""
    slab = F.pmod(F.xxhash64("term"), F.col("slabs")).cast("int").alias("slab")
    langs = groups.groupBy("lang").agg(F.first("slabs").alias("slabs"))
    in_slab = Window.partitionBy("lang", "slab")
    places = stage(
        kept.join(langs, "lang").select("lang", "term", "counts", slab)
        .withColumn("place", F.row_number().over(in_slab.orderBy("term")) - 1).drop("term"),
        "places",
    )
    widths = places.groupBy("lang", "slab").agg(F.count("*").cast("int").alias("width"))
    heads = groups.select("lang", "grp", "block", "blocks", F.col("p_none").alias("p"), F.explode(F.expr("sequence(0, slabs - 1)")).alias("slab"))
    heads = heads.join(widths, ["lang", "slab"], "left").na.fill(0, ["width"])
    heads = heads.select("lang", "slab", "grp", "block", "blocks", F.lit(-1).alias("place"), F.col("p").cast("long"), "width")
    seen = places.select("lang", "slab", "place", F.inline("counts")).join(groups, ["lang", "source"])
    seen = seen.select("lang", "slab", "grp", "block", "blocks", "place", _share("n", "total", "v").alias("p"), F.lit(0).alias("width"))
    slices = heads.unionByName(seen).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = slices.select(
        "lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "slab",
        "grp", "block", "place", "p", "width",
    )
    partial = cells.groupBy("lang", "i", "j", "slab").applyInPandas(_cell, "lang string, a int, b int, value long")
    sums = stage(partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    names = groups.select("lang", "grp", "source")
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    return (
        both.join(names.withColumnRenamed("grp", "a"), ["lang", "a"])
        .join(names.select("lang", F.col("grp").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", "item", "value")
    )
