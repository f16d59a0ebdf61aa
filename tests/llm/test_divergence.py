"""The source audit against whole-number arithmetic over all terms."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from thermolane.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, p int"


def brute(rows, min_docs, top):
    docs = [(t or "", lang or "", s or "") for _, t, lang, s, *_ in rows]
    found = {(lang, s): Counter() for _, lang, s in docs}
    spread = defaultdict(Counter)
    for t, lang, s in docs:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t)]
        found[lang, s].update(terms)
        spread[lang].update(set(terms))
    out = set()

    def ranked(lang, s, part, values, most=None):
        order = sorted(values.items(), key=lambda v: (-v[1], v[0].encode()))
        out.update((lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(order[:most]))

    for lang in {g[0] for g in found}:
        kept = [t for t, n in spread[lang].items() if n >= min_docs]
        own = {s: c for (x, s), c in found.items() if x == lang}
        every = sum(own.values(), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: shares(c) for s, c in own.items()}, shares(every)
        for s in own:
            ranked(lang, s, "pair", {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in own if o != s})
            ranked(lang, s, "term", {t: f(p[s][t], q[t]) for t in kept if own[s][t] and p[s][t] > q[t]}, top)
    return out


def sample():
    draw = random.Random(3)
    words = ["the", "The", "été", "ÉTÉ", "naïve", "日本", "x1y", *(f"w{'abcdefghij'[i % 10]}{'klmno'[i % 5]}" for i in range(40))]
    rows = [(i, " ".join(draw.choices(words, k=draw.randrange(1, 50))), draw.choice(["en", "fr", None]), f"s{draw.randrange(11)}", "clash", 1) for i in range(260)]
    rows += [(1, None, "en", "empty", "c", 1), (2, "", None, None, "c", 1), (3, "12 34", "xx", "a", "c", 1), (4, "rare", "xx", "b", "c", 1)]
    return rows + rows[:9] + [(None, "alone", "one", "only", "c", 1)] * 12 + [(9, "long " * 40000 + "the", "fr", "s1", "c", 1)]


@pytest.mark.parametrize(("group_block", "term_block"), [(8, 8192), (2, 5), (3, 1)])
def test_audit_is_exact(spark, group_block, term_block):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = divergence.audit_sources(df, min_docs=10, top=3, group_block=group_block, term_block=term_block).collect()
    got = {(r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in found}
    assert got == brute(rows, 10, 3) and len(got) == len(found)


def test_no_rows_and_no_kept_terms(spark):
    df = spark.createDataFrame(sample(), SCHEMA)
    assert divergence.audit_sources(df.limit(0)).collect() == []
    none = divergence.audit_sources(df, min_docs=10**6).collect()
    assert none and {r.value for r in none} == {0} and {r.part for r in none} == {"pair"}


def test_shares_are_exact_beyond_64_bits(spark):
    n = 2**61 + 12345
    total, v = 2**62 - 99, 1234567
    row = spark.range(1).selectExpr(f"{n}L as n", f"{total}L as t", f"{v}L as v").select(divergence._share("n", "t", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (total + 2 * v)


def test_terms_in_slices(monkeypatch):
    text = "Ein schöner Tag, naïve—ja 日本語 x\u007fy " * 5
    want = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
    for size in (1, 3, 8, 10**6):
        monkeypatch.setattr(divergence, "SLICE", size)
        assert [w.decode() for w in divergence._terms(text)] == want


def test_a_task_hands_on_one_row_per_term_of_a_language(spark):
    rows = [(i, f"The word{'abc'[i % 3]} the", "en", f"s{i % 20}", "clash", 1) for i in range(200)] + [(1, None, "fr", "none", "c", 1)]
    found = divergence.count_terms(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert len(found) == 6
    got = {(r.lang, r.term): (r.n, r.docs, {c.source: c.n for c in r["counts"]}) for r in found}
    assert got["en", "the"] == (400, 200, {f"s{k}": 20 for k in range(20)})
    assert got["en", "worda"][:2] == (67, 67) and sum(got["en", "wordb"][2].values()) == 67
    assert got["en", None] == (0, 0, {f"s{k}": 0 for k in range(20)}) and got["fr", None] == (0, 0, {"none": 0})


@pytest.mark.parametrize(("held", "piece", "rows_", "slice_"), [(10**6, 4 << 20, 1 << 16, 4 << 20), (30, 200, 7, 150), (1, 1, 1, 1), (10**6, 1000, 5, 10**6)])
def test_counts_at_any_limit(monkeypatch, held, piece, rows_, slice_):
    rows = [("x", "empty", ""), ("x", "empty", "12 ;"), *((lang or "", s, t or "") for _, t, lang, s, *_ in sample() if s), ("fr", "s1", "日本 " * 300)]
    batches = [pa.RecordBatch.from_pydict({c: [r[k] for r in rows[at : at + 50]] for k, c in enumerate(("lang", "source", "text"))}) for at in range(0, len(rows), 50)]
    for name, value in (("HELD", held), ("PIECE", piece), ("ROWS", rows_), ("SLICE", slice_)):
        monkeypatch.setattr(divergence, name, value)
    counts, docs, groups = Counter(), Counter(), set()
    for batch in divergence._count(iter(batches)):
        for r in batch.to_pylist():
            assert r["n"] == sum(c["n"] for c in r["counts"])
            for c in r["counts"]:
                if r["term"] is None:
                    groups.add((r["lang"], c["source"]))
                else:
                    counts[r["lang"], c["source"], r["term"]] += c["n"]
            if r["term"] is not None:
                docs[r["lang"], r["term"]] += r["docs"]
    want, spread = Counter(), Counter()
    for lang, s, t in rows:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t)]
        want.update((lang, s, w) for w in terms)
        spread.update((lang, w) for w in set(terms))
    assert counts == want and docs == spread and groups == {r[:2] for r in rows}
