"""Each operator against a brute-force version on small rows with nulls, empty texts, ties and copies."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from thermolane.llm import jaccard_join, pii, sharding, suffix_dedup, url_rules
from thermolane.llm.registry import URL_RULES

DOCS = "doc_id long, text string, node string, n int"


def texts():
    draw = random.Random(7)
    base = [" ".join(f"w{draw.randrange(400)}" for _ in range(60)) for _ in range(6)]
    out = [None, "", "  \t", "one two", "One TWO", "x " * 3000]
    for text in base:
        words = text.split()
        out += [text, text.upper(), text + " more"]
        for changed in (1, 2, 3):
            other = list(words)
            for _ in range(changed):
                other[draw.randrange(60)] = "changed"
            out.append(" ".join(other))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "clash", 1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS)


def roots(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_jaccard_join_is_exact(docs):
    sets = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    found = jaccard_join.jaccard_components(docs).collect()
    want = roots(sets, links)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), want[i]) for i, s in sets.items()}
    assert len(found) == len(sets)


def test_jaccard_join_near_its_bound(spark):
    """Families of texts with shared passages and changes at all places: many pairs just over and under the bound."""
    draw = random.Random(21)
    word = [f"v{i}" for i in range(300)]
    passage = [draw.choice(word) for _ in range(40)]
    rows = []
    for _ in range(12):
        base = passage[: draw.randrange(0, 41)] + [draw.choice(word) for _ in range(draw.randrange(20, 120))]
        for _ in range(25):
            text = list(base)
            for _ in range(draw.randrange(0, 5)):
                at = draw.randrange(len(text))
                text[at : at + draw.randrange(1, 3)] = [draw.choice(word) for _ in range(draw.randrange(0, 3))]
            rows.append(" ".join(text[draw.randrange(0, 4) : len(text) - draw.randrange(0, 8)]))
    rows += [" ".join(passage)] * 3 + [" ".join(passage[i:]) for i in range(12)]
    order = list(range(len(rows)))
    draw.shuffle(order)
    docs = spark.createDataFrame([(i, rows[k]) for i, k in enumerate(order)], "doc_id long, text string")
    sets = {}
    for i, k in enumerate(order):
        words = rows[k].split()
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    assert len(set(want.values())) > 30
    found = jaccard_join.jaccard_components(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_jaccard_join_compares_few_pairs_of_a_large_group(spark, monkeypatch):
    """Copies of one text with a few changes, too many for a link in a third of them: pairs stay in proportion to rows."""
    draw = random.Random(5)
    base = [f"b{draw.randrange(10**6)}" for _ in range(150)]
    rows = [" ".join(base)]
    for i in range(300):
        text = list(base)
        for at in draw.sample(range(10, 140), 6 if i % 3 == 0 else draw.randrange(1, 4)):
            text[at] = f"c{draw.randrange(10**6)}"
        rows.append(" ".join(text))
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in enumerate(r.split() for r in rows)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    compared, linked = [], jaccard_join._linked

    def counted(pairs, *rest):
        pairs = jaccard_join.stage(pairs, "compared")
        compared.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "_linked", counted)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == roots(sets, links)
    assert sum(compared) <= 4 * len(rows)


def test_jaccard_join_of_pairs_of_unlike_size(spark):
    """A text and a part of it around the bound: first shingles of the longer one may lie beyond those of the part."""
    draw = random.Random(9)
    rows = []
    for k in range(80):
        words = [f"u{k}x{j}" for j in range(draw.randrange(40, 160))]
        few = max(5, round((len(words) - 4) * draw.choice([0.78, 0.8, 0.81, 0.82, 0.85])) + 4)
        rows += [" ".join(words), " ".join(words[:few])]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in enumerate(r.split() for r in rows)}
    links = [(a, a + 1) for a in range(0, len(rows), 2) if 100 * len(sets[a] & sets[a + 1]) >= 80 * len(sets[a] | sets[a + 1])]
    assert 20 < len(links) < 80
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == roots(sets, links)


def test_jaccard_join_counts_no_single_shingles():
    """Shingles that occur once fill no counter, however many there are; those of a common passage do."""
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [" ".join(f"t{i}x{j}" for j in range(400)) + " " + passage for i in range(50)] + ["a b c d e f g"] * 9
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    out = pa.Table.from_batches(list(jaccard_join._profiles(5)(iter([batch]))))
    counts = np.concatenate([np.frombuffer(raw, np.int32) for raw in out["counts"].drop_null().to_pylist()])
    assert sorted(counts[counts > 0]) == [49] * 8


def test_jaccard_join_of_no_rows(docs):
    assert jaccard_join.jaccard_components(docs.limit(0)).collect() == []


def test_suffix_dedup_is_exact(docs):
    seen, want = set(), {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        data = (r.text or "").encode()
        grams = [data[i : i + 50] for i in range(len(data) - 49)]
        gone = set()
        for i, gram in enumerate(grams):
            if gram in seen:
                gone.update(range(i, i + 50))
        seen.update(grams)
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        spans = sum(1 for i in gone if i - 1 not in gone)
        want[r.doc_id] = (len(data), len(gone), spans, hashlib.sha256(kept).hexdigest())
    found = suffix_dedup.remove_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want


@pytest.mark.parametrize(("strings", "block"), [(1 << 20, 1 << 14), (50, 3)])
def test_suffix_groups_in_passes(monkeypatch, strings, block):
    """Many rows of one k-mer, most of them with the same bytes, against all strings of all rows."""
    monkeypatch.setattr(suffix_dedup, "STRINGS", strings)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    draw = random.Random(strings)
    kinds = [bytes(draw.choice(b"ab") for _ in range(draw.randrange(4, 14))) for _ in range(12)]
    rows = [(draw.randrange(3), draw.randrange(40), draw.randrange(1000), draw.choice(kinds[: draw.randrange(1, 13)])) for _ in range(400)]
    s, doc, start = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    got = set()
    for d, a, b in zip(*suffix_dedup._repeats(s, doc, start, [r[3] for r in rows], 6), strict=True):
        got.update((int(d), x) for x in range(a, b))
    least = {}
    for k, d, _, raw in rows:
        for i in range(len(raw) - 5):
            key = k, raw[i : i + 6]
            least[key] = min(least.get(key, d), d)
    want = {(d, a + i + j) for k, d, a, raw in rows for i in range(len(raw) - 5) if d > least[k, raw[i : i + 6]] for j in range(6)}
    assert got == want


def test_a_passage_in_thousands_of_documents(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{i * 7919} start {passage} end {i * 104729}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(df).collect()}
    assert found[0].n_removed == 0
    for i, text in rows[1:]:
        assert found[i].n_spans == 1 and len(passage) <= found[i].n_removed <= len(text), i


def test_shards_are_near_equal_and_gapless(docs):
    rows = sharding.shard_by_bytes(docs, shards=4).collect()
    want = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {i: (len(b) + 1, zlib.crc32(b)) for i, b in want.items()}
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    for shard in range(4):
        assert abs(sum(r["size"] for r in rows if r.shard == shard) - total / 4) <= largest


def test_url_rules_take_the_longest(spark):
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, action string")
    urls = ["http://EXAMPLE.com/en/a", "http://www.example.com/en/a?x", "http://a.net/es/b", None, "no host"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    found = {r.page_id: (r.host, r.rule, r.verdict) for r in url_rules.judge_pages(pages, rules).collect()}
    assert found[0] == ("example.com", "example.com/en/", "block")
    assert found[1] == ("www.example.com", "www.example.com/en/", "allow")
    assert found[2] == ("a.net", "net/es/", "block")
    assert found[3][:2] == found[4][:2] == ("", None)


def test_surrogates_are_consistent_and_distinct(spark):
    rows = [(1, "Write to ann@site.org or bob@site.org."), (2, "ann@site.org again"), (3, None), (4, "")]
    found = {r.doc_id: r.text for r in pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    mails = re.findall(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", found[1])
    assert "ann@site.org" not in found[1] and len(set(mails)) == 2
    assert found[2].startswith(mails[0].rstrip("."))
    assert found[3] is None and found[4] == ""


def test_relative_links_are_resolved_as_urljoin_does(spark):
    from urllib.parse import urljoin

    bases = ["http://a.org/x/y.html", "http://a.org", "http://a.org/d/e/?q=1", "https://B.org/d/e?q=1#f"]
    links = ["p2.html", "?x=1", "../a", "/z/./b/../c", "./", "../../../up/", "//c.org/k", "https://d.org/l?m", "g/h/..", "sub/?n=../o"]
    rows = [(b, x) for b in bases for x in links]
    df = spark.createDataFrame(rows, "base string, link string")
    got = df.select("base", "link", url_rules.node_of(url_rules.absolute(df.link, df.base)).alias("node")).collect()
    for r in got:
        want = urljoin(r.base, r.link).partition("://")[2].replace("B.org", "b.org")
        assert r.node == (want if "/" in want else want.replace("?", "/?") if "?" in want else want + "/"), (r.base, r.link)
    apart = spark.createDataFrame([("http://a.org/x", x) for x in ["#top", "mailto:ann@site.org", "javascript:void(0)"]], "base string, link string")
    assert all(r[0] is None for r in apart.select(url_rules.absolute(apart.link, apart.base)).collect())


def test_aliases_pass_on_a_block(spark):
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, action string")
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "http://a.net/es/b", None, 7), (2, "http://a.net/de/c", link.format("../es/b"), 7),
        (3, "http://q.org/", '<meta http-equiv="refresh" content="0; url=http://a.net/de/c">', 7),
        (4, "http://r.org/", "<!-- " + link.format("http://a.net/es/b") + " -->", 7),
        (5, "http://s.org/", link.format("http://t.org/") + link.format("http://a.net/fr/d"), 7),
        (6, "http://s.org/", None, 7), (None, None, None, None), (7, "http://u.org/" + "v" * 50_000, "w" * 50_000, 7),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host int")
    found = {r.page_id: r.verdict for r in url_rules.judge_pages(df, rules).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "block", None: "allow", 7: "allow"}
    assert url_rules.judge_pages(df.limit(0), rules).collect() == []
