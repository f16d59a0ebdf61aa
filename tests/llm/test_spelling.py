"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from thermolane.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=5):
    out = {}
    for w, n in words.items():
        others = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(others, default=None)
        form = best if best and -best[0] >= ratio * n else None
        out[w] = [n, len(others), form and form[1], form and -form[0], None]
    for w in out:
        at = w
        while out[at][2]:
            at = out[at][2]
        out[w][4] = at
    return {w: tuple(v) for w, v in out.items()}


def found(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_groups_equal_all_pairs(spark, partitions):
    draw = random.Random(partitions)
    base = ["".join(draw.choice("abé") for _ in range(draw.randrange(1, 9))) for _ in range(60)]
    words = {w: draw.choice([1, 2, 3, 10, 11, 60, 400, 400]) for w in base}
    for w in base:  # doubled letters, gains, losses, replacements
        i = draw.randrange(len(w))
        for v in (w[:i] + w[i:i + 1] + w[i:], w[:i] + w[i + 1:], w[:i] + "ÿ" + w[i + 1:], "a" + w, w + "b"):
            words.setdefault(v, draw.choice([1, 5, 30, 2000]))
    words.pop("", None)
    df = spark.createDataFrame([(w, n, "clash", 1) for w, n in words.items()], "word string, n long, form string, root int")
    assert found(spelling.group_variants(df.repartition(partitions))) == brute(words)


def test_chains_lead_to_the_last_form(spark):
    words = {"abcdef": 1, "abcdeg": 5, "abcdhg": 25, "abcihg": 125, "abjihg": 625, "akjihg": 3125}
    got = found(spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words) and got["abcdef"][4] == "akjihg"


def test_a_run_with_many_letters_and_a_doubled_one(spark):
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
    words = {f"aaa{x}bbb": 5 + i % 7 for i, x in enumerate(letters)} | {"aaabbb": 3, "aaaabbbb": 1000}
    got = found(spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)


def test_no_words_and_nulls(spark):
    df = spark.createDataFrame([(None, 3), ("abcdef", None), ("abcdef", 4)], "word string, n long")
    assert found(spelling.group_variants(df)) == {"abcdef": (4, 0, None, None, "abcdef")}
    assert found(spelling.group_variants(df.limit(0))) == {}


@pytest.mark.parametrize("piece", [1 << 22, 7])
def test_word_counts(spark, monkeypatch, piece):
    texts = [None, "", "Straße ÀÉÎÕÜ naïve÷naïve Ωmega×x Ÿpre abcªdef \U0001f642x", "Hello hello HELLO, hel1lo", "run" * 3000 + " tail"]
    docs = [(i if i != 3 else None, t) for i, t in enumerate([*texts, texts[3], texts[2], texts[2]])]
    want = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, word int").coalesce(1)
    if piece == 7:
        assert [w.decode("latin-1") for t in texts for w in _in_slices(monkeypatch, t or "")] == [
            re.sub("[A-Z]", lambda m: m[0].lower(), w) for t in texts for w in re.findall("[A-Za-zÀ-ÿ]+", t or "")
        ]
        return
    got = spelling.count_words(df, min_length=3, min_count=2, typo_every=3).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if len(w) >= 3 and n >= 2}


def _in_slices(monkeypatch, text):
    monkeypatch.setattr(spelling, "SLICE", 7)
    return list(spelling._runs(text))
