"""Every stage of the pipeline on awkward rows and on none; planted leaks; accuracy against labels."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from thermolane.llm import decontaminate, weak_quality

SF_DIR = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, node string, item string, m1 string"


def plain(draw, n):
    return " ".join(draw.choice("the of river stone walks under green light and to a in quiet house".split()) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    same = plain(draw, 40)
    texts = [None, "", " \t\n", "one", same, same, plain(draw, 30), plain(draw, 20_000), "x" * 30_000, "mail ann@site.org or +49 30 1234567 today"]
    out = [(i, t, None if i % 3 else "en", None if i % 2 else "web", None if t is None else len(t), "clash", "clash", "clash") for i, t in enumerate(texts)]
    return [*out, out[4], (None, same, "en", "web", 3, "clash", "clash", "clash"), (None, None, None, None, None, None, None, None)]


@needs_data
@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_a_stage_takes_awkward_rows(spark, rows, name, stage):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = stage(spark, docs, SF_DIR)
    found = out.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in found)
    given = sorted(-1 if r[0] is None else r[0] for r in rows)
    if name == "ngram_jaccard_join":
        assert ids == [i for i in given if i != 5]
    elif name != "quality_classifier":
        assert ids == given
    if name == "pii":
        text = {r.doc_id: r.text for r in found}
        assert "ann@site.org" not in text[9] and "1234567" not in text[9]
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found)
        assert all(text[i] == t for i, t, *_ in rows if i is not None and i < 9)


@needs_data
@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_a_stage_takes_no_rows(spark, name, stage):
    assert stage(spark, spark.createDataFrame([], SCHEMA), SF_DIR).collect() == []


def test_leaks_are_found_with_other_numbers(spark):
    draw = random.Random(9)
    item = "a baker sells 12 loaves in the morning and 30 loaves in the evening so how many loaves are sold when 12 more are baked"
    other = item.replace("12", "47").replace("30", "81")
    unlike = item.replace("12", "47", 1)  # one slot with two values
    texts = [None, "", item, f"{plain(draw, 200)} {other} {plain(draw, 50)}", unlike, plain(draw, 300), item]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(5, item), (3, item), (1, None), (2, "")], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.mark_contaminated(docs, items).collect()}
    assert {i for i, r in found.items() if r.contaminated} >= {2, 3, 6}
    assert not any(found[i].contaminated for i in (0, 1, 5))
    assert all(found[i].first_item == 3 and found[i].covered == 1.0 for i in (2, 3, 6))
    assert found[4].covered is None or found[4].covered < 1.0
    none = decontaminate.mark_contaminated(docs, items.limit(0)).collect()
    assert len(none) == len(texts) and not any(r.contaminated for r in none)


@needs_data
def test_quality_agrees_with_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality is not null")
    scored = weak_quality.score_documents(docs).join(labels, "doc_id").select("quality", F.coalesce("score", F.lit(0.0)).alias("score"))
    good, bad = ([r.score for r in scored.collect() if r.quality == k] for k in (1, 0))
    pairs = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert pairs / (len(good) * len(bad)) > 0.95


def test_an_id_with_two_texts_loses_neither(spark):
    draw = random.Random(3)
    same, other = plain(draw, 60), " ".join(f"w{i}" for i in range(60))
    rows = [(1, same, "en"), (2, same, "en"), (2, other, "en"), (3, other + " more", "en"), (3, "quite apart", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = corpus_pipeline.keep_one_of_each(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted([rows[0], rows[2], rows[4]])


def judged(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r for r in decontaminate.mark_contaminated(docs, held).collect()}


def test_numbers_alone_are_no_template(spark):
    item = "count on: " + " ".join(map(str, range(1, 21)))
    table = " ".join(map(str, range(5000, 7000)))
    found = judged(spark, [table, f"so {item} and on", f"{table} {' '.join(map(str, range(1, 16)))}"], [item])
    assert [found[i].contaminated for i in range(3)] == [False, True, True]
    assert found[1].covered == 1.0


def test_short_items_are_found_whole(spark):
    items = ["What is seven plus five?", "Paris", "  ", None, "name the 3 green rivers of old Wales now please"]
    texts = [
        "He asked: what is seven plus five, and left.", "what is six plus five", "a night in Paris, he said", "a night in Parisian air",
        "what is seven plus", None, "", "name the 4 green rivers of old Spain now please",
    ]
    found = judged(spark, texts, items)
    assert [i for i in found if found[i].contaminated] == [0, 2, 7]
    assert found[0].first_item == 0 and found[2].first_item == 1 and found[7].first_item == 4
