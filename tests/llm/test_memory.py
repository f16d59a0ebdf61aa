"""What a task holds at once: slices of a batch, not its batches."""

import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from thermolane.llm import bpe_stream, jaccard_join, storage, textbytes
from thermolane.llm.registry import default_tokenizer


def test_jaccard_join_holds_little_of_a_batch():
    draw = random.Random(8)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(450)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    levels = SimpleNamespace(value=np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8).tobytes())
    every = SimpleNamespace(value=b"\xff" * (jaccard_join.FILTER_BITS // 8))
    runs = [
        (jaccard_join._profiles(5), batch, 80e6),
        (jaccard_join._prefixes(5, levels, 80), batch.select(["text"]), 30e6),
        (jaccard_join._segments(5, levels, every), batch.select(["text"]), 30e6),
    ]
    for run, given, most in runs:
        tracemalloc.start()
        rows = sum(out.num_rows for out in run(iter([given])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows >= len(texts) and peak < most


def test_jaccard_join_remembers_sets_that_share_a_place():
    seen, far = jaccard_join._Seen(), jaccard_join.SEEN
    assert seen.first(np.array([0, 5, 5, -1, far - 1])).tolist() == [True, True, False, True, True]
    assert seen.first(np.array([0, 5 + far, 7])).tolist() == [False, True, True]
    assert seen.first(np.array([5 + far, 5])).tolist() == [False, True]


def test_slices_of_a_batch_hold_every_text():
    texts = [None, "", "a" * 10, "é" * 5, "b" * 40, None, "c", "d" * 9]
    held = pa.array(["before", *texts, "after"]).slice(1, len(texts))
    for most in (1, 10, 20, 1000):
        found = list(textbytes.text_pieces(held, most))
        assert [t for _, _, part in found for t in part] == texts
        assert [i for i, _, _ in found] == [0, *(j for _, j, _ in found)][: len(found)]
        assert all(j - i == 1 or sum(len((t or "").encode()) for t in part) <= most for i, j, part in found)
    assert list(textbytes.text_pieces(pa.array([], pa.string()))) == []


def test_small_batches_of_large_texts(spark, tmp_path):
    before = spark.conf.get(storage.BATCH_SETTING)
    docs = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 500_000).alias("text"))
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    with storage.small_batches(spark):
        found = [r.n for r in storage.stage(sizes, "sizes").collect()]
    assert sum(found) == 60 and max(found) <= 10
    assert spark.conf.get(storage.BATCH_SETTING) == before


def test_digests_need_one_python_worker_a_task(spark, capsys):
    tokenizer = bpe_stream.load(spark, default_tokenizer())
    docs = spark.createDataFrame([(1, "The Green river"), (2, None), (None, ""), (4, "odd Été <|endoftext|>")], "doc_id long, text string")
    found = bpe_stream.digests(docs, tokenizer)
    found.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    apart = bpe_stream.decode(bpe_stream.encode(docs, tokenizer), tokenizer).collect()
    told = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()}
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and len(told) == 4
    for r in apart:
        ids = ",".join(map(str, r.ids)).replace(",", " ")
        assert told[r.doc_id] == (len(r.ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (ids, r.decoded)))
