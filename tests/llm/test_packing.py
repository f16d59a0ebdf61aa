"""Power-of-two packing against the tokenizers library itself."""

import random
import zlib
from functools import cache

import numpy as np
import pytest

from thermolane.llm import bpe_stream, packing
from thermolane.llm.registry import default_tokenizer

TEXTS = [
    None, "", " \n ", "one", "Some words, some WORDS and été.", "a b c\x1cd", "<|endoftext|> in<|startoftext|>side",
    "x" * 5000, "word " * 9000, "the same text", "the same text", "é Å ﬁ ΑΣ ΣΑΣ", "日本語 текст 🙂🙂",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 4 else i // 2, t, "clash", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, sequence_id int")


@cache
def model():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(default_tokenizer())
    out.no_padding()
    out.no_truncation()
    return out


def library(text):
    return [*model().encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("longest", [1, 16, 4096])
def test_pieces_tile_every_document(spark, docs, longest):
    found = packing.pack(docs.coalesce(1), bpe_stream.load(spark, default_tokenizer()), longest=longest).collect()
    assert len({r.sequence_id for r in found}) == len(found)
    assert all(r.length <= longest and r.length & (r.length - 1) == 0 and r.offset == 0 for r in found)
    at = 0
    for i, text in enumerate(TEXTS):  # one partition keeps the order
        want, got = library(text), []
        while len(got) < len(want):
            r = found[at]
            assert r.doc_id == (None if i == 4 else i // 2) and r.start == len(got) and r.doc_tokens == len(want)
            got += np.frombuffer(r.ids, "<u4").tolist()
            assert len(got) - r.start == r.length
            at += 1
        assert got == want
        rest = len(want) % longest
        assert at and sum(1 for r in found[:at] if r.length < longest) == sum(bin(len(library(t)) % longest).count("1") for t in TEXTS[: i + 1]), rest
    assert at == len(found)


def test_equal_lengths_share_a_range_of_numbers(spark, docs):
    found = packing.pack(docs.repartition(3), bpe_stream.load(spark, default_tokenizer())).collect()
    by_number = sorted(found, key=lambda r: r.sequence_id)
    assert [r.length for r in by_number] == sorted(r.length for r in found)


def test_digests_and_buckets(spark, docs, tmp_path):
    pieces = packing.pack(docs, bpe_stream.load(spark, default_tokenizer()))
    want = sorted((r.length, zlib.crc32(r.ids)) for r in pieces.collect())
    assert sorted((r.length, r.ids_crc32) for r in packing.digests(pieces).collect()) == want
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.where("bucket != length or octet_length(ids) != 4 * bucket").count() == 0 and back.count() == len(want)


def test_no_end_id_no_rows_and_wrong_length(spark, docs):
    tokenizer = bpe_stream.load(spark, default_tokenizer())
    assert packing.pack(docs.limit(0), tokenizer).collect() == []
    assert packing.pack(docs.where("text = ''"), tokenizer, end_id=None).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer, longest=1000)


@pytest.fixture(scope="module")
def content():
    with open(default_tokenizer(), "rb") as f:
        return f.read()


def test_memory_of_chunks_is_bounded(monkeypatch, content):
    monkeypatch.setattr(packing, "MEMO_SIZE", 3)
    chunks = packing.Chunks(content)
    texts = ["alpha beta", "gamma delta epsilon " + "z" * 200, "beta " + "z" * 200 + " zeta", "alpha"]
    for _ in range(3):
        for text in texts:
            ids, counts = chunks.encode([text, ""])
            assert ids.tolist() == library(text)[:-1] and counts.tolist() == [len(ids), 0]
            assert len(chunks.chunks) <= 3 + 4
    monkeypatch.setattr(packing, "MEMO_SIZE", 1000)
    monkeypatch.setattr(packing, "MEMO_CHARS", 100)
    for text in texts * 2:
        assert chunks.encode([text])[0].tolist() == library(text)[:-1]
        assert chunks.held <= 100 + 205


def test_chunks_equal_the_library(content):
    draw = random.Random(5)
    letters = "aAbBzZ09.,;:!?'\"-<|>_ \n\t\x1c\x85\xa0\u2003éÉßẞΣσςİıﬁ\u0301\u0331\u0307H\u00c5\u212b\u1e9e日本🙂\ud7a3\u1100\u1161"
    parts = ["don't", "it's,", "<|endoftext|>", "<|ENDOFTEXT|>", "Word.", "word,", "H\u0331.", "ΟΔΟΣ.", "x.y,", "12,", "é,", "ab...", "“quote”,"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(1500)]
    texts += [draw.choice(["", " "]).join(draw.choices(parts, k=draw.randrange(9))) for _ in range(1500)]
    ids, counts = packing.Chunks(content).encode(texts)
    want = [library(t)[:-1] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
