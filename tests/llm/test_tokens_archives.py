"""Tokens against the tokenizers library, archives against plain digests, on small and awkward rows."""

import hashlib
import random
from functools import cache

import pytest

from thermolane.llm import bpe_stream, warc
from thermolane.llm.registry import default_tokenizer

TEXTS = [
    None, "", " \n\t ", "one", "One, TWO and été.", "<|endoftext|> in<|startoftext|>side", "same", "same",
    "x" * 9000, "word " * 9000, "é Å ﬁ ΑΣ ΣΑΣ", "日本語 текст 🙂🙂‍", "a\x00b\x1cc\r\n", "12345 " * 50,
]


@cache
def model():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(default_tokenizer())
    out.no_padding()
    out.no_truncation()
    return out


def drawn(count):
    draw = random.Random(11)
    letters = "abcdeEXY .,'-\né́一\U0001f642م"
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 400))) for _ in range(count)]


def test_ids_and_decoded_text_equal_the_library(spark):
    rows = [(None if i == 3 else i // 2, t, "clash", i) for i, t in enumerate(TEXTS + drawn(150))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, row int")
    found = bpe_stream.digests(docs.select("doc_id", "row", "text"), bpe_stream.load(spark, default_tokenizer())).collect()
    assert len(found) == len(rows)
    for r in found:
        ids = model().encode(rows[r.row][1] or "", add_special_tokens=False).ids
        text = model().decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids), rows[r.row][1]
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_tokens_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_stream.digests(docs, bpe_stream.load(spark, default_tokenizer())).collect() == []


def test_columns_of_the_same_name_are_replaced(spark):
    docs = spark.createDataFrame([(1, "some text", "clash", "clash")], "doc_id long, text string, ids string, decoded string")
    tokenizer = bpe_stream.load(spark, default_tokenizer())
    row = bpe_stream.decode(bpe_stream.encode(docs, tokenizer), tokenizer).first()
    ids = model().encode("some text", add_special_tokens=False).ids
    assert (list(row.ids), row.decoded) == (ids, model().decode(ids, skip_special_tokens=False))


def payloads():
    draw = random.Random(3)
    noise = "".join(chr(draw.randrange(32, 0x2FF)) for _ in range(200_000))
    return [None, "", "short", "short", "y" * 99, "y" * 99, "z" * 100, "z" * 100, "z" * 100, "é" * 50, "é" * 50,
            "WARC/1.0\r\nContent-Length: 5\r\n\r\n" * 20, "\r\n\r\n" * 60, noise, noise]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(90 - i, f"http://a.b/{i} c\n" if i % 3 else None, h, "clash") for i, h in enumerate(payloads())]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def test_archives_give_back_every_payload(pages):
    want, first = {}, {}
    data = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for i in sorted(data):
        if len(data[i]) >= 100:
            first.setdefault(data[i], i)
    for i, raw in data.items():
        of = first.get(raw, i)
        kind = ("response", None) if of == i else ("revisit", of)
        want[i] = (len(raw), hashlib.sha256(raw).hexdigest(), *kind)
    found = warc.archive_and_read(pages).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == want
    assert len(found) == len(data)


def test_archives_of_no_pages(pages):
    assert warc.archive_and_read(pages.limit(0)).collect() == []
