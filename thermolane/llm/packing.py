"""Packing by power-of-two decomposition.

A document's tokens are cut at the binary digits of their count: as many pieces of the longest length
as fit, then one piece for each binary digit of the rest, longest first. Every piece is a sequence of
its own, so that no sequence crosses documents and none is padded; pieces of equal length share a
bucket, from which batches of one shape are drawn.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_stream import SPACE, _Handle
from .textbytes import in_pieces

#: Beyond so many characters or chunks remembered, all are forgotten before the next texts.
MEMO_CHARS, MEMO_SIZE = 16_000_000, 400_000
#: Words encoded in one call.
TOGETHER = 2000
#: Marks that the tokenizer parts from letters before them.
MARKS = ".,;:!?"
#: Bits of a sequence number: the length's exponent, the task, the count within task and length.
TASK_BITS, COUNT_BITS = 25, 33
#: Pieces in one Arrow batch.
BATCH_PIECES = 4096

SCHEMA = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Numbers(dict):
    """Numbers strings in the order in which they are first asked for; ``new`` lists those of late."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n

    def of(self, keys, count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, count)

    def taken(self) -> list[str]:
        new, self.new = self.new, []
        return new


class Chunks:
    """Ids of white-space separated chunks by the tokenizers library, each distinct word encoded once.

    The tokenizer file drops white space, so that a text's ids are those of its chunks in turn. It also
    parts letters from punctuation: a chunk of letters and one mark is encoded as two words, other chunks
    as one. ``pool`` holds the ids of all words, one after the other; word 0 has none.
    """

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.model = Tokenizer.from_str(content.decode())
        self.model.no_padding()
        self.model.no_truncation()
        #: For words that the tokenizer's normaliser leaves alone: the same merges without it.
        self.quick = Tokenizer(self.model.model)
        self.quick.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content.lower() for t in self.model.get_added_tokens_decoder().values()]
        suffix = self.model.model.end_of_word_suffix
        self.ends_word = np.zeros(self.model.get_vocab_size(), bool)
        if suffix:
            self.ends_word[[i for t, i in self.model.get_vocab().items() if t.endswith(suffix)]] = True
        self.space = regex.compile(SPACE)
        self.narrow = regex.compile(r"[\x1c-\x1f]")  # white space for str.split, not for the tokenizer
        self._forget()

    def _forget(self):
        self.chunks, self.words, self.held = Numbers(), Numbers(), 0
        self.words[""] = 0
        self.head, self.mark = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the words of each chunk
        self.pool, self.first, self.size = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        """Chunks in lower case, where the tokenizer's own lower-casing gives the same; else as they are."""
        low = text.lower() if text.isascii() else text.replace("Σ", "σ").lower()
        plain = text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", low)
        if plain and not any(s in low for s in self.special):
            text = low
        if self.narrow.search(text):
            return [c for c in self.space.split(text) if c]
        return text.split()

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of normal words of letters, and how many each has, by one call for many words."""
        ids, ends = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a in range(0, len(words), TOGETHER):
            some = words[a : a + TOGETHER]
            got = np.array(self.quick.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            edges = np.concatenate([[0], np.flatnonzero(self.ends_word[got]) + 1])
            if len(edges) != len(some) + 1 or edges[-1] != len(got):
                raise ValueError("this tokenizer does not mark the ends of words")
            ids.append(got)
            ends.append(np.diff(edges))
        return np.concatenate(ids), np.concatenate(ends)

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _learn(self, chunks: list[str]) -> None:
        heads, marks = [], []
        for c in chunks:
            apart = c[-1] in MARKS and c[:-1].isalpha()
            heads.append(c[:-1] if apart else c)
            marks.append(c[-1] if apart else "")
        self.head = np.concatenate([self.head, self.words.of(heads, len(heads))])
        self.mark = np.concatenate([self.mark, self.words.of(marks, len(marks))])
        self.held += sum(map(len, chunks))
        new = self.words.taken()
        if not new:
            return
        odd = np.fromiter((not (w.isalpha() and w == w.lower() and is_normalized("NFC", w)) for w in new), bool, len(new))
        order = np.argsort(odd, kind="stable")
        n = len(new) - int(odd.sum())
        parts = self._together([new[i] for i in order[:n]]), self._apart([new[i] for i in order[n:]])
        ids, size = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        sizes, firsts = np.empty_like(size), np.empty_like(size)
        sizes[order], firsts[order] = size, len(self.pool) + np.cumsum(size) - size
        self.first, self.size = np.concatenate([self.first, firsts]), np.concatenate([self.size, sizes])
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if len(self.chunks) > MEMO_SIZE or self.held > MEMO_CHARS:
            self._forget()
        parts = [self.split(t) for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        code = self.chunks.of(chain.from_iterable(parts), int(counts.sum()))
        if new := self.chunks.taken():
            self._learn(new)
        word = np.stack([self.head[code], self.mark[code]], axis=1).ravel()
        size = self.size[word]
        end = np.cumsum(size)
        at = np.repeat(self.first[word] - (end - size), size) + np.arange(int(size.sum()))
        before, last = np.concatenate([[0], end]), 2 * np.cumsum(counts)
        return self.pool[at], before[last] - before[last - 2 * counts]


_chunks: dict[int, Chunks] = {}


def _loaded(tokenizer: _Handle) -> Chunks:
    """One per worker process, which keeps what it has learnt from task to task."""
    if tokenizer.id not in _chunks:
        _chunks.clear()
        _chunks[tokenizer.id] = Chunks(tokenizer.value)
    return _chunks[tokenizer.id]


def binary_cuts(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents with so many tokens, in order."""
    whole, rest = tokens // longest, tokens % longest
    digits = np.arange(longest.bit_length() - 2, -1, -1)
    doc, digit = np.nonzero((rest[:, None] >> digits) & 1)
    doc = np.concatenate([np.repeat(np.arange(len(tokens)), whole), doc])
    length = np.concatenate([np.full(int(whole.sum()), longest), 1 << digits[digit]])
    order = np.argsort(doc, kind="stable")  # whole pieces come first, then digits from the highest
    doc, length = doc[order], length[order]
    end = np.cumsum(length)
    first = np.searchsorted(doc, np.arange(len(tokens)))
    start = end - length
    return doc, start - start[first[doc]], length


def pack(
    df: DataFrame, tokenizer: _Handle, longest: int = 4096, end_id: int | None = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), one row per piece.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers. A document's ids are those of
    the tokenizers library without added special tokens, then ``end_id`` (None: no such id). ``length``
    is a power of two up to ``longest``, itself a power of two. Each piece is a sequence: ``offset`` is 0
    and nothing is padded. ``sequence_id`` holds the exponent of the length in its highest bits, so that
    a bucket of equal lengths is one range of numbers, then the task and the count there: one pass and no
    shuffle. The numbers are those of one evaluation: write the result (:func:`write_buckets`) before
    reading it twice.

    Null and empty texts have ``end_id`` alone, in one piece of length 1 (with None: no piece). Rows with
    repeated or null ids are packed one by one. Texts of any length are cut whole; an empty table gives
    no rows; other columns are ignored, whatever their names.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    kind = df.schema[id_col].dataType.simpleString()
    cols = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _loaded(tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(longest.bit_length(), np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in in_pieces(texts):
                ids, counts = chunks.encode(texts[lo:hi])
                ids = np.insert(ids, np.repeat(np.cumsum(counts), len(tail)), np.tile(tail, hi - lo))
                tokens = counts + len(tail)
                doc, start, length = binary_cuts(tokens, longest)
                power = np.log2(length).astype(np.int64)
                count = np.zeros(len(doc), np.int64)
                for k in np.unique(power):
                    of = np.flatnonzero(power == k)
                    count[of] = seen[k] + np.arange(len(of))
                    seen[k] += len(of)
                number = (power << (TASK_BITS + COUNT_BITS)) | (task << COUNT_BITS) | count
                ends = np.concatenate([[0], np.cumsum(length)])
                for a in range(0, len(doc), BATCH_PIECES):
                    of = slice(a, a + BATCH_PIECES)
                    edges = ends[a : a + BATCH_PIECES + 1]
                    raw = ids[edges[0] : edges[-1]].astype("<u4").tobytes()
                    offsets = ((edges - edges[0]) * 4).astype(np.int32)
                    n = len(offsets) - 1
                    pieces = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(doc[of] + lo)), pa.array(start[of]), pa.array(length[of]),
                         pieces, pa.array(tokens[doc[of]]), pa.array(number[of]), pa.array(np.zeros(n, np.int64))],
                        ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                    )

    return cols.mapInArrow(run, SCHEMA.format(id=kind))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store sequences by length: one folder per power of two, whose rows all have one shape."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").option("compression", "zstd").parquet(path)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
