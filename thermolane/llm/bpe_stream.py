"""Byte-pair encoding as a streaming transducer with bounded lookahead, and incremental decoding.

The merge list fixes how far to the right a merge can depend on text (:attr:`Merges.lookahead`). A
word is read through a window of that length and a token more; tokens that end before the lookahead
are final and leave the window, so memory does not grow with the word. Decoding feeds ids one by one.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the white space that the tokenizer file's ``\s`` means.
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
#: What ``str.split`` takes for white space, and the tokenizer does not.
_NOT_SPACE = regex.compile(r"[\x1c-\x1f]")
#: Chunks up to this length are remembered, up to so many of them at a time.
MEMO_CHARS, MEMO_SIZE = 64, 200_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = (b for b in range(256) if b not in plain)
    shifted = {b: chr(256 + k) for k, b in enumerate(rest)}
    return [chr(b) if b in plain else shifted[b] for b in range(256)]


class Merges:
    """A merge list over ids: ``rules`` maps a pair of ids to (rank, id of the merged token)."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]]):
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        self.length: dict[int, int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.rules.setdefault((x, y), (rank, z))
            made.setdefault(z, (rank, x, y))
        pending = list(made)
        while pending:  # lengths in symbols
            z = pending[-1]
            parts = made[z][1:]
            todo = [p for p in parts if p in made and p not in self.length]
            if todo:
                pending.extend(todo)
                continue
            self.length[z] = sum(self.length.get(p, 1) for p in parts)
            pending.pop()
        self.longest = max(self.length.values(), default=1)
        self.lookahead = self._lookahead(made)
        self.window = self.lookahead + self.longest + 64

    def _lookahead(self, made: dict) -> int:
        """Symbols after a token that can still undo it.

        Token b is undone by rule (b, c), if c stands to its right when that rule's turn comes. Whether
        it does depends on what can undo c before, and on what c's own formation depends on. Rules of
        lower rank come first, so one pass in rank order finds the longest such chain.
        """
        theft: dict[int, int] = {}  # by left token: over its rules of lower rank than the current one
        formed: dict[int, int] = {}
        for (b, c), (rank, z) in sorted(self.rules.items(), key=lambda r: r[1][0]):
            need = self.length.get(c, 1) + max(formed.get(c, 0), theft.get(c, 0))
            if made[z][0] == rank:
                formed[z] = max(theft.get(c, 0), formed.get(c, 0))
            theft[b] = max(theft.get(b, 0), need)
        return max([*theft.values(), *formed.values(), 0])

    def merge(self, symbols: list[int]) -> list[int]:
        """All tokens of a short word: merge the pair of least rank, leftmost first, to the end."""
        symbols, get = list(symbols), self.rules.get
        while len(symbols) > 1:
            best = None
            for i in range(len(symbols) - 1):
                rule = get((symbols[i], symbols[i + 1]))
                if rule and (best is None or rule[0] < best[0]):
                    best = (rule[0], i, rule[1])
            if best is None:
                break
            symbols[best[1] : best[1] + 2] = [best[2]]
        return symbols

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of a word of any length, each as soon as it is final."""
        held: list[int] = []
        for s in symbols:
            held.append(s)
            if len(held) == self.window:
                done = 0
                for token in self.merge(held):
                    end = done + self.length.get(token, 1)
                    if end > len(held) - self.lookahead:
                        break
                    yield token
                    done = end
                del held[:done]
        yield from self.merge(held)


class Tokenizer:
    """Encoding and decoding by a tokenizer file whose model is BPE over byte letters with word ends."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.merges = Merges(self.vocab, pairs)
        self.suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.final = [self.vocab[c + self.suffix] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.byte = {c: b for b, c in enumerate(letters)}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.space = regex.compile(SPACE)
        self.specials = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.memo: dict[str, array] = {}

    def _chunk(self, chunk: str) -> array:
        out = array("i")
        for word in self.words.findall(chunk):
            raw = word.encode("utf-8", "surrogatepass")
            symbols = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
            out.extend(self.merges.stream(symbols) if len(symbols) > self.merges.window else self.merges.merge(symbols))
        return out

    def _plain(self, text: str, out: array) -> None:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        memo = self.memo
        for chunk in self.space.split(text) if _NOT_SPACE.search(text) else text.split():
            ids = memo.get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(chunk) <= MEMO_CHARS:
                    if len(memo) >= MEMO_SIZE:
                        memo.clear()
                    memo[chunk] = ids
            out.extend(ids)

    def encode(self, text: str | None) -> array:
        out, at = array("i"), 0
        text = text or ""
        for m in self.specials.finditer(text):
            self._plain(text[at : m.start()], out)
            out.append(self.special[m.group()])
            at = m.end()
        self._plain(text[at:] if at else text, out)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """As the file's library does without a decoder: the tokens' own strings, a space between."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])

    def text(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text, piece by piece: bytes that do not yet make a character wait for the next token."""
        state, special = codecs.getincrementaldecoder("utf-8")("replace"), set(self.special.values())
        for i in ids:
            token = self.tokens[i]
            if i in special:
                yield state.decode(b"", True) + token
                state.reset()
                continue
            ends = bool(self.suffix) and token.endswith(self.suffix)
            raw = bytes(self.byte[c] for c in (token[: -len(self.suffix)] if ends else token))
            piece = state.decode(raw, ends)
            yield piece + " " * ends
        yield state.decode(b"", True)


_loaded: dict[int, Tokenizer] = {}


def _tokenizer(shared) -> Tokenizer:
    """One per worker process."""
    if shared.id not in _loaded:
        _loaded.clear()
        _loaded[shared.id] = Tokenizer(shared.value)
    return _loaded[shared.id]


class _Handle:
    """A tokenizer file's content, sent to the workers once; its size is that of the vocabulary."""

    def __init__(self, spark, path: str):
        with open(path, "rb") as f:
            self.sent = spark.sparkContext.broadcast(f.read())
        self.id = self.sent._jbroadcast.id() if hasattr(self.sent, "_jbroadcast") else hash(path)

    def __getstate__(self):
        return {"sent": self.sent, "id": self.id}

    @property
    def value(self) -> bytes:
        return self.sent.value


def load(spark, path: str) -> _Handle:
    return _Handle(spark, path)


def _encoding(tokenizer: _Handle, text_col: str, ids_col: str):
    """Batches with the ids of their texts as a last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out, ends = array("i"), [0]
                for text in part.column(text_col):
                    out.extend(tok.encode(text.as_py()))
                    ends.append(len(out))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(out, np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, ids_col])

    return run


def _decoding(tokenizer: _Handle, ids_col: str, out_col: str, readable: bool = False):
    """Batches with the decoded ids as a last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = []
                for v in part.column(ids_col):
                    ids = v.values.to_numpy(zero_copy_only=False).tolist() if v.is_valid else []
                    texts.append("".join(tok.text(ids)) if readable else tok.decode(ids))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out_col])

    return run


IDS_TYPE = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, tokenizer: _Handle, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns and ``ids_col``, array<int>; special tokens in a text are recognised, none is added.

    A null text counts as empty and gives no ids. A column named ``ids_col`` is replaced.
    """
    keep = [c for c in df.columns if c != ids_col]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(ids_col, IDS_TYPE)])
    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(_encoding(tokenizer, text_col, ids_col), schema)


def decode(df: DataFrame, tokenizer: _Handle, ids_col: str = "ids", out_col: str = "decoded", readable: bool = False) -> DataFrame:
    """All columns and ``out_col``: the library's decoding, or with ``readable`` the text of the bytes.

    Null ids give an empty string. A column named ``out_col`` is replaced.
    """
    keep = [c for c in df.columns if c != out_col]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out_col, T.StringType())])
    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(_decoding(tokenizer, ids_col, out_col, readable), schema)


def recode(df: DataFrame, tokenizer: _Handle, text_col: str = "text", ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass, without the text: a task has one Python worker, not two.

    Columns named ``ids_col`` or ``out_col`` are replaced.
    """
    keep = [c for c in df.columns if c not in (ids_col, out_col)]
    rest = [c for c in keep if c != text_col]
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(ids_col, IDS_TYPE), T.StructField(out_col, T.StringType())])
    encoded, decoded = _encoding(tokenizer, text_col, ids_col), _decoding(tokenizer, ids_col, out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoded(batch.select([*rest, ids_col]) for batch in encoded(batches))

    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def digests(df: DataFrame, tokenizer: _Handle, text_col: str = "text") -> DataFrame:
    """Encode, decode, and replace text, ids and decoded text by counts and digests."""
    done = recode(df, tokenizer, text_col)
    return done.select(
        *[F.col(f"`{c}`") for c in df.columns if c != text_col],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
