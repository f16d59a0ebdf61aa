"""Vectorised work on the bytes of a batch of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_MIX = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined(texts: list[str | None], separator: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All bytes, a separator after each text, and the offset of each text (and of the end)."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    data = np.frombuffer(separator.join([*parts, b""]), np.uint8)
    return data, np.concatenate([[0], np.cumsum(sizes)])


_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD**i and its inverse modulo 2**64, for i below at least n."""
    known = _POWERS.get("p")
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 19)
        inverse = pow(ODD, -1, 1 << 64)
        up, down = np.full(size, ODD, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        _POWERS["p"] = known = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return known[0][:n], known[1][:n]


def shingles(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit fingerprint) of every shingle of ``width`` words, sorted, without repeats in a row.

    Words are the runs of bytes other than 0x20 and 0x09 to 0x0D, A-Z lower-cased. A text with fewer
    words gives its whole sequence; one without words gives none.
    """
    data, ends = joined(texts)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    blank = _SPACE[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edge = np.concatenate([[0], edge])
    if not len(edge):
        return none
    first, after = edge[0::2], edge[1::2]  # the last byte is a separator, so every word ends
    up, down = _powers(len(data))
    total = np.cumsum(_MIX[_LOWER[data]] * up)  # wraps modulo 2**64
    before = np.where(first > 0, total[first - 1], np.uint64(0))
    word = mixed((total[after - 1] - before) * down[first] + (after - first).astype(np.uint64))
    row = np.searchsorted(ends, first, "right") - 1
    n = np.bincount(row, minlength=len(texts))
    start = np.concatenate([[0], np.cumsum(n)])
    many = len(word)
    rows, prints = [], []
    if many >= width:
        h = np.zeros(many - width + 1, np.uint64)
        for k in range(width):
            h = mixed(h * np.uint64(ODD) + word[k : many - width + 1 + k])
        whole = row[: len(h)] == row[width - 1 :]
        rows.append(row[: len(h)][whole])
        prints.append(h[whole])
    for few in range(1, width):
        r = np.flatnonzero(n == few)
        h = np.full(len(r), few, np.uint64)
        for k in range(few):
            h = mixed(h * np.uint64(ODD) + word[start[r] + k])
        rows.append(r)
        prints.append(h)
    r, h = np.concatenate(rows), np.concatenate(prints)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[new], h[new]


def text_pieces(texts: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int, list[str | None]]]:
    """(start, end, texts) of slices of the batch of about ``most`` bytes, one text at least.

    Only a slice at a time is made into strings. What ``shingles`` holds is some 60 times a slice.
    """
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))])
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
        yield start, end, texts.slice(start, end - start).to_pylist()
        start = end


def in_pieces(texts: list, most: int = 2 << 20):
    """Slices of the batch of about ``most`` characters, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
