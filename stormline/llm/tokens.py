"""Words of whole texts as numpy arrays, a batch of texts at a time.

A word is a run of bytes other than space and \\t..\\r; in UTF-8 these bytes only
ever stand for themselves, so words can be found without decoding.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.RandomState(20240601).randint(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """`hash`, `start` and `end` (byte positions) by word; text i has words first[i]:first[i+1]."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = np.atleast_1d(np.asarray(x, np.uint64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def words(column: pa.Array) -> Words:
    """All words of the texts, A-Z lower-cased, with a 64-bit hash each."""
    raw, off = utf8(column)
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), z, z, np.zeros(len(off), np.int64))
    inside = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, off)
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, first)
    size = end - start
    at = np.cumsum(size) - size
    place = np.arange(at[-1] + size[-1]) - np.repeat(at, size)
    value = _BYTE[_LOWER[raw[inside]]] * powers(int(size.max()))[place]
    return Words(mix(np.add.reduceat(value, at) + size.astype(np.uint64)), start, end, first)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words, and n + 1 offsets by text; a shorter text is one run."""
    count = np.diff(w.first)
    runs = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    off = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(w.first[:-1] - off[:-1], runs) + np.arange(off[-1])
    width = np.repeat(np.minimum(count, k), runs)
    p = powers(k + 1)
    h = np.zeros(off[-1], np.uint64)
    for j in range(k):
        has = j < width
        h[has] += w.hash[first[has] + j] * p[j + 1]
    return mix(h + width.astype(np.uint64)), off


def slices(batch: pa.RecordBatch, text: str = "text", most_bytes: int = 1 << 20):
    """A batch in pieces of about `most_bytes` of text, one whole text at least, so that arrays stay small."""
    column = batch.column(text)
    size = np.asarray(pa.compute.binary_length(column.cast(pa.large_string()).fill_null("")))
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + most_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to
