"""Numpy views of Arrow text columns: bytes, words and word hashes of many documents at once.

Used inside Spark tasks.  Work goes in chunks of about ``CHUNK`` bytes of whole documents,
so that memory does not follow the batch; a longer document is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from martlet.llm.common import SPACE_CHARS

CHUNK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACE_CHARS]] = True
_rng = np.random.default_rng(20240817)
# one random odd multiplier and one random number per byte value: a rule, not a stored table
_BASE = np.uint64(int(_rng.integers(1 << 62, 1 << 63)) | 1)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finalizer (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 2 * len(_POWERS)), _BASE)
        grown[0] = 1
        _POWERS = np.multiply.accumulate(grown)
    return _POWERS[:n]


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (len + 1) of a text or binary array; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(col: pa.Array, most: int = CHUNK) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets from 0) of runs of whole documents of about ``most`` bytes."""
    data, offsets = buffers(col)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield slice(i, j), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (byte places) of the words and the first word of each document (len docs + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    first = ~space
    last = ~space
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first[1:] &= space[:-1] | cut[1:-1]
    last[:-1] &= space[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    firsts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    at = np.arange(int(lens.sum()))
    within = at - np.repeat(firsts, lens)
    body = _BYTE[data[within + np.repeat(starts, lens)]]
    body *= _powers(int(lens.max()))[within]
    return mix(np.add.reduceat(body, firsts) + lens.astype(np.uint64))
