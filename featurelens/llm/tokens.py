"""Vectorised word hashing over Arrow text columns (used inside tasks).

Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``. A word's hash is a
polynomial over a fixed random table of bytes, computed for all words of a
batch by prefix sums, so no Python code runs per word. All functions take
whole texts and cut the byte buffer only at white space, so memory follows
the chunk, not the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_U = np.uint64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 (a bijection on 64-bit words)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(salt))


_TABLE = seeds(256, 7)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n``."""
    size = max(CHUNK_BYTES + 1, n)
    for k, v in _powers.items():
        if k >= size:
            return v
    up, down = np.empty(size, _U), np.empty(size, _U)
    for out, base in ((up, _MULT), (down, _INV)):
        out[0] = 1
        filled = 1
        while filled < size:
            m = min(filled, size - filled)
            out[filled:filled + m] = out[:m] * _U(pow(base, filled, 1 << 64))
            filled += m
    _powers.clear()
    _powers[size] = (up, down)
    return up, down


def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):  # no chunk at all
            col = pa.array([], pa.string())
    col = col.cast(pa.large_string()).fill_null("")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def word_bounds(data: np.ndarray, offs: np.ndarray,
                solid: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each text's first word (n + 1).
    ``solid`` marks the bytes of words, if not all but white space."""
    if not len(data):
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    if solid is None:
        solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of every word; A-Z count as a-z with ``lower``."""
    out = np.empty(len(starts), _U)
    table = _LOWER if lower else _TABLE
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + CHUNK_BYTES, "right")))
        hi = int(ends[to - 1])
        up, down = _power(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(table[data[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(_U))
        at = to
    return out


def hashed_words(col, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, each text's first word (n + 1)) of a text column."""
    data, offs = text_buffer(col)
    starts, ends, ptr = word_bounds(data, offs)
    return word_hashes(data, starts, ends, lower), ptr


def shingles(words: np.ndarray, ptr: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, in text order, and the texts' first
    shingle (m + 1). A text of fewer words has one shingle of them all; a
    text without words has none."""
    count = np.diff(ptr)
    m = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_ptr = np.concatenate([[0], np.cumsum(m)])
    at = np.arange(out_ptr[-1]) - np.repeat(out_ptr[:-1] - ptr[:-1], m)
    end = np.repeat(ptr[1:], m)
    coef = seeds(n, 11) | _U(1)
    padded = np.concatenate([words, np.zeros(n, _U)])
    out = np.zeros(len(at), _U)
    for k in range(n):
        piece = padded[at + k] * coef[k]
        if (count < n).any():
            piece[at + k >= end] = 0
        out += piece
    return mix(out + np.minimum(end - at, n).astype(_U)), out_ptr


def byte_slices(offs: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, one row at least."""
    out, at = [], 0
    while at < len(offs) - 1:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        out.append((at, to))
        at = to
    return out


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """The batch in row ranges whose texts hold at most ``limit`` bytes each
    (a longer text comes alone)."""
    _, offs = text_buffer(batch.column(batch.schema.get_field_index(column)))
    for a, b in byte_slices(offs, limit):
        yield batch.slice(a, b - a)
