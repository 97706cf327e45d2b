"""Word hashing over Arrow text columns with numpy, a few megabytes at a time.

A word is a run of bytes of a :class:`WordClass`.  Its 64-bit hash is a polynomial
over its bytes (prefix sums modulo 2**64 with an invertible odd base) followed
by a bit mixer, so all words of a chunk are hashed without a Python loop.  Hashes
depend on the bytes alone and agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


class WordClass:
    """Which bytes make words, and whether A-Z are lower-cased first."""

    def __init__(self, is_word: np.ndarray, lower: bool):
        self.is_word = is_word
        self.lower = np.arange(256, dtype=np.uint8)
        if lower:
            self.lower[65:91] += 32


def _spaced(lower: bool) -> WordClass:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    is_word = np.ones(256, bool)
    is_word[[0x20, *range(0x09, 0x0E)]] = False
    return WordClass(is_word, lower)


def _alnum() -> WordClass:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    is_word = np.zeros(256, bool)
    is_word[0x30:0x3A] = is_word[0x61:0x7B] = is_word[0x80:] = True
    return WordClass(is_word, True)


SPACED, SPACED_LOWER, ALNUM = _spaced(False), _spaced(True), _alnum()


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], have = 1, 1
    while have < n:
        step = _U(pow(base, have, 1 << 64))
        take = min(have, n - have)
        out[have:have + take] = out[:take] * step
        have += take
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        inverse = pow(_BASE, -1, 1 << 64)
        _TABLES["byte"] = np.random.Generator(np.random.PCG64(20240131)).integers(1, 1 << 63, 256, np.uint64) | _U(1)
        _TABLES["up"], _TABLES["down"] = _powers(_BLOCK, _BASE), _powers(_BLOCK, inverse)
    return _TABLES


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit integers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the pair (left, right), order kept."""
    return mix(left * _U(0xD6E8FEB86659FD93) + right)


@dataclass
class Words:
    """The words of a chunk of rows; ``doc`` is the row within the chunk."""

    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # per row and one more: index of its first word
    start: np.ndarray  # byte range of each word, from the chunk's first byte
    end: np.ndarray
    data: np.ndarray  # the chunk's bytes, as given
    offsets: np.ndarray  # per row and one more

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows that stay in a row, and where they start."""
        if len(self.hash) < n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        out = self.hash[: len(self.hash) - n + 1]
        for k in range(1, n):
            out = chain(out, self.hash[k: len(self.hash) - n + 1 + k])
        at = np.flatnonzero(self.doc[: len(out)] == self.doc[n - 1:])
        return out[at], at


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over runs of rows of at most ``most`` bytes, whole rows each."""
    data, offsets = text_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray, kind: WordClass) -> Words:
    """Split a chunk into words and hash them."""
    is_word = kind.is_word[kind.lower[data]]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = is_word[:-1], is_word[1:]
    full = np.diff(offsets) > 0
    before[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    start, end = np.flatnonzero(is_word & ~before), np.flatnonzero(is_word & ~after) + 1
    t = _tables()
    hashes = np.zeros(len(start), np.uint64)
    carry = _U(0)
    for lo in range(0, len(data), _BLOCK):
        hi = min(lo + _BLOCK, len(data))
        base, inverse = _U(pow(_BASE, lo, 1 << 64)), _U(pow(_BASE, -lo, 1 << 64))
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = carry
        np.cumsum(t["byte"][kind.lower[data[lo:hi]]] * t["up"][: hi - lo] * base, out=sums[1:])
        sums[1:] += carry
        a, b = np.searchsorted(start, [lo, hi])
        hashes[a:b] -= sums[start[a:b] - lo]
        a, b = np.searchsorted(end, [lo + 1, hi + 1])
        hashes[a:b] += sums[end[a:b] - lo]
        carry = sums[-1]
        del sums, base, inverse
    for lo in range(0, len(data), _BLOCK):  # undo the power of each word's place
        a, b = np.searchsorted(start, [lo, lo + _BLOCK])
        hashes[a:b] *= t["down"][start[a:b] - lo] * _U(pow(_BASE, -lo, 1 << 64))
    hashes = chain(hashes, (end - start).astype(np.uint64))
    first = np.searchsorted(start, offsets)
    return Words(hashes, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first, start, end, data, offsets)


def per_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the row ranges that ``ends`` (one more than rows) bound."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[ends[1:]] - sums[ends[:-1]]


def covered(size: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in any of the ranges."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) > 0
