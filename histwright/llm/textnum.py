"""Vectorised text features over Arrow batches (numpy, no per-character Python).

All functions work on a *chunk*: the UTF-8 bytes of several documents end to
end, with document offsets. Chunks are cut by bytes, so memory is bounded by
the chunk size or by one document, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C55)  # odd, hence invertible modulo 2**64
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> list[np.ndarray]:
    if len(_POW[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for i, p in enumerate((_P, _P_INV)):
            a = np.full(size, p, np.uint64)
            a[0] = 1
            _POW[i] = np.multiply.accumulate(a)
    return _POW


def lower_table() -> np.ndarray:
    """Byte to byte: A-Z become a-z, all others stay."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def not_space() -> np.ndarray:
    """Word bytes: all but the space and 0x09-0x0D."""
    t = np.ones(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return t


def alnum() -> np.ndarray:
    """Word bytes: ASCII letters and digits, and every byte of a non-ASCII character."""
    t = np.zeros(256, bool)
    t[48:58] = t[65:91] = t[97:123] = t[128:] = True
    return t


LOWER, NOT_SPACE, ALNUM = lower_table(), not_space(), alnum()


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, off, data = a.buffers()
    offs = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offs


def chunks(raw: np.ndarray, offs: np.ndarray, limit: int = CHUNK_BYTES) \
        -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) with at most ``limit`` bytes or one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


class Words:
    """Word starts, ends and 64-bit hashes of a chunk; ``first[d]`` is document d's first word."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, is_word: np.ndarray, fold: bool = True):
        flag = is_word[raw]
        n = len(raw)
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = False
            before[1:] = flag[:-1]
            after[-1] = False
            after[:-1] = flag[1:]
            inner = offs[(offs > 0) & (offs < n)]
            before[inner] = False
            after[inner - 1] = False
        self.start = np.flatnonzero(flag & ~before)
        self.end = np.flatnonzero(flag & ~after) + 1
        self.first = np.searchsorted(self.start, offs)
        text = LOWER[raw] if fold else raw
        pw, inv = _powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * pw[:n], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * inv[self.start])
        self.bytes = text

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def text(self, i: int, j: int) -> list[str]:
        """Words i to j-1 as text."""
        b = self.bytes
        return [b[s:e].tobytes().decode("utf-8", "replace")
                for s, e in zip(self.start[i:j], self.end[i:j])]


_Q = np.uint64(0xD1342543DE82EF95)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word spans by first word, and which of them lie in one document."""
    m = len(w) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    h = np.full(m, np.uint64(n), np.uint64)
    for i in range(n):
        h *= _Q
        h += w.hash[i:i + m]
    ends = w.first[1:]
    doc_end = np.repeat(ends, w.counts())[:m]
    return mix(h), np.arange(m) + n <= doc_end
