"""Words of whole texts as NumPy arrays over one Arrow buffer.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``. Nothing here looks at more
than a megabyte or so of text at once, however long a batch is; a single long text is one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
HASH_BYTES = 1 << 17

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPREAD = np.random.Generator(np.random.PCG64(20_240_229)).integers(
    0, 1 << 64, (2, 256), np.uint64, endpoint=False
) | np.uint64(1)
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(total, total[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts (one more at the end). Null: empty."""
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """``first[d]:first[d + 1]`` are the words of row ``d``; word ``i`` is ``data[start[i]:end[i]]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """The words' bytes without what is between them, and the offsets of each word."""
        sizes = self.end - self.start
        at = np.concatenate([[0], np.cumsum(sizes)])
        source = np.arange(at[-1]) + np.repeat(self.start - at[:-1], sizes)
        return self.data[source], at

    def strings(self) -> pa.Array:
        data, at = self.packed()
        return pa.LargeStringArray.from_buffers(
            len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)
        )

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; two independent ones by ``which``."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):  # a stretch of the buffer at a time, which stays in the cache
            base = self.start[i]
            j = max(int(np.searchsorted(self.end, base + HASH_BYTES, "right")), i + 1)
            part = self.data[base : self.end[j - 1]]
            terms = _SPREAD[which][part] * power_table(len(part), which)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
            start, end = self.start[i:j] - base, self.end[i:j] - base
            # Shift every word to the same power, so that its place in the buffer doesn't matter.
            out[i:j] = (sums[end] - sums[start]) * inverse_table(len(part) + 1, which)[start]
            i = j
        return mix(out + (self.end - self.start).astype(np.uint64))


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _table(size: int, which: int, inverse: bool) -> np.ndarray:
    have = _POWERS.get((which, inverse))
    if have is None or len(have) < size:
        base = int(_BASE[which])
        if inverse:
            base = pow(base, -1, 1 << 64)
        have = np.full(max(size, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _POWERS[which, inverse] = have
    return have[:size]


def power_table(size: int, which: int = 0) -> np.ndarray:
    return _table(size, which, False)


def inverse_table(size: int, which: int = 0) -> np.ndarray:
    return _table(size, which, True)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a finaliser of two multiplications)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA3B195354A39B70D)
    return x ^ (x >> np.uint64(32))


def sorting(values: np.ndarray) -> np.ndarray:
    """The order that sorts 64-bit digests, equal ones by place. Their first bits are sorted together with their
    places, which is several times as fast as ``argsort``; where those bits don't decide, it does the work."""
    low = np.uint64((1 << len(values).bit_length()) - 1)
    keys = values & ~low
    keys |= np.arange(len(values), dtype=np.uint64)
    keys.sort()
    keys &= low
    order = keys.view(np.int64)
    found = values.take(order)
    return order if (found[1:] >= found[:-1]).all() else np.argsort(values, kind="stable")


def kinds(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(First places of the distinct digests in ascending order, the number of each value's, how often each occurs)."""
    order = sorting(values)
    found = values.take(order)
    new = np.ones(len(values), bool)
    new[1:] = found[1:] != found[:-1]
    of = np.empty(len(values), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of, np.diff(np.append(np.flatnonzero(new), len(values)))


def rolling(values: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A hash of every run of ``width`` consecutive values, by the index of its first."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    powers = power_table(len(values) + 1, which)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1], dtype=np.uint64)])
    runs = sums[width:] - sums[: len(values) - width + 1]
    return mix(runs * inverse_table(len(values) + 1, which)[: len(runs)])


def words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of every row; ``lower`` maps A-Z to a-z and leaves all other characters alone."""
    data, at = raw(texts)
    if lower:
        data = _LOWER[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(len(at), np.int64))
    solid = ~_IS_SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[at] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | border[1:-1]
    closes[:-1] &= ~solid[1:] | border[1:-1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, at))
