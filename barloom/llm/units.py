"""Texts of one Arrow batch as arrays: bytes, words, and hashes of any span of them.

A span's hash is a polynomial over random byte values modulo 2^64, taken from prefix sums, so that every span costs
the same whatever its length.  Two different spans agree with a chance of about 2^-64.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is handled alone.
SLICE = 1 << 21
#: The same where each byte takes many bytes of work: what a worker needs beyond its batch stays at some ten megabytes.
SMALL = 1 << 17

_random = np.random.default_rng(20240817)
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[bool, np.ndarray] = {}
#: What other operators keep in a worker from task to task; given up when a task of texts as arrays comes to the worker.
CACHES: list[dict] = []


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE (or its inverse) to the powers 0..n-1, modulo 2^64; kept up to the usual slice."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        size = max(n, min(max(1 << n.bit_length(), SMALL), SLICE) + 1)
        have = np.full(size, BASE_INVERSE if inverse else BASE, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= SLICE + 1:
            _powers[inverse] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def prefix(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data)), out=sums[1:])
    return sums


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], the length included."""
    raw = (sums[ends] - sums[starts]) * powers(len(sums), inverse=True)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


@dataclass
class Slice:
    """Rows first..last of a batch: their bytes, and where each row's bytes begin (with a last entry at the end)."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray

    def row(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[Slice]:
    """The texts of a string column in slices of about ``limit`` bytes; null is an empty text."""
    for cache in CACHES:
        cache.clear()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, places, raw = column.buffers()
    bounds = np.frombuffer(places, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1, first + 1)
        yield Slice(first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


@dataclass
class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a slice; row r has words of[r]..of[r + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))


def words(part: Slice) -> Words:
    n = len(part.data)
    black = ~WHITE[part.data]
    edge = np.zeros(n + 1, bool)
    edge[part.bounds] = True
    before = np.zeros(n, bool)
    before[1:] = black[:-1]
    after = np.zeros(n, bool)
    after[:-1] = black[1:]
    starts = np.flatnonzero(black & (~before | edge[:n]))
    ends = np.flatnonzero(black & (~after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, part.bounds))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive hashes; those that begin in the last k - 1 are left out."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x2545F4914F6CDD1D) + hashes[i : i + n]
        out ^= out >> np.uint64(31)
    return mix(out)


def lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys, in three passes whatever the width."""
    n = len(keys)
    if n < width:
        return keys[:0]
    top = np.iinfo(keys.dtype).max
    blocks = np.full(-(-n // width) * width, top, keys.dtype)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Winnowing: place of the chosen gram (smallest hash, of equal ones the rightmost) of each ``width`` grams.

    The choice depends on the grams of the window alone: equal windows choose the same place within themselves.
    """
    back = np.uint64(0xFFFFFFFF)
    keys = (grams & ~back) | (back - np.arange(len(grams), dtype=np.uint64))
    return (back - (lowest(keys, width) & back)).astype(np.int64)
