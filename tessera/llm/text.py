"""Words and their hashes over whole Arrow columns of texts, without a Python loop over words.

Words are what stands between ASCII white space, A-Z lower-cased. A word's hash is a polynomial over random
values of its bytes, taken from prefix sums, then mixed; a shingle's hash is one over its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_BASE, _MASK = 0x9E3779B97F4A7C15, 2**64 - 1
_WORD = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finishes 64-bit hashes; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class _Powers:
    """Powers of the base and of its inverse; a word longer than a chunk gets its own."""

    up, down = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        most = CHUNK_BYTES + 4096
        if n > most:
            return _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)
        if not len(cls.up):
            cls.up, cls.down = _powers(_BASE, most), _powers(pow(_BASE, -1, 2**64), most)
        return cls.up[:n], cls.down[:n]


def _sums(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Prefix sums of the values times the powers."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


class Words:
    """The words of some texts: byte ranges in ``data``, hashes, and where each text's words begin."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        inside = ~_WHITE[data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        first, last = bounds[:-1], bounds[1:] - 1
        full = last >= first
        before[first[full]] = False
        after[last[full]] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.offsets = np.searchsorted(self.starts, bounds)
        self.hashes = np.empty(len(self.starts), np.uint64)
        lo = 0
        while lo < len(self.starts):  # some words at a time, a chunk's bytes or one word
            hi = max(lo + 1, int(np.searchsorted(self.ends, self.starts[lo] + CHUNK_BYTES, side="right")))
            first, end = self.starts[lo], self.ends[hi - 1]
            up, down = _Powers.of(int(end - first))
            sums, at, to = _sums(_BYTES[data[first:end]], up), self.starts[lo:hi] - first, self.ends[lo:hi] - first
            self.hashes[lo:hi] = mix((sums[to] - sums[at]) * down[at] + (to - at).astype(np.uint64) * _WORD)
            lo = hi

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def shingles(self, k: int) -> Iterator[np.ndarray]:
        """Each text's shingle hashes in order, repeats included; a text of fewer words is one shingle, one without words has none."""
        runs = rolling(self.hashes, k)
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            if b - a >= k:
                yield runs[a : b - k + 1]
            elif b > a:
                yield mix(rolling(self.hashes[a:b], b - a) + np.uint64(b - a))
            else:
                yield runs[:0]


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` neighbouring word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), 1
    for j in range(k):
        out += hashes[j : j + n] * np.uint64(factor)
        factor = factor * 0xA0761D6478BD642F & _MASK
    return mix(out)


def stretch(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of each run of words from a start to an end; starts ascend, runs are short, memory is that of a few thousand."""
    out, step = np.empty(len(starts), np.uint64), 1 << 15
    hashes = mix(hashes + np.uint64(salt)) if salt else hashes
    for lo in range(0, len(starts), step):
        a, b = starts[lo : lo + step], ends[lo : lo + step]
        hi = lo
        while hi < lo + len(a):  # starts may lie far apart
            first = int(a[hi - lo])
            n = max(1, int(np.searchsorted(a[hi - lo :], first + CHUNK_BYTES)))
            one, two = a[hi - lo : hi - lo + n] - first, b[hi - lo : hi - lo + n] - first
            up, down = _Powers.of(int(two.max()) + 1)
            sums = _sums(hashes[first : first + len(up) - 1], up[: len(up) - 1])
            out[hi : hi + n] = mix((sums[two] - sums[one]) * down[one] + (two - one).astype(np.uint64))
            hi += n
    return out


def chunks(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """Ranges of rows of about a MB of text, with their words; nulls are empty."""
    column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + CHUNK_BYTES, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, Words(data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo])
        lo = hi
