"""64-bit hashes of the words of many texts at once, in numpy over the bytes of an Arrow column.

A word's hash is a polynomial over a random value for each of its bytes, read off running sums; A-Z count as a-z. Equal words
have equal hashes; different ones share a hash about once in 2**60 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose words are worked out together; one longer word is taken whole.
CHUNK = 1 << 19

_rng = np.random.default_rng(606)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_LENGTH = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Hashes of words parted by the given bytes."""

    def __init__(self, separators: bytes):
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        value = _VALUE.copy()
        value[0x41:0x5B] = value[0x61:0x7B]
        self.value = np.where(self.inside, value, np.uint64(0))
        self.up, self.down = _powers(_BASE, CHUNK), _powers(pow(_BASE, -1, 2**64), CHUNK)

    def _cut(self, data: np.ndarray, bounds: np.ndarray, lo: int) -> int:
        """Where the chunk that begins at lo ends: not within a word."""
        end, hi = int(bounds[-1]), lo + CHUNK
        if hi >= end:
            return end
        start = int(bounds[np.searchsorted(bounds, hi, side="right") - 1])  # of the text that hi lies in
        gaps = np.flatnonzero(~self.inside[data[lo:hi]])
        best = max(start, lo + int(gaps[-1]) + 1 if len(gaps) else 0)
        if best > lo:
            return best
        stop = int(bounds[np.searchsorted(bounds, hi, side="left")])
        for at in range(hi, stop, CHUNK):
            gaps = np.flatnonzero(~self.inside[data[at : min(at + CHUNK, stop)]])
            if len(gaps):
                return at + int(gaps[0]) + 1
        return stop

    def _chunk(self, b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first byte, hash) of each word of b; words also begin at starts."""
        if len(b) > len(self.up):
            up, down = _powers(_BASE, len(b)), _powers(pow(_BASE, -1, 2**64), len(b))
        else:
            up, down = self.up, self.down
        inside = self.inside[b]
        begin, last = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        starts = starts[starts < len(b)]
        begin[starts] = inside[starts]
        before = starts[starts > 0] - 1
        last[before] = inside[before]
        first, final = np.flatnonzero(begin), np.flatnonzero(last)
        total = np.cumsum(self.value[b] * up[: len(b)], dtype=np.uint64)
        h = total[final] - np.where(first > 0, total[first - 1], np.uint64(0))
        return first, mix(h * down[first] + (final - first + 1).astype(np.uint64) * _LENGTH)

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words, where each text's begin and the last's end) of a column of texts; null has no words."""
        column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
        lo, places, hashes = int(bounds[0]), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        while lo < bounds[-1]:
            hi = self._cut(data, bounds, lo)
            a, b = np.searchsorted(bounds, lo), np.searchsorted(bounds, hi)
            first, h = self._chunk(data[lo:hi], bounds[a:b] - lo)
            places.append(first + lo)
            hashes.append(h)
            lo = hi
        return np.concatenate(hashes), np.searchsorted(np.concatenate(places), bounds)

    def pieces(self, column: pa.Array, size: int = 4 * CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, end, hashes, begins) of runs of texts of some size bytes together."""
        n = len(column)
        if not n:
            return
        lens = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
        total, at = np.cumsum(lens), 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size, side="right")))
            yield at, end, *self.of(column.slice(at, end - at))
            at = end
