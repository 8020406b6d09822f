"""Windows of a fixed length over sequences, dealt out by content.

Every window of `window` units is owned by its anchor: the least-hashed k-gram that it holds (the leftmost
of equals). Consecutive windows with one anchor make a segment. Equal windows have equal anchors wherever
they are, so repeats can be looked for anchor by anchor, at some 2/(window-k+2) anchors a unit.
"""

from __future__ import annotations

import numpy as np
import xxhash

from tidewright.llm.common import MASK64, mix64

#: Rolling names are polynomials modulo 2**64 in this odd number.
BASE = 0x9E3779B97F4A7C15 | 1
_POS_BITS = 20
_POS = np.uint64((1 << _POS_BITS) - 1)
#: Units of a sequence looked at together; longer ones are cut with overlaps.
CHUNK = 1 << 19

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, 1 << 16)
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE, np.uint64)]), dtype=np.uint64)
        _inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, pow(BASE, -1, MASK64 + 1), np.uint64)]), dtype=np.uint64)


class Names:
    """Sums of powers of a sequence of uint64 units, from which its k-grams are named."""

    def __init__(self, units: np.ndarray):
        _grow(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * _powers[: len(units)], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """Mixed names of all k-grams."""
        n = len(self.sums) - k
        return mix64((self.sums[k:] - self.sums[:n]) * _inverse[:n])


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive values."""
    n, size = len(x) - width + 1, 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x[:n] if size == width else np.minimum(x[:n], x[width - size : width - size + n])


def segments(units: np.ndarray, window: int, k: int, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor's name and segment's name of each segment of a sequence. A
    segment is named by a hash of all it holds, as sums of powers alone would let structured repeats collide."""
    if len(units) < window:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    found = []
    step = CHUNK - window + 1
    for at in range(0, len(units) - window + 1, step):
        part = units[at : at + CHUNK]
        names = Names(part if table is None else table[part])
        grams = names.grams(k)
        keys = (grams & ~_POS) | np.arange(len(grams), dtype=np.uint64)
        place = least(keys, window - k + 1) & _POS
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        n = np.diff(first, append=len(place))
        raw, size = memoryview(np.ascontiguousarray(part)).cast("B"), part.itemsize
        ends = first + n - 1 + window
        named = [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip((first * size).tolist(), (ends * size).tolist())]
        found.append((first + at, n, grams[place[first].astype(np.int64)], np.array(named, np.uint64)))
    return tuple(np.concatenate(x) for x in zip(*found)) if len(found) > 1 else found[0]
