"""Polynomial hashes of byte ranges, and the anchors of fixed-length windows.

``H(a, b) = sum T[byte_i] * B**(i - a)`` over the range, modulo 2**64, comes
from prefix sums, so any number of ranges of a text costs a few numpy passes.
"""

from __future__ import annotations

import numpy as np

#: Odd bases and a random value for each byte (seeded): the same everywhere.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BYTE_VALUES = np.random.default_rng(200).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i for i < n, kept and grown as needed."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers[base] = tuple(both)
    return _powers[base][0][:n], _powers[base][1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class RangeHashes:
    """Hashes of ranges [a, b) of ``octets``, with either base."""

    def __init__(self, octets: np.ndarray):
        self.values = BYTE_VALUES[octets]
        self.sums: dict[int, np.ndarray] = {}

    def of(self, a: np.ndarray | slice, b: np.ndarray | slice, base: int = 0) -> np.ndarray:
        n = len(self.values)
        up, down = powers(BASES[base], n + 1)
        if base not in self.sums:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(self.values * up[:n], out=total[1:])
            self.sums[base] = total
        total = self.sums[base]
        return mixed((total[b] - total[a]) * down[a])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by running minima of blocks."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def window_anchors(hashes: RangeHashes, window: int, gram: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window, hash of the anchor's gram): each
    window of ``window`` bytes belongs to the place of its least gram hash
    (leftmost if several), so equal windows have equal anchors. Windows of one
    anchor are neighbours. ``starts``: where the texts in the array begin, and
    its end; no window crosses from one to the next, each has room for one."""
    n = len(hashes.values)
    grams = hashes.of(slice(0, n - gram + 1), slice(gram, n + 1))
    low = np.uint64((1 << 24) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    owner = (sliding_least((grams & ~low) | place, window - gram + 1) & low).astype(np.int64)
    fresh = np.empty(len(owner), bool)
    fresh[0], fresh[1:] = True, owner[1:] != owner[:-1]
    fresh[starts[:-1]] = True
    for end in starts[1:-1]:  # windows that reach into the next text
        owner[end - window + 1:end] = -1
        fresh[end - window + 1:end] = False
        fresh[end - window + 1] = True
    first = np.flatnonzero(fresh)
    last = np.append(first[1:] - 1, len(owner) - 1)
    anchor = owner[first]
    inside = anchor >= 0
    first, last, anchor = first[inside], last[inside], anchor[inside]
    return anchor, first, last, grams[anchor]
