"""Log-frequency Bloom filter of n-gram counts, in numpy.

A count c has the level 1 + floor(log_BASE c), and an n-gram of level q is entered q times, once for each level up to q.
A reader probes level after level until one is missing. There are no false negatives, so a level is never too low; it is
too high by one with the false-positive rate of the filter, by two with its square, and so on.

The filter is cut into slices by the high bits of the n-gram's hash; each slice has room for its own entries.
"""

from __future__ import annotations

import math

import numpy as np

from plumbline.llm.common import mix64

BASE = 1.5
BITS_PER_ENTRY = 8
PROBES = 4

_STEP = 0x9E3779B97F4A7C15
_SHIFT = np.uint64(32)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return (1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9)).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The mean of the whole counts that have a level if counts are even in logarithms; 0 for level 0.

    Up to level 3 a level has one count. Counts of n-grams are at least as skewed, so plain middles would be too large.
    """
    powers = np.power(BASE, np.maximum(levels, 1).astype(np.float64))
    low, high = np.ceil(powers / BASE - 1e-9), np.ceil(powers - 1e-9) - 1
    mean = (high - low + 1) / np.log((high + 0.5) / (low - 0.5))
    return np.where(levels > 0, np.where(low == high, low, mean), 0.0)


def slice_of(grams: np.ndarray, n_slices: int) -> np.ndarray:
    """Slices are equal ranges of the hash, so sorted hashes are sorted by slice."""
    return (((grams >> _SHIFT) * np.uint64(n_slices)) >> _SHIFT).astype(np.int64)


def _places(grams: np.ndarray, level: int, bits: np.ndarray | int):
    """The bit of each probe: two halves of a hash, combined."""
    x = mix64(grams + np.uint64(level * _STEP % (1 << 64)))
    a, b = x >> _SHIFT, (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    bits = np.asarray(bits, dtype=np.uint64)
    for i in range(PROBES):
        yield ((((a + np.uint64(i) * b) & np.uint64(0xFFFFFFFF)) * bits) >> _SHIFT).astype(np.int64)


def build(grams: np.ndarray, counts: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> np.ndarray:
    """The packed bits of one slice: a multiple of 64, at least 64."""
    levels = levels_of(counts)
    bits = max(64, -(-int(levels.sum()) * bits_per_entry // 64) * 64)
    flags = np.zeros(bits, dtype=bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = grams[levels >= level]
        for place in _places(own, level, bits):
            flags[place] = True
    return np.packbits(flags, bitorder="little")


class Filter:
    """Some or all slices, side by side; ``has`` tells for which n-grams it can answer."""

    def __init__(self, n_slices: int, parts: dict[int, np.ndarray]):
        self.n_slices = n_slices
        self.bits = np.zeros(n_slices, dtype=np.uint64)
        self.first = np.zeros(n_slices, dtype=np.int64)
        self.here = np.zeros(n_slices, dtype=bool)
        at = 0
        for k, packed in sorted(parts.items()):
            self.bits[k], self.first[k], self.here[k] = len(packed) * 8, at, True
            at += len(packed)
        self.packed = np.concatenate([parts.pop(k) for k in sorted(parts)]) if parts else np.zeros(1, np.uint8)

    def has(self, grams: np.ndarray) -> np.ndarray:
        return self.here[slice_of(grams, self.n_slices)]

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each n-gram by repeated membership probes; 0 where its slice isn't here."""
        out = np.zeros(len(grams), dtype=np.uint8)
        live = np.flatnonzero(self.has(grams))
        level = 1
        while len(live):
            own = grams[live]
            k = slice_of(own, self.n_slices)
            first, bits = self.first[k], self.bits[k]
            found = np.ones(len(live), dtype=bool)
            for place in _places(own, level, bits):
                found &= (self.packed[first + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 == 1
            live = live[found]
            out[live] = level
            level += 1
        return out
