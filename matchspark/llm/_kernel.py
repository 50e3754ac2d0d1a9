"""Word hashes of whole texts in numpy.

A prefix sum of byte values times powers of an odd number gives each word's polynomial hash from two
entries of the sum, so the cost is a few vector operations a byte and no Python step a word.
"""

from __future__ import annotations

import numpy as np

#: Bytes handled at once; longer texts are cut at white space.
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0x51ED2701 + 1))


class Words:
    """Hashes of the words of a text. space: the bytes between words; lower: whether A-Z count as a-z."""

    def __init__(self, space: bytes = b" \t\n\x0b\x0c\r", lower: bool = True):
        self.is_word = np.ones(256, bool)
        self.is_word[list(space)] = False
        self.value = numbers(256, 7)
        if lower:
            self.value[65:91] = self.value[97:123]
        self.base = np.uint64(0xD1342543DE82EF95)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.power = self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n >= len(self.power):
            n = max(n + 1, 1 << 16)
            for name, factor in (("power", self.base), ("back", self.inverse)):
                x = np.full(n, factor, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def _slice(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = self.is_word[b]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate(([0], edge))
        if inside[-1]:
            edge = np.concatenate((edge, [len(b)]))
        start, end = edge[0::2], edge[1::2]
        self._grow(len(b))
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.value[b] * self.power[: len(b)], out=total[1:])
        return start, end, mix((total[end] - total[start]) * self.back[start])

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (bytes) and hash of each word."""
        b = np.frombuffer(data, np.uint8)
        none = np.zeros(0, np.int64)
        found = [(none, none, none.astype(np.uint64))]
        at = 0
        while at < len(b):
            end = min(at + SLICE, len(b))
            if end < len(b):  # back to white space, or on to it where one word fills the slice
                gaps = np.flatnonzero(~self.is_word[b[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    while end < len(b) and self.is_word[b[end]]:
                        end += 1
            start, stop, h = self._slice(b[at:end])
            found.append((start + at, stop + at, h))
            at = end
        return tuple(np.concatenate(x) for x in zip(*found[1:] or found, strict=True))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k words in a row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = numbers(k, 11) | np.uint64(1)
    out = h[:n] * factors[0]
    for j in range(1, k):
        out += h[j : n + j] * factors[j]
    return mix(out)
