"""Hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

P, Q, ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(1)
#: Words that a worker process remembers, about 100 bytes each.
REMEMBERED = 200_000


class _Hashes(dict):
    """64-bit hash of a word; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


HASHES = _Hashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries."""
    out = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for i in range(k):
        out = out * P + h[i : i + len(out)]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        x, span = np.minimum(x[:-span], x[span:]), span * 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if span < w else x
