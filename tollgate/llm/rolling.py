"""Vectorised polynomial hashes of words and of runs of words, for use inside tasks."""

from __future__ import annotations

import numpy as np

from tollgate.llm.common import ship

MASK = (1 << 64) - 1
BASES = (0x9E3779B97F4A7C13, 0xC2B2AE3D27D4EB4B)    # odd, 3 mod 8: powers keep their low bits apart
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 256, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and base^0..base^-n modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(1 << 14, 2 * (n + 1))
        have = tuple(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))).cumprod()
                     for b in (base, pow(base, -1, 1 << 64)))
        if n < 1 << 22:
            _POWERS[base] = have
    return have


class Runs:
    """Hashes of any run values[start:end] of a sequence, by differences of prefix sums."""

    def __init__(self, values: np.ndarray, base: int):
        self.up, self.down = powers(base, len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word (run of bytes that are not white space) of UTF-8 text."""
    if not data:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate(([True], _SPACE[raw], [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return mix(Runs(_BYTES[raw], BASES[0]).hash(start, end) + (end - start).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width`` values."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:len(least) - step], least[step:])
        have += step
    return least


ship(__name__)
