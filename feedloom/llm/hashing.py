"""Hashes of short sequences, computed for all places of an array at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the rolling hash's base and of its inverse, as long as the longest sequence so far needs."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < count:
            for name, base in (("up", _BASE), ("down", _BACK)):
                known = getattr(self, name)
                setattr(self, name, np.concatenate((known, known * np.uint64(pow(base, len(known), 1 << 64)))))
        return self.up[:count], self.down[:count]


def rolling(values: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """A hash of every `width` consecutive values (uint64), from one running sum."""
    up, down = powers.to(len(values) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)))
    return mixed((sums[width:] - sums[:-width]) * down[:max(0, len(values) - width + 1)])
