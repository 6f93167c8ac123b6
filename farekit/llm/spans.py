"""Hashes of many stretches of a byte array at once, and the different ones among many."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    filled = 1
    while filled < n:
        step = np.uint64(pow(base, filled, 1 << 64))
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * step
        filled += more
    return out


class SpanHasher:
    """64-bit hashes of stretches: equal bytes give equal hashes at any place, in any task.

    A polynomial over random 64-bit values of the bytes, from one running sum:
    a few array passes however many stretches are asked for. Different
    stretches share a hash with probability of about 2^-64.
    """

    def __init__(self) -> None:
        self.letters = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def _sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) + 1 > len(self.powers):
            size = 1 << len(data).bit_length()
            self.powers, self.inverse = _powers(_BASE, size), _powers(_INVERSE, size)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self._sums(data)
        return self._finished((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def windows(self, data: np.ndarray, width: int) -> np.ndarray:
        """The hashes of all stretches of one width, by their first place."""
        n = max(len(data) - width + 1, 0)
        sums = self._sums(data)
        return self._finished((sums[len(data) + 1 - n :] - sums[:n]) * self.inverse[:n] + np.uint64(width))

    @staticmethod
    def _finished(h: np.ndarray) -> np.ndarray:
        # The low bits of a polynomial are weak; a finalizer spreads the high ones.
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values in order, a place of each, and which one stands at every place."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(values), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], order[new], which
