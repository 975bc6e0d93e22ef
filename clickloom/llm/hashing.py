"""64-bit hashes of many byte strings at once."""

import numpy as np
import xxhash

#: Odd multiplier of the polynomial and its inverse modulo 2^64.
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
#: Longer strings are hashed by XXH64: a polynomial modulo 2^64 is the same for some long strings of two letters.
LONG = 32

_powers: dict[int, np.ndarray] = {}


def _table(base: int, size: int) -> np.ndarray:
    """base^0, base^1, ..., grown as needed and kept by the process."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, 1 << 20), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the hash over all bits (in place)."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


class Polynomial:
    """Hashes of any substrings of one byte block, equal for equal strings wherever they stand."""

    def __init__(self, data: np.ndarray):
        self.data, n = data, len(data)
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= _table(INVERSE, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.scale = _table(MULTIPLIER, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each [start, end); the length enters too."""
        h = (self.sums[ends] - self.sums[starts]) * self.scale[starts]
        h ^= (ends - starts).astype(np.uint64) << np.uint64(48)
        h = mixed(h)
        long = np.flatnonzero(ends - starts > LONG)
        if len(long):
            view, digest = memoryview(np.ascontiguousarray(self.data)), xxhash.xxh64_intdigest
            h[long] = [digest(view[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        return h

    def rolling(self, width: int) -> np.ndarray:
        """Hash of every substring of that width, by start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = self.sums[width:] - self.sums[:-width]
        h *= self.scale[:n]
        return mixed(h)
