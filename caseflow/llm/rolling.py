"""Hashes of word ranges in constant time: prefix sums of word hashes times powers of a base.

All arithmetic is modulo 2**64. The hash of a range is its part of the prefix sums, divided by the power
at which it starts, so that equal ranges have equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_POWERS: list[np.ndarray] = []


def word_hashes(words: list[str] | list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word; hashing anew is quicker than looking words up."""
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(1024, 2 * n) + 1
        _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))), dtype=np.uint64) for b in (BASE, INVERSE)]
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """The values with all bits stirred, differently for each salt."""
    x = (x + np.asarray(salt, np.uint64) * np.uint64(0xD6E8FEB86659FD93)).astype(np.uint64)
    for _ in range(2):
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def prefix_sums(hashes: np.ndarray) -> np.ndarray:
    """Prefix sums of the words' hashes times powers of the base: the start of every range hash."""
    power, _ = powers(len(hashes))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * power[: len(hashes)], dtype=np.uint64)))


def range_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every range of `length` words, in order of their starts."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(hashes)
    return mixed((sums[length:] - sums[:n]) * powers(n)[1][:n], length)
