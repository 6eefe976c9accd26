"""Prefix polynomial hashes of bytes, in whole arrays.

Arithmetic is modulo 2^64. The prefix hash at i is the sum of byte_j * BASE^j for j < i;
as BASE is odd it has an inverse, and the hash of a piece is a difference of two prefix
hashes moved back to the power 0.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^j and BASE^-j for j < n at least."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(BASE, -1, 1 << 64)
        for k, base in enumerate((BASE, inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix hash at every place and at the end."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    # Bytes are moved up by one: zero bytes count too.
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def piece_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each piece [start, end)."""
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
