"""Hilbert keys of points with integer coordinates, over numpy arrays (the public transpose method of J. Skilling, 2004)."""

from __future__ import annotations

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of `points` (n x dims, values below 2**bits, dims * bits at most 63) along the curve."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    if dims * bits > 63:
        raise ValueError("a key has 63 bits at most")
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the excess rotations, from the coarsest level on
        below = bit - 1
        for i in range(dims):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(x[dims - 1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros(len(points), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key
