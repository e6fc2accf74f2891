"""Exact integer matrix products by Strassen's seven-product recursion, for use inside tasks."""

from __future__ import annotations

import numpy as np

#: Below this many rows, columns or inner places a product is worked out directly.
LEAF = 16


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b``. Odd sides are padded with zeros, level by level.

    Sums inside the recursion may wrap around; as all steps are additions and products modulo 2^64,
    the result is exact whenever every entry of it fits in 64 bits.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    found = np.empty((2 * i, 2 * h), a.dtype)
    found[:i, :h] = p1 + p4 - p5 + p7
    found[:i, h:] = p3 + p5
    found[i:, :h] = p2 + p4
    found[i:, h:] = p1 - p2 + p3 + p6
    return found[:m, :n]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of 64-bit integers with entries that are right or refused.

    Where a bound on the entries does not rule out an overflow, the product is taken over Python's
    integers, and an entry beyond 64 bits raises.
    """
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    bound = _largest(a) * _largest(b) * a.shape[1]
    if bound < 1 << 63:
        return strassen(a, b)
    found = a.astype(object) @ b.astype(object)
    if max(abs(int(found.max())), abs(int(found.min()))) >= 1 << 63:
        raise OverflowError("an inner product does not fit in 64 bits")
    return found.astype(np.int64)


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min())))
