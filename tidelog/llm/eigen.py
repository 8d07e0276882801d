"""Leading eigenpairs of a symmetric matrix: tridiagonal form, bisection, inverse iteration."""

from __future__ import annotations

import numpy as np

# Eigenvalues closer than this share of the norm have their vectors made orthogonal.
CLUSTER = 1e-3
EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and unit reflectors (as columns) of Householder's reduction."""
    a = np.array(matrix, float)
    size = len(a)
    reflectors = np.zeros((size, max(size - 2, 0)))
    for k in range(size - 2):
        column = a[k + 1 :, k].copy()
        scale = np.abs(column).max()
        if scale == 0 or not column[1:].any():
            continue
        v = column / scale
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        reflectors[k + 1 :, k] = v
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * (v @ column) * v
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def counts_below(diagonal: np.ndarray, squares: np.ndarray, shifts: np.ndarray, tiny: float) -> np.ndarray:
    """Sturm counts: how many eigenvalues are below each shift."""
    q = diagonal[0] - shifts
    below = (q < 0).astype(int)
    for d, s in zip(diagonal[1:], squares):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d - shifts - s / q
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection of all of them in step."""
    size = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    norm = max(abs(low), abs(high), np.finfo(float).tiny)
    lo, hi = np.full(count, low - EPS * norm), np.full(count, high + 2 * EPS * norm)
    rank = size - 1 - np.arange(count)  # of each, counted from the smallest
    tiny = max(EPS * EPS * norm, np.finfo(float).tiny)
    while True:
        middle = (lo + hi) / 2
        if ((middle <= lo) | (middle >= hi)).all():
            return middle
        above = counts_below(diagonal, off * off, middle, tiny) > rank
        hi, lo = np.where(above, middle, hi), np.where(above, lo, middle)


def _factors(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, tiny: float):
    """Rows of the upper factor of ``T - shift`` for all shifts, with swaps and multipliers."""
    size, width = len(diagonal), len(shifts)
    upper = np.zeros((size, 3, width))
    swap, factor = np.zeros((size, width), bool), np.zeros((size, width))
    row = np.stack([diagonal[0] - shifts, np.full(width, off[0] if size > 1 else 0.0), np.zeros(width)])
    for i in range(size - 1):
        after = off[i + 1] if i + 2 < size else 0.0
        below = np.stack([np.full(width, off[i]), diagonal[i + 1] - shifts, np.full(width, after)])
        swap[i] = np.abs(below[0]) > np.abs(row[0])
        top, other = np.where(swap[i], below, row), np.where(swap[i], row, below)
        top[0] = np.where(np.abs(top[0]) < tiny, tiny, top[0])
        factor[i] = other[0] / top[0]
        upper[i] = top
        row = np.stack([other[1] - factor[i] * top[1], other[2] - factor[i] * top[2], np.zeros(width)])
    row[0] = np.where(np.abs(row[0]) < tiny, tiny, row[0])
    upper[size - 1] = row
    return upper, swap, factor


def _solve(upper: np.ndarray, swap: np.ndarray, factor: np.ndarray, right: np.ndarray) -> np.ndarray:
    size = len(right)
    y = right.copy()
    for i in range(size - 1):
        top, other = np.where(swap[i], y[i + 1], y[i]), np.where(swap[i], y[i], y[i + 1])
        y[i], y[i + 1] = top, other - factor[i] * top
    x = np.zeros((size + 2, y.shape[1]))
    for i in range(size - 1, -1, -1):
        x[i] = (y[i] - upper[i, 1] * x[i + 1] - upper[i, 2] * x[i + 2]) / upper[i, 0]
    return x[:size]


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, steps: int = 4) -> np.ndarray:
    """Unit eigenvectors (as columns) of the tridiagonal matrix for falling ``values``.

    Inverse iteration from fixed starts. Vectors of a cluster of values are made orthogonal
    to the earlier ones of that cluster after every step.
    """
    size, width = len(diagonal), len(values)
    norm = max(float(np.abs(diagonal).max() + 2 * (np.abs(off).max() if len(off) else 0)), np.finfo(float).tiny)
    # Equal values are set apart a little, so that their systems differ.
    shifts = values.copy()
    for i in range(1, width):
        shifts[i] = min(shifts[i], shifts[i - 1] - 2 * EPS * norm)
    first = np.zeros(width, int)
    for i in range(1, width):
        first[i] = first[i - 1] if values[i - 1] - values[i] <= CLUSTER * norm else i
    factors = _factors(diagonal, off, shifts, EPS * norm)
    found = np.random.default_rng(1).uniform(-1, 1, (size, width))
    for _ in range(steps):
        found /= np.abs(found).max(axis=0)
        found = _solve(*factors, found)
        found /= np.abs(found).max(axis=0)
        for i in range(width):
            for _ in range(2):
                earlier = found[:, first[i] : i]
                found[:, i] -= earlier @ (earlier.T @ found[:, i])
            found[:, i] /= np.sqrt(found[:, i] @ found[:, i])
    return found


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    count = min(count, len(matrix))
    largest = np.abs(matrix).max(initial=0.0)
    if not count or largest == 0:
        return np.zeros(count), np.eye(len(matrix), count)
    diagonal, off, reflectors = tridiagonal(matrix / largest)
    values = leading_values(diagonal, off, count)
    found = vectors(diagonal, off, values)
    for k in range(reflectors.shape[1] - 1, -1, -1):
        v = reflectors[:, k]
        found -= np.outer(2 * v, v @ found)
    return values * largest, found
