"""Leading eigenpairs of a symmetric matrix: tridiagonal form, bisection on Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
# Eigenvalues closer than this share of the largest are one cluster, whose vectors are made orthogonal to each other.
CLUSTER = 1e-3
ITERATIONS = 6
SEED = 29


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal, and the mirrors (a row each) that bring a symmetric matrix to this form one after the other."""
    a = np.array(matrix, np.float64)
    size = len(a)
    mirrors = np.zeros((max(size - 2, 0), size))
    for k in range(size - 2):
        column = a[k + 1:, k].copy()
        length = np.linalg.norm(column)
        if length == 0 or not column[1:].any():
            continue
        v = column.copy()
        v[0] += np.copysign(length, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        half = rest @ v
        half -= (half @ v) * v
        rest -= 2 * (np.outer(v, half) + np.outer(half, v))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(length, column[0])
        mirrors[k, k + 1:] = v
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point: negative pivots of the form shifted by it."""
    tiny = EPS**2 * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0)) + np.finfo(np.float64).tiny
    count = np.zeros(len(points), np.int64)
    pivot = np.ones(len(points))
    for k, entry in enumerate(diagonal):
        pivot = entry - points - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def largest_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each by halving an interval that holds all of them."""
    size = len(diagonal)
    reach = np.zeros(size)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    wanted = size - 1 - np.arange(min(count, size))
    low = np.full(len(wanted), (diagonal - reach).min())
    high = np.full(len(wanted), (diagonal + reach).max())
    width = high - low
    low, high = low - EPS * width - np.finfo(np.float64).tiny, high + EPS * width + np.finfo(np.float64).tiny
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        few = below(diagonal, off, middle) <= wanted
        low, high = np.where(few, middle, low), np.where(few, high, middle)


def _factor(diagonal: np.ndarray, off: np.ndarray, shift: float, tiny: float):
    """Rows of the triangular form of a shifted tridiagonal matrix, with row exchanges: pivots, next two entries, steps."""
    size = len(diagonal)
    first, second, third = np.zeros(size), np.zeros(size), np.zeros(size)
    steps = []
    one, two = diagonal[0] - shift, off[0] if size > 1 else 0.0
    for k in range(size - 1):
        under, next_one, next_two = off[k], diagonal[k + 1] - shift, off[k + 1] if k + 2 < size else 0.0
        if abs(one) >= abs(under):
            one = one if abs(one) > tiny else tiny
            factor = under / one
            first[k], second[k] = one, two
            one, two = next_one - factor * two, next_two
            steps.append((False, factor))
        else:
            factor = one / under
            first[k], second[k], third[k] = under, next_one, next_two
            one, two = two - factor * next_one, -factor * next_two
            steps.append((True, factor))
    first[-1] = one if abs(one) > tiny else tiny
    return first, second, third, steps


def _solved(factors, right: np.ndarray) -> np.ndarray:
    first, second, third, steps = factors
    x = right.copy()
    for k, (exchanged, factor) in enumerate(steps):
        if exchanged:
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            x[k + 1] -= factor * x[k]
    for k in range(len(x) - 1, -1, -1):
        if k + 1 < len(x):
            x[k] -= second[k] * x[k + 1]
        if k + 2 < len(x):
            x[k] -= third[k] * x[k + 2]
        x[k] /= first[k]
    return x


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling ``values`` by inverse iteration, made orthogonal inside clusters."""
    size = len(diagonal)
    scale = np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)
    if scale == 0:
        return np.eye(size, len(values))
    out = np.zeros((size, len(values)))
    start = np.random.default_rng(SEED)
    shift = None
    begin = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * scale:
            begin = j
        # Equal values are moved apart by a rounding, so that their solutions differ.
        shift = value if shift is None or begin == j else min(value, shift - EPS * scale)
        factors = _factor(diagonal, off, shift, EPS * scale)
        x = start.standard_normal(size)
        for _ in range(ITERATIONS):
            x = _solved(factors, x / np.abs(x).max())
            x /= np.linalg.norm(x)
            for _ in range(2):
                x -= out[:, begin:j] @ (out[:, begin:j].T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def leading_pairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and unit eigenvectors as columns, the largest entry of each positive."""
    diagonal, off, mirrors = tridiagonal(matrix)
    values = largest_values(diagonal, off, count)
    vectors = vectors_of(diagonal, off, values)
    for mirror in mirrors[::-1]:
        vectors -= 2 * np.outer(mirror, mirror @ vectors)
    vectors /= np.linalg.norm(vectors, axis=0)
    most = np.abs(vectors).argmax(0)
    return values, vectors * np.where(vectors[most, np.arange(len(values))] < 0, -1.0, 1.0)
