"""Symmetric eigenvectors: a float32 start, refined by Ogita and Aishima's iteration in higher precision.

Each step is two matrix products: with R = I - X'X and S = X'AX the update X + XE removes the
error of X to first order, so the number of right digits doubles. Matrices are held in `longdouble`
(64 bits of mantissa on x86) and multiplied in float64 slices whose products are exact, which
leaves the result right to the last bits of a double. Between eigenvalues that lie close together
the step only keeps the vectors orthonormal; their cluster is then solved as a problem of its own:
A, shifted by the cluster's mean, is projected on the cluster's basis, scaled to size one and solved
the same way, which tells apart eigenvalues that agree in all but their last digits.
"""

from __future__ import annotations

import numpy as np

STEPS = 12
# Eigenvalues closer than this share of the largest are a cluster; a float32 start is right to about 1e-6 of it.
CLOSE = 1e-4
HIGH = np.longdouble


def _slices(a: np.ndarray, bits: int, axis: int) -> list[np.ndarray]:
    """`a` as a sum of float64 matrices of `bits` bits below each row's (axis 1) or column's (axis 0) largest."""
    parts = []
    for _ in range(-(-66 // bits)):
        top = np.abs(a).max(axis=axis, keepdims=True)
        unit = np.exp2(np.ceil(np.log2(np.where(top > 0, top, 1))) - bits)
        part = np.rint(a / unit) * unit
        parts.append(part.astype(np.float64))
        a = a - part
    return parts


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b to 64 bits of the largest terms: sums of float64 products that round nothing."""
    bits = (52 - int(np.ceil(np.log2(max(2, a.shape[1]))))) // 2
    left, right = _slices(a, bits, 1), _slices(b, bits, 0)
    total = np.zeros((a.shape[0], b.shape[1]), dtype=HIGH)
    for order in reversed(range(len(left))):
        for i in range(order + 1):
            total += left[i] @ right[order - i]
    return total


def _step(a: np.ndarray, x: np.ndarray, solved: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """The next basis, its eigenvalues, the gap below which two are one cluster, and the step's size.

    `solved` marks the pairs of a cluster that has been solved by itself: they are only kept orthonormal.
    """
    rest = np.eye(x.shape[1], dtype=HIGH) - product(x.T, x)
    inner = product(x.T, product(a, x))
    values = np.diag(inner) / (1 - np.diag(rest))
    off = inner - np.diag(values)
    gap = CLOSE * float(np.abs(values).max(initial=0))
    error = 2 * float(np.linalg.norm(off.astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(rest.astype(float)))
    gap = max(gap, error)
    difference = values[None, :] - values[:, None]
    apart = (np.abs(difference) > gap) & ~solved
    update = np.where(apart, (inner + values[None, :] * rest) / np.where(apart, difference, 1), rest / 2)
    return x + product(x, update), values, gap, float(np.abs(update).max(initial=0))


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Index sets of values (any order) that follow one another at most `gap` apart, two or more each."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def _start(a: np.ndarray, single: bool) -> np.ndarray:
    size = float(np.abs(a).max(initial=0)) or 1.0
    scaled = (a / size).astype(np.float32 if single else np.float64)
    return np.linalg.eigh(scaled)[1].astype(HIGH)


def refined_eigenvectors(a: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Eigenvalues that agree to the last bit of the norm are one eigenvalue; any orthonormal
    basis of their space is right. An empty matrix has none.
    """
    a = np.asarray(a, dtype=HIGH)
    if not len(a):
        return np.zeros(0, HIGH), np.zeros((0, 0), HIGH)
    tiny = float(np.finfo(HIGH).eps) * len(a)
    x = _start(a, single=depth == 0)
    solved = np.zeros(a.shape, dtype=bool)
    for _ in range(STEPS):
        x, values, gap, change = _step(a, x, solved)
        norm = float(np.abs(values).max(initial=0))
        if change > 1e-8:
            continue
        close = [c for c in clusters(values, gap) if not solved[np.ix_(c, c)].all()]
        if not close and change <= tiny * 8:
            break
        for c in close:
            solved[np.ix_(c, c)] = True
            basis = x[:, c]
            middle = values[c].mean()
            # The shift takes the common digits off before the projection, not after it.
            inner = product(basis.T, product(a, basis) - middle * basis)
            inner = (inner + inner.T) / 2
            if depth < 8 and float(np.abs(inner).max()) > norm * tiny:
                x[:, c] = product(basis, refined_eigenvectors(inner, depth + 1)[1])
    # One closing step settles the values; a cluster's basis is kept orthonormal by it.
    x, values, _, _ = _step(a, x, solved)
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]
