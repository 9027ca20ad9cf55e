"""Leading eigenpairs of a small symmetric matrix.

Householder reflections bring the matrix to tridiagonal form, bisection on Sturm counts finds
the leading eigenvalues, inverse iteration their vectors; vectors of close eigenvalues are
orthogonalised against each other in every step, then all are taken back by the reflections.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Eigenvalues closer than this share of the largest one are a cluster.
CLUSTER = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with ``a = q t q^T`` for the tridiagonal t."""
    t = np.array(a, dtype=float)
    size = len(t)
    q = np.eye(size)
    for k in range(size - 2):
        v = t[k + 1:, k].copy()
        norm = np.linalg.norm(v)
        if norm == 0 or not v[1:].any():
            continue
        reach = -norm if v[0] >= 0 else norm
        v[0] -= reach
        v /= np.linalg.norm(v)
        rest = t[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        t[k + 1:, k] = t[k, k + 1:] = 0
        t[k + 1, k] = t[k, k + 1] = reach
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(t).copy(), np.diag(t, -1).copy(), q


def below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each x."""
    tiny = EPS * max(1e-300, float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)))
    count = np.zeros(len(x), np.int64)
    pivot = np.ones(len(x))
    for i in range(len(diagonal)):
        pivot = diagonal[i] - x - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection between Gershgorin's bounds."""
    size = len(diagonal)
    reach = np.zeros(size)
    reach[1:] += np.abs(off)
    reach[:-1] += np.abs(off)
    low = np.full(k, float((diagonal - reach).min()))
    high = np.full(k, float((diagonal + reach).max()))
    high += EPS * np.abs(high) + 1e-300
    want = size - 1 - np.arange(k)               # eigenvalues below the wanted one
    for _ in range(200):
        mid = 0.5 * (low + high)
        if ((mid <= low) | (mid >= high)).all():
            break
        under = below(diagonal, off, mid) <= want
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return 0.5 * (low + high)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """(t - shift) z = b by elimination with row exchanges; a zero pivot counts as ``tiny``."""
    n = len(diagonal)
    d, u, u2, z = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n, b.tolist()
    lower = off.tolist()
    for i in range(n - 1):
        if abs(lower[i]) > abs(d[i]):
            d[i], lower_i, u[i], d[i + 1], u2[i] = lower[i], d[i], d[i + 1], u[i], u[i + 1]
            u[i + 1] = 0.0
            z[i], z[i + 1] = z[i + 1], z[i]
        else:
            lower_i = lower[i]
        if abs(d[i]) < tiny:
            d[i] = tiny
        f = lower_i / d[i]
        d[i + 1] -= f * u[i]
        u[i + 1] -= f * u2[i]
        z[i + 1] -= f * z[i]
    if abs(d[-1]) < tiny:
        d[-1] = tiny
    for i in range(n - 1, -1, -1):
        s = z[i] - (u[i] * z[i + 1] if i + 1 < n else 0.0) - (u2[i] * z[i + 2] if i + 2 < n else 0.0)
        z[i] = s / d[i]
    return np.array(z)


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, seed: int = 1) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal for falling ``values``."""
    size, rng = len(diagonal), np.random.Generator(np.random.PCG64(seed))
    top = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)), 1e-300)
    out = np.zeros((size, len(values)))
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * top:
            first = k
        z = rng.standard_normal(size)
        for _ in range(5):
            z = _solve(diagonal, off, value - (k - first) * EPS * top, z / np.linalg.norm(z), EPS * top)
            z /= np.abs(z).max()
            for _again in range(2):
                z -= out[:, first:k] @ (out[:, first:k].T @ z)
        out[:, k] = z / np.linalg.norm(z)
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the ``k`` largest eigenvalues of a
    symmetric positive semidefinite matrix; those that are zero to double precision go."""
    size = len(a)
    if not size or not np.any(a):
        return np.zeros(0), np.zeros((size, 0))
    scale = float(np.abs(a).max())
    diagonal, off, q = tridiagonal(a / scale)
    values = leading_values(diagonal, off, min(k, size))
    values = values[values > size * 8 * EPS * values[0]]
    found = q @ vectors(diagonal, off, values)
    found /= np.linalg.norm(found, axis=0)
    return np.einsum("ij,ij->j", found, (a / scale) @ found) * scale, found
