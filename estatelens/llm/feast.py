"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST).

For an interval of the spectrum the resolvent is integrated over a circle
through its ends: complex shifted systems are solved at quadrature points
and their solutions summed, which projects a block of vectors onto the
interval's eigenspace.  Rayleigh-Ritz in that space gives the pairs, and the
step is repeated with them until the residuals are at rounding level.  How
many eigenvalues an interval holds is known beforehand from inertia counts
(Sylvester's law), so a missed one is noticed.
"""

from __future__ import annotations

import numpy as np

#: Quadrature points on the upper half of the circle.
POINTS = 8
#: Eigenvalues of an interval that is not divided further.
GROUP = 8
ROUNDS = 40
_ALPHA = (1 + 17 ** 0.5) / 8


def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``a`` above ``shift``: positive pivots of a symmetric
    indefinite factorisation (1x1 and 2x2 pivots) of ``a - shift``."""
    m = a - shift * np.eye(len(a))
    n, k, positive = len(m), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < n:
        below = np.abs(m[k + 1:, k])
        size = 1
        if len(below) and below.max() > 0:
            r = k + 1 + int(np.argmax(below))
            own, most = abs(m[k, k]), below.max()
            if own < _ALPHA * most:
                across = np.abs(m[r, k:])
                across[r - k] = 0
                if own * across.max() >= _ALPHA * most * most:
                    pass
                elif abs(m[r, r]) >= _ALPHA * across.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        block, c = m[k:k + size, k:k + size], m[k + size:, k:k + size]
        if size == 2:
            positive += 1  # such a block has one eigenvalue of each sign
            m[k + 2:, k + 2:] -= c @ np.linalg.solve(block, c.T)
        else:
            positive += int(block[0, 0] > 0)
            if block[0, 0]:
                m[k + 1:, k + 1:] -= (c @ c.T) / block[0, 0]
        k += size
    return positive


def _boundary(a: np.ndarray, wanted: int, low: float, high: float, scale: float) -> tuple[float, int]:
    """A shift with ``wanted`` eigenvalues above it, and their number: more
    if the next ones are equal to the last within rounding."""
    while True:
        mid = (low + high) / 2
        n = count_above(a, mid)
        if n == wanted:
            return mid, n
        if n > wanted:
            low = mid
        else:
            high = mid
        if high - low <= 1e-12 * scale:
            return low, count_above(a, low)


def intervals(a: np.ndarray, floor: float, top: float, wanted: int, group: int = GROUP) -> list[tuple[float, float, int]]:
    """(low, high, count) of disjoint intervals that hold the ``wanted``
    largest eigenvalues above ``floor``, highest first.  ``group`` is passed
    only by eigenvalues that are equal within rounding."""
    out, high, done = [], top, 0
    available = min(wanted, count_above(a, floor))
    while done < available:
        low, n = _boundary(a, min(available, done + group), floor, high, top)
        if n <= done:  # rounding at a cluster: take it with the next
            group *= 2
            continue
        out.append((low, high, n - done))
        high, done = low, n
    return out


def interval_pairs(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in (low, high], falling."""
    n = len(a)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    scale = np.abs(a).sum(axis=1).max()
    draw = np.random.default_rng(0)
    size = min(n, max(count + 8, 3 * count // 2))
    block = draw.standard_normal((n, size))
    best = np.inf
    for _ in range(ROUNDS):
        space = np.zeros_like(block)
        for t, weight in zip(turn, w):
            space += weight / 2 * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(n) - a, block)).real
        q, _ = np.linalg.qr(space)
        q, _ = np.linalg.qr(q)
        ritz, mix = np.linalg.eigh(q.T @ a @ q)
        vectors = q @ mix
        inside = np.flatnonzero((ritz > low) & (ritz <= high))
        if len(inside) == count:
            residual = np.abs(a @ vectors[:, inside] - vectors[:, inside] * ritz[inside]).max()
            if residual <= 1e-15 * scale or residual >= best / 2 and best <= 1e-12 * scale:
                order = inside[::-1]
                return ritz[order], vectors[:, order]
            slow, best = residual > best / 10, min(best, residual)
        else:  # the block was too small, or held spurious vectors
            slow = True
        if slow and size < n:
            size = min(n, 2 * size)
            vectors = np.concatenate([vectors, draw.standard_normal((n, size - vectors.shape[1]))], axis=1)
        block = vectors
    raise ArithmeticError(f"{count} eigenvalues lie in ({low}, {high}], not all were found")


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest eigenvalues above rounding level, falling,
    and unit eigenvectors as columns; fewer if the matrix has a lower rank."""
    n = len(a)
    top = float(np.abs(a).sum(axis=1).max()) if n else 0.0
    if not top:
        return np.zeros(0), np.zeros((n, 0))
    top *= 1 + 1e-9
    floor = top * n * np.finfo(float).eps * 4
    found = [interval_pairs(a, *i) for i in intervals(a, floor, top, wanted)]
    if not found:
        return np.zeros(0), np.zeros((n, 0))
    values, vectors = np.concatenate([f[0] for f in found])[:wanted], np.concatenate([f[1] for f in found], axis=1)[:, :wanted]
    if count_above(a, floor) < len(values) or (np.diff(values) > 1e-10 * top).any():
        raise ArithmeticError("the intervals' eigenvalues do not fit the inertia count")
    return values, vectors
