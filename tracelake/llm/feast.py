"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST).

The spectrum is cut into intervals that hold a few eigenvalues each.  For an
interval, the quadrature of ``(1 / 2 pi i) * integral of (z I - V)^-1 Y dz`` over a
circle through its ends, one complex solve per node, projects a block ``Y`` onto
the eigenvectors of the eigenvalues inside; Rayleigh-Ritz in that subspace gives
eigenpairs; the two steps repeat until the residuals are at rounding level.

How many eigenvalues lie below a number is known without finding one: the count
of negative pivots of ``V - number * I`` (Sylvester's law of inertia).  These
counts choose the intervals and, afterwards, prove that none was missed.

The matrix is dimension by dimension, whatever the number of rows it sums up.
"""

from __future__ import annotations

import numpy as np

NODES = 16  # Gauss-Legendre nodes on the upper half circle
BLOCK = 8  # eigenvalues an interval should hold at most
ROUNDS = 40


class NotConverged(ArithmeticError):
    """The counts and the extracted eigenpairs do not agree."""


def below(matrix: np.ndarray, shift: float) -> int:
    """The number of eigenvalues below ``shift``: negative pivots of a
    symmetric elimination with one-row and two-row pivots (Bunch-Parlett)."""
    a = np.array(matrix, float)
    a[np.diag_indices_from(a)] -= shift
    alpha = (1 + 17**0.5) / 8
    negative = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        r = int(diagonal.argmax())
        off = np.abs(a)
        off[np.diag_indices_from(off)] = 0
        p, q = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[r] >= alpha * off[p, q]:
            if not diagonal[r]:
                break  # all that is left is zero: eigenvalues equal to the shift
            pivot, rest = a[r, r], np.delete(a[:, r], r)
            negative += pivot < 0
            a = np.delete(np.delete(a, r, 0), r, 1) - np.outer(rest, rest / pivot)
        else:
            both = [p, q]
            e = a[np.ix_(both, both)]
            negative += 1  # such a pivot has one eigenvalue of either sign
            rest = np.delete(a[:, both], both, 0)
            a = np.delete(np.delete(a, both, 0), both, 1) - rest @ np.linalg.solve(e, rest.T)
    return negative


def intervals(matrix: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """``(low, high, eigenvalues inside)`` from the top until ``k`` are covered,
    halved by inertia counts until each holds at most ``BLOCK``; a cluster that
    cannot be parted stays whole.  Eigenvalues at rounding level are left out."""
    d = len(matrix)
    top = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
    floor = top * d * np.finfo(float).eps
    if not top:
        return []
    found: list[tuple[float, float, int]] = []
    waiting = [(floor, top * (1 + 1e-9), below(matrix, floor), d)]
    covered = 0
    while waiting and covered < k:
        low, high, n_low, n_high = waiting.pop()
        if n_high == n_low:
            continue
        if n_high - n_low <= BLOCK and high - low < low or high - low < 64 * floor:
            found.append((low, high, n_high - n_low))
            covered += n_high - n_low
            continue
        # halve the ratio while the ends are far apart: small eigenvalues lie closer
        middle = (low * high) ** 0.5 if high > 4 * low else (low + high) / 2
        n = below(matrix, middle)
        waiting += [(low, middle, n_low, n), (middle, high, n, n_high)]
    return found


def inside(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs with ``low <= eigenvalue < high``."""
    d, scale = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (nodes + 1)
    centre, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * angles)
    eye = np.eye(d)
    size = min(d, 2 * count + 4)
    rng = np.random.default_rng(11)
    while True:
        block = rng.standard_normal((d, size))
        last = np.inf
        for _ in range(ROUNDS):
            projected = np.zeros((d, size))
            for turn, weight in zip(turns, weights, strict=True):
                solved = np.linalg.solve((centre + radius * turn) * eye - matrix, block)
                projected += weight / 2 * (radius * turn * solved).real
            basis = np.linalg.qr(projected)[0]
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ small
            hit = (values >= low) & (values < high)
            if hit.sum() == count:
                residual = np.abs(matrix @ block[:, hit] - block[:, hit] * values[hit]).max()
                if residual <= 4 * np.finfo(float).eps * scale or residual <= 1e-12 * scale and residual >= last / 2:
                    return values[hit], block[:, hit]
                last = residual
        if size == d:
            raise NotConverged(f"{count} eigenvalues counted in [{low}, {high}), {int(hit.sum())} found")
        size = min(d, 2 * size)


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above rounding level (fewer if there are
    fewer), falling, and their unit eigenvectors as columns, each with its largest
    entry positive."""
    parts = [inside(matrix, *interval) for interval in intervals(matrix, k)]
    if not parts:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # one Rayleigh-Ritz over all intervals makes the columns orthogonal to rounding
    basis = np.linalg.qr(np.concatenate([v for _, v in parts], axis=1))[0]
    values, small = np.linalg.eigh(basis.T @ matrix @ basis)
    values, vectors = values[::-1][:k], (basis @ small)[:, ::-1][:, :k]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs
