"""Symmetric eigendecomposition kept up to date under rank-one updates (numpy, one small matrix).

A spectrum is (eigenvalues ascending, unit eigenvectors as columns) of a scatter
matrix. Adding ``v v'`` deflates what the update leaves alone, finds the other
eigenvalues as roots of the secular equation, and multiplies the eigenvectors.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots t of ``1 + sum w_j / (d_j - t) = 0`` for rising, distinct ``d`` and positive ``w``.

    Root i lies between d_i and d_(i+1), the last below ``d[-1] + sum(w)``. Returned are the
    roots and the matrix ``d_j - t_i`` (rows by root), which is exact to the last bits: each
    root is held as its distance from the nearer pole. All roots advance together by the
    rational iteration that fits both neighbouring poles, kept inside a bracket by bisection.
    """
    k = len(d)
    if k == 1:
        return d + w, -w[:, None]
    upper = np.append(d[1:], d[-1] + w.sum())
    mid = 1 + (w / (d - ((d + upper) / 2)[:, None])).sum(1)
    right = (mid < 0) & (np.arange(k) < k - 1)  # the root is nearer to the pole on its right
    origin = np.where(right, upper, d)
    delta = d - origin[:, None]
    lo, hi = d - origin, upper - origin
    half = (lo + hi) / 2
    lo = np.where(mid < 0, half, lo)
    hi = np.where(mid >= 0, half, hi)
    x = (lo + hi) / 2
    # the poles on either side of each root; the last root lies beyond both of its own
    own = np.minimum(np.arange(k), k - 2)
    left = np.arange(k) <= own[:, None]
    end = np.arange(k) == k - 1
    pole_a, pole_b = d[own] - origin, d[own + 1] - origin
    done = np.zeros(k, bool)
    for _ in range(60):
        inv = 1 / (delta - x[:, None])
        term = w * inv
        f = 1 + term.sum(1)
        lo, hi = np.where(f < 0, x, lo), np.where(f > 0, x, hi)
        slope = term * inv
        psi = np.where(left, slope, 0).sum(1)
        phi = slope.sum(1) - psi
        a, b = pole_a - x, pole_b - x
        p, q = (a + b) * f - a * b * (psi + phi), a * b * f
        c = f - a * psi - b * phi
        root = np.sqrt(np.abs(p * p - 4 * q * c))
        with np.errstate(all="ignore"):
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            beyond = np.where(p >= 0, (p + root) / (2 * np.abs(c)), 2 * q / (p - root))
            step = np.where(end, beyond, step)
        done |= (np.abs(f) <= k * EPS * (1 + np.abs(term).sum(1))) | (np.abs(step) <= 2 * EPS * np.abs(x))
        done |= hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
        if done.all():
            break
        new = x + step
        x = np.where(done, x, np.where((new > lo) & (new < hi), new, (lo + hi) / 2))
    return origin + x, delta - x[:, None]


def rank_one(lam: np.ndarray, u: np.ndarray, v: np.ndarray, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum after adding ``weight * v v'`` (weight >= 0).

    Deflation: in each cluster of equal eigenvalues a reflection leaves one direction of the
    update, and directions without a part of the update keep their eigenvalue.
    """
    z = u.T @ v * np.sqrt(weight)
    size = float(z @ z)
    if size == 0.0 or not np.isfinite(size):
        return lam, u
    order = np.argsort(lam, kind="stable")
    lam, u, z = lam[order].copy(), u[:, order].copy(), z[order]
    scale = max(float(np.abs(lam).max()), size)
    near = np.diff(lam) <= 8 * EPS * scale
    if near.any():
        cut = np.r_[0, np.flatnonzero(~near) + 1, len(lam)]
        for a, b in zip(cut, cut[1:]):
            if b - a > 1 and (n := float(np.sqrt(z[a:b] @ z[a:b]))) > 0:
                h = z[a:b].copy()
                sign = 1.0 if h[-1] >= 0 else -1.0
                h[-1] += sign * n
                u[:, a:b] -= np.outer(u[:, a:b] @ h, h) * (2 / float(h @ h))
                z[a:b] = 0
                z[b - 1] = -sign * n
                lam[a:b] = lam[a:b].mean()
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > 8 * EPS * scale)
    if not len(live):
        return lam, u
    d = lam[live]
    t, gap = secular_roots(d, z[live] ** 2)
    # the update that has exactly these roots: with it the new vectors are orthogonal to the last bits
    k = len(live)
    below = np.subtract.outer(d, d)
    bottom = np.empty((k, k))
    i, j = np.indices((k, k))
    bottom[i < j] = below[i < j]
    after = np.append(d[1:], 0)
    bottom[i >= j] = (after[:, None] - d)[i >= j]
    bottom[-1] = 1
    z_hat = np.sqrt(np.abs(np.prod(gap / bottom, axis=0))) * np.sign(z[live])
    q = (z_hat / gap).T
    q /= np.sqrt((q * q).sum(0))
    lam[live] = t
    u[:, live] = u[:, live] @ q
    return lam, u


def add_rows(lam: np.ndarray, u: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum after one rank-one update for each row.

    More rows than dimensions are first reduced to their triangular factor, which has as many
    rows as dimensions and the same scatter.
    """
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    for v in rows:
        lam, u = rank_one(lam, u, v)
    return lam, u


def combine(one: tuple, other: tuple) -> tuple:
    """(count, mean, eigenvalues, eigenvectors) of two sets of rows as one, by successive rank-one updates."""
    if one[0] < other[0]:
        one, other = other, one
    m, mean, lam, u = one
    k, mean2, lam2, u2 = other
    if k == 0:
        return one
    apart = mean2 - mean
    lam, u = rank_one(lam, u, apart, m * k / (m + k))
    for e, v in zip(lam2, u2.T):
        if e > 0:
            lam, u = rank_one(lam, u, v, float(e))
    return m + k, mean + apart * (k / (m + k)), lam, u
