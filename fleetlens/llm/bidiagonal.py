"""Singular values and right singular vectors of a small square matrix:
Householder bidiagonalisation, dqds for the values, twisted factorisations for
the vectors. Work and memory are bounded by the matrix (d x d), never by rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal a, superdiagonal b, V) with r = U B V^T, B upper bidiagonal.
    U is not formed."""
    m = np.array(r, float)
    d = m.shape[0]
    v = np.eye(d)
    for j in range(d - 1):
        _reflect(m[j:, j:], None)
        if j < d - 2:
            _reflect(m[j:, j + 1 :].T, v[:, j + 1 :].T)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _reflect(m: np.ndarray, v: np.ndarray | None) -> None:
    """The reflection that clears the first column of ``m`` below its first
    entry, applied to ``m`` and, where given, to ``v`` (both in place)."""
    x = m[:, 0].copy()
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or not np.abs(x[1:]).any():
        return
    x /= scale
    x[0] += np.copysign(np.sqrt(x @ x), x[0])
    x *= np.sqrt(2.0 / (x @ x))
    m -= np.outer(x, x @ m)
    m[1:, 0] = 0.0
    if v is not None:
        v -= np.outer(x, x @ v)


def _sweep(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform with shift ``tau``: the new q and e, and the d's on
    the way; None where the shift is above the smallest eigenvalue."""
    q1, e1, ds = [], [], []
    d = q[0] - tau
    for i, ei in enumerate(e):
        if d < 0:
            return None
        ds.append(d)
        s = d + ei
        t = q[i + 1] / s if s > 0 else 0.0
        q1.append(s)
        e1.append(ei * t)
        d = d * t - tau
    if d < 0:
        return None
    return [*q1, d], e1, [*ds, d]


def _guess(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the trailing 2 x 2, lowered by its coupling."""
    low, high, off = q[-1], q[-2] + e[-1], e[-1] * q[-1]
    half = 0.5 * (low + high)
    eig = max(0.0, low * q[-2] / (half + np.sqrt(max(half * half - low * q[-2], 0.0)))) if half > 0 else 0.0
    coupling = e[-2] / (q[-2] + e[-2]) if len(e) > 1 and q[-2] + e[-2] > 0 else 0.0
    return float(eig * (1.0 - min(1.0, 2.0 * coupling))) if off >= 0 else 0.0


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Eigenvalues of B^T B, falling, by dqds with deflation.

    The shift is guessed from the trailing 2 x 2; where that is above the
    smallest eigenvalue, 1 / trace(inverse) is taken, which never is (a Newton
    step from below) and which a sweep without shift gives for nothing.
    """
    scale = max(float(np.abs(a).max(initial=0.0)), float(np.abs(b).max(initial=0.0)))
    if scale == 0:
        return np.zeros(len(a))
    out: list[float] = []
    parts = [([(float(x) / scale) ** 2 for x in a], [(float(x) / scale) ** 2 for x in b], 0.0)]
    while parts:
        q, e, sigma = parts.pop()
        for _ in range(1000 * len(q)):
            small = [EPS * EPS * (sigma + min(x, y)) for x, y in zip(q, q[1:])]
            split = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small[i]), None)
            if split is not None:
                parts.append((q[: split + 1], e[:split], sigma))
                q, e = q[split + 1 :], e[split + 1 :]
            if len(q) == 1:
                break
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, ds = _sweep(q, e, 0.0)
            if min(ds) <= 0.0:
                continue  # singular: the next sweep sets the zero apart
            safe = (1.0 - 4 * EPS * len(q)) / sum(1.0 / d for d in ds)
            for tau in (max(_guess(q, e), safe), safe, 0.5 * safe):
                step = _sweep(q, e, tau)
                if step:
                    q, e, sigma = step[0], step[1], sigma + tau
                    break
        else:
            raise ArithmeticError("dqds did not converge")
        out.append(q[0] + sigma)
    return np.sort(np.array(out))[::-1] * scale * scale


class Twisted:
    """Twisted factorisation of L D L^T - lam, the shifted B^T B: stationary
    from the top, progressive from the bottom, met where the pivot is least."""

    def __init__(self, a: np.ndarray, b: np.ndarray, lam: float):
        n = len(a)
        floor = EPS * EPS * max(np.abs(a).max(), np.abs(b).max(initial=0.0))
        a = np.where(np.abs(a) < floor, floor, a)
        d, low = a * a, b / a[:-1]
        pivot = max(lam, float(d.max())) * EPS * EPS
        safe = lambda x: x if abs(x) > pivot else -pivot
        self.dp, self.lp, s = np.empty(n), np.empty(n - 1), np.empty(n)
        s[0] = -lam
        for i in range(n):
            self.dp[i] = safe(s[i] + d[i])
            if i < n - 1:
                self.lp[i] = d[i] * low[i] / self.dp[i]
                s[i + 1] = self.lp[i] * low[i] * s[i] - lam
        self.dm, self.um, p = np.empty(n), np.empty(n - 1), np.empty(n)
        p[-1] = d[-1] - lam
        for i in range(n - 2, -1, -1):
            self.dm[i + 1] = safe(d[i] * low[i] * low[i] + p[i + 1])
            t = d[i] / self.dm[i + 1]
            self.um[i] = low[i] * t
            p[i] = p[i + 1] * t - lam
        gamma = s + p + lam
        self.k = int(np.argmin(np.abs(gamma)))
        self.gamma = safe(float(gamma[self.k]))

    def _spread(self, w: np.ndarray) -> np.ndarray:
        z = w.copy()
        for i in range(self.k - 1, -1, -1):
            z[i] = w[i] - self.lp[i] * z[i + 1]
        for i in range(self.k + 1, len(w)):
            z[i] = w[i] - self.um[i - 1] * z[i - 1]
        return z / np.linalg.norm(z)

    def vector(self) -> np.ndarray:
        w = np.zeros(len(self.dp))
        w[self.k] = 1.0
        return self._spread(w)

    def solve(self, v: np.ndarray) -> np.ndarray:
        """Direction of the solution of (L D L^T - lam) z = v."""
        y, k, n = v.copy(), self.k, len(v)
        for i in range(1, k):
            y[i] -= self.lp[i - 1] * y[i - 1]
        for i in range(n - 2, k, -1):
            y[i] -= self.um[i] * y[i + 1]
        if k > 0:
            y[k] -= self.lp[k - 1] * y[k - 1]
        if k < n - 1:
            y[k] -= self.um[k] * y[k + 1]
        w = np.concatenate([y[:k] / self.dp[:k], [y[k] / self.gamma], y[k + 1 :] / self.dm[k + 1 :]])
        return self._spread(w / np.abs(w).max())


CLOSE = 1e-3  # relative gap under which vectors are made orthogonal to each other


def leading_vectors(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(all eigenvalues of B^T B, falling; unit eigenvectors of the first
    ``count``, as columns). Close values share a cluster: their vectors come
    from inverse iteration on the same factors and are orthogonalised."""
    n = len(a)
    norm = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    cuts = [0, *(i + 1 for i in range(n - 1) if abs(b[i]) <= EPS * EPS * norm), n]
    found = []
    for lo, hi in zip(cuts, cuts[1:]):
        found += [(lam, lo, hi) for lam in squared_singular_values(a[lo:hi], b[lo : hi - 1])]
    found.sort(key=lambda x: (-x[0], x[1]))
    vectors = np.zeros((n, min(count, n)))
    rng = np.random.default_rng(0)
    for j, (lam, lo, hi) in enumerate(found[: vectors.shape[1]]):
        near = [i for i in range(j) if found[i][1] == lo and found[i][0] - lam <= CLOSE * found[0][0]]
        own = vectors[lo:hi, near]
        if hi - lo == 1 or lam <= 0:
            start = rng.standard_normal(hi - lo)
            vectors[lo:hi, j] = _orthogonal(start, vectors[lo:hi, [i for i in range(j) if found[i][1] == lo]])
            continue
        factors = Twisted(a[lo:hi], b[lo : hi - 1], lam)
        z = factors.vector()
        if near:
            z = _orthogonal(z + 0.0, own, rng)
            for _ in range(3):
                z = _orthogonal(factors.solve(z), own, rng)
        vectors[lo:hi, j] = z
    return np.array([x[0] for x in found]), vectors


def _orthogonal(z: np.ndarray, own: np.ndarray, rng: np.random.Generator | None = None) -> np.ndarray:
    """``z`` without its parts along the columns of ``own``, of unit length."""
    for _ in range(3):
        z = z / np.linalg.norm(z)
        z = z - own @ (own.T @ z)
        if np.linalg.norm(z) < 1e-8 and rng is not None:
            z = rng.standard_normal(len(z))
    z = z - own @ (own.T @ z)
    return z / np.linalg.norm(z)


def principal_axes(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values of ``r``, falling; the first ``count`` right
    singular vectors, as columns)."""
    a, b, v = bidiagonalise(r)
    values, z = leading_vectors(a, b, count)
    return values, v @ z
