"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The LDL' factors of V - s I have as many positive pivots as V has eigenvalues above s
(Sylvester's law of inertia). Bisection on that count isolates each leading
eigenvalue in an interval of its own; Rayleigh quotient iteration converges cubically from
there, and its result is accepted only where the counts on both sides prove its number.
"""

from __future__ import annotations

import numpy as np

ALPHA = (1 + 17**0.5) / 8  # fixed value: bounds the growth of elements with pivots of size one and two
EPS = np.finfo(float).eps
STEPS = 12  # of Rayleigh quotient iteration; three or four are the rule


class Factors:
    """P (V - s I) P' = L D L' with diagonal pivots of size one and two, chosen over all that remains."""

    def __init__(self, matrix: np.ndarray):
        a, n = matrix.copy(), len(matrix)
        self.order, self.lower, self.pivots = np.arange(n), np.eye(n), []
        k = 0
        while k < n:
            rest = a[k:, k:]
            diagonal = np.abs(np.diag(rest))
            r = int(diagonal.argmax())
            off = np.abs(np.tril(rest, -1))
            i, j = np.unravel_index(off.argmax(), off.shape)
            two = k + 1 < n and diagonal[r] < ALPHA * off[i, j]
            for at, other in [(k, k + j), (k + 1, k + i)] if two else [(k, k + r)]:
                self._swap(a, at, other, k)
            size = 2 if two else 1
            d = a[k : k + size, k : k + size].copy()
            if not two and d[0, 0] == 0:  # nothing but zeros remains
                self.pivots += [np.zeros((1, 1))] * (n - k)
                break
            below = a[k + size :, k : k + size]
            factor = below @ np.linalg.inv(d)
            a[k + size :, k + size :] -= factor @ below.T
            self.lower[k + size :, k : k + size] = factor
            self.pivots.append(d)
            k += size

    def _swap(self, a: np.ndarray, i: int, j: int, done: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.lower[[i, j], :done] = self.lower[[j, i], :done]
            self.order[[i, j]] = self.order[[j, i]]

    def positive(self) -> int:
        """A pivot of size two has one eigenvalue of each sign."""
        return sum(1 if len(d) == 2 else int(d[0, 0] > 0) for d in self.pivots)

    def solve(self, right: np.ndarray, tiny: float) -> np.ndarray:
        """Pivots below `tiny` count as that: V - s I is nearly singular where s is nearly an eigenvalue."""
        x = right[self.order].copy()
        for k in range(len(x)):
            x[k] -= self.lower[k, :k] @ x[:k]
        k = 0
        for d in self.pivots:
            if len(d) == 2:
                x[k : k + 2] = np.linalg.solve(d, x[k : k + 2])
            else:
                x[k] /= d[0, 0] if abs(d[0, 0]) > tiny else tiny
            k += len(d)
        for k in range(len(x) - 1, -1, -1):
            x[k] -= self.lower[k + 1 :, k] @ x[k + 1 :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Slicer:
    def __init__(self, matrix: np.ndarray):
        self.v = (matrix + matrix.T) / 2
        self.n = len(matrix)
        reach = np.abs(self.v).sum(axis=1) - np.abs(np.diag(self.v))  # eigenvalues lie in these circles
        self.norm = float(max(np.abs(self.v).sum(axis=1).max(), np.finfo(float).tiny))
        self.tiny = EPS * self.norm
        self.low = float((np.diag(self.v) - reach).min()) - self.tiny * self.n
        self.high = float((np.diag(self.v) + reach).max()) + self.tiny * self.n
        self.counts = {self.low: self.n, self.high: 0}

    def above(self, shift: float) -> int:
        """Eigenvalues above the shift."""
        if shift not in self.counts:
            self.counts[shift] = Factors(self.v - shift * np.eye(self.n)).positive()
        return self.counts[shift]

    def interval(self, k: int, apart: bool = True) -> tuple[float, float]:
        """The narrowest known (low, high] with fewer than k eigenvalues above high and at least k above low;
        if `apart`, bisected until eigenvalue k is alone in it, or it cannot be told from its neighbours."""
        while True:
            low = max(s for s, c in self.counts.items() if c >= k)
            high = min((s for s, c in self.counts.items() if c < k and s > low), default=self.high)
            alone = self.counts[low] == k and self.counts[high] == k - 1
            if not apart or alone or high - low <= 8 * self.tiny:
                return low, high
            middle = (low + high) / 2
            if not low < middle < high:
                return low, high
            self.above(middle)

    def halve(self, k: int) -> None:
        low, high = self.interval(k, apart=False)
        self.above((low + high) / 2)

    def _solve(self, shift: float, right: np.ndarray) -> np.ndarray:
        return Factors(self.v - shift * np.eye(self.n)).solve(right, self.tiny)

    def single(self, k: int, before: np.ndarray, rng: np.random.Generator) -> tuple[float, np.ndarray]:
        """Eigenpair k, alone in its interval, orthogonal to the columns `before`."""

        def unit(x: np.ndarray) -> np.ndarray:
            x = x / np.linalg.norm(x)
            x = x - before @ (before.T @ x)
            return x / np.linalg.norm(x)

        while True:
            low, high = self.interval(k)
            if high - low <= 8 * self.tiny:
                break
            x = unit(rng.normal(size=self.n))
            for _ in range(2):
                x = unit(self._solve((low + high) / 2, x))
            for _ in range(STEPS):
                value = float(x @ self.v @ x)
                if not low < value <= high:
                    break  # on the way to another eigenvalue: a narrower interval will hold it
                left = np.linalg.norm(self.v @ x - value * x)
                if left <= 4 * self.n**0.5 * self.tiny:
                    side = max(4 * self.n * self.tiny, 2 * left)
                    if self.above(value - side) >= k > self.above(value + side):
                        return value, x
                    break
                x = unit(self._solve(value, x))
            self.halve(k)
        x = unit(rng.normal(size=self.n))
        for _ in range(3):
            x = unit(self._solve((low + high) / 2, x))
        return float(x @ self.v @ x), x


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` greatest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues that cannot be told from zero are left out. Of eigenvalues that cannot be told
    apart, any orthonormal vectors of their space serve. The largest entry of a vector is positive.
    """
    if not np.any(matrix):
        return np.zeros(0), np.zeros((len(matrix), 0))
    slicer, rng = Slicer(matrix), np.random.default_rng(3)
    values, vectors = [], np.zeros((len(matrix), 0))
    for k in range(1, min(most, len(matrix)) + 1):
        value, x = slicer.single(k, vectors, rng)
        if value <= 8 * len(matrix) * slicer.tiny:
            break
        x = x if x[np.abs(x).argmax()] > 0 else -x
        values.append(value)
        vectors = np.column_stack([vectors, x])
    return np.array(values), vectors
