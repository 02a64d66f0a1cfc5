"""The eigendecomposition of a scatter matrix, kept up to date by rank-one updates.

A ``Spectrum`` holds the exact count and integer sums of the vectors it has seen, and eigenvalues and
eigenvectors of their scatter about their mean. One vector more changes the scatter by a multiple of
one outer product; the new eigenvalues are the roots of the secular equation, one between each two old
ones, and the new eigenvectors follow from them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(float).eps)
#: Rounds of the root search; a bracket halves at least every second one.
ROUNDS = 120


def secular_roots(poles: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """(origin, offset) of each root of 1 + rho * sum(z2 / (poles - x)).

    ``poles`` ascend and are distinct, ``z2`` and ``rho`` are positive. Root i is ``poles[origin[i]] +
    offset[i]``, kept apart so that its distance to each pole has full precision. Rational
    interpolation through both neighbouring poles, inside a bracket that bisection closes.
    """
    k = len(poles)
    w = rho * z2
    ends = np.append(poles[1:], poles[-1] + w.sum())
    at = np.arange(k)
    half = (ends - poles) / 2
    middle = 1 + (w / ((poles - poles[:, None]) - half[:, None])).sum(1)
    right = (middle < 0) & (at < k - 1)
    origin = np.where(right, at + 1, at)
    delta = poles[None, :] - poles[origin][:, None]
    first = poles - poles[origin]
    second = ends - poles[origin]
    low = np.where(right, first + half, np.where((at == k - 1) & (middle < 0), half, 0.0))
    high = np.where(right, 0.0, np.where((at == k - 1) & (middle < 0), 2 * half, half))
    x = (low + high) / 2
    left_of = at[None, :] <= at[:, None]
    for _ in range(ROUNDS):
        gap = delta - x[:, None]
        terms = w / gap
        slopes = terms / gap
        f = 1 + terms.sum(1)
        noise = 4 * EPS * k * (1 + np.abs(terms).sum(1))
        low, high = np.where(f < 0, x, low), np.where(f > 0, x, high)
        open_ = (np.abs(f) > noise) & (high - low > 2 * EPS * np.abs(x))
        if not open_.any():
            break
        d1, d2 = first - x, second - x
        s1 = np.where(left_of, slopes, 0).sum(1)
        s2 = slopes.sum(1) - s1
        a = (d1 + d2) * f - d1 * d2 * (s1 + s2)
        b = d1 * d2 * f
        c = f - d1 * s1 - d2 * s2
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        new = np.where(inside, new, (low + high) / 2)
        x = np.where(open_, new, x)
    return origin, x


def updated(values: np.ndarray, vectors: np.ndarray, rho: float, direction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``vectors diag(values) vectors^T + rho direction direction^T``; values ascend."""
    z = vectors.T @ direction
    length = float(np.sqrt(z @ z))
    if rho <= 0 or length == 0:
        return values, vectors
    z, rho = z / length, rho * length * length
    tolerance = 8 * EPS * max(float(np.abs(values).max()), rho)
    live = rho * np.abs(z) > tolerance
    if not live.any():
        return values, vectors
    values, z = values.copy(), z.copy()
    index = np.flatnonzero(live)
    if _close(values[index], z[index], tolerance).any():
        vectors = vectors.copy()
        index = _rotate(values, vectors, z, index, tolerance)
        order = np.argsort(values[index], kind="stable")
        index = index[order]
    poles, part = values[index], z[index]
    origin, offset = secular_roots(poles, part * part, rho)
    # Distance of root j from pole i, from the root's own origin.
    distance = (poles[origin] - poles[:, None]) + offset
    between = poles - poles[:, None]
    k = len(index)
    lower = np.tril(np.ones((k, k), bool), -1)
    under = np.ones((k, k))
    under[lower] = between[lower]
    upper = ~lower
    upper[:, -1] = False
    shifted = np.ones((k, k))
    shifted[:, :-1] = between[:, 1:]
    under[upper] = shifted[upper]
    exact = np.sqrt(np.abs(np.prod(distance / under, axis=1)))
    weights = np.copysign(exact, part)[:, None] / distance
    weights /= np.sqrt((weights * weights).sum(0))
    values[index] = poles[origin] + offset
    vectors = vectors.copy()
    vectors[:, index] = vectors[:, index] @ weights
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _close(poles: np.ndarray, z: np.ndarray, tolerance: float) -> np.ndarray:
    """Which neighbours are so close that a rotation frees one of them."""
    gap, size = np.diff(poles), z[:-1] ** 2 + z[1:] ** 2
    return np.abs(gap * z[:-1] * z[1:]) <= tolerance * size


def _rotate(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, index: np.ndarray, tolerance: float) -> np.ndarray:
    """Deflate close poles: turn each pair so that one of them no longer takes part; those that still do."""
    kept = []
    i = index[0]
    for j in index[1:]:
        size = float(np.hypot(z[i], z[j]))
        c, s = z[j] / size, z[i] / size
        if abs((values[j] - values[i]) * c * s) <= tolerance:
            one, two = vectors[:, i].copy(), vectors[:, j].copy()
            vectors[:, i], vectors[:, j] = c * one - s * two, s * one + c * two
            a, b = values[i], values[j]
            values[i], values[j] = a * c * c + b * s * s, a * s * s + b * c * c
            z[i], z[j] = 0.0, size
        else:
            kept.append(i)
        i = j
    kept.append(i)
    return np.array(kept)


def whole_numbers(*sizes: int) -> type:
    """The kind of array that holds whole numbers of these sizes and their differences exactly."""
    return np.int64 if max(map(abs, sizes), default=0) < 2**61 else object


@dataclass
class Spectrum:
    """Count, exact sums, and the spectrum of the scatter of some vectors of whole numbers."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, [0] * size, np.zeros(size), np.eye(size))

    def _apply(self, rho: float, direction: np.ndarray) -> None:
        self.values, self.vectors = updated(self.values, self.vectors, rho, direction)

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """One centred rank-one update for each of ``rows``, a vector that occurs so many times."""
        if not len(rows):
            return
        seen = self.n + int(counts.sum())
        kind = whole_numbers(seen * max(abs(int(rows.max())), abs(int(rows.min())), 1), *self.sums)
        rows, counts = rows.astype(kind), counts.astype(kind)
        before = self.n + np.cumsum(counts) - counts
        times = counts[:, None] * rows
        passed = np.cumsum(times, axis=0)
        # The count times the distance from the mean of all vectors before, exactly.
        apart = before[:, None] * rows - (np.array(self.sums, dtype=kind) + passed - times)
        for far, n, count in zip(apart, before.tolist(), counts.tolist()):
            if n:
                self._apply(n * count / (n + count), (far / n).astype(float))
        self.n = seen
        self.sums = [a + int(b) for a, b in zip(self.sums, passed[-1])]

    def merge(self, other: Spectrum) -> None:
        """Take in another spectrum: a rank-one update for each of its directions and one for the means."""
        if not other.n:
            return
        if self.n:
            apart = [(a * other.n - b * self.n) / (self.n * other.n) for a, b in zip(self.sums, other.sums)]
            self._apply(self.n * other.n / (self.n + other.n), np.array(apart))
        for value, vector in zip(other.values[::-1], other.vectors.T[::-1]):
            if value > 0:
                self._apply(float(value), vector)
        self.n += other.n
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]
