"""Leading eigenpairs of a symmetric matrix by spectrum slicing, in numpy.

The LDL' factors of A - s I have as many positive pivots as A has eigenvalues above s (Sylvester's
law of inertia). Slices of the spectrum are halved by such counts until each of the leading
eigenvalues lies alone in one; Rayleigh quotient iteration then converges in it, and the counts at
both ends of the slice say which number the eigenvalue has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PANEL = 48
#: Multipliers above this make the factors inexact.
GROWTH = 1e3
#: Slices of less than this share of the scale are not halved: their eigenvalues are equal.
NARROWEST = 1e-13
#: Eigenvalues of less than this share of the scale count as zero.
ZERO = 1e-12


def pivots(a: np.ndarray, shift: float) -> tuple[np.ndarray, float]:
    """The pivots D of LDL' = a - shift I, computed by panels, and the largest multiplier."""
    b = a - shift * np.eye(len(a))
    d, growth = np.empty(len(a)), 0.0
    for start in range(0, len(a), PANEL):
        panel = b[start:, start : start + PANEL]  # columns: L times D
        width = panel.shape[1]
        for k in range(width):
            d[start + k] = panel[k, k] or np.finfo(float).tiny
            below = panel[k + 1 :, k] / d[start + k]
            growth = max(growth, float(np.abs(below).max(initial=0.0)))
            panel[k + 1 :, k + 1 :] -= np.outer(below, panel[k + 1 : width, k])
        rest = panel[width:]
        b[start + width :, start + width :] -= (rest / d[start : start + width]) @ rest.T
    return d, growth


class Slices:
    """Shifts with the number of eigenvalues of `a` above them."""

    def __init__(self, a: np.ndarray):
        self.a = a
        self.scale = float(np.abs(a).sum(1).max(initial=0.0))  # no eigenvalue is larger
        self.ends = [(self.scale * 1.01, 0)]
        if self.scale:
            self.halve(0.5 * ZERO * self.scale, 1.5 * ZERO * self.scale)
        self.positive = self.ends[-1][1]

    def halve(self, low: float, high: float) -> None:
        """Count at a shift near the middle of low to high.

        Any shift inside a slice serves, so one whose factors are inexact is left for another.
        """
        tried = []
        for k in range(20):
            shift = low + (0.5 + (-1) ** k * 0.02 * ((k + 1) // 2)) * (high - low)
            d, growth = pivots(self.a, shift)
            tried.append((growth, shift, int((d > 0).sum())))
            if growth <= GROWTH:
                break
        self.ends.append(min(tried)[1:])

    def around(self, number: int) -> tuple[float, float, bool]:
        """The narrowest known slice that holds the eigenvalue `number`, and whether it is alone there."""
        low, up_to = max(e for e in self.ends if e[1] >= number)
        high, before = min(e for e in self.ends if e[1] < number)
        return low, high, up_to == number == before + 1


@dataclass
class Pair:
    """Eigenvalue and unit vector; `low` to `high` is the slice whose counts certify its number."""

    value: float
    vector: np.ndarray
    low: float
    high: float


def _orthogonal(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for u in others:
            v = v - (u @ v) * u
    return v / np.linalg.norm(v)


def _solved(a: np.ndarray, shift: float, v: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a - shift * np.eye(len(a)), v)
    except np.linalg.LinAlgError:  # exactly an eigenvalue
        return np.linalg.solve(a - shift * (1 + 1e-15) * np.eye(len(a)), v)


def _rayleigh(slices: Slices, low: float, high: float, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """Two steps of inverse iteration at the middle of the slice, then Rayleigh quotient iteration."""
    a, value = slices.a, (low + high) / 2
    v = _orthogonal(np.random.default_rng(len(found)).normal(size=len(a)), found)
    for step in range(14):
        v = _orthogonal(_solved(a, value, v), found)
        quotient = float(v @ a @ v)
        if step >= 1 and low < quotient < high:
            value = quotient
        if np.linalg.norm(a @ v - quotient * v) <= 4e-16 * slices.scale:
            break
    return quotient, v


def leading(a: np.ndarray, most: int) -> list[Pair]:
    """The `most` largest positive eigenvalues with unit vectors, largest first.

    Equal eigenvalues get orthogonal vectors; eigenvalues that count as zero are left out.
    """
    slices = Slices(a)
    out: list[Pair] = []
    while len(out) < min(most, slices.positive):
        low, high, alone = slices.around(len(out) + 1)
        equal = high - low <= NARROWEST * slices.scale
        if alone or equal:
            value, vector = _rayleigh(slices, low, high, [p.vector for p in out])
            if equal or low < value < high:
                out.append(Pair(value, vector, low, high))
                continue
        slices.halve(low, high)
    return out
