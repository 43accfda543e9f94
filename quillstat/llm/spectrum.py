"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The pivots of LDL' of ``matrix - shift * I`` have as many positive values as the matrix has
eigenvalues above the shift (Sylvester's law of inertia). Bisecting on that count puts every
wanted eigenvalue alone in an interval whose ends tell its number; inside the interval
Rayleigh quotient iteration converges cubically. A pair is accepted only if the quotient and
its residual bound lie in the interval, so the counts certify its number.
"""

from __future__ import annotations

import numpy as np

PIVOT = (1 + 17 ** 0.5) / 8  # Bunch and Kaufman's bound on growth
SPLIT = 0.5 + 2 ** -7 / np.e  # off the middle, so a simple fraction of the range is no end of an interval
STEPS = 30


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: the positive pivots of LDL' with diagonal pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        first = abs(a[0, 0])
        below = np.abs(a[1:, 0])
        r = 1 + int(below.argmax()) if len(below) else 0
        most = below[r - 1] if r else 0.0
        if first == 0 and most == 0:
            a = a[1:, 1:]  # a zero eigenvalue of the shifted matrix
            continue
        pair = False
        if first < PIVOT * most:
            beside = np.abs(a[:, r])
            beside[r] = 0
            widest = beside.max()
            if first * widest < PIVOT * most * most:
                pair = abs(a[r, r]) < PIVOT * widest
                place = 1 if pair else 0
                a[[place, r]] = a[[r, place]]
                a[:, [place, r]] = a[:, [r, place]]
        if pair:  # such a block has one eigenvalue of either sign
            above += 1
            side = a[2:, :2]
            a = a[2:, 2:] - side @ np.linalg.solve(a[:2, :2], side.T)
        else:
            above += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
    return int(above)


def slices(matrix: np.ndarray, wanted: int, tolerance: float) -> list[tuple[float, float, int, int]]:
    """(low, high, first, last) for the ``wanted`` greatest eigenvalues: numbers first to last lie in (low, high].
    An interval holds several only if they agree within ``tolerance``."""
    radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
    low = float((np.diag(matrix) - radius).min()) - tolerance
    high = float((np.diag(matrix) + radius).max()) + tolerance
    todo, done = [(low, high, len(matrix), 0)], []
    while todo:
        low, high, over_low, over_high = todo.pop()
        if over_low == over_high or over_high >= wanted:
            continue
        if over_low - over_high == 1 or high - low <= tolerance:
            done.append((low, high, over_high + 1, over_low))
            continue
        cut = low + SPLIT * (high - low)
        over = count_above(matrix, cut)
        todo += [(low, cut, over_low, over), (cut, high, over, over_high)]
    return sorted(done, key=lambda s: s[2])


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, tolerance: float) -> np.ndarray:
    """The solution, scaled to entries of at most 1; a shift that is an eigenvalue to the last bit is moved a little."""
    shifted = matrix - shift * np.eye(len(matrix))
    for move in (0.0, 0.25, -0.5, 1.0):
        try:
            found = np.linalg.solve(shifted + move * tolerance * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        most = np.abs(found).max()
        if np.isfinite(most) and 0 < most < 1e200:
            return found / most
    raise ArithmeticError("no shift near the eigenvalue can be solved for")


def rayleigh(matrix: np.ndarray, low: float, high: float, start: np.ndarray, tolerance: float) -> tuple[float, np.ndarray, float]:
    """Eigenvalue, unit vector and residual reached from the middle of the interval by Rayleigh quotient iteration."""
    x = _solve(matrix, (low + high) / 2, start, tolerance)
    x /= np.linalg.norm(x)
    best = (np.inf, 0.0, x)
    for _ in range(STEPS):
        e = float(x @ matrix @ x)
        residual = float(np.linalg.norm(matrix @ x - e * x))
        if residual >= best[0] / 2 and best[0] <= tolerance:
            break
        if residual < best[0]:
            best = (residual, e, x)
        x = _solve(matrix, e, x, tolerance)
        x /= np.linalg.norm(x)
    return best[1], best[2], best[0]


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their unit vectors as rows.

    Eigenvalues that agree to working precision get an orthonormal basis of their common
    space; the zero matrix gets unit vectors.
    """
    size = len(matrix)
    wanted = min(wanted, size)
    norm = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    if norm == 0:
        return np.zeros(wanted), np.eye(size)[:wanted]
    tolerance = 4 * size * np.finfo(float).eps * norm
    rng = np.random.default_rng(size)
    values, vectors = [], np.zeros((0, size))
    for low, high, first, last in slices(matrix, wanted, tolerance):
        while first == last:
            e, x, residual = rayleigh(matrix, low, high, rng.normal(size=size), tolerance)
            if low - tolerance <= e - residual and e + residual <= high + tolerance and residual <= tolerance:
                block = x[None]
                break
            if high - low <= tolerance:  # nothing narrower: the interval is the answer
                block = _solve(matrix, (low + high) / 2, rng.normal(size=size), tolerance)[None]
                break
            cut = low + SPLIT * (high - low)
            low, high = (cut, high) if count_above(matrix, cut) >= first else (low, cut)
        else:
            block = rng.normal(size=(last - first + 1, size))
            for _ in range(6):
                block = _solve(matrix, high + tolerance, block.T, tolerance).T
                block = np.linalg.qr((block - block @ vectors.T @ vectors).T)[0].T
        block = block - block @ vectors.T @ vectors  # close eigenvalues leave a part of each other's vectors
        block = block / np.linalg.norm(block, axis=1, keepdims=True)
        values += [float(x @ matrix @ x) for x in block]
        vectors = np.vstack([vectors, block])
    return np.array(values[:wanted]), vectors[:wanted]
