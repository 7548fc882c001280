"""Singular values and right singular vectors of a small square matrix.

Householder reflections make the matrix upper bidiagonal. Its singular values come from differential qd transforms
with shifts, which keep small ones accurate as well; each right vector comes from a twisted factorisation, which
meets from both ends at the row where the residual is least, or by inverse iteration where values nearly tie.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
CLOSE = 1e-3            # relative gap under which vectors are made orthogonal to each other


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector v for which (I - 2 v v') x is `length` times the first axis; zeros if nothing is to be turned."""
    length = float(np.linalg.norm(x))
    if length == 0 or not np.any(x[1:]):
        return np.zeros_like(x), float(x[0])
    v = x.copy()
    length = -np.copysign(length, x[0])
    v[0] -= length
    return v / np.linalg.norm(v), length


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and the orthogonal V with matrix = U B V'."""
    work = np.array(matrix, float)
    n = work.shape[1]
    right = np.eye(n)
    for k in range(n):
        v, _ = _reflector(work[k:, k])
        work[k:, k:] -= 2 * np.outer(v, v @ work[k:, k:])
        if k < n - 2:
            v, _ = _reflector(work[k, k + 1:])
            work[k:, k + 1:] -= 2 * np.outer(work[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2 * np.outer(right[:, k + 1:] @ v, v)
    return np.diagonal(work).copy(), np.diagonal(work, 1).copy(), right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd transform with a shift; None if the shift is beyond the least eigenvalue."""
    n = len(q)
    new_q, new_e, d = [0.0] * n, [0.0] * (n - 1), q[0] - shift
    for k in range(n - 1):
        if d < 0:
            return None
        total = d + e[k]
        new_q[k] = total
        if total == 0:
            new_e[k], d = 0.0, q[k + 1] - shift
        else:
            ratio = q[k + 1] / total
            new_e[k], d = e[k] * ratio, d * ratio - shift
    if d < 0 or d != d:
        return None
    new_q[-1] = d
    return new_q, new_e


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling."""
    scale = max(np.max(np.abs(diagonal), initial=0), np.max(np.abs(upper), initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    parts = [([float(x) ** 2 for x in diagonal / scale], [float(x) ** 2 for x in upper / scale], 0.0)]
    while parts:
        q, e, moved = parts.pop()
        if q[0] * 1.5 < q[-1]:
            q, e = q[::-1], e[::-1]
        while len(q) > 1:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1])) or e[k] < 1e-300), None)
            if cut is not None:
                if cut < len(q) - 2:
                    parts.append((q[:cut + 1], e[:cut], moved))
                    q, e = q[cut + 1:], e[cut + 1:]
                    continue
                found.append(moved + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            a, b, c = q[-2], e[-1], q[-1]      # the lesser eigenvalue of the last two rows bounds the shift from above
            mean = (a + b + c) / 2
            shift = a * c / (mean + np.sqrt(max(mean * mean - a * c, 0.0)))
            step = None
            for share in (1 - 1e-9, 0.9, 0.5, 0.1):
                step = _transform(q, e, shift * share)
                if step is not None:
                    moved += shift * share
                    break
            q, e = step or _transform(q, e, 0.0)
        found.append(moved + q[0])
    return np.sort(np.array(found))[::-1] * scale ** 2


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B for a value that stands alone: factors of B'B - value from the top and from the bottom
    meet in the row where the residual is least, and the vector is read off them from there."""
    n, tiny = len(a), np.finfo(float).tiny / EPS
    down, up = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.empty(n), np.empty(n)
    s[0], p[-1] = -value, a[-1] ** 2 - value
    for k in range(n - 1):
        pivot = s[k] + a[k] ** 2
        pivot = pivot if abs(pivot) > tiny else tiny
        down[k] = a[k] * b[k] / pivot
        s[k + 1] = b[k] ** 2 * (s[k] / pivot) - value
    for k in range(n - 2, -1, -1):
        pivot = b[k] ** 2 + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        up[k] = a[k] * b[k] / pivot
        p[k] = a[k] ** 2 * (p[k + 1] / pivot) - value
    at = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[at] = 1
    for k in range(at - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(at, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def close_vector(a: np.ndarray, b: np.ndarray, value: float, others: np.ndarray, start: int) -> np.ndarray:
    """The same for one of several close values: inverse iteration, kept orthogonal to the vectors found before."""
    gram = np.diag(a ** 2) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    gram[np.arange(1, len(a)), np.arange(1, len(a))] += b ** 2
    gram -= (value + EPS * np.abs(gram).max()) * np.eye(len(a))
    z = np.random.default_rng(start).normal(size=len(a))
    for _ in range(5):
        z = np.linalg.solve(gram, z)
        for _ in range(2):
            z /= np.linalg.norm(z)
            z = z - others @ (others.T @ z)
        z /= np.linalg.norm(z)
    return z


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors, as columns, of a bidiagonal matrix for the given squared singular values, which fall.

    Where the upper diagonal vanishes the matrix falls into blocks, whose vectors share no row. The vector of a value that
    stands alone is read off a twisted factorisation, which cannot tell close values apart."""
    n = len(diagonal)
    size = max(np.max(np.abs(diagonal), initial=0), np.max(np.abs(upper), initial=0))
    out = np.zeros((n, len(values)))
    ends = [0, *(np.flatnonzero(np.abs(upper) <= EPS * size) + 1), n]
    blocks = [(i, j, list(squared_singular_values(diagonal[i:j], upper[i:j - 1]))) for i, j in zip(ends, ends[1:])]
    owners = sorted(((v, k) for k, (_, _, own) in enumerate(blocks) for v in own), key=lambda x: -x[0])
    for column, (value, owner) in enumerate(owners[:len(values)]):
        i, j, own = blocks[owner]
        if j - i == 1:
            out[i, column] = 1
            continue
        gap = CLOSE * value + (4 * EPS * size) ** 2
        if sum(abs(other - value) <= gap for other in own) == 1:
            out[i:j, column] = twisted_vector(diagonal[i:j], upper[i:j - 1], value)
        else:
            near = [c for c in range(column) if owners[c][1] == owner and owners[c][0] - value <= gap]
            out[i:j, column] = close_vector(diagonal[i:j], upper[i:j - 1], value, out[i:j, near], column)
    return out


def right_singular(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values, falling, and the right singular vectors of the `count` greatest as columns."""
    diagonal, upper, right = bidiagonalise(matrix)
    values = squared_singular_values(diagonal, upper)
    return values, right @ right_vectors(diagonal, upper, values[:count])
