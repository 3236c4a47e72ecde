"""Singular values and right singular vectors of a square matrix by way of a bidiagonal one.

Householder reflections make R = Q B P' with B upper bidiagonal. The dqds algorithm finds the squares of B's
singular values without forming B'B, each to nearly full relative accuracy. Right singular vectors of B come from
twisted factorisations of B'B - t = N D N': the factorisation from the top and the one from the bottom meet where
their pivot is smallest, and the vector follows from there by products only. Values that are close relative to
their size are first shifted by one of their neighbours, which pulls them apart. All this is for matrices of a
model's width, on one machine.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
TINY = 1e-290
#: Values nearer to each other than this share of their size are shifted before their vectors are taken.
APART = 1e-3
DEPTH = 12


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and P with orthonormal columns, for a square ``matrix`` = Q B P'."""
    work = np.array(matrix, float)
    size = len(work)
    right = np.eye(size)
    for k in range(size):
        mirror = _mirror(work[k:, k])
        work[k:, k:] -= np.outer(mirror, 2 * (mirror @ work[k:, k:]))
        if k < size - 2:
            mirror = _mirror(work[k, k + 1 :])
            work[k:, k + 1 :] -= np.outer(2 * (work[k:, k + 1 :] @ mirror), mirror)
            right[:, k + 1 :] -= np.outer(2 * (right[:, k + 1 :] @ mirror), mirror)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _mirror(column: np.ndarray) -> np.ndarray:
    """The unit vector of the reflection that takes a vector to a multiple of the first axis."""
    scale = np.abs(column).max(initial=0)
    if scale == 0:
        return np.zeros_like(column)
    mirror = column / scale
    mirror[0] += np.copysign(np.linalg.norm(mirror), mirror[0])
    return mirror / np.linalg.norm(mirror)


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling, by dqds."""
    found: list[float] = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while todo:
        q, e, shifted = todo.pop()
        while q:
            cut = _negligible(q, e, shifted)
            if len(q) == 1 or cut == len(q) - 2:
                found.append(max(shifted + q[-1], 0.0))
                q, e = q[:-1], e[:-1]
            elif cut is not None:
                todo.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
            else:
                if 1.5 * q[0] < q[-1]:
                    q, e = q[::-1], e[::-1]
                q, e, by = _shrunk(q, e)
                shifted += by
    return np.sort(np.array(found))[::-1]


def _negligible(q: list[float], e: list[float], shifted: float) -> int | None:
    """The last off-diagonal that changes no value."""
    for i in range(len(e) - 1, -1, -1):
        if e[i] <= EPS * EPS * (shifted + min(q[i], q[i + 1])) or e[i] < TINY:
            return i
    return None


def _shrunk(q: list[float], e: list[float]) -> tuple[list[float], list[float], float]:
    """One transformation with a shift below the smallest value; a shift that was too large is tried lower."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
    half = (a + c) / 2
    shift = max(0.0, (a * c - b) / (half + np.sqrt(max(half * half - a * c + b, 0.0)))) if half > 0 else 0.0
    shift = float(min(shift, min(q)))
    for _ in range(4):
        new_q, new_e, at = _dqds(q, e, shift)
        if at is None:
            return new_q, new_e, shift
        shift = max(0.0, shift + new_q[-1]) if at == len(q) - 1 else shift / 4
    new_q, new_e, _ = _dqds(q, e, 0.0)
    return new_q, new_e, 0.0


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], int | None]:
    """q and e of the shifted matrix, and where the shift turned out too large."""
    new_q, new_e = [], []
    d = q[0] - shift
    for i in range(len(e)):
        if d < 0 and shift > 0:
            return [*new_q, d], new_e, i
        pivot = max(d + e[i], TINY)
        ratio = q[i + 1] / pivot
        new_q.append(pivot)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    new_q.append(d)
    if d < 0:
        if shift > 0:
            return new_q, new_e, len(q) - 1
        new_q[-1] = 0.0
    return new_q, new_e, None


# Vectors


def right_singular_vectors(diagonal: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the singular values of an upper bidiagonal matrix, falling, and its right vectors as columns."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if norm == 0:
        return np.zeros(size), np.eye(size)
    diagonal, above = diagonal / norm, above / norm
    bounds = [0, *(np.flatnonzero(np.abs(above) <= EPS) + 1).tolist(), size]
    values, vectors = [], np.zeros((size, size))
    for low, high in zip(bounds, bounds[1:]):
        part = slice(low, high)
        own = squared_singular_values(diagonal[part], above[low : high - 1])
        values.extend(own)
        vectors[part, part] = _block_vectors(diagonal[part], above[low : high - 1], own)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * norm**2, vectors[:, order]


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    size = len(diagonal)
    if size == 1:
        return np.ones((1, 1))
    solid = np.where(np.abs(diagonal) < EPS * EPS, EPS * EPS, diagonal)  # B'B = L D L' needs pivots
    d, l = solid**2, above / solid[:-1]
    vectors = np.zeros((size, size))
    _separated(d.tolist(), l.tolist(), values.tolist(), list(range(size)), vectors, 0)
    return np.linalg.qr(vectors)[0]  # orthogonal to the last digit; a column moves by rounding only


def _separated(d: list, l: list, values: list, places: list, out: np.ndarray, depth: int) -> None:
    """Vectors of the falling ``values`` of L D L', at columns ``places``; groups of close ones after a shift."""
    start = 0
    for i in range(1, len(values) + 1):
        if i < len(values) and values[i - 1] - values[i] < APART * max(abs(values[i - 1]), abs(values[i]), TINY):
            continue
        group = values[start:i]
        if len(group) == 1:
            out[:, places[start]] = _twisted(d, l, group[0])[0]
        elif depth == DEPTH or group[0] - group[-1] <= 4 * EPS * max(abs(group[0]), TINY):
            out[:, places[start:i]] = _one_subspace(d, l, group)
        else:
            _shifted(d, l, values, start, i, places, out, depth)
        start = i


def _shifted(d: list, l: list, values: list, start: int, end: int, places: list, out: np.ndarray, depth: int) -> None:
    """A close group in the factorisation shifted to just beside it, where it is no longer close."""
    group = values[start:end]
    width = group[0] - group[-1]
    shift = group[-1] - max(width, 8 * EPS * abs(group[-1])) / 8
    pivots, factors, _ = _from_top(d, l, shift)
    if not np.isfinite(pivots).all() or max(map(abs, pivots)) > 1e8 * max(map(abs, d)):
        out[:, places[start:end]] = _one_subspace(d, l, group)
        return
    reach = 4 * width + 64 * EPS * abs(group[0])
    fresh = [_bisected(pivots, factors, len(d) - 1 - rank, -reach, 2 * reach) for rank in _ranks(d, l, group)]
    _separated(pivots, factors, fresh, places[start:end], out, depth + 1)


def _ranks(d: list, l: list, group: list) -> list[int]:
    """The places of a group among all values of L D L', falling from 0."""
    below = _count_below(d, l, group[-1] - (group[0] - group[-1]) / 16 - 8 * EPS * abs(group[-1]))
    last = len(d) - 1 - below
    return list(range(last - len(group) + 1, last + 1))


def _count_below(d: list, l: list, at: float) -> int:
    """How many values of L D L' lie below a number."""
    return sum(p < 0 for p in _from_top(d, l, at)[0])


def _bisected(d: list, l: list, rank: int, low: float, high: float) -> float:
    """The value of L D L' that has ``rank`` values below it."""
    while _count_below(d, l, low) > rank:
        low -= high - low
    while _count_below(d, l, high) <= rank:
        high += high - low
    for _ in range(120):
        middle = (low + high) / 2
        if middle in (low, high) or high - low <= 2 * EPS * max(abs(low), abs(high)):
            break
        if _count_below(d, l, middle) > rank:
            high = middle
        else:
            low = middle
    return (low + high) / 2


def _from_top(d: list, l: list, shift: float) -> tuple[list, list, list]:
    """L D L' - shift = L+ D+ L+': pivots, factors and remainders."""
    pivots, factors, rest = [], [], []
    s = -shift
    for i in range(len(l)):
        rest.append(s)
        pivot = s + d[i]
        if abs(pivot) < TINY:
            pivot = -TINY
        pivots.append(pivot)
        factors.append(d[i] * l[i] / pivot)
        s = factors[i] * l[i] * s - shift
    rest.append(s)
    pivots.append(s + d[-1])
    return pivots, factors, rest


def _from_bottom(d: list, l: list, shift: float) -> tuple[list, list]:
    """L D L' - shift = U D- U': factors and remainders."""
    factors, rest = [0.0] * len(l), [0.0] * len(d)
    p = d[-1] - shift
    rest[-1] = p
    for i in range(len(l) - 1, -1, -1):
        pivot = d[i] * l[i] * l[i] + p
        if abs(pivot) < TINY:
            pivot = -TINY
        ratio = d[i] / pivot
        factors[i] = l[i] * ratio
        p = p * ratio - shift
        rest[i] = p
    return factors, rest


def _twisted(d: list, l: list, value: float) -> tuple[np.ndarray, float]:
    """The unit vector of one value of L D L', and the pivot where both factorisations meet."""
    _, down, s = _from_top(d, l, value)
    up, p = _from_bottom(d, l, value)
    meet = [abs(a + b + value) for a, b in zip(s, p)]
    k = min(range(len(d)), key=lambda i: meet[i] if meet[i] == meet[i] else np.inf)
    z = [0.0] * len(d)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, len(l)):
        z[i + 1] = -up[i] * z[i]
    vector = np.array(z)
    vector /= np.abs(vector).max()
    return vector / np.linalg.norm(vector), meet[k]


def _one_subspace(d: list, l: list, group: list) -> np.ndarray:
    """An orthonormal basis for values that are equal to the last digits: inverse iteration on several vectors."""
    size = len(d)
    held = np.random.default_rng(0).standard_normal((size, len(group)))
    shift = group[len(group) // 2]
    pivots, factors, _ = _from_top(d, l, shift + 2 * EPS * max(abs(shift), TINY))
    for _ in range(4):
        held = np.linalg.qr(held)[0]
        for i in range(1, size):
            held[i] -= factors[i - 1] * held[i - 1]
        held /= np.array(pivots)[:, None]
        for i in range(size - 2, -1, -1):
            held[i] -= factors[i] * held[i + 1]
        held /= np.abs(held).max()
    return np.linalg.qr(held)[0]
