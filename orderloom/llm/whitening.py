"""Whitening of embeddings by spectrum slicing.

Components are whole numbers x = floor(1024 * c) + 100000, so that sums are exact whatever the order in which tasks
add them up: one pass gives the sums per dimension, a second the products of vectors centred at the whole
number next to the mean (the rest is subtracted exactly), both as whole numbers. What leaves the tasks is a table of
dimension-squared sums, added up by a shuffle on their places; only that table, whose size does not depend on the
rows, reaches the driver.

The covariance's leading eigenvalues are isolated by slicing: the number of positive pivots in the LDLᵀ
factorisation of the covariance less a shift is the number of eigenvalues above the shift, so bisection finds
an interval for each. Rayleigh quotient iteration converges within it, and is bisected further where it leaves
it. Counts on both sides of the value found certify its number. Eigenvalues that agree to double precision share an
interval and are given an orthonormal basis of their space.

Rows whose vector is null or holds null or non-finite entries are dropped, and do not count. Vectors of different
lengths are whitened apart, each length with its own fit list; an empty vector has no component and gives no row.
Entries beyond 2**52 / 1024 count as that. Repeated rows and ids are rows like any other. A component
without variance (fewer distinct vectors than dimensions) has the whitened value null and stays out of
``identity_error``; ``explained`` is null where there is no variance at all. ``deviation`` is null where the exact
value is beyond a long. Empty input gives empty output. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.vectors import matrices, numbered

COMPONENTS = 8
#: Fixed values of the data: components as whole numbers.
SCALE, SHIFT = 1024, 100_000
LARGEST = 2**52
LIMB, LIMBS = 40, 4
PIECE = 18
EPS = float(np.finfo(float).eps)
#: Rounding errors of a matrix within which eigenvalues count as equal.
MARGIN = 32
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


# --- exact sums --------------------------------------------------------------------------------


def whole(matrix: np.ndarray) -> np.ndarray:
    """Whole components without the shift, which covariances and deviations do not depend on."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * matrix), -LARGEST, LARGEST).astype(np.int64)


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns, as Python integers."""
    low = (x & 0xFFFFFFFF).sum(0).astype(object)
    return low + ((x >> 32).sum(0).astype(object) << 32)


def products(z: np.ndarray) -> np.ndarray:
    """Exact sums of products of columns, as Python integers: products of 18-bit pieces are exact in doubles."""
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for begin in range(0, len(z), 1 << 16):
        rest, pieces, shift = z[begin : begin + (1 << 16)], [], 0
        while rest.min(initial=0) < -(1 << PIECE) or rest.max(initial=0) > 1 << PIECE:
            pieces.append((shift, (rest & ((1 << PIECE) - 1)).astype(float)))
            rest, shift = rest >> PIECE, shift + PIECE
        pieces.append((shift, rest.astype(float)))
        for s, a in pieces:
            for t, b in pieces:
                total += (a.T @ b).astype(np.int64).astype(object) << (s + t)
    return total


def totals(rows: DataFrame, sums: Callable[[np.ndarray], np.ndarray]) -> dict[int, list[int]]:
    """By length of vector: the number of rows, then the exact sums over all rows of what ``sums`` gives for a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for ids, matrix in matrices(batch):
                part = np.concatenate((np.array([len(ids)], object), sums(whole(matrix))))
                held[matrix.shape[1]] = held.get(matrix.shape[1], 0) + part
        for length, values in held.items():
            places = np.arange(len(values), dtype=np.int32)
            limbs = [[(v >> (LIMB * k)) & ((1 << LIMB) - 1) for v in values] for k in range(LIMBS - 1)]
            limbs.append([v >> (LIMB * (LIMBS - 1)) for v in values])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), length, np.int32)), pa.array(places), *(pa.array(limb, pa.int64()) for limb in limbs)],
                ["length", "place", *(f"l{k}" for k in range(LIMBS))],
            )

    limbs = [f"l{k}" for k in range(LIMBS)]
    parts = rows.mapInArrow(run, "length int, place int, " + ", ".join(f"{name} long" for name in limbs))
    out: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("length", "place").agg(*(F.sum(name).alias(name) for name in limbs)).collect():
        out.setdefault(r["length"], {})[r["place"]] = sum(r[name] << (LIMB * k) for k, name in enumerate(limbs))
    return {length: [places[k] for k in range(len(places))] for length, places in out.items()}


# --- spectrum slicing --------------------------------------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above the shift: positive pivots of LDLᵀ of the shifted matrix.

    Pivots are chosen from the whole remainder, one row or, where an entry beside the diagonal is much
    larger than any on it, two rows at once; such a pair has one positive and one negative eigenvalue.
    """
    rest, positive = matrix - shift * np.eye(len(matrix)), 0
    while len(rest):
        size = np.abs(rest)
        i = int(size.diagonal().argmax())
        one = size[i, i]
        np.fill_diagonal(size, 0)
        r, s = divmod(int(size.argmax()), len(rest))
        if one == 0 and size[r, s] == 0:
            break
        pivot = [i] if one >= 0.64 * size[r, s] else [r, s]
        others = np.setdiff1d(np.arange(len(rest)), pivot)
        block, beside = rest[np.ix_(pivot, pivot)], rest[np.ix_(others, pivot)]
        positive += 1 if len(pivot) == 2 else int(block[0, 0] > 0)
        rest = rest[np.ix_(others, others)] - beside @ np.linalg.solve(block, beside.T)
        rest = (rest + rest.T) / 2
    return positive


@dataclass
class Slice:
    """An interval (low, high] that holds the eigenvalues numbered first .. last."""

    low: float
    high: float
    first: int
    last: int


def slices(matrix: np.ndarray, k: int, width: float) -> list[Slice]:
    """Intervals of one eigenvalue each, or narrower than ``width``, that hold the ``k`` largest; falling."""
    reach = float(np.abs(matrix).sum(1).max()) + width
    todo, done = [Slice(-reach, reach, 1, len(matrix))], []
    while todo:
        one = todo.pop()
        if one.first > k:
            continue
        if one.first == one.last or one.high - one.low <= width:
            done.append(one)
            continue
        todo.extend(halves(matrix, one))
    return sorted(done, key=lambda s: s.first)


def halves(matrix: np.ndarray, one: Slice) -> list[Slice]:
    middle = (one.low + one.high) / 2
    n = min(max(above(matrix, middle), one.first - 1), one.last)
    parts = [Slice(one.low, middle, n + 1, one.last), Slice(middle, one.high, one.first, n)]
    return [s for s in parts if s.first <= s.last]


def iterate(matrix: np.ndarray, one: Slice, found: list[np.ndarray], tiny: float) -> tuple[float, np.ndarray] | None:
    """An eigenpair of the slice by Rayleigh quotient iteration, orthogonal to those found; None if it leaves the slice."""
    x = np.random.default_rng(one.first + len(found)).normal(size=len(matrix))
    shift, best, kept = (one.low + one.high) / 2, np.inf, None
    for step in range(30):
        try:
            x = np.linalg.solve(matrix - shift * np.eye(len(matrix)), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            x = np.linalg.solve(matrix - (shift + tiny) * np.eye(len(matrix)), x)
        for _ in range(2):
            for other in found:
                x = x - (other @ x) * other
            x = x / np.linalg.norm(x)
        value = float(x @ matrix @ x)
        residual = float(np.linalg.norm(matrix @ x - value * x))
        if residual < best / 2:
            best, kept = residual, (value, x)
        elif best <= 16 * tiny:
            break
        if step >= 1:  # two steps at the middle, then at the quotient
            shift = value
    inside = kept is not None and one.low - MARGIN * tiny <= kept[0] <= one.high + MARGIN * tiny
    return kept if inside and best <= 16 * tiny else None


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows.

    Each vector's entry of largest size is positive.
    """
    k, scale = min(k, len(matrix)), float(np.abs(matrix).sum(1).max(initial=0))
    if k == 0 or scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:k]
    tiny = 4 * len(matrix) * EPS * scale
    values: list[float] = []
    vectors: list[np.ndarray] = []
    for one in slices(matrix, k, MARGIN * tiny):
        while one.first <= min(one.last, k):
            pair = iterate(matrix, one, vectors, tiny)
            apart = MARGIN * tiny
            certain = pair and above(matrix, pair[0] + apart) < one.first <= above(matrix, pair[0] - apart)
            if not certain:
                if one.high - one.low <= tiny:
                    raise ArithmeticError(f"no certain eigenvector for eigenvalue {one.first}")
                one = next(s for s in halves(matrix, one) if s.first == one.first)
                continue
            values.append(pair[0])
            vectors.append(pair[1] * np.sign(pair[1][np.abs(pair[1]).argmax()]))
            one = Slice(one.low, one.high, one.first + 1, one.last)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order]


# --- the operator ------------------------------------------------------------------------------


@dataclass
class Whitener:
    """What the vectors of one length are whitened with."""

    n: int
    centre: np.ndarray  # the whole number next to each mean
    rest: list[int]  # sum less n times the centre
    axes: np.ndarray  # one component a row, over the root of its eigenvalue; NaN without variance
    explained: np.ndarray
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([r / self.n for r in self.rest], float)
        return ((x - self.centre).astype(float) - mean) @ self.axes.T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - S)**2, exact."""
        z = x - self.centre
        rough = ((self.n * z.astype(float) - np.array([float(r) for r in self.rest])) ** 2).sum(1)
        out: list[int | None] = [None] * len(x)
        plain = np.flatnonzero(rough < 0.9 * 2**63)
        if len(plain):  # neither the parts nor the sum leave a long
            exact = ((self.n * z[plain] - np.array(self.rest, np.int64)) ** 2).sum(1)
            for k, value in zip(plain.tolist(), exact.tolist()):
                out[k] = value
        for k in np.flatnonzero((rough >= 0.9 * 2**63) & (rough < 1.1 * 2**63)).tolist():
            value = sum((self.n * int(a) - r) ** 2 for a, r in zip(z[k], self.rest))
            out[k] = value if value < 2**63 else None
        return out


def fitted(rows: DataFrame, components: int) -> dict[int, Whitener]:
    """Whiteners by length of vector."""
    sums = {length: (values[0], values[1:]) for length, values in totals(rows, column_sums).items()}
    centres = {length: np.array([(2 * s + n) // (2 * n) for s in parts], np.int64) for length, (n, parts) in sums.items()}

    def centred(x: np.ndarray) -> np.ndarray:
        return products(x - centres[x.shape[1]])[np.triu_indices(x.shape[1])]

    out = {}
    for length, (n, *upper) in totals(rows, centred).items():
        rest = [s - n * int(c) for s, c in zip(sums[length][1], centres[length])]
        covariance = np.zeros((length, length))
        for i, j, total in zip(*np.triu_indices(length), upper):
            covariance[i, j] = covariance[j, i] = (n * total - rest[i] * rest[j]) / (n * n)
        values, vectors = leading(covariance, components)
        trace = float(np.trace(covariance))
        some = values > 64 * length * EPS * values.max(initial=0)
        axes = np.where(some, 1 / np.sqrt(np.where(some, values, 1)), np.nan)[:, None] * vectors
        explained = values / trace if trace > 0 else np.full(len(values), np.nan)
        out[length] = Whitener(n, centres[length], rest, axes, explained)
    return out


def measured(rows: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """Largest entry of the covariance of the whitened vectors less the identity, by length of vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, matrix in matrices(batch):
                w = models[matrix.shape[1]].whitened(whole(matrix))
                part = np.concatenate((w.sum(0), (w.T @ w).ravel()))
                held[matrix.shape[1]] = held.get(matrix.shape[1], 0) + part
        for length, values in held.items():
            arrays = [np.full(len(values), length, np.int32), np.arange(len(values), dtype=np.int32), values]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["length", "place", "total"])

    parts = rows.mapInArrow(run, "length int, place int, total double")
    out: dict[int, dict[int, float]] = {}
    for r in parts.groupBy("length", "place").agg(F.sum("total").alias("total")).collect():
        out.setdefault(r["length"], {})[r["place"]] = r["total"]
    errors = {}
    for length, places in out.items():
        model, k = models[length], len(models[length].axes)
        values = np.array([places[p] for p in range(len(places))]) / model.n
        mean, square = values[:k], values[k:].reshape(k, k)
        apart = np.abs(square - np.outer(mean, mean) - np.eye(k))
        some = np.isfinite(model.axes).all(1)
        errors[length] = float(apart[np.ix_(some, some)].max(initial=0))
    return errors


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = numbered(vectors)
    models = fitted(rows, components)
    for length, error in measured(rows, models).items():
        models[length].identity_error = error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in matrices(batch):
                model, x = models[matrix.shape[1]], whole(matrix)
                k, m = len(model.axes), len(x)
                each = np.repeat(np.arange(m), k)
                not_a_number = lambda a: pa.array(a, mask=np.isnan(a))
                columns = [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    not_a_number(model.whitened(x).ravel()),
                    not_a_number(np.tile(model.explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)
