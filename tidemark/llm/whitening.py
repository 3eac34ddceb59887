"""Embedding whitening by spectrum slicing.

Vectors become integers, so their sums and products are added exactly: each partition adds the
products of its vectors, centred at the whole part of the mean, and gives one number for each pair of
dimensions; what the fraction of the mean changes is exact arithmetic on the sums. Only the matrix,
whose size follows the number of dimensions alone, reaches the driver.

There the leading eigenvalues are found by counting. With P(V - sI)P' = LDL' the signs of D tell how
many eigenvalues of V lie below s (Sylvester's law of inertia), so bisection isolates each leading
eigenvalue in an interval of its own. Rayleigh quotient iteration, started from the interval's middle,
then converges cubically; if it leaves the interval, the interval is halved again. Counts just below and
just above each result certify its number. Eigenvalues that counts cannot tell apart share an interval;
their vectors are made orthogonal to each other.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import settle

COMPONENTS = 32
SCALE, BASE = 64, 1_000_000
EXACT = 2**53  # doubles hold integers below exactly
PIVOT = (1 + 17**0.5) / 8


def negatives(a: np.ndarray) -> int:
    """Number of negative eigenvalues of a symmetric matrix: of the 1x1 and 2x2 pivots of its LDL' with complete pivoting."""
    a, found = a.copy(), 0
    while len(a):
        size = np.abs(a)
        diagonal = np.diag(size).copy()
        np.fill_diagonal(size, 0)
        r, (i, j) = int(diagonal.argmax()), divmod(int(size.argmax()), len(a))
        if diagonal[r] >= PIVOT * size[i, j]:
            if a[r, r] == 0:
                break  # nothing but zeros is left
            found += bool(a[r, r] < 0)
            chosen = [r]
        else:
            found += 1  # such a pivot has one eigenvalue of each sign
            chosen = [i, j]
        rest = np.delete(np.arange(len(a)), chosen)
        side = a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(chosen, chosen)], side.T)
    return found


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of `v` are at least `shift`."""
    return len(v) - negatives(v - shift * np.eye(len(v)))


def isolate(v: np.ndarray, k: int, width: float) -> list[tuple[float, float, int, int]]:
    """(low, high, first, last): intervals, from the top, that hold the eigenvalues numbered first to last alone.

    There is more than one number in an interval only where it is narrower than `width`.
    """
    bound = float(np.abs(v).sum(1).max()) * 1.01 + width
    found, open_ = [], [(-bound, bound, len(v), 0)]
    while open_:
        low, high, n_low, n_high = open_.pop()  # counts of eigenvalues at least low, at least high
        if n_low == n_high or n_high >= k:
            continue
        if n_low - n_high == 1 or high - low < width:
            found.append((low, high, n_high + 1, n_low))
            continue
        middle = (low + high) / 2
        n = above(v, middle)
        open_ += [(low, middle, n_low, n), (middle, high, n, n_high)]
    return sorted(found, reverse=True)


def _solve(v: np.ndarray, shift: float, x: np.ndarray, tiny: float) -> np.ndarray:
    while True:
        try:
            y = np.linalg.solve(v - shift * np.eye(len(v)), x)
            if np.isfinite(y).all():
                return y
        except np.linalg.LinAlgError:
            pass
        shift, tiny = shift + tiny, 2 * tiny  # the shift is an eigenvalue to the last bit


def rayleigh(v: np.ndarray, shift: float, start: np.ndarray, beside: list[np.ndarray], tol: float) -> tuple[float, np.ndarray]:
    """An eigenvalue and unit eigenvector near `shift`, orthogonal to `beside`: two inverse steps, then Rayleigh quotients as shifts."""

    def unit(x):
        for b in beside:
            x = x - (b @ x) * b
        return x / np.linalg.norm(x)

    x, near = unit(start), False
    for step in range(60):
        x = unit(_solve(v, shift, x, tol))
        value = float(x @ v @ x)
        if near:
            break  # one step after the residual is small: convergence is cubic
        near = step >= 2 and np.linalg.norm(v @ x - value * x) <= tol
        if step >= 1:
            shift = value
    return value, x


def leading(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a covariance, falling, and their unit eigenvectors as rows.

    Eigenvalues that rounding alone could have made, below 1e-12 of the largest, are left out. A vector's
    largest entry is positive.
    """
    values, vectors = [], []
    norm = float(np.linalg.norm(v)) if v.size else 0.0
    if norm == 0:
        return np.empty(0), np.empty((0, len(v)))
    tol, rng = 8 * len(v) * np.finfo(float).eps * norm, np.random.default_rng(0)
    for low, high, first, last in isolate(v, min(k, len(v)), 4 * tol):
        while first == last:  # one eigenvalue: halving ends where it is the nearest to the middle
            start = rng.standard_normal(len(v))
            beside = [w for e, w in zip(values, vectors) if abs(e - (low + high) / 2) < 1e-6 * norm]
            value, vector = rayleigh(v, (low + high) / 2, start, beside, tol)
            if low - 2 * tol <= value <= high + 2 * tol:
                values.append(value)
                vectors.append(vector)
                break
            middle = (low + high) / 2
            low, high = (middle, high) if above(v, middle) == last else (low, middle)
        else:
            for _ in range(first, last + 1):
                beside = [w for e, w in zip(values, vectors) if abs(e - (low + high) / 2) < 1e-6 * norm]
                x = rng.standard_normal(len(v))
                for _ in range(4):
                    for b in beside:
                        x = x - (b @ x) * b
                    x = _solve(v, (low + high) / 2, x / np.linalg.norm(x), tol)
                for b in beside + beside:
                    x = x / np.linalg.norm(x)
                    x = x - (b @ x) * b
                vectors.append(x / np.linalg.norm(x))
                values.append(float(vectors[-1] @ v @ vectors[-1]))
    order = np.argsort(-np.array(values), kind="stable")[:k]
    values, vectors = np.array(values)[order], np.array(vectors)[order]
    for number, value in enumerate(values, 1):  # the counts certify the numbers
        if not above(v, value + 16 * tol) < number <= above(v, value - 16 * tol):
            raise ArithmeticError(f"eigenvalue {number} is not certified by the counts")
    fine = values > 1e-12 * values[0]
    values, vectors = values[fine], vectors[fine]
    peak = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)]
    return values, vectors * np.sign(peak)[:, None]


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): rows whose vector is neither null nor holds null or non-finite entries, as integers."""
    fine = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    whole = F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + BASE)
    return vectors.where(F.col(embedding).isNotNull() & fine).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column, d long; shorter vectors are filled up with what an entry of zero becomes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == d).all():
        return flat.reshape(-1, d)
    out = np.full((len(sizes), d), BASE, flat.dtype)
    out[np.arange(d) < sizes[:, None]] = flat
    return out


def products(c: np.ndarray) -> np.ndarray:
    """Exact c'c of integers: as doubles where every sum fits, otherwise with integers of any length."""
    most = int(np.abs(c).max(initial=0))
    if len(c) * most * most < EXACT:
        c = c.astype(np.float64)
        return (c.T @ c).astype(np.int64).astype(object)
    c = c.astype(object)
    return c.T @ c


def _partial(d: int, of, kind: pa.DataType):
    """Adds up `of(batch)`, a (rows, d) array, over a partition; gives (i, j, value) once."""

    def run(batches):
        total = None
        for batch in batches:
            part = of(batch)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.nonzero(np.ones(total.shape, bool))
            value = total[i, j]
            value = [Decimal(int(x)) for x in value] if pa.types.is_decimal(kind) else value
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value, kind)], ["i", "j", "value"])

    return run


def _total(rows: DataFrame, shape: tuple[int, int], of, exact: bool) -> np.ndarray:
    """The sum of `of` over all batches as a matrix; partitions' sums meet in Spark, entry by entry."""
    kind, name = (pa.decimal128(38, 0), "decimal(38,0)") if exact else (pa.float64(), "double")
    parts = rows.mapInArrow(_partial(shape[1], of, kind), f"i int, j int, value {name}")
    out = np.zeros(shape, object if exact else np.float64)
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():  # as many rows as the matrix has entries
        out[i, j] = int(value) if exact else value
    return out


class Whitening:
    """Fitted on integer vectors (vec_id, x): n, dimensions d, sums, covariance, eigenvalues and components (rows)."""

    def __init__(self, vectors: DataFrame, components: int = COMPONENTS):
        self.n, d = vectors.agg(F.count("*"), F.max(F.size("x"))).first()
        self.d = d = d or 0
        if not d:
            self.sums, self.values, self.components, self.trace = [], np.empty(0), np.empty((0, 0)), 0.0
            return
        n = self.n
        sums = _total(vectors, (1, d), lambda b: _matrix(b.column("x"), d).astype(object).sum(0, keepdims=True), True)[0]
        self.sums = [int(s) for s in sums]
        whole = np.array([s // n for s in self.sums])
        gram = _total(vectors, (d, d), lambda b: products(_matrix(b.column("x"), d) - whole), True)
        rest = np.array([s % n for s in self.sums], object)
        exact = gram * n - np.outer(rest, rest)  # n^2 times the covariance
        self.covariance = np.array([[int(x) / (n * n) for x in row] for row in exact])
        self.trace = int(np.trace(exact)) / (n * n)
        self.values, self.components = leading(self.covariance, components)

    def transform(self, vectors: DataFrame) -> DataFrame:
        """vec_id, deviation, whitened (array): deviation is null where it does not fit a long."""
        n, d = self.n, self.d
        if not d:
            return vectors.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        whole, rest = np.array([s // n for s in self.sums]), np.array([s % n for s in self.sums])
        turn = (self.components / np.sqrt(self.values)[:, None]).T

        def run(batches):
            for batch in batches:
                c = _matrix(batch.column("x"), d) - whole
                most = n * (int(np.abs(c).max(initial=0)) + 1)
                kind = np.int64 if most * most * d < 2**63 else object
                off = c.astype(kind) * n - rest.astype(kind)
                deviation = [int(x) if x < 2**63 else None for x in (off * off).sum(1)]
                w = np.ascontiguousarray((c - rest / n) @ turn)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviation, pa.int64()), lists], ["vec_id", "deviation", "whitened"])

        return vectors.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, k: int, n: int) -> float:
    """Largest absolute entry of the covariance of `whitened` minus the identity; centred before multiplying."""
    if not k or not n:
        return 0.0

    def rows(batch):
        return batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)

    mean = _total(whitened, (1, k), lambda b: rows(b).sum(0, keepdims=True), False) / n

    def centred(batch):
        w = rows(batch) - mean
        return w.T @ w

    return float(np.abs(_total(whitened, (k, k), centred, False) / n - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable vector and component.

    Vectors that are null or hold null or non-finite entries drop out; shorter vectors are filled up with
    zero entries. Equal rows and rows without an id count each. There are fewer components where the
    covariance has no more eigenvalues above rounding, and none, so no rows, for equal vectors, vectors
    without entries and empty tables. Further columns are not read.
    """
    fitted = settle(usable(vectors, vec_id, embedding), "whole_vectors")
    model = Whitening(fitted, components)
    done = settle(model.transform(fitted), "whitened")
    error = identity_error(done, len(model.values), model.n)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    spread = done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return spread.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
