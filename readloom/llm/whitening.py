"""Whitening of embeddings by spectrum slicing of their covariance.

Entries become integers (``floor(scale * c) + offset``), so counts, sums and
deviations are exact.  Spark makes the sums, then the covariance of the centred
vectors; a d x d matrix is all that reaches the driver, where

1. LDLᵀ factors of the shifted covariance (symmetric pivots of one or two rows)
   count the eigenvalues above the shift, by Sylvester's law of inertia;
2. bisection on these counts isolates each of the leading eigenvalues;
3. Rayleigh quotient iteration, started inside the interval, converges
   cubically; a quotient outside its interval sends it back to bisection;
4. counts just above and below every found value certify its number.

Eigenvalues that no shift can tell apart (closer than ``NEAR`` of the norm) form
one cluster: inverse iteration on as many vectors as the counts say, which are
made orthogonal to each other.  All others are orthogonal by themselves.

Results: rows with a null vector or with null or non-finite entries are left
out.  Shorter vectors count as padded by zeros.  Repeated rows and null ids take
part as they are.  Components whose eigenvalue is zero up to rounding (``d``
times the machine's precision of the norm) are left out, so equal vectors, a
single one, or an empty table give no rows.  ``deviation`` is null where it
exceeds a 64-bit integer.  Ties of eigenvalues leave the basis within the tied
space open.  Further columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.shared import stored

#: Distance, in parts of the norm, within which eigenvalues are one cluster.
NEAR = 1e-11
EPS = float(np.finfo(float).eps)
#: Groups in which the tasks' matrices are added up before the last sum.
SALTS = 64
_ALPHA = (1 + 17**0.5) / 8


def count_above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of a symmetric matrix above ``shift``: positive pivots of LDLᵀ of the shifted matrix."""
    a = a - shift * np.eye(len(a))
    found = 0
    while len(a):
        rest = np.abs(a[1:, 0])
        most = rest.max(initial=0.0)
        swap, pair = 0, False
        if abs(a[0, 0]) < _ALPHA * most:
            r = int(rest.argmax()) + 1
            other = np.abs(a[r])
            other[r] = 0.0
            sigma = other.max()
            if abs(a[0, 0]) * sigma < _ALPHA * most * most:
                swap = r
                pair = abs(a[r, r]) < _ALPHA * sigma
        if pair:
            order = np.concatenate(([0, swap], np.delete(np.arange(len(a)), [0, swap])))
            a = a[np.ix_(order, order)]
            e, c = a[:2, :2], a[2:, :2]
            found += 1 if np.linalg.det(e) < 0 else 2 * int(e[0, 0] + e[1, 1] > 0)
            a = a[2:, 2:] - c @ np.linalg.solve(e, c.T)
            continue
        if swap:
            order = np.arange(len(a))
            order[[0, swap]] = swap, 0
            a = a[np.ix_(order, order)]
        pivot, c = a[0, 0], a[1:, 0]
        found += int(pivot > 0)
        a = a[1:, 1:] - np.outer(c, c / pivot) if pivot else a[1:, 1:]
    return found


def _solve(a: np.ndarray, shift: float, x: np.ndarray, norm: float) -> np.ndarray:
    """Solution of the shifted system; a singular one is moved by a rounding step."""
    for step in (0.0, 4 * EPS * norm, 64 * EPS * norm):
        try:
            y = np.linalg.solve(a - (shift + step) * np.eye(len(a)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    return x


def rayleigh(a: np.ndarray, low: float, high: float, norm: float, start: np.ndarray) -> tuple[float, np.ndarray] | None:
    """The eigenpair of the one eigenvalue between ``low`` and ``high``, or None if the iteration left the interval."""
    x = start
    for _ in range(2):
        x = _solve(a, (low + high) / 2, x, norm)
        x /= np.linalg.norm(x)
    value, best = float(x @ a @ x), np.inf
    for _ in range(40):
        away = float(np.linalg.norm(a @ x - value * x))
        if away >= best / 2 and away <= 1e-12 * norm:
            break
        best = min(best, away)
        x = _solve(a, value, x, norm)
        x /= np.linalg.norm(x)
        value = float(x @ a @ x)
    slack = 8 * len(a) * EPS * norm
    return (value, x) if low - slack <= value <= high + slack and best <= 1e-11 * norm else None


def leading_eigenpairs(a: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``limit`` largest eigenvalues that aren't zero, falling, and their unit eigenvectors as columns."""
    d = len(a)
    norm = float(np.abs(a).sum(axis=1).max(initial=0.0))
    least = d * EPS * norm
    want = min(limit, count_above(a, least)) if norm > 0 else 0
    values, vectors = np.zeros(want), np.zeros((d, want))
    if not want:
        return values, vectors
    draw = np.random.default_rng(17)
    slack = 4 * d * EPS * norm
    todo = [(least, norm * (1 + 4 * EPS * d), count_above(a, least), 0)]
    while todo:
        low, high, below, above = todo.pop()
        if below == above or above >= want:
            continue
        if below - above == 1 and high - low <= norm / 8:
            got = rayleigh(a, low, high, norm, draw.standard_normal(d))
            if got is not None:
                value, x = got
                if count_above(a, value + slack) <= above < below <= count_above(a, value - slack):
                    values[above], vectors[:, above] = value, x
                    continue
        if high - low <= NEAR * norm:  # a cluster
            block = draw.standard_normal((d, below - above))
            for _ in range(4):
                block = np.linalg.qr(_solve(a, (low + high) / 2, block, norm))[0]
            small = block.T @ a @ block
            own, turn = np.linalg.eigh((small + small.T) / 2)
            for i, j in zip(range(above, min(below, want)), np.argsort(-own), strict=False):
                values[i], vectors[:, i] = own[j], block @ turn[:, j]
            continue
        middle = (low + high) / 2
        n = count_above(a, middle)
        n = min(max(n, above), below)
        todo += [(low, middle, below, n), (middle, high, n, above)]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(want)])
    return values, vectors * np.where(sign == 0, 1.0, sign)


def integer_entries(vectors: DataFrame, scale: int, offset: int, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, x array<long>`` of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.col(vec_col).isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter(F.coalesce(fine, F.lit(False)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c).cast("long") + offset).alias("x"))


def _rows(column: pa.Array, d: int, filler: int) -> np.ndarray:
    """Vectors of a batch as a matrix; shorter ones end in ``filler``."""
    flat, sizes = np.asarray(column.flatten()), np.asarray(column.value_lengths())
    if (sizes == d).all():
        return flat.reshape(len(column), d)
    out = np.full((len(column), d), filler, np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    for i, n in enumerate(sizes.tolist()):
        out[i, :n] = flat[at[i] : at[i] + n]
    return out


def summed(ints: DataFrame, make: Callable[[pa.Array], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum of the matrices that ``make`` gives for the batches: per task, then row by row in salted groups, then whole rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += make(batch.column(0))
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array([task] * shape[0], pa.int64()), pa.array([row.tobytes() for row in total], pa.binary())], ["i", "task", "m"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("task", kind="stable")  # the same order of additions in every run
        return pd.DataFrame({"i": group["i"].iloc[:1], "task": group["task"].iloc[:1], "m": [sum(np.frombuffer(m) for m in group["m"]).tobytes()]})

    kind = "i int, task long, m binary"
    parts = ints.select("x").mapInArrow(run, kind)
    some = parts.groupBy("i", F.pmod("task", F.lit(SALTS)).alias("salt")).applyInPandas(add, kind)
    out = np.zeros(shape)
    for row in some.groupBy("i").applyInPandas(add, kind).collect():  # one row of the matrix each
        out[row["i"]] = np.frombuffer(row["m"])
    return out


def whiten(vectors: DataFrame, limit: int = 32, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and leading component."""
    spark = vectors.sparkSession
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    ints = stored(integer_entries(vectors, scale, offset, id_col, vec_col), "whitening-vectors")
    n, d = ints.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if not n or not d:
        return spark.createDataFrame([], kind)
    sums = ints.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s"), F.count("x").alias("k")).collect()  # d rows
    total = np.zeros(d, np.int64)
    for r in sums:
        total[r["i"]] = r["s"] + (n - r["k"]) * offset

    def apart(column: pa.Array) -> np.ndarray:
        """``n * x - S``, exact."""
        return n * (_rows(column, d, offset) - offset) - (total - n * offset)

    def outer(column: pa.Array) -> np.ndarray:
        c = apart(column) / n
        return c.T @ c

    cov = summed(ints, outer, (d, d)) / n
    values, axes = leading_eigenpairs((cov + cov.T) / 2, limit)
    p = len(values)
    if not p:
        return spark.createDataFrame([], kind)
    explained = values / np.trace(cov)
    to_white = axes / np.sqrt(values)

    def moments(column: pa.Array) -> np.ndarray:
        w = apart(column) / n @ to_white
        return np.vstack((w.T @ w, w.sum(axis=0)))

    white = summed(ints, moments, (p + 1, p)) / n
    error = float(np.abs(white[:p] - np.outer(white[p], white[p]) - np.eye(p)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                z = apart(batch.column(1))
                m = batch.num_rows
                fits = (z.astype(float) ** 2).sum(axis=1) < 9.2e18
                deviation = pa.array(np.where(fits, (np.where(fits[:, None], z, 0) ** 2).sum(axis=1), 0), mask=~fits)
                pick = pa.array(np.repeat(np.arange(m), p))
                columns = [batch.column(0).take(pick), pa.array(np.tile(np.arange(1, p + 1, dtype=np.int32), m)), pa.array(np.full(m * p, n, np.int64)), deviation.take(pick), pa.array((z / n @ to_white).reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * p, error))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in kind.split(", ")])

    return ints.mapInArrow(run, kind)
