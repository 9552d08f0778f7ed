"""Embedding whitening with eigenvectors refined in mixed precision.

1. Vectors become whole numbers (``_vectors.scaled``); the fit list is each
   distinct vector once, written.
2. Count, sums and scatter of the fit list are whole numbers too, and stay
   exact: entries are centred at the integer nearest to the mean before they
   are multiplied, tasks multiply in blocks that cannot round, sums are decimals,
   and the rest of the mean (below one half) is taken off in integers.  So the
   covariance does not depend on how rows lie in tasks.  Tasks send d (d + 1) / 2
   cells each, summed by cell; the driver gets that many, whatever the rows.
3. The d x d eigenproblem: eigenvectors in float32, then Ogita-Aishima steps
   (matrix products only) in the widest float of numpy: from R = I - X'X and
   S = X'VX each step corrects X by X + XE, E_ij = (S_ij + w_j R_ij) / (w_j - w_i),
   or R_ij / 2 where w_i and w_j are closer than the error bound or ``CLOSE``.
   Eigenvalues that stay that close are a cluster, of which this finds the space: its
   columns J are turned by the solution, found the same way, of the small problem
   X_J'(V - m I)X_J, shifted by the cluster's mean and scaled, so that its gaps are wide.
4. Every row is projected on the leading components: an Arrow batch times a
   d x k matrix, which is broadcast.  A last pass over the fit list measures the
   covariance of the whitened values against the identity.

Defined cases: rows whose vector is null, empty, holds a null, a non-finite
entry or one beyond 2**54 are dropped, as are vectors of another length than the
commonest.  Null and repeated ids are kept, each row has its own result.
A component without variance (fewer distinct vectors than components, constant
data) has null ``whitened`` and takes no part in ``identity_error``, which is null
when no component has variance, as is ``explained`` when there is no variance at
all.  ``deviation`` is null where it does not fit a long.  Equal eigenvalues: any
orthogonal basis of their space, the same one for all rows.  An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemart.llm._shared import written
from livemart.llm._vectors import matrix, of_common_length, scaled

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")
CELLS = pa.schema([("cell", pa.int32()), ("value", pa.decimal128(38, 0))])
HIGH = np.longdouble
CLOSE = 1e-8  # relative gap below which corrections would lose the columns' orthogonality to rounding
ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: count, sums, leading eigenvalues and unit eigenvectors (columns), and its measured error."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: tuple[float | None, ...]
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of the rows of ``x``; columns without variance are nan."""
        centre = np.array([nearest(s, self.n) for s in self.sums], np.int64)
        rest = np.array([float(HIGH(s - self.n * int(c)) / HIGH(self.n)) for s, c in zip(self.sums, centre, strict=True)])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (x - centre - rest) @ self.vectors / np.sqrt(self.values), np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Per row the exact sum of (n * x - sum)^2, None where it exceeds a long."""
        size = self.n * max(int(np.abs(x).max(initial=0)), 1) + max(abs(s) for s in self.sums)
        kind = np.int64 if x.shape[1] * size * size < 1 << 63 else object
        far = x.astype(kind) * self.n - np.array(self.sums, dtype=kind)
        return [v if v < 1 << 63 else None for v in (far * far).sum(axis=1).tolist()]


def nearest(total: int, n: int) -> int:
    """The integer nearest to ``total / n``."""
    return (2 * total + n) // (2 * n)


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the rows of ``vectors`` (vec_id, embedding) that take part, written."""
    x, good = scaled()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), good.alias("good")).where("good")
    return of_common_length(written(rows.drop("good"), "whole-vectors"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield matrix(batch.column("x").slice(at, ROWS))


def _cells(values: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()),
                                       pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))], schema=CELLS)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cell 0: rows; then one cell per dimension."""
    total = None
    for x in _blocks(batches):
        found = np.r_[len(x), x.sum(axis=0)] if float(np.abs(x).max()) * len(x) < 2.0 ** 62 else np.r_[len(x), x.astype(object).sum(axis=0)]
        total = found.astype(object) if total is None else total + found.astype(object)
    if total is not None:
        yield _cells([int(v) for v in total])


def products(y: np.ndarray) -> np.ndarray:
    """y'y of whole numbers, exact: as doubles or longs where these cannot round or overflow."""
    most = float(np.abs(y).max(initial=0)) ** 2 * len(y)
    kind = np.float64 if most < 2.0 ** 53 else np.int64 if most < 2.0 ** 62 else object
    found = y.astype(kind)
    found = found.T @ found
    return found.astype(np.int64).astype(object) if kind is np.float64 else found.astype(object)


def _scatter(centre: list[int]):
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _blocks(batches):
            found = products(x - np.array(centre, np.int64))
            total = found if total is None else total + found
        if total is not None:
            yield _cells([int(v) for v in total[np.triu_indices(len(centre))]])
    return scatter


def _summed(cells: DataFrame) -> list[int]:
    """The cells' exact sums in cell order (as many as cells, whatever the tasks)."""
    found = cells.groupBy("cell").agg(F.sum("value").alias("value")).collect()
    return [int(r["value"]) for r in sorted(found, key=lambda r: r["cell"])]


def covariance(scatter: list[int], sums: list[int], n: int) -> np.ndarray:
    """V, correctly rounded to the wide float, from the scatter about the integers nearest to the means."""
    d = len(sums)
    rest = [s - n * nearest(s, n) for s in sums]
    v = np.empty((d, d), HIGH)
    for cell, i, j in zip(scatter, *np.triu_indices(d), strict=True):
        v[i, j] = v[j, i] = HIGH(str(n * cell - rest[i] * rest[j])) / HIGH(str(n * n))
    return v


def _norm(m: np.ndarray):
    return np.sqrt((m * m).sum())


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, HIGH, np.ndarray, HIGH]:
    """One Ogita-Aishima correction: (X, largest correction, eigenvalues, gap below which they are one cluster)."""
    r = np.eye(len(a), dtype=HIGH) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # else its rounding would enter E unevenly and cost orthogonality
    w = np.diag(s) / (1 - np.diag(r))
    close = max(2 * (_norm(s - np.diag(w)) + _norm(a) * _norm(r)), CLOSE)
    gap = w[None, :] - w[:, None]
    apart = np.abs(gap) > close
    e = np.where(apart, (s + w[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, np.abs(e).max(), w, close


def eigen(v: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix, refined in the wide float."""
    size = np.abs(v).max(initial=0)
    if size == 0:
        return np.zeros(len(v), HIGH), np.eye(len(v), dtype=HIGH)
    a = (v / size).astype(HIGH)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    tiny = 4 * np.finfo(HIGH).eps * len(a)
    last = None
    for _ in range(rounds):
        x, largest, w, close = _step(a, x)
        if largest <= tiny or (last is not None and last / 2 <= largest < 1e-9):
            break  # the rest is rounding
        last = largest
    x = x / np.sqrt((x * x).sum(axis=0))
    w = (x * (a @ x)).sum(axis=0)
    order = np.argsort(w)
    for group in np.split(order, np.flatnonzero(np.diff(w[order]) > close) + 1):
        if len(group) > 1:  # the space is found; its own directions from the small shifted problem
            mean = w[group].mean()
            small = x[:, group].T @ (a @ x[:, group] - mean * x[:, group])
            spread = np.abs(small).max()
            if spread > tiny:  # else equal as far as the wide float tells
                w_own, q = eigen((small + small.T) / 2, rounds)
                x[:, group], w[group] = x[:, group] @ q, mean + w_own
    order = np.argsort(-w, kind="stable")
    return w[order] * size, x[:, order]


def _moments(model: Whitening):
    """Sums of the whitened values and of their products, per task."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for x in _blocks(batches):
            w = np.nan_to_num(model.project(x))
            total = total + np.concatenate([w.sum(axis=0)[None], w.T @ w]).ravel()
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)],
                                             names=["cell", "value"])
    return moments


def fit(rows: DataFrame, components: int = 4) -> Whitening | None:
    """The whitening of ``rows`` (vec_id, x), each distinct x counting once; None without rows."""
    distinct = written(rows.select("x").distinct(), "fit-list")
    counts = _summed(distinct.mapInArrow(_sums, "cell int, value decimal(38,0)"))
    if not counts:
        return None
    n, *sums = counts
    centre = [nearest(s, n) for s in sums]
    v = covariance(_summed(distinct.mapInArrow(_scatter(centre), "cell int, value decimal(38,0)")), sums, n)
    trace = np.trace(v)
    values, vectors = eigen(v)
    values, vectors = values[:components], vectors[:, :components]
    values = np.where(values > np.finfo(np.float64).eps * len(sums) * trace, values, 0)
    share = tuple(float(e / trace) if trace > 0 else None for e in values)
    model = Whitening(n, tuple(sums), values.astype(np.float64), vectors.astype(np.float64), share)
    live = np.flatnonzero(model.values > 0)
    if not len(live):
        return model
    k = len(values)
    sent = distinct.mapInArrow(_moments(model), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("v"))
    found = np.array([r["v"] for r in sorted(sent.collect(), key=lambda r: r["cell"])]).reshape(k + 1, k) / n
    off = (found[1:] - np.outer(found[0], found[0]) - np.eye(k))[np.ix_(live, live)]
    return Whitening(n, model.sums, model.values, model.vectors, share, float(np.abs(off).max()))


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row of ``rows`` (vec_id, x)."""
    spark = rows.sparkSession
    if model is None:
        return spark.createDataFrame([], RESULT)
    shared = spark.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column("x"))
                again = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(again)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(again), model.n, np.int64)),
                    pa.array(model.deviation(x), pa.int64()).take(pa.array(again)),
                    pa.array(model.project(x).ravel(), from_pandas=True),
                    pa.array(list(model.explained) * len(x), pa.float64()),
                    pa.array([model.identity_error] * len(again), pa.float64())], names=[c.split()[0] for c in RESULT.split(", ")])
    return rows.select("vec_id", "x").mapInArrow(project, RESULT)
