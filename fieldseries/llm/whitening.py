"""PCA whitening of embeddings, with eigenvectors refined beyond single precision.

1. Vectors become integers; each distinct one is in the fit list once (a written table).
2. Tasks sum the fit list, then its products, centred on the rounded mean.  Sums of integers in float64
   are exact up to 2**53, and what is left of the mean is taken out by exact fractions.
3. The covariance's eigenvectors in float32 are the start.  Ogita-Aishima iterations, matrix
   products in extended precision, double the right digits each time; eigenvalues too close for an iteration to
   tell apart are a cluster, which is solved on its own subspace.
4. The whitened fit list's own covariance is measured over all of it.

The driver holds d x d numbers, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, map_batches, materialise, small_batches

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this do not fit and count as not finite.
MOST = float(1 << 61)
#: Iterations at most; from float32 three or four are enough, and a cluster costs one more.
ITERATIONS = 20
#: Vectors that are multiplied at once.
TILE = 4096

High = np.longdouble


def scaled(vector: str) -> Column:
    """The vector's entries as integers; null for a vector that is null or empty or holds a null or non-finite entry."""
    entries = F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")) + F.lit(SHIFT))
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < MOST / SCALE, F.lit(False)))  # false for NaN: Spark orders it above all numbers
    return F.when(F.col(vector).isNotNull() & (F.size(vector) > 0) & fits, entries.cast("array<bigint>"))


def common_length(vectors: DataFrame) -> int:
    """The dimension that most vectors have, the larger of equals; 0 without vectors."""
    top = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top.d if top else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def _summed(fit: DataFrame, d: int) -> tuple[int, list[int], list[int], list[int]]:
    """n, and for each dimension the sum, the smallest and the largest entry."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, np.zeros(d, object), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                x = _matrix(batch.column(0).slice(at, TILE), d)
                n += len(x)
                near = len(x) * max(abs(int(x.min())), abs(int(x.max()))) < 1 << 62
                total = total + (x.sum(0).astype(object) if near else x.astype(object).sum(0))
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([str(int(t)) for t in total]), pa.array(low), pa.array(high)], ["j", "n", "total", "low", "high"])

    parts = fit.select("x").mapInArrow(task, "j int, n bigint, total string, low bigint, high bigint")
    rows = parts.groupBy("j").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("j").collect()
    return (rows[0].n if rows else 0), [int(r.total) for r in rows], [r.low for r in rows], [r.high for r in rows]


def _products(fit: DataFrame, d: int, of: np.ndarray, map_to: np.ndarray | None = None, less: np.ndarray | None = None) -> np.ndarray:
    """The sum over the fit list of y y', for y = x - of, or for y = (x - of - less) @ map_to."""
    k = d if map_to is None else map_to.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                y = (_matrix(batch.column(0).slice(at, TILE), d) - of).astype(np.float64)
                if map_to is not None:
                    y = (y - less) @ map_to
                total += y.T @ y
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])

    rows = fit.select("x").mapInArrow(task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((k, k))
    out[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["v"].to_numpy()
    return np.triu(out) + np.triu(out, 1).T


def clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within `width`, two or more together."""
    order = np.argsort(-values, kind="stable")
    ends = np.flatnonzero(-np.diff(values[order]) > width) + 1
    return [g for g in np.split(order, ends) if len(g) > 1]


def refined(a: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling, and unit eigenvectors as columns) of a symmetric matrix in extended precision.

    start: approximate eigenvectors; by default float32 ones.
    """
    d = len(a)
    size = High(np.abs(a).max(initial=0)) or High(1)
    a = np.asarray(a, High) / size
    x = np.asarray(np.linalg.eigh(a.astype(np.float32))[1] if start is None else start, High)
    one, norm = np.eye(d, dtype=High), np.sqrt((a * a).sum())
    change = High(np.inf)
    for _ in range(ITERATIONS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2  # else rounding over a small gap costs orthogonality
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        width = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        near = clusters(value, width)
        alone = np.ones((d, d), bool)
        for g in near:
            alone[np.ix_(g, g)] = False
        np.fill_diagonal(alone, False)
        gap = value[None, :] - value[:, None]
        e = np.where(alone, (s + value[None, :] * r) / np.where(alone, gap, 1), r / 2)
        x = x + x @ e
        for g in near:  # the subspace is right by now, the vectors in it are not: solve what is left of the matrix there
            own = x[:, g]
            inner = own.T @ (a @ own) - value[g].mean() * (own.T @ own)
            scale = np.abs(inner).max()
            if scale > 0:
                turn = np.asarray(np.linalg.eigh(((inner + inner.T) / (2 * scale)).astype(np.float64))[1], High)
                x[:, g] = own @ (turn @ (3 * np.eye(len(g), dtype=High) - turn.T @ turn)) / 2  # a rotation in extended precision too
        before, change = change, np.abs(e).max(initial=0)
        if change < 8 * np.finfo(High).eps or change < 1e-9 and change > before / 2:
            break  # right to the last digit, or to what the smallest gap lets be right
    x = x / np.sqrt((x * x).sum(0))
    value = (x * (a @ x)).sum(0)
    order = np.argsort(-value, kind="stable")
    return value[order] * size, x[:, order]


@dataclass
class Whitening:
    """What vectors need to be whitened: bounded by the dimension."""

    n: int
    sums: list[int]
    of: np.ndarray  # the mean, rounded
    less: np.ndarray  # mean - of
    values: np.ndarray
    share: np.ndarray
    project: np.ndarray  # columns: eigenvectors over the root of their values
    widest: int  # of |n * x - S|, over the fit list
    error: float = float("nan")


def fit_whitening(fit: DataFrame, d: int, k: int) -> Whitening:
    """fit: a written table of distinct vectors `x` of d entries."""
    n, sums, low, high = _summed(fit, d)
    of = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    left = [s - n * int(o) for s, o in zip(sums, of, strict=True)]
    less = np.array(left, High) / n
    v = (np.asarray(_products(fit, d, of), High) - np.outer(np.array(left, High), less)) / n
    values, vectors = refined(v)
    trace = np.trace(v)
    k = min(k, d, int((values > d * High(1e-12) * max(values[0], High(0))).sum()) if trace > 0 else 0)
    project = (vectors[:, :k] / np.sqrt(values[:k])).astype(np.float64)
    widest = max(max(abs(n * h - s), abs(n * lo - s)) for h, lo, s in zip(high, low, sums, strict=True))
    out = Whitening(n, sums, of, less.astype(np.float64), values[:k].astype(np.float64), (values[:k] / trace).astype(np.float64) if k else np.zeros(0), project, widest)
    if k:
        out.error = float(np.abs(_products(fit, d, of, project, out.less) / n - np.eye(k)).max())
    return out


def deviations(x: np.ndarray, w: Whitening) -> list[int | None]:
    """The sum of (n * x - S)^2 for each vector, exact; None where 64 bits do not hold it."""
    if len(w.sums) * w.widest * w.widest < 1 << 63 and w.n * max(abs(int(x.min())), abs(int(x.max()))) < 1 << 63 and max(map(abs, w.sums)) < 1 << 62:
        y = w.n * x - np.array(w.sums, np.int64)
        return (y * y).sum(1).tolist()
    y = x.astype(object) * w.n - np.array(w.sums, object)
    return [int(t) if t < 1 << 63 else None for t in (y * y).sum(1)]


def whiten(embeddings: DataFrame, k: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n, deviation, whitened (array), explained (array), identity_error: a row a usable row of embeddings.

    Rows whose vector is null or empty or holds null, NaN or infinite entries (or ones that 64 bits do not hold) are left
    out, and so are vectors of another length than most have.  Repeated rows count once in the fit list and are all
    returned; a null id stays null.  Components whose eigenvalue is zero to working precision are not returned, so
    that constant vectors give empty arrays; a deviation that a long does not hold is null.
    """
    spark, scratch = embeddings.sparkSession, []
    small_batches(spark)
    kind = dict(embeddings.dtypes)[id_col]
    usable = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).select("vec_id", scaled("v").alias("x")).filter("x is not null")
    fit = materialise(usable.select("x").distinct(), "vectors", scratch)
    d = common_length(usable)
    schema = f"vec_id {kind}, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    if not d:
        drop_scratch(spark, scratch)
        return spark.createDataFrame([], schema)
    w = fit_whitening(fit.filter(F.size("x") == d), d, k)
    drop_scratch(spark, scratch)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column(1), d)
        rows, kept = len(x), w.project.shape[1]
        y = ((x - w.of).astype(np.float64) - w.less) @ w.project
        at = pa.array(np.arange(rows + 1, dtype=np.int32) * kept)
        columns = [batch.column(0), pa.array([w.n] * rows, pa.int64()), pa.array(deviations(x, w), pa.int64()), pa.ListArray.from_arrays(at, pa.array(y.ravel())), pa.ListArray.from_arrays(at, pa.array(np.tile(w.share, rows))), pa.array([w.error] * rows, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(usable.filter(F.size("x") == d), work, schema)


def op12(embeddings: DataFrame, k: int = 16) -> DataFrame:
    """The contract's columns: a row a remaining row and component."""
    out = whiten(embeddings, k).select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
