"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never multiplied out to a covariance.  A step makes one
pass over them: each task takes Xv of its rows, the next left vector u, and
adds up its part of X'u, the next right vector; only vectors of the
embedding's dimension reach the driver.  A left vector has as many entries as
there are rows; as it always lies in the range of X it is held as the short
vector w with u = Xw, and its products with earlier ones follow from X'u, so
that both sides are reorthogonalised in full (Golub and Kahan, 1965; Simon and
Zha, 2000).  The singular vectors of the small bidiagonal matrix turn the right
vectors into components, its singular values into deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import workers_import_package, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
_CHECKED = 16               # steps after a restart that must bring no new leading component
_LONG, _MOST = 2.0 ** 63, 2.0 ** 40    # of a long; of an entry


def integer_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): the rows whose vectors are whole, as integers floor(64 c) + 1000000."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = embeddings.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).where("size(v) > 0")
    rows = rows.where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= _MOST)))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(batch.num_rows, -1)


def _summed(fit: DataFrame, values: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over the batches of the fit list of `values(x)`, a short vector."""
    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                here = values(_matrix(batch))
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": np.arange(len(total), dtype=np.int32), "value": total})
    rows = fit.mapInArrow(part, f"at int, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows), np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r["at"]] = r["value"]
    return out


@dataclass(frozen=True)
class Whitening:
    n: int                      # vectors of the fit list
    sums: np.ndarray            # their sum, exact
    components: np.ndarray      # (dimension, components), orthonormal columns
    deviations: np.ndarray      # standard deviation along each component
    trace: float                # total variance
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = np.divmod(self.sums, self.n)      # no product of n and x, which could overflow
        return (x - whole) - rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / self.deviations


def bidiagonalise(product: Callable[[np.ndarray], tuple[np.ndarray, float]], dim: int, rank: int, wanted: int,
                  tolerance: float = 1e-13, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(components, singular values): the `wanted` leading right singular pairs of X, fewer if
    its rank is smaller.

    `product(w)` -> (X'Xw, |Xw|^2), one pass over the rows; `rank` bounds the rank.  Steps
    end when no wanted pair has a residual left, are then restarted at random across
    all vectors so far (a value that stands twice shows only to a new start), and
    end for good when that changes no wanted value, or when the dimension is used
    up.  The small matrix is bidiagonal but for the columns of restarts."""
    rng = np.random.default_rng(seed)
    right, left, seen = [], [], []      # v, w with u = Xw, X'u
    largest, restarted, before = 0.0, None, None

    def across(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for a in right:
                v = v - a * (a @ v)
        return v

    def fresh() -> np.ndarray:
        v = across(rng.standard_normal(dim))
        return v / np.linalg.norm(v)

    def pairs() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left and right coefficients and values of the small matrix, u'Xv of all steps."""
        small = np.stack(seen) @ np.stack(right, axis=1)
        p, s, qt = np.linalg.svd(small)
        return p, s, qt
    v, beta = fresh(), 0.0
    while True:
        w = v - beta * left[-1] if beta else v.copy()
        g, _ = product(w)
        for _ in range(2):              # u across all earlier left vectors
            for a, b in zip(left, seen):
                h = a @ g
                w, g = w - h * a, g - h * b
        alpha = float(np.sqrt(max(w @ g, 0.0)))
        largest = max(largest, alpha)
        right.append(v)
        if alpha <= 1e-12 * largest or alpha == 0.0:    # v lies where the rows do not vary
            left.append(np.zeros(dim))
            seen.append(np.zeros(dim))
            following = np.zeros(dim)
        else:
            left.append(w / alpha)
            seen.append(g / alpha)
            following = across(seen[-1] - alpha * v)
        m = len(right)
        if m >= min(dim, rank + 1):
            break
        beta = float(np.linalg.norm(following))
        settled, top = False, min(wanted, m)
        if m > wanted:
            p, s, qt = pairs()
            residual = np.stack(seen, axis=1) @ p[:, :top] - np.stack(right, axis=1) @ qt[:top].T * s[:top]
            settled = np.linalg.norm(residual, axis=0).max() <= tolerance * max(s[0], 1e-300)
        if settled and restarted is not None and m >= restarted + _CHECKED and before is not None and np.allclose(
                s[:top], before, rtol=1e-12, atol=0):
            break
        if settled and (restarted is None or m >= restarted + _CHECKED):
            restarted, before, beta, v = m, s[:top], 0.0, fresh()
        elif beta <= 1e-12 * max(largest, 1e-300):
            beta, v = 0.0, fresh()
        else:
            v = following / beta
    _, s, qt = pairs()
    keep = min(wanted, int((s > 1e-10 * max(s[0], 1e-300)).sum()))
    return np.stack(right, axis=1) @ qt[:keep].T, s[:keep]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """`vectors(x)`: integer vectors of one dimension, each once."""
    def first(x: np.ndarray) -> np.ndarray:
        return np.append(x.sum(axis=0), len(x))
    got = _summed(vectors, first, "long")
    n, sums = int(got[-1]), got[:-1]
    if n == 0:
        return Whitening(0, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)
    dim, base = len(sums), Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)

    def product(w: np.ndarray) -> tuple[np.ndarray, float]:
        def values(x: np.ndarray) -> np.ndarray:
            centred = base.centred(x)
            u = centred @ w
            return np.append(u @ centred, u @ u)
        out = _summed(vectors, values)
        return out[:-1], float(out[-1])
    trace = float(_summed(vectors, lambda x: np.array([np.square(base.centred(x)).sum()]))[0]) / n
    found, singular = bidiagonalise(product, dim, n - 1, components) if trace else (np.zeros((dim, 0)), np.zeros(0))
    done = Whitening(n, sums, found, singular / np.sqrt(n), trace)
    k = len(singular)
    if not k:
        return done

    def moments(x: np.ndarray) -> np.ndarray:
        y = done.whitened(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])
    out = _summed(vectors, moments) / n
    covariance = out[k:].reshape(k, k) - np.outer(out[:k], out[:k])
    return Whitening(n, sums, found, done.deviations, trace, float(np.abs(covariance - np.eye(k)).max()))


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def apply(vectors: DataFrame, model: Whitening) -> DataFrame:
    """Every row of `vectors(vec_id, x)` along every component: columns of RESULT."""
    k = len(model.deviations)
    explained = model.deviations ** 2 / model.trace if k else np.zeros(0)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x, rows = _matrix(batch), batch.num_rows
            exact = np.square(model.n * x - model.sums).sum(axis=1)      # wraps where it is too large
            large = np.square(model.n * model.centred(x)).sum(axis=1) >= _LONG
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
                "n": np.full(rows * k, model.n, np.int64),
                "deviation": pa.array(np.repeat(exact, k), pa.int64(), mask=np.repeat(large, k)),
                "whitened": model.whitened(x).ravel(), "explained": np.tile(explained, rows),
                "identity_error": np.full(rows * k, model.identity_error)})
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(project, RESULT)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component: vec_id, component (from 1, by falling variance),
    n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries (or of 2**40 and
    more, whose sums would leave a long) are dropped.
    Every dimension that occurs is a space of its own, fitted on its distinct
    vectors.  Components along which nothing varies are left out, so a space of a
    single vector gives no rows.  A deviation beyond a long is null.  Null and repeated
    ids keep their rows.  Other columns are not read.  An empty table gives an
    empty table."""
    spark = embeddings.sparkSession
    workers_import_package(spark)
    rows = integer_vectors(embeddings, id_col, vector_col).withColumn("dim", F.size("x"))
    # each vector once: copies are combined before the shuffle
    distinct = written(rows.groupBy("dim", "x").agg(F.lit(1).alias("one")).select("dim", "x"), "whitening-vectors")
    out = spark.createDataFrame([], RESULT)
    for dim in sorted(r["dim"] for r in distinct.select("dim").distinct().collect()):
        model = fit(distinct.where(F.col("dim") == dim).select("x"), components)
        out = out.unionByName(apply(rows.where(F.col("dim") == dim), model))
    return out
