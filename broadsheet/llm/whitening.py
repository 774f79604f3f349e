"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are turned into integer coordinates ``x = floor(scale * c) + shift``
and stored once.  The covariance ``V`` (divisor n, centred before multiplying)
is never formed: each pass over the stored rows computes ``V Q`` for a block
``Q`` of a few more columns than wanted, every task adding the ``d x p``
product of its rows and Spark summing the partial products.  A Chebyshev
polynomial of ``V``, applied by its three-term recurrence one pass a degree,
damps the eigenvalues under the block's least Ritz value and lifts those above;
then QR and a Rayleigh-Ritz step give new vectors.  The iteration stops when
the residual ``|V q - e q|`` of every wanted vector is under ``TOLERANCE``
times the largest eigenvalue; it fails, rather than returning a guess, if that
takes over ``MAX_ITERATIONS``.

Rows with a null vector, a null or non-finite entry, or another length than the
longest vector are left out of the fit list and the result.  Components with
eigenvalue zero are not returned (fewer than ``k`` for rank-deficient data, none
for one row).  An empty table gives no rows.  Each component's sign makes its
entry of greatest magnitude positive.  Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.session import materialise

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
DEGREE = 8
TOLERANCE = 1e-11
MAX_ITERATIONS = 200


def finite(vector: Column) -> Column:
    """Whether a vector exists and all its entries are finite numbers."""
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & ok


def coordinates(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    return F.transform(vector, lambda c: (F.floor(c.cast("double") * scale) + shift).cast("long"))


def _matrix(batch: pa.RecordBatch, at: int, d: int) -> np.ndarray:
    values = pc.list_flatten(batch.column(at)).to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(batch.num_rows, d)


@dataclass
class Covariance:
    """The covariance of stored rows ``x`` (array of longs), applied by passes over them."""

    rows: DataFrame
    n: int
    sums: np.ndarray  # exact per-dimension sums
    passes: int = 0

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    def apply(self, q: np.ndarray) -> tuple[np.ndarray, float]:
        """``V q`` and the trace of ``V``, by one pass over the rows."""
        d, p = q.shape
        mean, at = self.mean, self.rows.columns.index("x")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, trace = np.zeros((d, p)), 0.0
            for batch in batches:
                xc = _matrix(batch, at, d) - mean
                part += xc.T @ (xc @ q)
                trace += float(np.einsum("ij,ij->", xc, xc))
            i, j = np.divmod(np.arange(d * p), p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(j, 0), pa.int32()),
                 pa.array(np.append(part.ravel(), trace))],
                ["i", "j", "v"],
            )

        summed = self.rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
        out, trace = np.zeros((d, p)), 0.0
        for r in summed.collect():
            if r["i"] < 0:
                trace = r["v"]
            else:
                out[r["i"], r["j"]] = r["v"]
        self.passes += 1
        return out / self.n, trace / self.n


def _filter(cov: Covariance, q: np.ndarray, vq: np.ndarray, degree: int, cut: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of ``V`` applied to ``q``: small on [0, cut], scaled to one at ``top``.

    The scaled three-term recurrence of -V keeps the block's entries near one
    in size; ``vq`` is ``V q`` already at hand.
    """
    a, b = -cut, 0.0  # the damped interval of -V
    e, c = (b - a) / 2, (b + a) / 2
    sigma = e / (-top - c)
    tau = 2 / sigma
    y = (-vq - c * q) * (sigma / e)
    x = q
    for _ in range(1, degree):
        sigma_new = 1 / (tau - sigma)
        ny = (-cov.apply(y)[0] - c * y) * (2 * sigma_new / e) - (sigma * sigma_new) * x
        x, y, sigma = y, ny, sigma_new
    return y


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = q.T @ vq
    values, z = np.linalg.eigh((h + h.T) / 2)
    order = np.argsort(-values, kind="stable")
    return values[order], q @ z[:, order], vq @ z[:, order]


def eigenpairs(cov: Covariance, d: int, k: int = COMPONENTS, degree: int = DEGREE, tolerance: float = TOLERANCE):
    """The ``k`` greatest eigenvalues of ``V``, their unit vectors (columns) and the trace."""
    p = min(d, max(2 * k, k + 16))
    q, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((d, p)))
    vq, trace = cov.apply(q)
    values, q, vq = _ritz(q, vq)
    for _ in range(MAX_ITERATIONS):
        top = max(values[0], 0.0)
        residual = np.linalg.norm(vq[:, :k] - q[:, :k] * values[:k], axis=0)
        if top <= 0 or residual.max() <= tolerance * top or p == d and residual.max() <= 1e-9 * top:
            break
        cut = max(values[-1], 0.0) if p < d else 0.0
        if p == d or cut >= top:
            # The block spans everything: Rayleigh-Ritz alone is exact up to rounding.
            y = vq
        else:
            y = _filter(cov, q, vq, degree, cut, top)
        q, _ = np.linalg.qr(y)
        vq, trace = cov.apply(q)
        values, q, vq = _ritz(q, vq)
    else:
        raise RuntimeError("the eigenvectors were not certified")
    keep = values[:k] > max(values[0], 0.0) * 1e-12
    vectors = q[:, :k][:, keep]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[:k][keep], vectors, trace


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """Per kept row and component: key, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    spark = vectors.sparkSession
    fit = vectors.where(finite(F.col(f"`{vector}`"))).select(
        F.col(f"`{key}`").alias("key"), coordinates(F.col(f"`{vector}`")).alias("x")
    )
    d = fit.agg(F.max(F.size("x"))).first()[0] or 0
    rows = materialise(fit.where(F.size("x") == d))
    sums = rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    n = rows.count()
    kind = rows.schema["key"].dataType.simpleString()
    if n == 0 or d == 0:
        empty = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], empty).withColumnRenamed("key", key)
    s = np.zeros(d, np.int64)
    for r in sums:
        s[r["pos"]] = r["s"]
    cov = Covariance(rows, n, s)
    values, q, trace = eigenpairs(cov, d, k)
    scaled = q / np.sqrt(values)
    # Covariance of the whitened values, from one more pass: scaledᵀ V scaled.
    check = scaled.T @ cov.apply(scaled)[0] if len(values) else np.zeros((0, 0))
    identity_error = float(np.abs(check - np.eye(len(values))).max()) if len(values) else 0.0
    mean, m = cov.mean, len(values)
    nx = F.zip_with("x", F.array(*[F.lit(int(v)) for v in s]), lambda a, b: (F.lit(n) * a - b).cast("decimal(38,0)"))
    deviation = F.aggregate(nx, F.lit(0).cast("decimal(38,0)"), lambda acc, v: acc + v * v).cast("long")
    base = rows.select("key", deviation.alias("deviation"), "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = (_matrix(batch, 2, d) - mean) @ scaled
            take = pa.array(np.repeat(np.arange(batch.num_rows), m))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), batch.num_rows)), pa.array(w.ravel())],
                ["key", "deviation", "component", "whitened"],
            )

    # One narrow pass over the stored rows; components are rows of their own.
    projected = base.mapInArrow(run, f"key {kind}, deviation long, component int, whitened double")
    explained = F.element_at(F.array(*[F.lit(float(v / trace)) for v in values]), F.col("component"))
    return projected.select(
        F.col("key").alias(key),
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(identity_error).alias("identity_error"),
    )
