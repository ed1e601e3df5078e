"""Embedding whitening: leading principal components by a block Jacobi-Davidson method on Spark.

The covariance V of the fit list is never formed.  Its only use is the product of V with a small
block of vectors, one Spark job: every task centres its rows by the exact mean and returns
``C^T (C B)`` for them, one partial of dimension times block width; partials are added in two
steps, so that the driver gets about the square root of the tasks' number of them.

Search space: Rayleigh-Ritz on an orthonormal basis, kept with its products.  Ritz pairs whose
residual is at double precision (``TOLERANCE`` times dimension times machine epsilon times the
largest eigenvalue) are locked in falling order and projected out.  For the others the correction
equation ``(I - QQ')(V - theta I)(I - QQ') t = -r`` is solved by a few MINRES steps, all columns in
lockstep, so that a step costs one Spark job for the whole block; the corrections widen the basis,
which is restarted from its best Ritz vectors when it is full.  The driver holds matrices of
dimension times basis width only.

Integers: an entry c becomes ``floor(64 c) + 1000000``.  Sums S are exact, and rows are centred
as ``(x - floor(S / n)) - (S mod n) / n``, so that the large common offset costs no digits.

Vectors that are null or hold null or non-finite entries take no part.  Where lengths differ, the
most common length is whitened (the longer at equal counts) and other vectors take no part.
Scaled entries beyond 2^40 count as 2^40.  Repeated rows and rows without an id
count and are returned like any other.  Components whose eigenvalue is below 1e-11 of the largest
can't be whitened in double precision and are left out, so equal vectors and an empty table give no
rows.  ``deviation`` is null where it doesn't fit a long.  Ties between eigenvalues: any orthonormal
basis, the same for all rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import Table, batches, read
from tidings.llm.vectors import matrices

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
LARGEST = 2.0 ** 40
GUARD = 8  # search vectors beyond the wanted ones
BLOCK = 32  # corrections at a time
INNER = 6  # MINRES steps for a correction
BASIS = 96  # widest search space beyond the locked vectors
TOLERANCE = 16
LEAST_SHARE = 1e-11
ROUNDS = 300
BLOCK_ROWS = 4096


def integers(m: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    return np.floor(np.clip(scale * m, -LARGEST, LARGEST)).astype(np.int64) + offset


class FitList:
    """The integer vectors of a table, written as blocks of rows; sums and products over all of them."""

    def __init__(self, vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET):
        self.spark = vectors.sparkSession

        def run(it):
            for b in it:
                ids = b.column("vec_id")
                for rows, m in matrices(b.column("embedding")):
                    if not m.shape[1]:
                        continue
                    x = integers(m, scale, offset)
                    for i in range(0, len(x), BLOCK_ROWS):
                        own = ids.take(pa.array(rows[i:i + BLOCK_ROWS]))
                        part = x[i:i + BLOCK_ROWS] - offset  # small numbers: 16 bits mostly
                        kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= part.min() and part.max() <= np.iinfo(k).max)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([m.shape[1]], pa.int32()), pa.array([len(own)], pa.int64()), pa.array([own.to_pylist()], pa.list_(pa.int64())),
                             pa.array([kind]), pa.array([part.astype(kind).tobytes()], pa.binary())], names=["dim", "rows", "ids", "kind", "x"])

        v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        self.table = Table(v.mapInArrow(run, "dim int, rows long, ids array<bigint>, kind string, x binary"), "whitening-blocks")
        self.offset = offset
        most = self.table.df().groupBy("dim").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
        self.dim, self.n = (most["dim"], most["n"]) if most else (0, 0)
        if self.n:
            self.sums = [int(s) for s in self._sums()]
            self.floor = np.array([s // self.n for s in self.sums], np.int64)
            self.rest = np.array([s % self.n for s in self.sums], np.int64)
            self.tasks = self.blocks().rdd.getNumPartitions()

    def blocks(self) -> DataFrame:
        return self.table.df().where(F.col("dim") == self.dim)

    def _sums(self) -> list:
        dim, offset = self.dim, self.offset

        def run(it):
            total = np.zeros(dim, object)
            for b in it:
                for kind, x, rows in zip(b.column("kind").to_pylist(), b.column("x"), b.column("rows").to_pylist()):
                    part = np.frombuffer(x.as_py(), kind).reshape(rows, dim)
                    total = total + part.astype(np.int64).sum(0).astype(object) + rows * offset  # at most 2^12 rows below 2^41 each
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array([str(t) for t in total])], names=["i", "s"])

        parts = self.blocks().select("kind", "x", "rows").mapInArrow(run, "i int, s string")
        return [r["s"] for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()]

    def total(self, work, shape: tuple[int, int]) -> np.ndarray:
        """Sum of ``work(centred rows)`` over blocks of rows."""
        dim, centre = self.dim, self.centring()

        def merged(it):
            out, seen = np.zeros(shape), False
            for b in it:
                for p in b.column("p"):
                    out += np.frombuffer(p.as_py()).reshape(shape)
                    seen = True
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["p"])

        def run(it):
            out, seen = np.zeros(shape), False
            for b in it:
                for kind, x, rows in zip(b.column("kind").to_pylist(), b.column("x"), b.column("rows").to_pylist()):
                    out += work(centre(np.frombuffer(x.as_py(), kind).reshape(rows, dim)))
                    seen = True
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["p"])

        parts = self.blocks().select("kind", "x", "rows").mapInArrow(run, "p binary")
        if self.tasks > 64:
            parts = parts.repartition(math.isqrt(self.tasks)).mapInArrow(merged, "p binary")
        return sum((np.frombuffer(r["p"]).reshape(shape) for r in parts.collect()), np.zeros(shape))

    def centring(self):
        """Stored block -> centred rows."""
        shift, rest = self.floor - self.offset, self.rest / self.n
        return lambda part: (part.astype(np.int64) - shift) - rest

    def product(self, b: np.ndarray) -> np.ndarray:
        """V b: one Spark job."""
        return self.total(lambda c: c.T @ (c @ b), b.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda c: np.array([[(c * c).sum()]]), (1, 1))[0, 0]) / self.n


def _orthonormal(t: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of what t adds to the given orthonormal columns."""
    for _ in range(3):
        for q in against:
            if q.shape[1]:
                t = t - q @ (q.T @ t)
        size = np.linalg.norm(t, axis=0)
        t = t[:, size > 1e-12] / size[size > 1e-12] if len(size) else t
        if not t.shape[1]:
            return t
        u, s, _ = np.linalg.svd(t, full_matrices=False)
        t = u[:, s > 1e-8]
    return t


def _minres(apply, b: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for one symmetric system a column, all in lockstep; ``apply`` takes and gives whole blocks."""
    def over(x, y):
        return np.divide(x, y, out=np.zeros_like(x), where=y != 0)

    beta = np.linalg.norm(b, axis=0)
    v_old, v = np.zeros_like(b), over(b, np.broadcast_to(beta, b.shape))
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    x, eta = np.zeros_like(b), beta.copy()
    c_old = c = np.ones_like(beta)
    s_old = s = np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        u = apply(v)
        alpha = (v * u).sum(0)
        u = u - alpha * v - beta * v_old
        beta_next = np.linalg.norm(u, axis=0)
        # two earlier rotations, then the one that removes beta_next
        r1 = c * alpha - c_old * s * beta
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        size = np.hypot(r1, beta_next)
        c_old, s_old = c, s
        c, s = over(r1, size), over(beta_next, size)
        w_next = over(v - r3 * w_old - r2 * w, np.broadcast_to(size, v.shape))
        w_old, w = w, w_next
        x = x + c * eta * w
        eta = -s * eta
        v_old, v = v, over(u, np.broadcast_to(beta_next, u.shape))
        beta = beta_next
    return x


def eigenpairs(product, dim: int, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors of the symmetric matrix behind ``product``."""
    k = min(k, dim)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dim, 0)), []
    w = _orthonormal(rng.standard_normal((dim, min(dim, k + GUARD))), [])
    aw = product(w)
    largest, residuals = 0.0, []
    for _ in range(ROUNDS):
        small = w.T @ aw
        theta, u = np.linalg.eigh((small + small.T) / 2)
        theta, u = theta[::-1], u[:, ::-1]
        w, aw = w @ u, aw @ u  # the basis is now the Ritz vectors
        largest = max([largest, abs(theta[0]) if len(theta) else 0.0, *values])
        limit = TOLERANCE * dim * np.finfo(float).eps * largest
        r = aw - w * theta
        r -= locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        full = locked.shape[1] + w.shape[1] == dim
        done = 0
        while done < w.shape[1] and size[done] <= limit and len(values) + done < k:
            done += 1
        # locked in falling order, unless a larger value has come up since
        values += theta[:done].tolist()
        locked = np.hstack([locked, w[:, :done]])
        w, aw, theta, r, size = w[:, done:], aw[:, done:], theta[done:], r[:, done:], size[done:]
        if len(values) >= k or not w.shape[1]:
            late = len(theta) and theta[0] > min(values) + limit and size[0] > limit
            if not late or full:
                break
            k += 1  # a direction that was found late: it is locked too, and the best are returned
        want = min(w.shape[1], max(k - len(values), 1), BLOCK)
        residuals.append(size[:want].max())
        if full:
            # nothing to add: fresh products of an orthonormal basis, until rounding is all that is left
            w = _orthonormal(w, [locked])
            aw = product(w)
            if len(residuals) > 4 and residuals[-1] > 0.5 * max(residuals[-4:-1]) and residuals[-1] < 1e-9 * largest:
                values += theta[:max(0, k - len(values))].tolist()
                locked = np.hstack([locked, w[:, np.argsort(-(w * aw).sum(0))][:, :len(values) - locked.shape[1]]])
                break
            continue
        x, shift = w[:, :want], theta[:want]
        q = np.hstack([locked, x])

        def project(t, q=q):
            return t - q @ (q.T @ t)

        t = _minres(lambda v: project(product(project(v)) - project(v) * shift), project(-r[:, :want]), INNER)
        if w.shape[1] + want > max(BASIS, 2 * (k - len(values)) + GUARD):  # restart
            keep = k - len(values) + GUARD
            w, aw = w[:, :keep], aw[:, :keep]
        room = dim - locked.shape[1] - w.shape[1]
        t = _orthonormal(np.hstack([t, r[:, :want]]), [locked, w])[:, :min(room, 2 * want)]
        if not t.shape[1]:
            t = _orthonormal(rng.standard_normal((dim, min(room, want))), [locked, w])
        w, aw = np.hstack([w, t]), np.hstack([aw, product(t)])
    else:
        raise RuntimeError(f"residuals didn't reach double precision in {ROUNDS} rounds: {residuals[-1]}")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order]


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector that takes part."""
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = FitList(vectors, scale, offset)
    if not fit.n:
        return fit.spark.createDataFrame([], out)
    values, vectors_ = eigenpairs(fit.product, fit.dim, components)
    keep = (values > 0) & (values > LEAST_SHARE * values.max())
    values, basis = values[keep], vectors_[:, keep]
    k = len(values)
    if not k:
        return fit.spark.createDataFrame([], out)
    explained = values / fit.trace()
    to_white = basis / np.sqrt(values)

    def moments(c):
        w = c @ to_white
        return np.vstack([w.sum(0), w.T @ w])

    m = fit.total(moments, (k + 1, k)) / fit.n
    error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max())
    n, centre, floor, rest, shift = fit.n, fit.centring(), fit.floor, fit.rest, fit.offset
    dim = fit.dim
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
                        ("explained", pa.float64()), ("identity_error", pa.float64())])

    def deviations(part):
        """Sum over dimensions of (n x - S)^2, exact."""
        gap = part.astype(np.int64) + shift - floor
        if dim * (n * (float(np.abs(gap).max()) + 1)) ** 2 < 2.0 ** 62:
            return (((n * gap - rest) ** 2).sum(1)).tolist()
        exact = ((gap.astype(object) * n - rest.astype(object)) ** 2).sum(1)
        return [int(x) if x < 1 << 63 else None for x in exact]

    def run(it):
        for b in it:
            for ids, kind, x in zip(b.column("ids"), b.column("kind").to_pylist(), b.column("x")):
                part = np.frombuffer(x.as_py(), kind).reshape(-1, dim)
                white = centre(part) @ to_white
                rows = len(part)
                at = np.repeat(np.arange(rows), k)
                yield from batches(schema, {
                    "vec_id": ids.values.take(pa.array(at)), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows), "n": np.full(rows * k, n),
                    "deviation": pa.array(deviations(part), pa.int64()).take(pa.array(at)), "whitened": white.ravel(),
                    "explained": np.tile(explained, rows), "identity_error": np.full(rows * k, error)})

    return fit.blocks().select("ids", "kind", "x").mapInArrow(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
