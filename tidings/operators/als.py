"""Explicit-feedback matrix factorisation by alternating ridge regression.

One half-step solves, for every key (user or article),

    x = (lambda * I + sum_r v v^T)^-1 * sum_r rating * v

over that key's rating rows r, with v the fixed factors of the other side.
lambda is *not* scaled by the rating count (so MLlib ALS, which weights it by
the count, is not a drop-in replacement).  Duplicate ratings count once each.

Plan, built for skew and scale:

* ``layout_side`` runs once per side and training: ratings get a ``salt`` (0
  for normal keys, ``ceil(count / rows_per_group)`` buckets for hot keys) and a
  block id ``blk`` from (key, salt), and are written once as a table bucketed
  by ``blk`` in the shared checkpoint folder.  Every later read is known to be
  hash-partitioned by block, so no half-step shuffles the ratings again.
* broadcast plan (factor table size proven by its row count): the factors go to
  every executor as numpy arrays; ratings never carry factors to Python.  A block
  arrives as a stream of Arrow batches in the order of (key, salt); the kernel keeps the
  sums of the run that is still open and finishes all others, so its memory
  depends on neither the block's nor a key's number of rows.
* block plan (larger factor tables): one copy of each needed factor per block
  (the distinct (factor id, block) pairs are computed once), cogrouped by block
  with the ratings; the kernel looks factors up in numpy.  A cogroup holds its block: there are at
  most as many blocks as Spark allows buckets, so beyond some 1e11 ratings blocks grow.
  Where few ratings share a factor within a block there are nearly as many copies as ratings, so
  blocks are worked off in waves and a wave's copies are deleted before the next one's are made.
* either kernel reduces each (key, salt) run to the Gram matrix and right-hand
  side and solves normal keys in one batched ``np.linalg.solve``.  Hot keys
  emit packed partial sums instead; those are added as arrays, key by key, in
  partitions sorted by key, and solved.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.vectors import dot, init_vector, squared_norm
from tidings.session import (DEFAULT_ITERATIONS, DEFAULT_LAMBDA, DEFAULT_RANK, checkpoint_dir, delete_path, discard, freeing_shuffles,
                             materialize, materialize_parts, materialized)

# a group above this many rating rows is split into salt buckets
DEFAULT_ROWS_PER_GROUP = 1_000_000
# target rows per partition of a laid-out side
DEFAULT_ROWS_PER_PARTITION = 4_000_000
# target rating rows per block (the unit of the non-broadcast half-step)
DEFAULT_ROWS_PER_BLOCK = 1_000_000
# largest factor table shipped to every executor; each one passes through the driver, and a job ships one a half-step
DEFAULT_MAX_BROADCAST_BYTES = 16 * 1024 * 1024
# copies of factors dealt to rating blocks at a time; more are dealt in waves, of a block a core at least
DEFAULT_WAVE_BYTES = 1024 ** 3
# hot-key table is broadcast below this many keys (<= rows / rows_per_group)
_MAX_HOT_KEYS_BROADCAST = 2_000_000

# rows and keys of a tile: what a kernel gathers factors and Gram matrices for at a time
_TILE_ROWS, _TILE_KEYS = 262_144, 4_096

_HALF_STEP_SCHEMA = "id long, salt int, hot boolean, x array<double>"
_EMPTY_OUT = pa.table({"id": pa.array([], pa.int64()), "salt": pa.array([], pa.int32()),
                       "hot": pa.array([], pa.bool_()), "x": pa.array([], pa.list_(pa.float64()))})
_FACTORS_SCHEMA = "id long, f array<double>"


def layout_partitions(spark, n_rows: int) -> int:
    """About DEFAULT_ROWS_PER_PARTITION rows per partition at scale; small inputs use at
    most one partition per core (and at least ~20k rows each), not the session's default."""
    by_size = -(-n_rows // DEFAULT_ROWS_PER_PARTITION)
    by_cores = min(spark.sparkContext.defaultParallelism, -(-n_rows // 20_000))
    return max(1, by_size, by_cores)


def factor_bytes(k: int) -> int:
    """Upper estimate of one factor row in a broadcast relation."""
    return 8 * k + 64


@dataclass
class SideLayout:
    """Ratings of one side, keyed, salted, partitioned and checkpointed."""

    data: DataFrame  # key, other, rating, hot, salt, blk
    key: str
    other: str
    partitions: int
    n_hot: int = -1  # number of salted keys; -1 = unknown
    blocks: int = 1  # rating blocks: blk = pmod(xxhash64(key, salt), blocks)
    _needs: DataFrame | None = None
    _n_keys: int | None = None
    _n_copies: int | None = None
    table: str | None = None  # catalog name of the bucketed layout, if written
    path: str | None = None   # its files
    held: list = field(default_factory=list)  # broadcast factors of half-steps that may still run
    written: list = field(default_factory=list)  # tables that such half-steps read

    def free(self) -> None:
        """Drop what half-steps that have been materialized were sent or have written."""
        while self.held:
            self.held.pop().destroy()
        while self.written:
            discard(self.written.pop())

    def release(self) -> None:
        """Drop the layout, its files and what was sent, once everything reading it has been materialized."""
        self.free()
        discard(self._needs)
        if self.table:
            spark = self.data.sparkSession
            spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            delete_path(spark, self.path)
            self.table = None

    def n_keys(self) -> int:
        """Distinct keys (counted once): every key with a rating gets a factor in training."""
        if self._n_keys is None:
            with freeing_shuffles(self.data.sparkSession):
                self._n_keys = self.data.select(self.key).distinct().count()
        return self._n_keys

    def needs(self) -> DataFrame:
        """(_fid, _blks): the blocks that need a fixed-side factor, one row a factor (computed once)."""
        if self._needs is None:
            pairs = self.data.select(F.col(self.other).alias("_fid"), "blk")
            self._needs = materialize(pairs.groupBy("_fid").agg(F.collect_set("blk").alias("_blks")), "needs")
        return self._needs

    def n_copies(self) -> int:
        """Copies of fixed-side factors that all blocks need together (counted once)."""
        if self._n_copies is None:
            self._n_copies = self.needs().agg(F.sum(F.size("_blks"))).first()[0] or 0
        return self._n_copies

    def placed(self, fixed: DataFrame) -> DataFrame:
        """(_fid, f, _blks): each needed factor with the blocks that get a copy."""
        return fixed.select(F.col("id").alias("_fid"), "f").join(self.needs(), "_fid")

    def waves(self, copy_bytes: int) -> list[tuple[int, int]]:
        """Ranges of blocks that are worked off one after the other, as evenly as they go."""
        if self.table is None or copy_bytes <= DEFAULT_WAVE_BYTES:  # a layout that isn't written would be made again for each
            return [(0, self.blocks)]
        size = max(int(self.blocks * DEFAULT_WAVE_BYTES / copy_bytes), self.data.sparkSession.sparkContext.defaultParallelism)
        size = -(-self.blocks // -(-self.blocks // size))
        return [(i, min(i + size, self.blocks)) for i in range(0, self.blocks, size)]


def layout_side(ratings: DataFrame, key: str, other: str, rows_per_group: int = DEFAULT_ROWS_PER_GROUP,
                partitions: int | None = None, seed: int = 17, checkpoint: bool = True,
                n_rows: int | None = None, rows_per_block: int = DEFAULT_ROWS_PER_BLOCK) -> SideLayout:
    """Salt hot keys, give each (key, salt) a block, partition by block, sort, and (by default) checkpoint.

    The hot-key table is broadcast only under its counted size (or, unchecked,
    under the bound ``n_rows / rows_per_group``); beyond that it is a shuffle
    join, whose skewed side AQE splits.
    """
    spark = ratings.sparkSession
    r = ratings.select(key, other, "rating").where(F.col("rating").isNotNull())
    if n_rows is None:
        with freeing_shuffles(spark):
            n_rows = r.count()
    parts = partitions or layout_partitions(spark, n_rows)
    if n_rows <= rows_per_group:
        # no key can exceed the threshold: skip the per-key count entirely
        n_hot = 0
        keyed = r.withColumn("n_salt", F.lit(None).cast("int"))
    else:
        counts = r.groupBy(key).count()
        hot = (counts.where(F.col("count") > rows_per_group)
               .select(key, F.ceil(F.col("count") / F.lit(rows_per_group)).cast("int").alias("n_salt")))
        n_hot = -1
        if checkpoint:
            hot = materialize(hot, "hot_keys")  # the per-key count runs once; the hot table is tiny
            n_hot = hot.count()
        # broadcast under the exact count when known, else under the bound rows / rows_per_group
        size = n_hot if n_hot >= 0 else n_rows // max(1, rows_per_group)
        hot_side = F.broadcast(hot) if size <= _MAX_HOT_KEYS_BROADCAST else hot
        keyed = r.join(hot_side, key, "left")
    # a block is one kernel group and one bucket file
    blocks = min(max(parts, -(-n_rows // rows_per_block)), max_buckets(spark))
    salted = (keyed
              .withColumn("hot", F.col("n_salt").isNotNull())
              .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64(other, "rating", F.lit(seed)), F.col("n_salt")))
                          .otherwise(F.lit(0)).cast("int"))
              .drop("n_salt")
              .withColumn("blk", F.pmod(F.xxhash64(key, "salt"), F.lit(blocks)).cast("int")))
    table = path = None
    if checkpoint:
        salted, table, path = _bucketed_table(salted, blocks, key)
    return SideLayout(salted, key, other, blocks, n_hot, blocks, table=table, path=path)


def max_buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))


def _bucketed_table(df: DataFrame, buckets: int, key: str) -> tuple[DataFrame, str, str]:
    """Write ``df`` bucketed by ``blk`` under the shared checkpoint folder and read it back.

    A durable cut of lineage whose reads Spark knows to be hash-partitioned by
    ``blk``: grouping or cogrouping by block then needs no exchange of the ratings,
    in every half-step.  One writer task per bucket keeps one sorted file per bucket.
    """
    spark = df.sparkSession
    name = f"tidings_layout_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    with freeing_shuffles(spark):
        (df.repartition(buckets, "blk").write.bucketBy(buckets, "blk").sortBy("blk", key, "salt")
         .option("path", path).saveAsTable(name))
    return spark.table(name), name, path


# ---------------------------------------------------------------- kernels

def _segments(keys: np.ndarray, salts: np.ndarray):
    n = len(keys)
    if n == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    change = np.flatnonzero((keys[1:] != keys[:-1]) | (salts[1:] != salts[:-1])) + 1
    return np.r_[0, change], np.r_[change, n]


def _list_column(rows: np.ndarray) -> pa.Array:
    """(m, d) float64 -> Arrow list<double> with m entries of length d."""
    m, d = rows.shape if rows.ndim == 2 else (0, 0)
    offsets = pa.array(np.arange(m + 1, dtype=np.int32) * d, type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1), type=pa.float64()))


def _factor_matrix(col: pa.ChunkedArray | pa.Array, n: int, k: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if flat.size != n * k:
        raise ValueError(f"factor vectors must all have length {k}")
    # offsets may not start at 0 after slicing; flatten() already honours them
    return flat.reshape(n, k)


def _emit(ids, salts, hots, gram, rhs, k, lam, iu):
    """Finish groups: solve normal ones, pack hot ones."""
    hots = np.asarray(hots, dtype=bool)
    rows = []
    if (~hots).any():
        a = gram[~hots] + lam * np.eye(k)[None, :, :]
        x = np.linalg.solve(a, rhs[~hots][:, :, None])[:, :, 0]
        rows.append((np.asarray(ids)[~hots], np.asarray(salts)[~hots], np.zeros((~hots).sum(), bool), x))
    if hots.any():
        packed = np.concatenate([gram[hots][:, iu[0], iu[1]], rhs[hots]], axis=1)
        rows.append((np.asarray(ids)[hots], np.asarray(salts)[hots], np.ones(hots.sum(), bool), packed))
    for i, s, h, x in rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int64()), pa.array(s, pa.int32()), pa.array(h, pa.bool_()), _list_column(x)],
            names=["id", "salt", "hot", "x"])


def _tiles(starts: np.ndarray, ends: np.ndarray):
    """(first run, past the last run) of consecutive runs within the tile bounds; one run at least."""
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _TILE_ROWS, side="right")))
        j = min(j, i + _TILE_KEYS, n)
        yield i, j
        i = j


def _run_sums(fm: np.ndarray, r: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int):
    """Gram matrix and right-hand side of each run of rows."""
    gram = np.empty((len(starts), k, k))
    for g, (s, e) in enumerate(zip(starts, ends)):
        gram[g] = fm[s:e].T @ fm[s:e]
    return gram, np.add.reduceat(fm * r[:, None], starts, axis=0)


def _solve_runs(keys, salts, hot, at, fmat, r, k: int, lam: float, iu) -> pa.Table:
    """Rows of one block in any order, ``at`` their factors' places -> per (key, salt): solved factor, or packed partial sums if hot."""
    if len(keys) == 0:
        return _EMPTY_OUT
    srt = np.lexsort((salts, keys))
    keys, salts, hot, r, at = keys[srt], salts[srt], hot[srt], r[srt], at[srt]
    starts, ends = _segments(keys, salts)
    batches = []
    for i, j in _tiles(starts, ends):
        s, e = starts[i:j], ends[i:j]
        gram, rhs = _run_sums(fmat[at[s[0]:e[-1]]], r[s[0]:e[-1]], s - s[0], e - s[0], k)
        batches += _emit(keys[s], salts[s], hot[s], gram, rhs, k, lam, iu)
    return pa.Table.from_batches(batches) if batches else _EMPTY_OUT


def _look_up(block: pa.Table, fid: np.ndarray, fmat: np.ndarray, key: str, other: str, k: int, lam: float, iu) -> pa.Table:
    """One rating block and factors sorted by id; a rating without a factor takes no part."""
    oth = block.column(other).to_numpy()
    if not len(oth) or not len(fid):
        return _EMPTY_OUT
    at = np.minimum(np.searchsorted(fid, oth), len(fid) - 1)
    found = fid[at] == oth
    return _solve_runs(block.column(key).to_numpy()[found], block.column("salt").to_numpy()[found],
                       block.column("hot").to_numpy(zero_copy_only=False)[found], at[found], fmat,
                       block.column("rating").to_numpy()[found], k, lam, iu)


def _sorted_factors(ids, col, k: int):
    fid = ids.to_numpy()
    fmat = _factor_matrix(col, len(fid), k)
    o = np.argsort(fid, kind="stable")
    return fid[o], fmat[o]


def _ascending(keys: np.ndarray, salts: np.ndarray) -> bool:
    return bool(((keys[1:] > keys[:-1]) | ((keys[1:] == keys[:-1]) & (salts[1:] > salts[:-1]))).all())


def _stream_kernel(bc, key: str, other: str, k: int, lam: float):
    """One rating block (groupBy blk) as batches in the order of (key, salt); the factors came as a broadcast."""
    iu = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fid, fmat = bc.value
        if not len(fid):
            return
        last = gram_open = rhs_open = None  # the run that may go on: (key, salt, hot) and its sums
        for b in batches:
            oth = b.column(other).to_numpy()
            at = np.minimum(np.searchsorted(fid, oth), len(fid) - 1)
            found = np.flatnonzero(fid[at] == oth)  # a rating without a factor takes no part
            if not len(found):
                continue
            keys, salts = b.column(key).to_numpy()[found], b.column("salt").to_numpy()[found]
            hot = b.column("hot").to_numpy(zero_copy_only=False)[found]
            r, at = b.column("rating").to_numpy()[found], at[found]
            starts, ends = _segments(keys, salts)
            ids, parts, hots = keys[starts], salts[starts], hot[starts]
            if last is not None and (ids[0], parts[0]) < last[:2] or not _ascending(ids, parts):
                raise RuntimeError("ratings of a block must come in the order of key and salt")
            for i, j in _tiles(starts, ends):
                s, e = starts[i:j], ends[i:j]
                gram, rhs = _run_sums(fmat[at[s[0]:e[-1]]], r[s[0]:e[-1]], s - s[0], e - s[0], k)
                if last is not None:
                    if (ids[i], parts[i]) == last[:2]:
                        gram[0] += gram_open
                        rhs[0] += rhs_open
                    else:
                        yield from _emit(*[[x] for x in last], gram_open[None], rhs_open[None], k, lam, iu)
                last, gram_open, rhs_open = (ids[j - 1], parts[j - 1], hots[j - 1]), gram[-1].copy(), rhs[-1].copy()
                if j - i > 1:
                    yield from _emit(ids[i:j - 1], parts[i:j - 1], hots[i:j - 1], gram[:-1], rhs[:-1], k, lam, iu)
        if last is not None:
            yield from _emit(*[[x] for x in last], gram_open[None], rhs_open[None], k, lam, iu)

    return run


def _sum_runs(width: int):
    """Adds the arrays ``x`` of each ``id``; batches come in the order of id, one sum stays open between them."""

    def run(batches):
        last = total = None
        for b in batches:
            if not b.num_rows:
                continue
            ids, x = b.column("id").to_numpy(), _factor_matrix(b.column("x"), b.num_rows, width)
            starts = np.r_[0, np.flatnonzero(ids[1:] != ids[:-1]) + 1]
            sums, ids = np.add.reduceat(x, starts, axis=0), ids[starts]
            if last is not None:
                if ids[0] == last:
                    sums[0] += total
                else:
                    sums, ids = np.vstack([total, sums]), np.r_[last, ids]
            last, total = ids[-1], sums[-1].copy()
            if len(ids) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(ids[:-1], pa.int64()), _list_column(sums[:-1])], names=["id", "p"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), _list_column(total[None])], names=["id", "p"])

    return run


def _merged(partials: DataFrame, k: int) -> DataFrame:
    """``id, p`` : the packed partial sums of every key, added."""
    ordered = partials.select("id", "x").repartition("id").sortWithinPartitions("id")
    return ordered.mapInArrow(_sum_runs(k * (k + 1) // 2 + k), "id long, p array<double>")


def _packed_solver(k: int, lam: float):
    iu = np.triu_indices(k)
    t = len(iu[0])

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            p = _factor_matrix(batch.column("p"), n, t + k)
            gram = np.zeros((n, k, k))
            gram[:, iu[0], iu[1]] = p[:, :t]
            gram[:, iu[1], iu[0]] = p[:, :t]
            a = gram + lam * np.eye(k)[None, :, :]
            x = np.linalg.solve(a, p[:, t:][:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([batch.column("id"), _list_column(x)], names=["id", "f"])

    return run


def _block_kernel(key: str, other: str, k: int, lam: float):
    """One rating block (cogroup by blk) with its copies of the factors."""
    iu = np.triu_indices(k)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return _EMPTY_OUT
        return _look_up(left, *_sorted_factors(right.column("_fid"), right.column("f"), k), key, other, k, lam, iu)

    return run


def _residual_kernel(key: str, other: str, lam: float):
    """One rating block with its copies of the fixed factors and its keys' solved ones.

    Per (key, salt) the sums of v (v.x - rating); of normal keys, which are whole, the residual.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = right.column("own").to_numpy(zero_copy_only=False)
        both = [right.filter(pa.array(mask)) for mask in (~own, own)]
        if not left.num_rows or not all(t.num_rows for t in both):
            return _EMPTY_OUT
        k = len(both[0].column("f")[0])
        (fid, fmat), (xid, xmat) = (_sorted_factors(t.column("_fid"), t.column("f"), k) for t in both)
        keys, oth, salts = (left.column(c).to_numpy() for c in (key, other, "salt"))
        at, of = np.minimum(np.searchsorted(fid, oth), len(fid) - 1), np.minimum(np.searchsorted(xid, keys), len(xid) - 1)
        found = np.flatnonzero((fid[at] == oth) & (xid[of] == keys))
        if not len(found):
            return _EMPTY_OUT
        found = found[np.lexsort((salts[found], keys[found]))]
        keys, salts, at, of = keys[found], salts[found], at[found], of[found]
        hot, r = left.column("hot").to_numpy(zero_copy_only=False)[found], left.column("rating").to_numpy()[found]
        starts, ends = _segments(keys, salts)
        batches = []
        for i, j in _tiles(starts, ends):
            rows, s = slice(starts[i], ends[j - 1]), starts[i:j]
            v, x = fmat[at[rows]], xmat[of[s]]
            miss = np.einsum("ij,ij->i", v, xmat[of[rows]]) - r[rows]
            sums = np.add.reduceat(v * miss[:, None], s - s[0], axis=0)
            for part, h in ((~hot[s], False), (hot[s], True)):
                if part.any():
                    value = sums[part] if h else np.abs(sums + lam * x).max(axis=1)[part][:, None]
                    batches.append(pa.RecordBatch.from_arrays(
                        [pa.array(keys[s][part], pa.int64()), pa.array(salts[s][part], pa.int32()), pa.array(hot[s][part], pa.bool_()),
                         _list_column(value)], names=["id", "salt", "hot", "x"]))
        return pa.Table.from_batches(batches)

    return run


# ---------------------------------------------------------------- operators

def _block_rows(side: SideLayout) -> DataFrame:
    return side.data.select(side.key, "salt", "hot", side.other, "rating", "blk")


def _by_block(side: SideLayout, placed: DataFrame, n_copies: int, k: int, kernel) -> DataFrame:
    """(id, salt, hot, x): ``kernel`` of every rating block and its copies of the ``placed`` factors.

    Up to DEFAULT_WAVE_BYTES of copies this is one lazy cogroup.  Beyond, the factors are joined to their blocks
    and written once; waves of blocks then take their copies from there, and the result is a written table.
    """
    rows, cols = _block_rows(side), [c for c in placed.columns if c != "_blks"]

    def cogrouped(ratings, factors, blocks):
        copies = factors.select(F.explode(blocks).alias("_blk"), *cols)
        return ratings.groupBy("blk").cogroup(copies.groupBy("_blk")).applyInArrow(kernel, _HALF_STEP_SCHEMA)

    waves = side.waves(n_copies * factor_bytes(k))
    if len(waves) == 1:
        return cogrouped(rows, placed, "_blks")
    factors = materialize(placed, "placed")
    out = materialize_parts(factors.sparkSession, (
        cogrouped(rows.where(F.col("blk").between(lo, hi - 1)), factors, F.filter("_blks", lambda b: b.between(lo, hi - 1)))
        for lo, hi in waves), "blocks")
    discard(factors)
    return out


def _solved_or_packed(side: SideLayout, fixed: DataFrame, k: int, lam: float, n_fixed: int | None,
                      max_broadcast_bytes: int) -> DataFrame:
    """(id, salt, hot, x): x solved for normal keys, packed partial sums for hot ones.

    Broadcast plan: the factor table (size proven by ``n_fixed``) goes to every
    executor once and each block of the bucketed ratings is reduced by a streaming
    grouped kernel; no exchange, and 25 bytes a rating to Python.
    Block plan: every block receives one copy of each factor it needs (one
    shuffle of at most (distinct ids x blocks) factor rows, or one a wave), and a cogroup by
    block does the lookup in numpy; ratings never carry factors through a shuffle.
    """
    if n_fixed is not None and n_fixed * factor_bytes(k) <= max_broadcast_bytes:
        t = fixed.select("id", "f").toArrow()  # bounded by the check above
        bc = fixed.sparkSession.sparkContext.broadcast(_sorted_factors(t.column("id"), t.column("f"), k))
        side.held.append(bc)
        ratings = _block_rows(side)
        if side.table is None:  # a bucketed layout is dealt by block already
            ratings = ratings.repartition(side.blocks, "blk")
        ordered = ratings.sortWithinPartitions("blk", side.key, "salt")
        return ordered.groupBy("blk").applyInArrow(_stream_kernel(bc, side.key, side.other, k, lam), _HALF_STEP_SCHEMA)
    return _by_block(side, side.placed(fixed), side.n_copies(), k, _block_kernel(side.key, side.other, k, lam))


def half_step(side: SideLayout, fixed: DataFrame, k: int, lam: float = DEFAULT_LAMBDA,
              n_fixed: int | None = None, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """New factors (id, f) for every key of ``side`` that has a rating on a factored id."""
    out = _solved_or_packed(side, fixed, k, lam, n_fixed, max_broadcast_bytes)
    if side.n_hot != 0:
        out = materialized(out, "half_step")  # both branches below read the kernel output once
    side.written.append(out)
    if side.n_hot == 0:
        return out.select("id", F.col("x").alias("f"))
    done = out.where(~F.col("hot")).select("id", F.col("x").alias("f"))
    merged = _merged(out.where(F.col("hot")), k).mapInArrow(_packed_solver(k, lam), _FACTORS_SCHEMA)
    return done.unionByName(merged)


def init_factors(ratings: DataFrame, other: str = "article_id", k: int = DEFAULT_RANK, seed: int = 1,
                 mode: str = "hash") -> DataFrame:
    """Initial factors of every distinct ``other`` key that has a rating."""
    keys = ratings.select(F.col(other).alias("id")).distinct()
    return keys.select("id", init_vector("id", k, seed, mode).alias("f"))


@dataclass
class Model:
    users: DataFrame     # id, f
    articles: DataFrame  # id, f
    n_users: int
    n_articles: int
    k: int
    n_ratings: int = -1


def train(ratings: DataFrame, k: int = DEFAULT_RANK, iterations: int = DEFAULT_ITERATIONS,
          lam: float = DEFAULT_LAMBDA, seed: int = 1, init_mode: str = "hash",
          rows_per_group: int = DEFAULT_ROWS_PER_GROUP,
          max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, partitions: int | None = None,
          history: list | None = None, rows_per_block: int = DEFAULT_ROWS_PER_BLOCK, persist: bool = True) -> Model:
    """Initialise article factors, then ``iterations`` x (users from articles, articles from users).

    Each half-step result is written to the shared folder: lineage stays one
    step long and a lost executor recomputes at most one step.  What a step
    supersedes is deleted.  ``persist=False``: the caller has cached the ratings.
    """
    r = ratings.select("user_id", "article_id", "rating").where(F.col("rating").isNotNull())
    if persist:
        r = materialize(r, "ratings")  # read by both layouts and the init
    n_rows = r.count()
    by_user = layout_side(r, "user_id", "article_id", rows_per_group, partitions, n_rows=n_rows,
                          rows_per_block=rows_per_block)
    by_article = layout_side(r, "article_id", "user_id", rows_per_group, partitions, n_rows=n_rows,
                             rows_per_block=rows_per_block)
    # factor tables have exactly one row per distinct key of the matching layout
    n_u, n_v = by_user.n_keys(), by_article.n_keys()
    v = materialize(init_factors(r, "article_id", k, seed, init_mode), "factors")
    if history is None:
        discard(r)
    u = None
    for _ in range(iterations):
        discard(u)
        u = materialize(half_step(by_user, v, k, lam, n_v, max_broadcast_bytes), "factors")
        by_user.free()
        if history is not None:
            history.append(objective(r, u, v, lam))
        discard(v)
        v = materialize(half_step(by_article, u, k, lam, n_u, max_broadcast_bytes), "factors")
        by_article.free()
        if history is not None:
            history.append(objective(r, u, v, lam))
    discard(r)
    by_user.release()
    by_article.release()
    return Model(u, v, n_u if u is not None else 0, n_v, k, n_rows)


def fold_in(ratings: DataFrame, articles: DataFrame, k: int = DEFAULT_RANK, lam: float = DEFAULT_LAMBDA,
            n_articles: int | None = None, rows_per_group: int = DEFAULT_ROWS_PER_GROUP,
            max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, checkpoint: bool = True) -> DataFrame:
    """User factors of the given ratings' users from fixed article factors (one half-step).

    With ``checkpoint`` (default) the factors are written to the shared folder and
    the layout's catalog entry is released; otherwise the result stays lazy.
    """
    side = layout_side(ratings, "user_id", "article_id", rows_per_group, checkpoint=checkpoint)
    if n_articles is None:
        n_articles = articles.count()
    factors = half_step(side, articles, k, lam, n_articles, max_broadcast_bytes)
    if not checkpoint:
        return factors
    factors = materialize(factors, "fold_in")
    side.release()
    return factors


def objective(ratings: DataFrame, users: DataFrame, articles: DataFrame, lam: float) -> float:
    """sum (r - u.v)^2 + lam * (sum |u|^2 + sum |v|^2)  (the quantity the half-steps minimise)."""
    u = users.select(F.col("id").alias("user_id"), F.col("f").alias("fu"))
    v = articles.select(F.col("id").alias("article_id"), F.col("f").alias("fv"))
    err = (ratings.join(u, "user_id").join(v, "article_id")
           .select(F.pow(F.col("rating") - dot("fu", "fv"), 2).alias("e"))
           .agg(F.sum("e")).first()[0] or 0.0)
    reg_u = users.select(F.sum(squared_norm("f"))).first()[0] or 0.0
    reg_v = articles.select(F.sum(squared_norm("f"))).first()[0] or 0.0
    return float(err + lam * (reg_u + reg_v))


def normal_equation_residuals(ratings: DataFrame, side_key: str, other: str, solved: DataFrame,
                              fixed: DataFrame, lam: float, side: SideLayout | None = None,
                              rows_per_group: int = DEFAULT_ROWS_PER_GROUP) -> DataFrame:
    """``id, residual``: max |(G + lam I) x - b| of every key, an exact-solve check on the ratings themselves.

    (G + lam I) x - b = sum_r v (v.x - rating) + lam x.  A block of ratings gets one copy of each factor it needs, as in the block plan;
    a rating never becomes a row per entry.  Sums of hot keys are added over their salts.  ``side``: the ratings' layout, if there is one.
    """
    own = side or layout_side(ratings, side_key, other, rows_per_group)
    first = fixed.select(F.size("f")).first()
    k = first[0] if first else 1
    keys = own.data.select(F.col(own.key).alias("_fid"), "blk").groupBy("_fid").agg(F.collect_set("blk").alias("_blks"))
    solved_there = solved.select(F.col("id").alias("_fid"), "f").join(keys, "_fid")
    placed = own.placed(fixed).withColumn("own", F.lit(False)).unionByName(solved_there.withColumn("own", F.lit(True)))
    out = _by_block(own, placed, own.n_copies() + own.n_keys(), k, _residual_kernel(own.key, own.other, lam))
    out = materialized(out, "residuals")
    if side is None:
        own.release()
    done = out.where(~F.col("hot")).select("id", F.col("x")[0].alias("residual"))
    if own.n_hot == 0:
        return done
    sums = (out.where(F.col("hot")).select("id", "x").repartition("id").sortWithinPartitions("id")
            .mapInArrow(_sum_runs(k), "id long, p array<double>"))
    merged = sums.join(solved.select("id", "f"), "id")
    entries = F.zip_with("p", "f", lambda s, x: F.abs(s + F.lit(lam) * x))
    return done.unionByName(merged.select("id", F.array_max(entries).alias("residual")))


def normal_equation_residual(ratings: DataFrame, side_key: str, other: str, solved: DataFrame,
                             fixed: DataFrame, lam: float) -> float:
    """The largest residual over all keys."""
    return float(normal_equation_residuals(ratings, side_key, other, solved, fixed, lam).agg(F.max("residual")).first()[0] or 0.0)


def normal_equation_terms(ratings: DataFrame, fixed: DataFrame, key: str, other: str, k: int,
                          n_fixed: int | None = None,
                          max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Per key: packed upper triangle of sum v v^T (row-major) followed by sum rating * v.

    Same kernel and merge as the half-step with every group emitting partials.
    """
    side = layout_side(ratings, key, other, checkpoint=False)
    side = SideLayout(side.data.withColumn("hot", F.lit(True)), key, other, side.partitions, -1, side.blocks)
    out = _solved_or_packed(side, fixed, k, 0.0, n_fixed, max_broadcast_bytes)
    return _merged(out, k).withColumnRenamed("p", "terms")
