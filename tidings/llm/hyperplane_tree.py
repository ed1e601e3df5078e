"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Scores are inner products of integer vectors (entries times 256, rounded down).  To make them a
metric, every vector gets one more entry that lifts it to the largest norm M of the table; then a
score s with an anchor a is the distance ``sqrt(|a|^2 + M^2 - 2 s)``, so a score window is an
annulus around the anchor, and the first k in it are those nearest to its inner rim.

A node of the tree has up to ``FAN`` split points, far from each other; rows go to the nearest
one, and the node stores, for every split point and every sibling subtree, the least and the largest
distance from the point to the subtree's rows.  A query at distance d from a split point rules
out each sibling whose range misses ``[max(d - R, r - d), d + R]``, with r and R the rims of its annulus; R
shrinks as the k-th score rises.  Distances carry a slack far above their rounding, leaves are
scored exactly.  A node is worked off for all its queries at once.

On Spark the first level of the tree is common: up to ``MOST_CELLS`` split points from a bounded
sample (at most ``16 * MOST_CELLS + 64`` rows; it changes speed only) deal the rows to cells, whose
ranges are gathered over all rows.  A cell above ``SHARD_ROWS`` rows is dealt by hash into shards,
whatever its rows are; each shard's deeper levels are built in the task.  Queries first go to the shards of
their nearest cell; the k-th score found there narrows the annulus with which the other cells are
ruled out.  Queries of a shard are worked off ``BLOCK_QUERIES`` at a time.

An anchor's positives are its first rows of the same label; every positive gives a score window
for the negatives, and equal windows of an anchor are searched once.

Rows with a null id, label or vector and vectors with null or non-finite entries take no part.  Vectors are
compared with those of their own length.  Repeated rows: each is a candidate; an anchor that
repeats exactly is asked once; rows with the anchor's id are neither its positives nor its
negatives; a positive that repeats has its negatives once for each row.  Ties: the smaller id.
Positives with a negative score have an empty window.  Scores must fit a long.  Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import Table, read
from tidings.llm.vectors import blobs, from_blobs, matrices

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # window of the negatives, in percent of the positive's score
FAN = 8
LEAF = 96
CELL_ROWS = 4096
MOST_CELLS = 128
SHARD_ROWS = 32_768
BLOCK_QUERIES = 4096
SLICE = 2048
SLACK = 1e-6  # of the largest norm; distances are exact to some 1e-7 of it
FAR = 1 << 62


def rows_of(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, dim, v, norm2`` of the rows that take part; v is 64-bit integers as bytes."""

    def run(it):
        for b in it:
            for rows, m in matrices(b.column("embedding")):
                x = np.floor(scale * m).astype(np.int64)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(at), b.column("label").take(at), pa.array(np.full(len(x), x.shape[1], np.int32)), blobs(x),
                     pa.array((x.astype(float) ** 2).sum(1))], names=["vec_id", "label", "dim", "v", "norm2"])

    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    return v.where("vec_id is not null and label is not null").mapInArrow(run, "vec_id long, label long, dim int, v binary, norm2 double")


def lifted(x: np.ndarray, most2: float) -> np.ndarray:
    x = x.astype(float)
    return np.hstack([x, np.sqrt(np.maximum(most2 - (x * x).sum(1), 0))[:, None]])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0))


def split_points(x: np.ndarray, fan: int, tiny: float) -> np.ndarray:
    """Row numbers of up to ``fan`` points far from each other, out of three times as many."""
    rng = np.random.default_rng(len(x))
    tried = rng.choice(len(x), min(len(x), 3 * fan), replace=False)
    picked, gap = [int(tried[0])], np.full(len(tried), np.inf)
    while len(picked) < fan:
        gap = np.minimum(gap, distances(x[tried], x[picked[-1:]])[:, 0])
        if gap.max() <= tiny:
            break
        picked.append(int(tried[gap.argmax()]))
    return np.array(picked)


class Rims:
    """Inner and outer radius of the annuli of score windows ``[floor, ceiling]`` around queries."""

    def __init__(self, norm2: np.ndarray, most2: float, floor: np.ndarray, ceiling: np.ndarray):
        self.base = norm2 + most2
        self.slack = SLACK * (np.sqrt(norm2) + math.sqrt(most2)) + 1e-9
        self.inner = np.maximum(np.sqrt(np.maximum(self.base - 2.0 * ceiling, 0)) - self.slack, 0)
        self.outer = np.empty(len(norm2))
        self.raise_floor(np.arange(len(norm2)), floor)

    def raise_floor(self, at: np.ndarray, floor: np.ndarray) -> None:
        self.outer[at] = np.sqrt(np.maximum(self.base[at] - 2.0 * floor, 0)) + self.slack[at]

    def meets(self, at: np.ndarray, d: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether ranges ``[low, high]`` of distances meet the annuli of queries at distances d from the split points."""
        outer, inner = self.outer[at][:, None], self.inner[at][:, None]
        return (low <= d + outer) & (high >= np.maximum(d - outer, inner - d))


class Tree:
    """GNAT over integer vectors; ``visited`` counts (leaf, query) pairs that were scored."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, most2: float, fan: int = FAN, leaf: int = LEAF):
        self.most2, self.visited = most2, 0
        far = lifted(x, most2)
        order, tiny = np.arange(len(x)), SLACK * math.sqrt(most2)
        self.span, self.inner, self.label_low, self.label_high = [], [], [], []

        def node(rows, start):
            order[start:start + len(rows)] = rows
            self.span.append((start, start + len(rows)))
            self.inner.append(None)
            self.label_low.append(labels[rows].min())
            self.label_high.append(labels[rows].max())
            return len(self.span) - 1

        todo = [node(order.copy(), 0)] if len(x) else []
        while todo:
            i = todo.pop()
            start, end = self.span[i]
            if end - start <= leaf:
                continue
            rows = order[start:end].copy()
            points = far[rows[split_points(far[rows], fan, tiny)]]
            if len(points) < 2:
                continue
            d = distances(far[rows], points)
            own = d.argmin(1)
            used = np.unique(own)
            if len(used) < 2:
                continue
            parts = [np.flatnonzero(own == j) for j in used]
            low = np.stack([d[p].min(0) for p in parts], 1)
            high = np.stack([d[p].max(0) for p in parts], 1)
            children = []
            for p in parts:
                children.append(node(rows[p], start))
                start += len(p)
            self.inner[i] = (points, low, high, used, children)
            todo += children
        self.x, self.ids, self.labels = x[order], ids[order], labels[order]

    def search(self, q: np.ndarray, own: np.ndarray, label: np.ndarray, same: np.ndarray, floor: np.ndarray, ceiling: np.ndarray, k: int):
        """(scores, ids, how many) of the first k rows of each query in its window, with its own label or with others."""
        if q.dtype != self.x.dtype:
            raise TypeError("queries and rows need one type")
        exact = q.dtype.kind == "f"
        none = -np.inf if exact else np.iinfo(np.int64).min
        top, top_id = np.full((len(q), k), none, q.dtype), np.full((len(q), k), FAR, np.int64)
        floor = floor.astype(q.dtype)
        far = np.hstack([q.astype(float), np.zeros((len(q), 1))])
        rims = Rims((far * far).sum(1), self.most2, floor.astype(float), ceiling.astype(float))
        stack = [(0, np.arange(len(q)), None)] if self.span else []
        while stack:
            i, at, ranges = stack.pop()
            if ranges is not None:
                at = at[rims.meets(at, *ranges).all(1)]
            low, high = self.label_low[i], self.label_high[i]
            mine = (label[at] >= low) & (label[at] <= high)
            at = at[np.where(same[at], mine, (low != high) | (label[at] != low))]
            if not len(at):
                continue
            if self.inner[i] is not None:
                points, low, high, used, children = self.inner[i]
                d = distances(far[at], points)
                for j in np.argsort(-d[:, used].mean(0)):  # the nearest on top
                    stack.append((children[j], at, (d, low[:, j], high[:, j])))
                continue
            start, end = self.span[i]
            for s in range(start, end, SLICE):
                e = min(end, s + SLICE)
                self.visited += len(at)
                score = q[at] @ self.x[s:e].T
                ok = (score >= floor[at][:, None]) & (score <= ceiling[at][:, None]) & (self.ids[s:e] != own[at][:, None])
                ok &= (self.labels[s:e] == label[at][:, None]) == same[at][:, None]
                hit = np.flatnonzero(ok.any(1))
                if not len(hit):
                    continue
                a = at[hit]
                x = np.hstack([top[a], np.where(ok[hit], score[hit], none)])
                ids = np.hstack([top_id[a], np.where(ok[hit], self.ids[s:e], FAR)])
                best = np.lexsort((ids, -x if exact else ~x), axis=1)[:, :k]
                top[a], top_id[a] = np.take_along_axis(x, best, 1), np.take_along_axis(ids, best, 1)
                floor[a] = np.maximum(floor[a], top[a, -1])
                rims.raise_floor(a, floor[a].astype(float))
        return top, top_id, (top != none).sum(1)


def _with(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, T.IntegerType()) for n in names]])


class Cells:
    """The common first level: split points, ranges and shards of each cell, for every vector length that has them."""

    def __init__(self, rows: DataFrame, n: int):
        self.most2 = {r["dim"]: r["m"] for r in rows.groupBy("dim").agg(F.max("norm2").alias("m")).collect()}
        cells = min(MOST_CELLS, n // CELL_ROWS)
        self.points: dict[int, np.ndarray] = {}
        if cells > 1:
            want = 4 * cells + 16
            some = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)) < want).select("dim", "v").limit(16 * MOST_CELLS + 64).collect()
            for dim in {r["dim"] for r in some}:
                x = lifted(np.unique(np.array([np.frombuffer(r["v"], np.int64) for r in some if r["dim"] == dim]), axis=0), self.most2[dim])
                self.points[dim] = x[split_points(x, cells, SLACK * math.sqrt(self.most2[dim]))]
        self.ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.shards: dict[tuple[int, int], int] = {}

    def nearest(self, dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distances to all split points) of lifted rows."""
        p = self.points.get(dim)
        if p is None:
            return np.zeros(len(x), np.int32), np.zeros((len(x), 1))
        d = distances(x, p)
        return d.argmin(1).astype(np.int32), d

    def place(self, rows: DataFrame, tasks: int) -> DataFrame:
        """``rows`` with their cell and shard; learns ranges and counts on the way."""
        points, most2, nearest = self.points, self.most2, self.nearest

        def by_dim(b):
            dim = b.column("dim").to_numpy()
            for n in np.unique(dim):
                at = np.flatnonzero(dim == n)
                yield int(n), at, lifted(from_blobs(b.column("v").take(pa.array(at)), np.int64), most2[int(n)])

        def assign(it):
            for b in it:
                cell = np.zeros(b.num_rows, np.int32)
                for n, at, x in by_dim(b):
                    cell[at] = nearest(n, x)[0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])

        placed = Table(rows.mapInArrow(assign, _with(rows.schema, "cell")), "cells").df()

        def spread(it):
            low, high = {}, {}
            for b in it:
                cell = b.column("cell").to_numpy()
                for n, at, x in by_dim(b):
                    if n not in points:
                        continue
                    d, m = distances(x, points[n]), len(points[n])
                    lo, hi = low.setdefault(n, np.full((m, m), np.inf)), high.setdefault(n, np.full((m, m), -np.inf))
                    for j in np.unique(cell[at]):
                        own = d[cell[at] == j]
                        lo[j], hi[j] = np.minimum(lo[j], own.min(0)), np.maximum(hi[j], own.max(0))
            yield from packed(low, high)

        def merge(it):
            low, high = {}, {}
            for b in it:
                for n, p, r in zip(b.column("dim").to_pylist(), b.column("low"), b.column("high")):
                    lo, hi = np.frombuffer(p.as_py()), np.frombuffer(r.as_py())
                    low[n], high[n] = np.minimum(low.get(n, lo), lo), np.maximum(high.get(n, hi), hi)
            yield from packed(low, high)

        def packed(low, high):
            if low:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(low), pa.int32()), pa.array([x.tobytes() for x in low.values()], pa.binary()),
                     pa.array([x.tobytes() for x in high.values()], pa.binary())], names=["dim", "low", "high"])

        if points:
            form = "dim int, low binary, high binary"
            parts = placed.select("dim", "v", "cell").mapInArrow(spread, form)
            while tasks > 32:  # partials of tasks meet in about the square root of their number, again and again
                tasks = math.isqrt(tasks)
                parts = parts.repartition(tasks).mapInArrow(merge, form)
            for r in parts.collect():
                m = len(points[r["dim"]])
                lo, hi = np.frombuffer(r["low"]).reshape(m, m), np.frombuffer(r["high"]).reshape(m, m)
                was = self.ranges.get(r["dim"], (lo, hi))
                self.ranges[r["dim"]] = np.minimum(was[0], lo), np.maximum(was[1], hi)
        counts = placed.groupBy("dim", "cell").count()
        self.shards = {(r["dim"], r["cell"]): -(-r["count"] // SHARD_ROWS) for r in counts.collect()}  # MOST_CELLS a length
        of = counts.select(F.col("dim").alias("_d"), F.col("cell").alias("_c"), F.ceil(F.col("count") / SHARD_ROWS).alias("_n"))
        out = placed.join(of, (F.col("dim") == F.col("_d")) & (F.col("cell") == F.col("_c")))
        return out.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v", "salt"), F.col("_n")).cast("int")).drop("_d", "_c", "_n")

    def route(self, asked: DataFrame, home: bool) -> DataFrame:
        """``asked`` once for each shard: those of the nearest cell that isn't ruled out, or of all others."""
        points, ranges, shards, most2, nearest = self.points, self.ranges, self.shards, self.most2, self.nearest

        def run(it):
            for b in it:
                dim = b.column("dim").to_numpy()
                for n in np.unique(dim).tolist():
                    own = b.filter(pa.array(dim == n))
                    cells = [c for m, c in shards if m == n]
                    if not cells:
                        continue
                    x = from_blobs(own.column("v"), np.int64).astype(float)
                    x = np.hstack([x, np.zeros((len(x), 1))])
                    d = nearest(n, x)[1]
                    open_ = np.zeros(d.shape, bool)
                    open_[:, cells] = True
                    at, first = np.arange(len(x)), np.array(cells)[d[:, cells].argmin(1)]
                    if home:
                        open_[:] = False
                        open_[at, first] = True
                    else:
                        open_[at, first] = False
                        if n in points:
                            rims = Rims((x * x).sum(1), most2[n], own.column("floor").to_numpy().astype(float), own.column("ceiling").to_numpy().astype(float))
                            low, high = ranges[n]
                            for i in range(len(points[n])):
                                open_ &= rims.meets(at, d[:, i:i + 1], low[:, i], high[:, i])
                    for c in cells:
                        part = own.filter(pa.array(open_[:, c]))
                        for s in range(shards[n, c] if part.num_rows else 0):
                            yield pa.RecordBatch.from_arrays(
                                [*part.columns, pa.array(np.full(part.num_rows, c, np.int32)), pa.array(np.full(part.num_rows, s, np.int32))],
                                names=[*part.schema.names, "cell", "shard"])

        return asked.mapInArrow(run, _with(asked.schema, "cell", "shard"))


def _search(most2: dict[int, float], k: int):
    schema = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def cell(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        dim = queries["dim"][0].as_py()
        x, q = from_blobs(rows["v"], np.int64), from_blobs(queries["v"], np.int64)
        if dim * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2.0 ** 52:
            x, q = x.astype(float), q.astype(float)  # inner products are exact in doubles
        tree = Tree(x, rows["vec_id"].to_numpy(), rows["label"].to_numpy(), most2[dim])
        column = {c: queries[c].to_numpy() for c in ("q", "qid", "label", "floor", "ceiling")}
        top, ids, found = tree.search(q, column["qid"], column["label"], queries["same"].to_numpy(), column["floor"], column["ceiling"], k)
        some = np.arange(k) < found[:, None]
        return pa.table([pa.array(np.repeat(column["q"], found)), pa.array(ids[some]), pa.array(top[some].astype(np.int64))], schema=schema)

    return cell


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(placed: DataFrame, cells: Cells, asked: DataFrame, k: int) -> DataFrame:
    """``q, vec_id, score, rank`` : the first k rows of every query.

    ``asked``: q (key), qid, label, dim, v, same (own label, or others), floor and ceiling of the score.
    """
    out = "q long, vec_id long, score long"
    key = ["dim", "cell", "shard", "block"]
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int")
    rows = placed.select("vec_id", "label", "dim", "v", "cell", "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(routed):
        return rows.groupBy(*key).cogroup(routed.withColumn("block", block).groupBy(*key)).applyInArrow(_search(cells.most2, k), out)

    near = Table(meet(cells.route(asked, home=True)), "home").df()
    kth = near.groupBy("q").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    narrowed = asked.join(kth.withColumnRenamed("q", "_q"), F.col("q") == F.col("_q"), "left")
    narrowed = narrowed.withColumn("floor", F.greatest("floor", F.coalesce("kth", "floor"))).select(*asked.columns)
    return _first(near.unionByName(meet(cells.route(narrowed, home=False))), k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` .

    ``vectors``: vec_id, label, embedding; ``is_anchor``: a condition on ``vec_id``.  A negative's score is between ``low`` and ``high``
    percent of the positive's.
    """
    spark = vectors.sparkSession
    rows = Table(rows_of(vectors, scale).withColumn("salt", F.monotonically_increasing_id()), "vectors").df()
    cells = Cells(rows, max(1, rows.count()))
    placed = Table(cells.place(rows, rows.rdd.getNumPartitions()), "shards").df()
    anchors = Table(rows.where(is_anchor).select("vec_id", "label", "dim", "v").distinct().withColumn("q", F.monotonically_increasing_id()), "anchors").df()
    base = anchors.withColumnRenamed("vec_id", "qid")
    near = search(placed, cells, base.withColumns({"same": F.lit(True), "floor": F.lit(-FAR), "ceiling": F.lit(FAR)}), positives)
    near = Table(near.select("q", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives").df()
    windows = near.where("positive_score >= 0").select(F.col("q").alias("a"), F.col("positive_score").alias("s")).distinct()
    windows = base.withColumnRenamed("q", "a").join(windows, "a").withColumns({
        "same": F.lit(False), "floor": F.expr(f"({low} * s + 99) div 100"), "ceiling": F.expr(f"{high} * s div 100"),
        "q": F.monotonically_increasing_id()})
    windows = Table(windows, "windows").df()
    asked = windows.select("qid", "label", "dim", "v", "q", "same", "floor", "ceiling")
    far = search(placed, cells, asked, negatives).select("q", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                                                         F.col("score").alias("negative_score"))
    out = far.join(windows.select("q", "a", "s", "qid"), "q").withColumnRenamed("q", "_w")
    out = out.join(near, (out["a"] == near["q"]) & (out["s"] == near["positive_score"]))
    return out.select(F.col("qid").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(v.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


ORACLE = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, a.label as own, c.vec_id, c.label, list_dot_product(a.e, c.e)::bigint as score
  from v a join v c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.e) = len(c.e)),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor_id order by score desc, vec_id) as r
  from s where label = own),
n as (
  select p.anchor_id, positive_id, s.vec_id as negative_id, positive_score, s.score as negative_score,
         row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
  from p join s on p.anchor_id = s.anchor_id
  where r <= 5 and s.label <> s.own and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
