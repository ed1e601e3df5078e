"""Exact top-k by inner product: a KD-tree per shard of vectors.

Vectors are integers (components times 256, rounded down), sharded by a hash of id, vector and a
number of the row, so that neither a common id nor a common vector fills a shard.  A shard's tree splits at the median of the widest dimension and keeps a tight bounding box and
the least id per node.  A query walks it best first: the bound of a box is the largest inner
product that any point in it could have, and the walk ends when no box can beat the kth score
(or tie with a smaller id).  Queries first search the shard they live in; the kth score found
there goes along to all other shards, where it prunes from the start.

Every query meets every shard, in cells of at most ``SHARD_ROWS`` vectors and ``BLOCK_QUERIES``
queries; a cell returns k rows a query at most.

Vectors that are null or hold null or non-finite components, and rows without an id, take no
part.  Vectors are compared with those of their own length.  Repeated rows: each is a candidate;
a query that repeats exactly is asked once, and rows with the query's own id aren't its candidates.
Ties: the smaller id.  Scores must fit a long.  Empty table: no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings.llm.common import Table, read

SHARD_ROWS = 65_536
LEAST_SHARD = 2_048
BLOCK_QUERIES = 16_384
LEAF = 128
SCALE = 256
K = 5


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, dim, v`` (64-bit integers as bytes) of the vectors that take part."""

    def run(it):
        for b in it:
            ids, dim, out = [], [], []
            for i, e in zip(b.column("vec_id"), b.column("embedding")):
                x = None if not e.is_valid else e.values
                if x is None or x.null_count:
                    continue
                x = x.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                ids.append(i.as_py())
                dim.append(len(x))
                out.append(np.floor(scale * x).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dim, pa.int32()), pa.array(out, pa.binary())],
                                             names=["vec_id", "dim", "v"])

    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null")
    return v.mapInArrow(run, "vec_id long, dim int, v binary")


class Tree:
    """KD-tree of integer points; node i has children left[i], left[i] + 1 or is a leaf (left[i] = 0)."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids = points, ids
        order = np.arange(len(ids))
        low, high, span, left, least = [], [], [], [], []

        def node(s, e):
            p = points[order[s:e]]
            low.append(p.min(0))
            high.append(p.max(0))
            span.append((s, e))
            left.append(0)
            least.append(ids[order[s:e]].min())
            return len(left) - 1

        todo = [node(0, len(ids))] if len(ids) else []
        while todo:
            i = todo.pop()
            s, e = span[i]
            wide = high[i] - low[i]
            if e - s <= leaf or not wide.size or wide.max() == 0:
                continue
            d = int(wide.argmax())
            half = (e - s) // 2
            part = order[s:e]
            order[s:e] = part[np.argpartition(points[part, d], half)]
            left[i] = node(s, s + half)
            node(s + half, e)
            todo += [left[i], left[i] + 1]
        self.order, self.span, self.left = order, span, left
        self.low, self.high, self.least = np.array(low), np.array(high), least
        self.sorted_points, self.sorted_ids = points[order], ids[order]

    def top(self, q: np.ndarray, own: int, k: int, kth: float) -> list[tuple[int, int]]:
        """Up to k (score, -id), best first, among those with a score of at least ``kth``."""
        if not self.left:
            return []
        bound = self.high @ np.maximum(q, 0) + self.low @ np.minimum(q, 0)
        heap, best = [(-bound[0], 0)], []  # best: a heap of (score, -id), the worst on top
        while heap:
            b, i = heapq.heappop(heap)
            b = -b
            if len(best) == k:
                kth = best[0][0]
            if b < kth:
                break
            if len(best) == k and b == kth and self.least[i] > -best[0][1]:
                continue
            if self.left[i]:
                for c in (self.left[i], self.left[i] + 1):
                    if bound[c] >= kth:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            s, e = self.span[i]
            score = self.sorted_points[s:e] @ q
            near = np.flatnonzero((score >= kth) & (self.sorted_ids[s:e] != own))
            if len(near) > k:  # only the best k of a leaf can matter; ids break ties
                near = near[np.lexsort((self.sorted_ids[s:e][near], -score[near]))[:k]]
            for j in near.tolist():
                x = (int(score[j]), -int(self.sorted_ids[s + j]))
                if len(best) < k:
                    heapq.heappush(best, x)
                elif x > best[0]:
                    heapq.heapreplace(best, x)
        return sorted(best, reverse=True)


def _matrix(col, dim: int) -> np.ndarray:
    m = np.frombuffer(b"".join(col.to_pylist()), np.int64).reshape(len(col), dim)
    # doubles while every inner product is exact in them
    return m.astype(np.float64) if not m.size or dim * float(np.abs(m).max()) ** 2 < 2.0 ** 52 else m


def _search(k: int):
    def cell(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "q", "vec_id", "score"]
        schema = pa.schema([("query_id", pa.int64()), ("q", pa.binary()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not vectors.num_rows or not queries.num_rows:
            return schema.empty_table()
        dim = queries["dim"][0].as_py()
        points, q = _matrix(vectors["v"], dim), _matrix(queries["v"], dim)
        if points.dtype != q.dtype:
            points, q = points.astype(np.int64), q.astype(np.int64)
        elif points.dtype == np.float64 and q.size and points.size and dim * np.abs(points).max() * np.abs(q).max() >= 2.0 ** 52:
            points, q = points.astype(np.int64), q.astype(np.int64)
        tree = Tree(points, vectors["vec_id"].to_numpy())
        out = [[], [], [], []]
        blobs = queries["v"].to_pylist()
        for own, blob, row, kth in zip(queries["vec_id"].to_pylist(), blobs, q, queries["kth"].to_pylist()):
            for score, near in tree.top(row, own, k, -np.inf if kth is None else kth):
                for c, x in zip(out, (own, blob, -near, score)):
                    c.append(x)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema)], names=names)

    return cell


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    # the salt is written along: it stays the same however often the table is read
    v = Table(scaled(vectors, scale).withColumn("salt", F.monotonically_increasing_id()), "vectors").df()
    n = v.count()
    shards = max(1, -(-n // SHARD_ROWS), min(3 * spark.sparkContext.defaultParallelism, n // LEAST_SHARD))
    v = v.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v", "salt"), F.lit(shards)).cast("int")).drop("salt")
    asked = Table(v.where(is_query).dropDuplicates(["vec_id", "v"]), "queries").df()
    out = "query_id long, q binary, vec_id long, score long"
    key = ["dim", "shard"]
    home = asked.withColumn("kth", F.lit(None).cast("double"))
    first = Table(v.groupBy(*key).cogroup(home.groupBy(*key)).applyInArrow(_search(k), out), "home").df()
    # kth score of each query so far, if there are k
    kth = first.groupBy("query_id", "q").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("kth"))
    a = asked.select("vec_id", "dim", "v", F.col("shard").alias("own"))
    a = a.join(kth, (a["vec_id"] == kth["query_id"]) & (a["v"] == kth["q"]), "left").select("vec_id", "dim", "v", "own", "kth")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    a = (a.withColumn("block", F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(blocks)).cast("int"))
         .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> own").drop("own"))
    cells = v.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "shard", "block"]
    rest = cells.groupBy(*key).cogroup(a.groupBy(*key)).applyInArrow(_search(k), out)
    return _best(first.unionByName(rest), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
