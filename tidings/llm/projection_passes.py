"""Embedding near-duplicates by sorted projection passes.

Equal vectors are one class at once (128-bit hash of the doubles).  A pass gives every class a key
of 64 signs of random projections, sorts all classes lexicographically by key (range-partitioned, so
dense regions are split evenly) and compares each with the ``WINDOW`` next ones.  The vector
travels as 8-bit integers with the exact norm of what rounding removed; that bounds the error of the
estimated cosine, so most pairs are proven linked or not linked on the spot.  Proven links are
thinned to a spanning forest of each batch, open pairs are checked on the doubles, unless their ends
are joined by then.  Passes run ``ROUND`` at a time and are united by components.

The number of passes follows from the number of classes n: two vectors at the threshold agree in a sign
with probability 1 - acos(0.9) / pi = 0.856, meet in a window when they agree in the first log2(n / WINDOW)
signs, and should do so in one pass at least with probability ``RECALL``; closer ones do so more often.

Windows bound the pairs of a pass, not the links: within each component that the passes have found all members are compared in double
precision, so every link inside it is counted, however many there are.  Members stand in blocks of ``BLOCK``
in the order of a key; two blocks whose balls (centre and largest angle) prove all their pairs linked, or none, are counted
as a whole, only open pairs of blocks are compared.  Nothing is emitted a pair.

Vectors that are null, zero or hold null or non-finite entries are linked with nothing; vectors of
different length aren't linked.  Repeated rows: same class, linked with each other.  Null ids: rows are kept; a component's
id is the least id that isn't null.  Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import Table, read
from tidings.llm.components import components, roots
from tidings.llm.vectors import blobs, from_blobs, matrices
from tidings.operators.ranking import group_ranks

COSINE = 0.9
WINDOW = 32
RECALL = 0.97
ROUND = 8
BITS = 64
BLOCK = 512
MARGIN = 1e-5  # above the rounding of single-precision estimates
SEED = 13


def passes(n: int, cosine: float = COSINE) -> int:
    """Passes after which a pair at the threshold has met with probability RECALL."""
    agree = 1 - math.acos(cosine) / math.pi
    meet = min(agree ** math.log2(max(2.0, n / WINDOW)), 1 - 1e-9)
    return max(2, math.ceil(math.log(1 - RECALL) / math.log(1 - meet)))


def scaled(m: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish; cosines stay the same."""
    most = np.abs(m).max(1, initial=0)
    return np.ldexp(m, -np.frexp(most)[1][:, None]) + 0.0


def classed(vectors: DataFrame) -> DataFrame:
    """``vec_id, cid, dim, v`` of all rows; cid, dim and v are null where the vector takes no part."""

    def run(it):
        for b in it:
            cid, dim, v = (np.full(b.num_rows, None, object) for _ in range(3))
            for rows, m in matrices(b.column("embedding")):
                m = m + 0.0  # no negative zeros
                some = m.any(1)
                rows, m = rows[some], m[some]
                for i, x in zip(rows, m):
                    v[i] = x.tobytes()
                    cid[i] = xxhash.xxh3_128_digest(v[i])
                    dim[i] = len(x)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cid, pa.binary()), pa.array(dim, pa.int32()), pa.array(v, pa.binary())],
                                             names=["vec_id", "cid", "dim", "v"])

    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return v.mapInArrow(run, "vec_id long, cid binary, dim int, v binary")


def _planes(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim, number)).standard_normal((dim, BITS))


def _key(u: np.ndarray, number: int) -> pa.Array:
    return blobs(np.packbits(u @ _planes(u.shape[1], number) > 0, axis=1))


def small(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(8-bit integers, scale, norm of the rest) of unit vectors."""
    step = np.abs(u).max(1) / 127
    q = np.rint(u / step[:, None]).astype(np.int8)
    return q, step, np.linalg.norm(u - q * step[:, None], axis=1)


def _by_length(b: pa.RecordBatch):
    dim = b.column("dim").to_numpy()
    for n in np.unique(dim):
        own = b.filter(pa.array(dim == n))
        yield own, scaled(from_blobs(own.column("v"), np.float64))


def pass_rows(classes: DataFrame, numbers: list[int]) -> DataFrame:
    """``pass, dim, key, cid, q, step, rest`` : a row for each class and pass."""

    def run(it):
        for b in it:
            for own, x in _by_length(b):
                u = x / np.linalg.norm(x, axis=1)[:, None]
                q, step, rest = small(u)
                q = blobs(q)
                for number in numbers:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(u), number, np.int32)), own.column("dim"), _key(u, number), own.column("cid"), q, pa.array(step),
                         pa.array(rest)], names=["pass", "dim", "key", "cid", "q", "step", "rest"])

    return classes.select("cid", "dim", "v").mapInArrow(run, "pass int, dim int, key binary, cid binary, q binary, step double, rest double")


def _settle(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _spanning(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Joins the groups of x and y; (settled parents, numbers of the pairs that joined two groups)."""
    used = []
    apart = np.flatnonzero(parent[x] != parent[y])
    for i in apart.tolist():
        a, b = int(x[i]), int(y[i])
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
            used.append(i)
    return _settle(parent), used


def _neighbours(cosine: float):
    def run(it):
        carry = None
        for b in it:
            t = pa.Table.from_batches([b])
            if carry is not None:
                t = pa.concat_tables([carry, t])
            t = t.combine_chunks()
            rows, fresh = t.num_rows, t.num_rows - b.num_rows
            carry = t.slice(max(0, rows - WINDOW))
            if rows < 2:
                continue
            number, dim = t["pass"].to_numpy(), t["dim"].to_numpy()
            step, rest = t["step"].to_numpy(), t["rest"].to_numpy()
            wide = int(dim.max())
            if (dim == wide).all():
                q = from_blobs(t["q"], np.int8)
            else:
                q = np.zeros((rows, wide), np.int8)
                for i, x in enumerate(t["q"].to_pylist()):
                    q[i, :len(x)] = np.frombuffer(x, np.int8)
            u = q * step[:, None].astype(np.float32)
            parent, sure, open_ = np.arange(rows), [], []
            for d in range(1, min(WINDOW, rows - 1) + 1):
                y = np.arange(max(d, fresh), rows)
                x = y - d
                estimate = np.einsum("ij,ij->i", u[x[0]:x[-1] + 1], u[y[0]:y[-1] + 1]) if len(y) else np.empty(0)
                error = rest[x] + rest[y] + 3 * rest[x] * rest[y] + MARGIN
                near = (estimate + error >= cosine) & (number[x] == number[y]) & (dim[x] == dim[y])
                proven = near & (estimate - error >= cosine)
                parent, used = _spanning(parent, x[proven], y[proven])
                sure.append(np.stack([x[proven][used], y[proven][used]], 1))
                near &= ~proven
                open_.append(np.stack([x[near], y[near]], 1))
            sure, open_ = np.concatenate(sure).astype(np.int64), np.concatenate(open_).astype(np.int64)
            open_ = open_[parent[open_[:, 0]] != parent[open_[:, 1]]]
            cid = t["cid"].combine_chunks()
            for pairs, is_sure in ((sure, True), (open_, False)):
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([cid.take(pa.array(pairs[:, 0])), cid.take(pa.array(pairs[:, 1])), pa.array(np.full(len(pairs), is_sure))],
                                                     names=["x", "y", "sure"])

    return run


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1))


def confirmed(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """The pairs ``a, b`` whose cosine in double precision reaches the threshold."""
    va = classes.select(F.col("cid").alias("a"), F.col("v").alias("va"))
    vb = classes.select(F.col("cid").alias("b"), F.col("v").alias("vb"))

    def check(it):
        for b in it:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("va"), b.column("vb"))):
                x, y = (scaled(np.frombuffer(z.as_py())[None, :]) for z in (x, y))
                if _cosines(x, y)[0, 0] >= cosine:
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("a").take(keep), b.column("b").take(keep)], names=["a", "b"])

    return pairs.join(va, "a").join(vb, "b").select("a", "b", "va", "vb").mapInArrow(check, "a binary, b binary")


def links(classes: DataFrame, n: int, cosine: float) -> DataFrame:
    """Pairs ``a, b`` of linked classes that join all links which the passes have found."""
    total = passes(n, cosine)
    found = None
    for first in range(0, total, ROUND):
        rows = pass_rows(classes, list(range(first, min(total, first + ROUND))))
        rows = rows.repartitionByRange("pass", "dim", "key", "cid").sortWithinPartitions("pass", "dim", "key", "cid")
        pairs = rows.mapInArrow(_neighbours(cosine), "x binary, y binary, sure boolean")
        pairs = Table(pairs.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.max("sure").alias("sure")), "pairs").df()
        found = pairs if found is None else found.unionByName(pairs)
    sure = found.where("sure").select("a", "b").distinct()
    joined = components(sure, "sure")
    open_ = with_root(with_root(found.where("not sure").select("a", "b").distinct(), joined, "a", "ra"), joined, "b", "rb")
    return sure.unionByName(confirmed(open_.where("ra <> rb").select("a", "b"), classes, cosine))


def with_root(rows: DataFrame, joined: Table, col: str, out: str) -> DataFrame:
    r = roots(joined).select(F.col("id").alias("_id"), F.col("root").alias("_root"))
    return rows.join(r, rows[col] == r["_id"], "left").withColumn(out, F.coalesce("_root", col)).drop("_id", "_root")


def _cells(rows: DataFrame, key: list[str], order: str, work, schema: str) -> DataFrame:
    """``work(table)`` for the rows of every key, one after the other."""

    def run(it):
        held, cell = [], None
        for b in it:
            if not b.num_rows:
                continue
            keys = list(zip(*[b.column(c).to_pylist() for c in key]))
            first = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            for s, e in zip(first, [*first[1:], len(keys)]):
                if cell is not None and keys[s] != cell:
                    yield from work(pa.Table.from_batches(held).combine_chunks())
                    held = []
                cell = keys[s]
                held.append(b.slice(s, e - s))
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition(*key).sortWithinPartitions(*key, order).mapInArrow(run, schema)


_BLOCK = "root binary, block long, cid binary, links long, centre binary, angle double, weight long"


def _within(cosine: float):
    """Links inside a block; the block's ball where its component has other blocks."""

    def work(t):
        x, copies = scaled(from_blobs(t["v"], np.float64)), t["copies"].to_numpy()
        n = len(x)
        count = (_cosines(x, x) >= cosine) @ copies
        root, block = t["root"][0].as_py(), t["block"][0].as_py()
        one = pa.RecordBatch.from_pydict({"root": [root] * n, "block": [block] * n, "cid": t["cid"].to_pylist(), "links": count,
                                          "centre": [None] * n, "angle": [None] * n, "weight": [None] * n}, schema=schema)
        yield one
        if t["group_size"][0].as_py() > BLOCK:
            u = x / np.linalg.norm(x, axis=1)[:, None]
            centre = u.mean(0)
            size = np.linalg.norm(centre)
            centre = centre / size if size > 1e-9 else u[0]
            angle = float(np.arccos(np.clip(u @ centre, -1, 1)).max())
            yield pa.RecordBatch.from_pydict({"root": [root], "block": [block], "cid": [None], "links": [None], "centre": [centre.tobytes()],
                                              "angle": [angle], "weight": [int(copies.sum())]}, schema=schema)

    schema = pa.schema([("root", pa.binary()), ("block", pa.int64()), ("cid", pa.binary()), ("links", pa.int64()), ("centre", pa.binary()),
                        ("angle", pa.float64()), ("weight", pa.int64())])
    return work


def _verdicts(cosine: float):
    """1 where two balls prove all pairs linked, -1 where they prove that none is, else 0."""
    limit = math.acos(cosine)

    def verdict(ca: pa.Array, cb: pa.Array, ra: pa.Array, rb: pa.Array) -> pa.Array:
        if not len(ca):
            return pa.array([], pa.int32())
        a = [np.frombuffer(x) for x in ca.to_pylist()]
        b = [np.frombuffer(x) for x in cb.to_pylist()]
        gap = np.arccos(np.clip([x @ y for x, y in zip(a, b)], -1, 1))
        reach = ra.to_numpy() + rb.to_numpy() + 1e-6
        return pa.array(np.where(gap + reach <= limit, 1, np.where(gap - reach > limit, -1, 0)), pa.int32())

    return F.arrow_udf(verdict, "int")


def _across(cosine: float):
    def work(t):
        x, copies, left = scaled(from_blobs(t["v"], np.float64)), t["copies"].to_numpy(), t["block"].to_numpy() == t["i"][0].as_py()
        a, b = np.flatnonzero(left), np.flatnonzero(~left)
        near = _cosines(x[a], x[b]) >= cosine
        count = np.zeros(len(x), np.int64)
        count[a], count[b] = near @ copies[b], near.T @ copies[a]
        yield pa.RecordBatch.from_arrays([t["cid"].combine_chunks(), pa.array(count)], names=["cid", "links"])

    return work


def counted(members: DataFrame, cosine: float) -> DataFrame:
    """``cid, links`` : rows that a member of a component is linked with, its own class included.

    ``members``: root, cid, v, copies, key.
    """
    placed = group_ranks(members, "root", ["key", "cid"]).withColumn("block", F.floor((F.col("rank") - 1) / BLOCK))
    placed = Table(placed.select("root", "block", "cid", "v", "copies", "group_size"), "blocks").df()
    own = Table(_cells(placed, ["root", "block"], "cid", _within(cosine), _BLOCK), "within").df()
    balls = own.where("cid is null").select("root", "block", "centre", "angle", "weight")
    a = balls.select("root", *[F.col(c).alias(f"{c}_a") for c in ("block", "centre", "angle", "weight")])
    b = balls.select("root", *[F.col(c).alias(f"{c}_b") for c in ("block", "centre", "angle", "weight")])
    pairs = a.join(b, "root").where("block_a < block_b")
    pairs = Table(pairs.withColumn("verdict", _verdicts(cosine)("centre_a", "centre_b", "angle_a", "angle_b"))
                  .where("verdict >= 0").select("root", "block_a", "block_b", "weight_a", "weight_b", "verdict"), "block-pairs").df()
    all_ = pairs.where("verdict = 1")
    extra = (all_.select("root", F.col("block_a").alias("block"), F.col("weight_b").alias("more"))
             .unionByName(all_.select("root", F.col("block_b").alias("block"), F.col("weight_a").alias("more")))
             .groupBy("root", "block").agg(F.sum("more").alias("more")))
    from_blocks = placed.select("root", "block", "cid").join(extra, ["root", "block"]).select("cid", F.col("more").alias("links"))
    open_ = pairs.where("verdict = 0").select("root", F.col("block_a").alias("i"), F.col("block_b").alias("j"))
    open_ = open_.withColumn("block", F.explode(F.array("i", "j")))
    cells = open_.join(placed, ["root", "block"]).select("root", "i", "j", "block", "cid", "v", "copies")
    across = _cells(cells, ["root", "i", "j"], "cid", _across(cosine), "cid binary, links long")
    parts = own.where("cid is not null").select("cid", "links").unionByName(from_blocks).unionByName(across)
    return parts.groupBy("cid").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``."""
    rows = Table(classed(vectors), "vectors").df()
    classes = Table(rows.where("cid is not null").groupBy("cid").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"),
                                                                     F.min("dim").alias("dim"), F.min("v").alias("v")), "classes").df()
    joined = components(links(classes.select("cid", "dim", "v"), max(1, classes.count()), cosine))
    with_roots = Table(with_root(classes, joined, "cid", "root"), "rooted").df()
    shared = roots(joined).select("root").distinct()

    def keys(it):
        for b in it:
            for own, x in _by_length(b):
                yield pa.RecordBatch.from_arrays([*own.columns, _key(x, 0)], names=[*own.schema.names, "key"])

    members = with_roots.join(shared, "root", "left_semi").select("root", "cid", "dim", "v", "copies")
    members = members.mapInArrow(keys, "root binary, cid binary, dim int, v binary, copies long, key binary")
    n_links = Table(counted(members, cosine), "counted").df()
    least = with_roots.groupBy("root").agg(F.min("least").alias("component_id"))
    found = (with_roots.select("root", "cid", "copies").join(least, "root").join(n_links, "cid", "left")
             .select("cid", "component_id", (F.coalesce("links", "copies") - 1).alias("n_links")))
    out = rows.select("vec_id", "cid").join(found, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
