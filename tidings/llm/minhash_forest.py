"""Near-duplicate classes by an LSH forest over MinHash signatures.

Shingles: 5 words (A-Z lower-cased); a shorter text is one shingle; none without words.  Texts
with the same set are one class at once, by a 128-bit hash of the sorted set.  Classes get a
signature of 128 minima and stand in 16 orders: each sorts by the signature read from another
start.  Rows are range-partitioned and sorted, so regions of any size are split evenly, and
neighbours in an order that agree in 3 values or more are candidates: in a sparse region that
is everything with the common prefix, in a dense one the neighbours agree to a larger depth.
Two bits of every minimum travel along and drop neighbours whose estimate is more than 0.24 below
the threshold.  For a pair at the threshold that has probability 1.3e-8 at 85 % and 1.3e-7 at 80 %,
less than that it shares no prefix in any order (2.4e-7 and 1.0e-5).

Links are confirmed on the full sets in two rounds: first every class with its best neighbours,
then all candidates that are still in different components.  So a group is joined by about as
many links as it has members, not by all its pairs, and each candidate is either confirmed,
refuted or already joined.

What neighbours in an order don't show is found by region, i.e. by the classes with a common
prefix of 3 values.  Regions that still hold more than one component are compared in whole: first
all members of a large region with those that have most links, which joins the copies of one
original, again until that gives nothing new; then every pair of members in different components,
in cells of two blocks of the region.  A pair is compared in the first order it shares a region in.

Components are kept as a forest: new links are mapped to the roots they join, and only these pairs of
roots are worked on.  Memberships of regions are written once, and only of regions with two classes or more.
Intermediate tables are deleted as soon as a result is written.

Null and empty texts: empty set, linked with nothing.  Repeated rows and ties: same class.
Null ids: rows are kept; a component's id is the least id that isn't null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.common import Scope, Table, id_type, keyed, lower_words, read, same_doc, text_key
from tidings.llm.components import components, roots
from tidings.llm.repeats import Powers, Prefix, mix
from tidings.llm.substring_dedup import _Hashes

SHINGLE = 5
PERCENT = 85
TREES = 16
HASHES = 128
KEY_VALUES = 16  # values of a sort key: the forest's largest depth
MIN_DEPTH = 3
WINDOW = 10
HUBS = 8  # members of a large region that all others are compared with first
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1_000_000
SLACK = 0.24  # candidates whose estimate is further below the threshold are dropped


def shingles(text: str, hashes: dict, powers: Powers, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    words = lower_words(text)
    units = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(units):
        return units
    pre = Prefix(units, powers)
    n = max(1, len(units) - size + 1)
    start = np.arange(n)
    h = pre.of(start, np.minimum(start + size, len(units)))
    return np.unique(mix(h ^ np.uint64(0 if len(units) >= size else len(units))))


def _permutations():
    rng = np.random.default_rng(20240229)
    return (rng.integers(1, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


class Signatures:
    """128 minima, as 32-bit values, of sets of shingle hashes."""

    CHUNK = 512

    def __init__(self):
        self.mult = _permutations()
        self.h, self.t = (np.empty((HASHES, self.CHUNK), np.uint32) for _ in range(2))

    def of(self, sh: np.ndarray) -> np.ndarray:
        out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
        low = (sh ^ (sh >> np.uint64(32))).astype(np.uint32)
        for i in range(0, len(low), self.CHUNK):
            x = low[None, i:i + self.CHUNK]
            h, t = self.h[:, :x.shape[1]], self.t[:, :x.shape[1]]
            np.multiply(x, self.mult, out=h)
            np.right_shift(h, np.uint32(15), out=t)
            h ^= t
            h *= np.uint32(0x85EBCA6B)
            np.right_shift(h, np.uint32(13), out=t)
            h ^= t
            np.minimum(out, h.min(1), out=out)
        return out


def sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, _h, n, cid, sig`` of ``keyed`` documents; cid and sig are null for empty sets."""

    def run(it):
        hashes, powers, minima = _Hashes(), Powers(), Signatures()
        for b in it:
            n, cid, sig = [], [], []
            for t in b.column("text"):
                sh = shingles(t.as_py(), hashes, powers, size)
                n.append(len(sh))
                cid.append(xxhash.xxh3_128_digest(sh.tobytes()) if len(sh) else None)
                sig.append(minima.of(sh).tobytes() if len(sh) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_h"), pa.array(n, pa.int64()), pa.array(cid, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc_id", "_h", "n", "cid", "sig"])

    return docs.mapInArrow(run, f"doc_id {id_type(docs)}, _h binary, n long, cid binary, sig binary")


def _signatures(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, HASHES)


def _values(s: np.ndarray) -> np.ndarray:
    """16 bits of every minimum, big-endian: what sort keys consist of."""
    return (mix(s.astype(np.uint64)) & np.uint64(0xFFFF)).astype(">u2")


def _bits(s: np.ndarray) -> pa.Array:
    """Two bits of every minimum."""
    two = (s >> np.uint32(3)) & np.uint32(3)
    bits = np.packbits(np.stack([two & 1, two >> 1], -1).astype(np.uint8).reshape(len(s), -1), axis=1)
    return pa.array([r.tobytes() for r in bits], pa.binary())


def forest_rows(classes: DataFrame) -> DataFrame:
    """``tree, key, cid, n, bits`` : one row for each class and order."""

    def run(it):
        step = HASHES // TREES
        for b in it:
            if not b.num_rows:
                continue
            s = _signatures(b.column("sig"))
            v16, bits = _values(s), _bits(s)
            for t in range(TREES):
                key = np.roll(v16, -t * step, axis=1)[:, :KEY_VALUES]
                key = pa.array([r.tobytes() for r in np.ascontiguousarray(key)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), t, np.int8)), key, b.column("cid"), b.column("n"), bits],
                                                 names=["tree", "key", "cid", "n", "bits"])

    return classes.mapInArrow(run, "tree tinyint, key binary, cid binary, n long, bits binary")


_ODD = np.uint64(0x5555555555555555)


def _floor(percent: int) -> float:
    """Least number of equal pairs of bits; chance agreement is a quarter."""
    return (1 + 3 * (percent / 100 - SLACK)) / 4 * HASHES


def _agreements(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    diff = x ^ y
    return HASHES - np.bitwise_count((diff | (diff >> np.uint64(1))) & _ODD).sum(-1, dtype=np.int64)


def _words(bits: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(bits.to_pylist()), np.uint64).reshape(len(bits), 2 * HASHES // 64)


def _neighbours(percent: int):
    floor = _floor(percent)

    def run(it):
        carry = None
        for b in it:
            t = pa.Table.from_batches([b])
            if carry is not None:
                t = pa.concat_tables([carry, t])
            t = t.combine_chunks()
            rows = t.num_rows
            fresh = rows - b.num_rows
            carry = t.slice(max(0, rows - WINDOW))
            if rows < 2:
                continue
            tree, n = t["tree"].to_numpy(), t["n"].to_numpy()
            key = np.frombuffer(b"".join(t["key"].to_pylist()), np.uint8).reshape(rows, -1)[:, :2 * MIN_DEPTH]
            bits = _words(t["bits"])
            left, right, est = [], [], []
            for d in range(1, min(WINDOW, rows - 1) + 1):
                y = np.arange(max(d, fresh), rows)
                x = y - d
                ok = (tree[x] == tree[y]) & (key[x] == key[y]).all(1) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
                x, y = x[ok], y[ok]
                same = _agreements(bits[x], bits[y])
                ok = same >= floor
                left.append(x[ok])
                right.append(y[ok])
                est.append(same[ok])
            x, y = np.concatenate(left), np.concatenate(right)
            if len(x):
                cid = t["cid"].combine_chunks()
                yield pa.RecordBatch.from_arrays([cid.take(pa.array(x)), cid.take(pa.array(y)), pa.array(np.concatenate(est).astype(np.int32))],
                                                 names=["x", "y", "est"])

    return run


def candidates(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b, est`` : distinct pairs of classes, a < b, with the estimate's agreements of 128."""
    rows = forest_rows(classes).repartitionByRange("tree", "key", "cid").sortWithinPartitions("tree", "key", "cid")
    pairs = rows.mapInArrow(_neighbours(percent), "x binary, y binary, est int")
    return (pairs.where("x <> y").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .agg(F.max("est").alias("est")))


def packed_texts(needed: DataFrame, reps: DataFrame, texts: DataFrame) -> Table:
    """``cid, z`` : compressed texts of the needed classes; deals all texts once, so the rounds that follow share what it gives."""
    packed = F.arrow_udf(lambda t: pa.array([zstandard.compress(x.as_py().encode("utf-8", "surrogatepass"), 3) for x in t], pa.binary()),
                         "binary")
    r = reps.join(needed, "cid", "left_semi")
    return Table(texts.join(r, same_doc(texts, r), "inner").select(r["cid"], packed(texts["text"]).alias("z"))
                 .dropDuplicates(["cid"]), "texts")


def confirmed(pairs: DataFrame, z: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets agree: |intersection| * 100 >= percent * |union|; z has the ``packed_texts`` of both.

    Texts travel compressed: once to each class that stands as ``b``, then to each pair.
    """
    za = z.select(F.col("cid").alias("a"), F.col("z").alias("za"))
    zb = z.select(F.col("cid").alias("b"), F.col("z").alias("zb"))

    def check(it):
        hashes, powers, un = _Hashes(), Powers(), zstandard.ZstdDecompressor()
        known, size_of = {}, 0

        def of(cid, blob):
            nonlocal size_of
            if cid not in known:
                if size_of > 2_000_000:
                    known.clear()
                    size_of = 0
                known[cid] = shingles(un.decompress(blob).decode("utf-8", "surrogatepass"), hashes, powers, size)
                size_of += len(known[cid])
            return known[cid]

        for b in it:
            a_, b_ = b.column("a"), b.column("b")
            keep = []
            for i, (a, c, x, y) in enumerate(zip(a_.to_pylist(), b_.to_pylist(), b.column("za"), b.column("zb"))):
                u, v = of(a, x.as_py()), of(c, y.as_py())
                both = len(np.intersect1d(u, v, assume_unique=True))
                if 100 * both >= percent * (len(u) + len(v) - both):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([a_.take(keep), b_.take(keep)], names=["a", "b"])

    return pairs.select("a", "b").join(zb, "b").join(za, "a").select("a", "b", "za", "zb").mapInArrow(check, "a binary, b binary")


def _with_root(pairs: DataFrame, found: DataFrame, col: str) -> DataFrame:
    r = found.select(F.col("id").alias(f"_{col}"), F.col("root").alias(f"r{col}"))
    return (pairs.join(r, pairs[col] == r[f"_{col}"], "left").withColumn(f"r{col}", F.coalesce(f"r{col}", col)).drop(f"_{col}"))


def joined(found: Table | None, links: DataFrame) -> Table:
    """``id, root`` of all classes that aren't roots, after more links ``a, b``; deletes the forest before."""
    if found is not None:
        ends = _with_root(_with_root(links.select("a", "b"), found.df(), "a"), found.df(), "b")
        links = ends.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
    stars = components(links)
    new = roots(stars)
    if found is not None:
        r = new.withColumnsRenamed({"id": "_id", "root": "_root"})
        moved = found.df().join(r, F.col("root") == F.col("_id"), "left").select("id", F.coalesce("_root", "root").alias("root"))
        new = moved.unionByName(new)
    out = Table(new, "forest")
    stars.drop()
    if found is not None:
        found.drop()
    return out


def region_members(classes: DataFrame) -> DataFrame:
    """``cid, n, bits, regions`` : the region (order and first values) of a class in every order."""

    def run(it):
        step = HASHES // TREES
        for b in it:
            if not b.num_rows:
                continue
            s = _signatures(b.column("sig"))
            v = _values(s).astype(np.int64)
            regions = np.empty((len(s), TREES), np.int64)
            for t in range(TREES):
                regions[:, t] = t
                for i in range(MIN_DEPTH):
                    regions[:, t] = regions[:, t] << 16 | v[:, (t * step + i) % HASHES]
            ends = pa.array(np.arange(0, TREES * len(s) + 1, TREES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column("cid"), b.column("n"), _bits(s), pa.ListArray.from_arrays(ends, pa.array(regions.ravel()))],
                                             names=["cid", "n", "bits", "regions"])

    return classes.mapInArrow(run, "cid binary, n long, bits binary, regions array<bigint>")


def memberships(members: DataFrame) -> Table:
    """``region, cid, n, bits`` of the regions with two classes or more, written once."""
    at = Table(members.select(F.explode("regions").alias("region"), "cid"), "regions")
    some = at.df().groupBy("region").count().where("count > 1").select("region")
    out = Table(at.df().join(some, "region").join(members.select("cid", "n", "bits"), "cid").select("region", "cid", "n", "bits"), "shared")
    at.drop()
    return out


def _shared_regions(rooted: DataFrame) -> DataFrame:
    """``region, rows, shingles`` of the regions with more than one component."""
    return (rooted.groupBy("region").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("rows"),
                                         F.sum("n").alias("shingles")).where("lo <> hi").drop("lo", "hi"))


def hub_pairs(rows: DataFrame, links: DataFrame, used: DataFrame | None, percent: int) -> tuple[Table, DataFrame]:
    """(``region, hub``, pairs ``a, b`` of a region's members with those of most links, in different components)."""
    ends = links.select(F.col("a").alias("cid")).unionByName(links.select(F.col("b").alias("cid")))
    degree = ends.groupBy("cid").agg(F.count("*").alias("degree"))
    left = rows.join(degree, "cid")
    if used is not None:
        left = left.join(used, (left["region"] == used["region"]) & (left["cid"] == used["hub"]), "left_anti")
    salt = F.pmod(F.xxhash64("root"), F.lit(HUBS))
    hubs = (left.groupBy("region", salt.alias("_s")).agg(F.max(F.struct("degree", "cid", "root", "n", "bits")).alias("h"))
            .select("region", F.col("h.cid").alias("hub"), F.col("h.root").alias("hub_root"), F.col("h.n").alias("hub_n"),
                    F.col("h.bits").alias("hub_bits")))
    hubs = Table(hubs, "hubs")
    same = F.arrow_udf(lambda x, y: pa.array(_agreements(_words(x), _words(y))), "long")
    p = rows.join(hubs.df(), "region").where(F.col("root") != F.col("hub_root"))
    p = p.where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")).where(same("bits", "hub_bits") >= _floor(percent))
    return hubs, p.select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()


def _cells(rows: DataFrame) -> DataFrame:
    """Members dealt to cells ``region, i, j`` : blocks i and j of the region, i <= j; ``block`` is the member's own."""
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    r = rows.withColumn("_n", blocks).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("_n")).cast("int"))
    r = r.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return r.select("region", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"), "block", "cid", "root", "n", "bits", "regions")


def _by_cell(cells: DataFrame, work, schema: str) -> DataFrame:
    """``work(table)`` for every cell."""

    def run(it):
        held, cell = [], None
        for b in it:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy() for c in ("region", "i", "j")], 1)
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            for s, e in zip(first, np.r_[first[1:], len(keys)]):
                if cell is not None and (keys[s] != cell).any():
                    yield from work(pa.Table.from_batches(held).combine_chunks())
                    held = []
                cell = keys[s].copy()
                held.append(b.slice(s, e - s))
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    key = ["region", "i", "j"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def _open_pairs(t: pa.Table, percent: int):
    """For members of a cell one after the other: (x, those y that x is still to be compared with)."""
    region, i, j = (t[c][0].as_py() for c in ("region", "i", "j"))
    block, n, bits = t["block"].to_numpy(), t["n"].to_numpy(), _words(t["bits"])
    regions = t["regions"].combine_chunks().flatten().to_numpy().reshape(len(t), TREES)
    _, root = np.unique(np.array(t["root"].to_pylist(), object), return_inverse=True)
    tree, floor = region >> 16 * MIN_DEPTH, _floor(percent)
    at = np.arange(len(t))
    for x in np.flatnonzero(block == i):
        y = np.flatnonzero((root != root[x]) & ((block == j) if i != j else (at > x)))
        y = y[100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])]
        y = y[(regions[y, :tree] != regions[x, :tree]).all(1)]  # else compared in an earlier order
        y = y[_agreements(bits[x], bits[y]) >= floor]
        if len(y):
            yield x, y


def _open_members(percent: int):
    def work(t):
        needed = np.zeros(len(t), bool)
        for x, y in _open_pairs(t, percent):
            needed[x] = needed[y] = True
        if needed.any():
            yield from t.filter(pa.array(needed)).to_batches()

    return work


def _compare(percent: int, size: int):
    """Links of a cell's members by their full sets; members that a link has joined aren't compared again."""
    powers = Powers()

    def work(t):
        hashes, un = _Hashes(), zstandard.ZstdDecompressor()
        sets_ = [shingles(un.decompress(z.as_py()).decode("utf-8", "surrogatepass"), hashes, powers, size) for z in t["z"]]
        ends = np.cumsum([0, *map(len, sets_)])
        _, unit = np.unique(np.concatenate(sets_), return_inverse=True)
        mark = np.zeros(unit.max() + 1, bool)
        group = np.arange(len(t))
        cid, a, b = t["cid"].to_pylist(), [], []
        for x, y in _open_pairs(t, percent):
            y = y[group[y] != group[x]]
            if not len(y):
                continue
            own = unit[ends[x]:ends[x + 1]]
            mark[own] = True
            both = np.array([np.count_nonzero(mark[unit[ends[k]:ends[k + 1]]]) for k in y])
            mark[own] = False
            total = len(own) + (ends[y + 1] - ends[y]) - both
            for k in y[100 * both >= percent * total]:
                if group[k] != group[x]:
                    group[group == group[k]] = group[x]
                    a.append(min(cid[x], cid[k]))
                    b.append(max(cid[x], cid[k]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return work


def region_links(members: DataFrame, found: Table, links: DataFrame, tested: DataFrame, reps: DataFrame, texts: DataFrame, percent: int,
                 size: int) -> Table:
    """The forest after all links that join components with a common region."""
    shared = memberships(members)
    used = z = None

    def rooted() -> Table:
        r = _with_root(shared.df().withColumnRenamed("cid", "a"), found.df(), "a")
        return Table(r.withColumnsRenamed({"a": "cid", "ra": "root"}), "rooted")

    while True:
        now = rooted()
        regions = Table(_shared_regions(now.df()), "regions")
        large = regions.df().where(F.col("rows") > WINDOW + 1)
        if large.isEmpty():
            break
        rows = Table(now.df().join(large, "region").select("region", "cid", "root", "n", "bits"), "large")
        hubs, pairs = hub_pairs(rows.df(), links, used, percent)
        pairs = Table(pairs.join(tested, ["a", "b"], "left_anti"), "pairs").df()
        rows.drop()
        if pairs.isEmpty():
            break
        if z is None:  # later rounds compare members of these regions only, as components grow
            z = packed_texts(now.df().join(regions.df(), "region").select("cid").distinct(), reps, texts).df()
        more = Table(confirmed(pairs, z, percent, size), "links").df()
        if more.isEmpty():
            break
        found = joined(found, more)
        hubs = hubs.df().select("region", "hub")
        used = hubs if used is None else used.unionByName(hubs)
        links, tested = links.unionByName(more), tested.unionByName(pairs)
        now.drop()
        regions.drop()
    open_ = now.df().join(regions.df(), "region").join(members.select("cid", "regions"), "cid")
    types = "region long, i int, j int, block int, cid binary, root binary, n long, bits binary, regions array<bigint>"
    left = Table(_by_cell(_cells(open_), _open_members(percent), types), "open").df()
    if left.isEmpty():
        return found
    if z is None:
        z = packed_texts(left.select("cid").distinct(), reps, texts).df()
    return joined(found, Table(_by_cell(left.join(z, "cid"), _compare(percent, size), "a binary, b binary"), "links").df())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``doc_id, _h, n_shingles, component_id, kept`` of every row of ``docs``."""
    with Scope() as scope:
        out = Table(_near_duplicates(docs, percent, size), "near-duplicates")
        scope.drop(but=out)
    return out.df()


def _near_duplicates(docs: DataFrame, percent: int, size: int) -> DataFrame:
    base = keyed(docs)
    s = Table(sets(base, size), "sets").df()
    # one row a class: its least document stands for it
    classes = Table(s.where("cid is not null").groupBy("cid")
                    .agg(F.min(F.struct("doc_id", "_h")).alias("r"), F.min("doc_id").alias("least"), F.first("n").alias("n"),
                         F.first("sig").alias("sig"))
                    .select("cid", "r.doc_id", "r._h", "least", "n", "sig"), "classes")
    pairs = Table(candidates(classes.df().select("cid", "n", "sig"), percent), "pairs").df()
    reps = classes.df().select("cid", "doc_id", "_h")
    # round 1: every class with its best neighbour
    ends = pairs.select("a", "b", "est").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "est"))
    z = packed_texts(ends.select(F.col("a").alias("cid")).distinct(), reps, base)
    best = ends.groupBy("a").agg(F.max(F.struct("est", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    best = Table(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "best").df()
    links = Table(confirmed(best, z.df(), percent, size), "links").df()
    found = joined(None, links)
    # round 2: candidates that are still apart
    apart = _with_root(_with_root(pairs.select("a", "b"), found.df(), "a"), found.df(), "b").where("ra <> rb").select("a", "b")
    apart = Table(apart.join(best, ["a", "b"], "left_anti"), "apart").df()
    more = Table(confirmed(apart, z.df(), percent, size), "links").df()
    z.drop()
    found = joined(found, more)
    members = Table(region_members(classes.df().select("cid", "n", "sig")), "members").df()
    found = region_links(members, found, links.unionByName(more), best.unionByName(apart), reps, base, percent, size)
    rooted = _with_root(classes.df().select(F.col("cid").alias("a"), "least"), found.df(), "a")
    least = rooted.groupBy("ra").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(least, "ra").select(F.col("a").alias("cid"), "component_id")
    out = s.select("doc_id", "_h", "n", "cid").join(of_class, "cid", "left")
    cid = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "_h", F.col("n").alias("n_shingles"), cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, F.lit(False)).alias("kept"))


def keep_first(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The documents that stand for their component, all columns; repeated rows of one of these stay once.

    Documents without words and documents without an id are kept: they are linked to nothing or
    can't be named by a component.
    """
    found = near_duplicates(docs, percent, size).where("kept or n_shingles = 0 or component_id is null").select("doc_id", "_h").distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select(
        "row", F.col("row.doc_id").alias("doc_id"), text_key(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("_h"))
    rows = rows.join(found, same_doc(rows, found), "left_semi")
    # of repeated rows that one with the least hash of all its columns: the same when a task runs again
    order = F.xxhash64(F.to_json("row"))
    return rows.groupBy("doc_id", "_h").agg(F.min_by("row", order).alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).drop("_h")


ORACLE = r"""
with recursive d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sh as (select distinct rid, md5(array_to_string(w[i:i + 4], ' ')) as s from d, unnest(generate_series(1, greatest(1, len(w) - 4))) as t(i)
       where len(w) > 0),
n as (select rid, count(*) as n from sh group by rid),
shared as (select a.rid as a, b.rid as b, count(*) as k from sh a join sh b on a.s = b.s and a.rid < b.rid group by a.rid, b.rid),
link as (select a, b from shared join n na on na.rid = a join n nb on nb.rid = b where 100 * k >= 85 * (na.n + nb.n - k)),
edge as (select a, b from link union all select b, a from link),
reach(a, b) as (select rid, rid from d union select reach.a, edge.b from reach join edge on reach.b = edge.a),
least as (select reach.a as rid, min(d.doc_id) as component_id from reach join d on reach.b = d.rid group by reach.a)
select doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, coalesce(doc_id = component_id, false) as kept
from d left join n using (rid) join least using (rid)
"""
