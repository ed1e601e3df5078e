"""Scoring, masking of rated articles, and per-user top-N.

score(u, a) = u . v_a for every user and article; an article the user already
rated is excluded; a candidate must have a strictly positive score; the list
keeps the N best, best first, ties broken by the smaller article id.  The
score matrix is never materialised as rows.

Physical plans (chosen by a size check, never by hope):

* **broadcast catalogue** (``n_articles * factor_bytes(k) <= max_broadcast_bytes``):
  the article factors are shipped once per executor; users are hashed into
  blocks and cogrouped with their rated pairs; each block walks the catalogue
  in chunks of falling vector norm keeping a running top-N, and a user stops where
  no later article can reach the N-th score.  No user row is replicated.
* **blocked catalogue** (larger): articles are dealt to blocks by falling
  vector norm.  All users meet the first block; a user's row is then sent only to
  the blocks whose longest vector can still reach the user's N-th score (ties go
  on), and article rows only to the user blocks that ask for them.  Each (user
  block, article block) cell emits at most N candidates per user, and a
  ``row_number`` over these keeps the final N.  The driver sees one number a block.

A user's mask is bounded by the catalogue size, so a user who rated a third
of everything still fits a block.
"""

from __future__ import annotations

import math
import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.vectors import squared_norm
from tidings.operators.als import DEFAULT_MAX_BROADCAST_BYTES, factor_bytes
from tidings.operators.ranking import with_positions
from tidings.session import DEFAULT_TOP_N, discard, materialize

DEFAULT_USERS_PER_BLOCK = 512         # users per cogroup group (broadcast catalogue)
DEFAULT_CELL_USERS = 65536            # users per cell (blocked catalogue)
DEFAULT_TILE_USERS = 512              # users per score tile inside a task
DEFAULT_ARTICLE_CHUNK = 4096          # articles per score tile
DEFAULT_ARTICLES_PER_BLOCK = 65536    # articles per cell (blocked catalogue)

MASK_ROWS = 4_000_000                 # rated pairs per group, on average
TASK_BYTES = 64 * 1024 * 1024         # bytes read by a scoring task

_RANKED_SCHEMA = "userid long, rank int, article_id long, score double"
_NO_ID = np.iinfo(np.int64).max


def _matrix(col, n: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if n == 0:
        return np.zeros((0, 0))
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, flat.size // n)


class Catalogue:
    """Articles in chunks of falling vector norm, by id within a chunk: what the walk of ``catalogue_top_n`` needs."""

    def __init__(self, aid: np.ndarray, vmat: np.ndarray, chunk: int = DEFAULT_ARTICLE_CHUNK):
        norm = np.sqrt((vmat * vmat).sum(axis=1)) if len(aid) else np.empty(0)
        norm[np.isnan(norm)] = np.inf
        order = np.argsort(-norm, kind="stable")
        self.starts = np.arange(0, len(aid), chunk)
        self.ends = np.minimum(self.starts + chunk, len(aid))
        # no vector of a chunk is longer than its first one
        self.longest = norm[order[self.starts]]
        order = order[np.lexsort((aid[order], np.arange(len(aid)) // chunk))]
        self.aid, self.vmat = aid[order], vmat[order]
        self._by_id = np.argsort(self.aid, kind="stable")

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Where articles stand; -1 for unknown ones."""
        if not len(self.aid):
            return np.full(len(ids), -1)
        sorted_ids = self.aid[self._by_id]
        at = np.minimum(np.searchsorted(sorted_ids, ids), len(sorted_ids) - 1)
        return np.where(sorted_ids[at] == ids, self._by_id[at], -1)


# bounds are products of rounded norms: this much above them is safe
_BOUND = 1 + 1e-9


def catalogue_top_n(uid: np.ndarray, umat: np.ndarray, cat: Catalogue, mask_u: np.ndarray, mask_a: np.ndarray, n: int,
                    tile_users: int = DEFAULT_TILE_USERS, seen: dict | None = None):
    """Top-n unrated, positive-score articles per user of one block: (user index, rank, article id, score).

    Chunks are walked by falling norm.  A user leaves the walk when the norm of the next chunk times the user's own can't reach the
    n-th score any more (a score equal to it could still win by its id, so ties go on).  Work is tiled as (tile_users x chunk)
    score matrices, so memory stays bounded however large the block.  ``seen`` counts (user, article) scores made and left out.
    """
    if len(uid) > tile_users:
        order = np.argsort(uid, kind="stable")
        su = uid[order]
        outs = []
        for s in range(0, len(uid), tile_users):
            rows = order[s:s + tile_users]
            lo, hi = su[s], su[min(s + tile_users, len(uid)) - 1]
            sel = (mask_u >= lo) & (mask_u <= hi)
            rr, kk, art, sc = catalogue_top_n(uid[rows], umat[rows], cat, mask_u[sel], mask_a[sel], n, tile_users, seen)
            outs.append((rows[rr], kk, art, sc))
        return tuple(np.concatenate([o[i] for o in outs]) for i in range(4))
    b, m = len(uid), len(cat.aid)
    if b == 0 or m == 0:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0)
    best_s = np.full((b, n), -np.inf)
    best_a = np.full((b, n), _NO_ID, dtype=np.int64)
    # mask pairs -> (row, place), by place
    order = np.argsort(uid, kind="stable")
    pos_u = np.searchsorted(uid[order], mask_u)
    place = cat.places(mask_a)
    ok = (pos_u < b) & (uid[order][np.minimum(pos_u, b - 1)] == mask_u) & (place >= 0)
    m_rows, m_cols = order[pos_u[ok]], place[ok]
    by_place = np.argsort(m_cols, kind="stable")
    m_rows, m_cols = m_rows[by_place], m_cols[by_place]
    length = np.sqrt((umat * umat).sum(axis=1)) * _BOUND
    length[np.isnan(length)] = np.inf
    active = np.arange(b)
    where = np.empty(b, np.int64)
    for start, end, longest in zip(cat.starts, cat.ends, cat.longest):
        with np.errstate(invalid="ignore"):
            most = length[active] * longest
        active = active[~((most < best_s[active, n - 1]) | (most <= 0))]
        if seen is not None:
            seen["scored"] = seen.get("scored", 0) + len(active) * (end - start)
            seen["skipped"] = seen.get("skipped", 0) + (b - len(active)) * (end - start)
        if not len(active):
            if seen is not None:
                seen["skipped"] += b * (m - end)
            break
        s = (umat if len(active) == b else umat[active]) @ cat.vmat[start:end].T
        i, j = np.searchsorted(m_cols, [start, end])
        where[:] = -1
        where[active] = np.arange(len(active))
        row = where[m_rows[i:j]]
        s[row[row >= 0], m_cols[i:j][row >= 0] - start] = -np.inf
        s[~(s > 0)] = -np.inf  # strict positive; NaN never wins
        cs, cc = _chunk_candidates(s, n)
        all_s = np.concatenate([best_s[active], cs], axis=1)
        all_a = np.concatenate([best_a[active], cat.aid[start + cc]], axis=1)
        o = np.lexsort((all_a, -all_s), axis=1)[:, :n]
        best_s[active] = np.take_along_axis(all_s, o, axis=1)
        best_a[active] = np.take_along_axis(all_a, o, axis=1)
    rr, kk = np.nonzero(np.isfinite(best_s))
    return rr, (kk + 1).astype(np.int32), best_a[rr, kk], best_s[rr, kk]


def block_top_n(uid: np.ndarray, umat: np.ndarray, aid: np.ndarray, vmat: np.ndarray,
                mask_u: np.ndarray, mask_a: np.ndarray, n: int, chunk: int = DEFAULT_ARTICLE_CHUNK,
                tile_users: int = DEFAULT_TILE_USERS):
    """``catalogue_top_n`` of a catalogue that is used once."""
    return catalogue_top_n(uid, umat, Catalogue(aid, vmat, chunk), mask_u, mask_a, n, tile_users)


def _chunk_candidates(s: np.ndarray, n: int):
    """Exact top-n (score desc, column asc) candidates of each row of one score tile."""
    b, w = s.shape
    if w <= n:
        return s, np.ascontiguousarray(np.broadcast_to(np.arange(w, dtype=np.int64), (b, w)))
    idx = np.argpartition(s, w - n, axis=1)[:, w - n:]
    cs, cc = np.take_along_axis(s, idx, axis=1), idx.astype(np.int64)
    kth = cs.min(axis=1)
    # rows where values equal to the n-th score were left out: pick them exactly (rare)
    ties = np.flatnonzero(np.isfinite(kth) & ((s >= kth[:, None]).sum(axis=1) > n))
    for r in ties:
        c = np.flatnonzero(s[r] >= kth[r])
        o = np.lexsort((c, -s[r, c]))[:n]
        cs[r], cc[r] = s[r, c[o]], c[o]
    return cs, cc


def _ranked_batch(uid, rr, kk, art, sc) -> pa.Table:
    return pa.table({"userid": pa.array(uid[rr], pa.int64()), "rank": pa.array(kk, pa.int32()),
                     "article_id": pa.array(art, pa.int64()), "score": pa.array(sc, pa.float64())})


def _broadcast_kernel(bc, n: int, apply_mask: bool, tile_users: int = DEFAULT_TILE_USERS):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        uid = left.column("id").to_numpy()
        umat = _matrix(left.column("f"), len(uid))
        if apply_mask and right.num_rows:
            mu, ma = right.column("user_id").to_numpy(), right.column("article_id").to_numpy()
        else:
            mu = ma = np.empty(0, np.int64)
        rr, kk, art, sc = catalogue_top_n(uid, umat, bc.value, mu, ma, n, tile_users)
        return _ranked_batch(uid, rr, kk, art, sc)
    return run


def _cell_kernel(n: int, chunk: int, tile_users: int = DEFAULT_TILE_USERS):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        uid = left.column("id").to_numpy()
        umat = _matrix(left.column("f"), len(uid))
        kind = right.column("kind").to_numpy()
        arts = right.filter(pa.array(kind == 0))
        pairs = right.filter(pa.array(kind == 1))
        aid = arts.column("article_id").to_numpy()
        vmat = _matrix(arts.column("f"), len(aid))
        rr, kk, art, sc = block_top_n(uid, umat, aid, vmat, pairs.column("user_id").to_numpy(),
                                      pairs.column("article_id").to_numpy(), n, chunk, tile_users)
        return _ranked_batch(uid, rr, kk, art, sc)
    return run


def _score_tasks(spark, n_groups: int, n_bytes: int) -> int:
    """Tasks for a compute-heavy stage: by the bytes it reads, two a core at least, one a group at most."""
    return max(1, min(n_groups, max(2 * spark.sparkContext.defaultParallelism, -(-n_bytes // TASK_BYTES))))


def _mask(ratings: DataFrame, tasks: int, keys: list[str], columns: list) -> DataFrame:
    """Rated pairs dealt by the groups' keys; re-ratings are dropped where they land, with no exchange of their own."""
    return ratings.select(*columns).repartition(tasks, *keys).dropDuplicates([*keys, "user_id", "article_id"])


def recommend(users: DataFrame, articles: DataFrame, ratings: DataFrame | None, n: int = DEFAULT_TOP_N,
              k: int | None = None, n_users: int | None = None, n_articles: int | None = None,
              users_per_block: int | None = None, article_chunk: int = DEFAULT_ARTICLE_CHUNK,
              articles_per_block: int = DEFAULT_ARTICLES_PER_BLOCK,
              max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
              tile_users: int = DEFAULT_TILE_USERS, n_ratings: int | None = None) -> DataFrame:
    """Ranked rows (userid, rank, article_id, score) of the true top-n per user.

    ``ratings`` None disables the rated-article mask (raw top scores).
    """
    spark = users.sparkSession
    if n_articles is None:
        n_articles = articles.count()
    if n_users is None:
        n_users = users.count()
    if k is None:
        first = articles.select(F.size("f")).first()
        k = first[0] if first else 1
    broadcast_catalogue = n_articles * factor_bytes(k) <= max_broadcast_bytes
    per_block = users_per_block or (DEFAULT_USERS_PER_BLOCK if broadcast_catalogue else DEFAULT_CELL_USERS)
    if n_ratings is None:
        n_ratings = ratings.count() if ratings is not None else 0
    n_ab = 1 if broadcast_catalogue else max(1, math.ceil(n_articles / articles_per_block))
    # groups are bounded by their users and by the rated pairs that mask them
    n_ub = max(1, math.ceil(n_users / per_block), math.ceil(n_ratings / (MASK_ROWS * n_ab)))
    if not broadcast_catalogue:  # all users meet the first block at once: enough groups for all cores
        n_ub = max(n_ub, math.ceil(n_ratings / MASK_ROWS), min(4 * spark.sparkContext.defaultParallelism, math.ceil(n_users / DEFAULT_USERS_PER_BLOCK)))
    tasks = _score_tasks(spark, n_ub, n_users * factor_bytes(k) + 24 * n_ratings)
    u = users.select("id", "f", F.pmod(F.xxhash64("id"), F.lit(n_ub)).cast("int").alias("ub"))
    ub = F.pmod(F.xxhash64("user_id"), F.lit(n_ub)).cast("int").alias("ub")
    if broadcast_catalogue:
        tbl = articles.select("id", "f").toArrow()  # bounded by the check above
        aid = tbl.column("id").to_numpy()
        vmat = _matrix(tbl.column("f"), len(aid)) if len(aid) else np.zeros((0, k))
        bc = spark.sparkContext.broadcast(Catalogue(aid, vmat, article_chunk))
        rated = ratings if ratings is not None else spark.createDataFrame([], "user_id long, article_id long")
        # explicit co-partitioning: AQE would otherwise merge this small-input, compute-heavy stage into few tasks
        right = _mask(rated, tasks, ["ub"], ["user_id", "article_id", ub])
        out = (u.repartition(tasks, "ub").groupBy("ub").cogroup(right.groupBy("ub"))
               .applyInArrow(_broadcast_kernel(bc, n, ratings is not None, tile_users), _RANKED_SCHEMA))
        # executors drop their copies with this frame; a plan made from it fetches them anew from the driver's file
        weakref.finalize(out, bc.unpersist)
        return out
    return _recommend_by_norm(u, articles, ratings, n, n_ub, n_ab, articles_per_block, article_chunk, tile_users)


def _cells(left: DataFrame, arts: DataFrame, mask: DataFrame | None, n: int, n_ub: int, chunk: int, tile_users: int) -> DataFrame:
    """Top-n candidates of users (id, f, ub, ab) among the articles (id, f, ab) of the blocks they are sent to."""
    asked = left.select(F.col("ub").alias("_ub"), F.col("ab").alias("_ab")).distinct()
    right = arts.join(asked, F.col("ab") == F.col("_ab")).select(
        F.lit(0).alias("kind"), F.col("id").alias("article_id"), "f", F.lit(None).cast("bigint").alias("user_id"), "_ab", "_ub")
    if mask is not None:  # a pair that is rated again masks once more, which changes nothing
        right = right.unionByName(mask.join(asked, (F.col("ub") == F.col("_ub")) & (F.col("ab") == F.col("_ab")), "left_semi").select(
            F.lit(1).alias("kind"), "article_id", F.lit(None).cast("array<double>").alias("f"), "user_id", F.col("ab").alias("_ab"), F.col("ub").alias("_ub")))
    tasks = max(2 * left.sparkSession.sparkContext.defaultParallelism, n_ub)
    return (left.select("id", "f", "ub", "ab").repartition(tasks, "ub", "ab").groupBy("ub", "ab")
            .cogroup(right.repartition(tasks, "_ub", "_ab").groupBy("_ub", "_ab"))
            .applyInArrow(_cell_kernel(n, chunk, tile_users), _RANKED_SCHEMA))


def _recommend_by_norm(users: DataFrame, articles: DataFrame, ratings: DataFrame | None, n: int, n_ub: int, n_ab: int,
                       articles_per_block: int, chunk: int, tile_users: int) -> DataFrame:
    spark = users.sparkSession
    made = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        made.append(materialize(df, name))
        return made[-1]

    length = lambda f: F.sqrt(squared_norm(f))
    placed = with_positions(articles.select("id", "f", length("f").alias("norm")), [F.col("norm").desc(), F.col("id")])
    arts = keep(placed.select("id", "f", "norm", F.least(F.floor(F.col("pos") / articles_per_block), F.lit(n_ab - 1)).cast("int").alias("ab")), "articles")
    users = keep(users.withColumn("length", length("f") * F.lit(_BOUND)), "users")
    mask = None
    if ratings is not None:
        # one row a rated pair, with the article's block
        ub = F.pmod(F.xxhash64("user_id"), F.lit(n_ub)).cast("int").alias("ub")
        block = arts.select(F.col("id").alias("article_id"), "ab")
        mask = keep(ratings.select("user_id", "article_id", ub).join(block, "article_id"), "mask")
    cand = keep(_cells(users.withColumn("ab", F.lit(0)), arts.where("ab = 0"), None if mask is None else mask.where("ab = 0"), n, n_ub, chunk, tile_users), "candidates")
    longest = [r["norm"] for r in arts.groupBy("ab").agg(F.max("norm").alias("norm")).orderBy("ab").collect()][1:]  # a number a block
    if longest:
        # NaN norms come first and rule nothing out, as NaN is the largest number to Spark
        bounds = F.array(*[F.lit(float(x)) for x in longest])
        nth = cand.where(F.col("rank") == n).select(F.col("userid").alias("id"), F.col("score").alias("nth"))
        open_ = users.join(nth, "id", "left").withColumn("blocks", F.size(F.filter(
            bounds, lambda norm: (norm * F.col("length") >= F.coalesce("nth", F.lit(0.0))) & (norm * F.col("length") > 0))))
        left = keep(open_.where("blocks > 0").select("id", "f", "ub", F.explode(F.sequence(F.lit(1), F.col("blocks"))).alias("ab")), "open")
        more = _cells(left, arts.where("ab > 0"), None if mask is None else mask.where("ab > 0"), n, n_ub, chunk, tile_users)
        w = Window.partitionBy("userid").orderBy(F.col("score").desc(), F.col("article_id").asc())
        cand = (cand.unionByName(more).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                .select("userid", F.col("rank").cast("int"), "article_id", "score"))
    out = materialize(cand, "ranked")
    for table in made:
        discard(table)
    return out


def to_lists(ranked: DataFrame, n: int = DEFAULT_TOP_N, require_full: bool = True) -> DataFrame:
    """(userid, recommendations) lists, best first.

    ``require_full``: keep users with exactly n recommendations (batch rule);
    otherwise users with at least one (fold-in rule).  Groups hold <= n rows.
    """
    lists = (ranked.groupBy("userid")  # at most n ranked rows per user
             .agg(F.sort_array(F.collect_list(F.struct("rank", "article_id"))).alias("l"))
             .select("userid", F.col("l.article_id").alias("recommendations")))
    size = F.size("recommendations")
    return lists.where(size == n) if require_full else lists.where(size >= 1)


def lists_to_rows(lists: DataFrame) -> DataFrame:
    """(userid, recommendations) -> (userid, rank, article_id)."""
    return lists.select("userid", F.posexplode("recommendations").alias("p", "article_id")).select(
        "userid", (F.col("p") + 1).cast("int").alias("rank"), "article_id")
