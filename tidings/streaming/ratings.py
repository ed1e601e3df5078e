"""Keeping recommendation lists current from a stream of rating messages.

Per micro-batch (``foreachBatch``), set-wise:

1. decode the messages (tolerant; rejects are counted, not fatal);
2. write the good ratings as a data folder of the ratings table;
3. remove every article a user just rated from that user's list: lists are
   exploded (at most N rows per user), anti-joined with the batch's
   (user, article) pairs and regrouped, so no group is larger than N;
4. users whose list ran empty get a fresh list: fold-in of their factors
   from the article factors over *all* their ratings, then top-N with
   the rated articles masked (``require_full=False``);
5. write the changed lists as a data folder, and commit both at once.

Users without a row in the table are ignored (the inner semantics of a keyed
lookup) and counted in the batch result (``unknown_users``).

Ratings, lists and article factors live in one ``sources.snapshots.Store``: a commit names
the folders of all three tables, the last batch that is stored (``last``) and the last one whose ratings the lists
have taken in (``applied``).  So a half-written batch counts for nothing, a replayed batch that
was committed changes nothing, and one that wasn't is worked out anew.  Lists are merge-on-read: a base (by the batch job or
``compact``) and deltas with the users whose list changed, latest per user.  A batch reads only the
buckets of its own users.

The batch job replaces base and factors in one commit.  Batches that it has not seen are applied by the next one, so nothing
that was streamed while it ran is lost.  ``maintain`` merges deltas and stored batches of equal level, and deltas
into the base when they have grown to its size, so the number of folders grows with the logarithm of the batches.

Batch numbers go on from the last one committed, also when a checkpoint is lost.
A source that then gives all messages again (``rereads``) replaces the ratings
stored before, so none counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.messages import decode_ratings, split_decoded
from tidings.operators import als, topn
from tidings.schemas import RATINGS, RECOMMENDATIONS, STORED_FACTORS
from tidings.session import DEFAULT_LAMBDA, DEFAULT_TOP_N, discard, materialize
from tidings.sources.sinks import loaded_factors, stored_factors
from tidings.sources.snapshots import DEFAULT_BUCKETS, RETENTION_SECONDS, Part, Snapshot, Store

# Fixed value: micro-batch interval of the list updater.
TRIGGER_INTERVAL = "2 seconds"
# parts of one level that are merged
FANOUT = 8
# the level of a part that no merge of deltas touches
BASE = -1

LISTS, STREAMED, FACTORS = "recommendations", "ratings", "article_factors"
_COLUMNS = [f.name for f in RATINGS.fields]
_BATCH = T.StructField("batch", T.LongType())
_LISTS = T.StructType([*RECOMMENDATIONS.fields, _BATCH])
_RATINGS = T.StructType([*RATINGS.fields, _BATCH])


# ------------------------------------------------------------ the tables

def open_store(spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS) -> Store:
    """The engine's store; ``buckets`` (of users) counts for a new one."""
    return Store(spark, root, buckets)


def put_model(store: Store, lists: DataFrame, factors: DataFrame | None = None, taken: int = -1) -> Snapshot:
    """A new version of the lists, and of the article factors (id, f) they come from, in one commit.

    ``taken``: the last stream batch whose ratings they know.
    """
    n_lists = lists.count()
    parts = {LISTS: [store.write(lists.select("userid", "recommendations").withColumn("batch", F.lit(taken).cast("long")), LISTS, "userid",
                                 n_lists, level=BASE, last=taken)]}
    facts = {"trained": taken, "applied": taken}
    if factors is not None:
        facts["n_articles"] = factors.count()
        parts[FACTORS] = [store.write(stored_factors(factors), FACTORS, "articleId", facts["n_articles"], level=BASE)]
    return store.update(lambda snap: (parts, facts | {"version": snap.fact("version") + 1}))


def put_base_ratings(store: Store, ratings: DataFrame) -> Snapshot:
    """The ratings from before the stream, kept by user bucket (replaces those kept before)."""
    rows = ratings.select(*[F.col(f.name).cast(f.dataType) for f in RATINGS.fields]).withColumn("batch", F.lit(-1).cast("long"))
    part = store.write(rows, STREAMED, "user_id", level=BASE)
    return store.update(lambda snap: ({STREAMED: [part, *[p for p in snap.parts(STREAMED) if p.last >= 0]]}, {}))


def read_lists(store: Store, snapshot: Snapshot | None = None, users: DataFrame | None = None) -> DataFrame:
    """(userid, recommendations): base and deltas of a snapshot (the newest), latest per user.

    ``users`` (a ``userid`` column): only theirs; only their buckets are scanned.
    """
    snap = snapshot or store.snapshot()
    if users is None:
        rows = store.read(snap, LISTS, _LISTS)
    else:
        keys = users.select("userid").distinct()
        rows = store.read(snap, LISTS, _LISTS, store.buckets_of(keys, "userid")).join(keys, "userid", "left_semi")
    if len(snap.parts(LISTS)) <= 1:
        return rows.select("userid", "recommendations")
    # per user at most a row a part, partially aggregated
    return rows.groupBy("userid").agg(F.max_by("recommendations", "batch").alias("recommendations"))


def stored_ratings(store: Store, snapshot: Snapshot | None = None, users: DataFrame | None = None, base: bool = True) -> DataFrame:
    """(user_id, article_id, rating, batch) of a snapshot; ``base=False``: what was streamed only; ``users`` as in ``read_lists``."""
    snap = snapshot or store.snapshot()
    if not base:
        snap = Snapshot(snap.number, {STREAMED: tuple(p for p in snap.parts(STREAMED) if p.last >= 0)}, snap.facts)
    if users is None:
        return store.read(snap, STREAMED, _RATINGS).drop("bucket")
    keys = users.select(F.col("userid").alias("user_id")).distinct()
    return store.read(snap, STREAMED, _RATINGS, store.buckets_of(keys, "user_id")).drop("bucket").join(keys, "user_id", "left_semi")


def article_factors(store: Store, snapshot: Snapshot | None = None) -> DataFrame:
    """(articleId, latentFactors) of a snapshot."""
    return store.read(snapshot or store.snapshot(), FACTORS, STORED_FACTORS).drop("bucket")


# ------------------------------------------------------------ upkeep

def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("userid").agg(F.max_by("recommendations", "batch").alias("recommendations"), F.max("batch").alias("batch"))


def compact(store: Store) -> int:
    """Base and deltas of the lists as a new base; returns the version.  A running stream goes on from it."""
    snap = store.snapshot()
    old = snap.parts(LISTS)
    rows = materialize(read_lists(store, snap), "lists")
    n = rows.count()
    applied = snap.fact("applied")
    new = store.write(rows.withColumn("batch", F.lit(applied).cast("long")), LISTS, "userid", n, level=BASE, last=applied)
    discard(rows)

    def swap(now: Snapshot):
        if not set(old) <= set(now.parts(LISTS)):
            return None  # another base is there
        return {LISTS: [new, *[p for p in now.parts(LISTS) if p not in old]]}, {"version": now.fact("version") + 1}

    return store.update(swap).fact("version")


def maintain(store: Store, fanout: int = FANOUT, retention: float = RETENTION_SECONDS) -> None:
    """Merges what is due and deletes what no reader can still hold."""
    before = store.snapshot().number
    store.merge(LISTS, "userid", _LISTS, fanout, _latest)
    store.merge(STREAMED, "user_id", _RATINGS, fanout, lambda rows: rows)
    parts = store.snapshot().parts(LISTS)
    base = sum(max(0, p.rows) for p in parts if p.level == BASE)
    if any(p.level > 0 for p in parts) and sum(max(0, p.rows) for p in parts if p.level != BASE) >= max(1, base):
        compact(store)
    if store.snapshot().number != before:
        store.clean(retention)


# ------------------------------------------------------------ pure DataFrame steps

def apply_ratings(lists: DataFrame, ratings: DataFrame) -> DataFrame:
    """New (userid, recommendations) of every listed user that rated something; lists may become empty."""
    pairs = ratings.select(F.col("user_id").alias("userid"), "article_id").distinct()
    raters = pairs.select("userid").distinct()
    affected = lists.join(raters, "userid", "left_semi")
    rows = affected.select("userid", F.posexplode("recommendations").alias("p", "article_id"))
    kept = (rows.join(pairs, ["userid", "article_id"], "left_anti")
            # at most N rows per user (the list length)
            .groupBy("userid").agg(F.sort_array(F.collect_list(F.struct("p", "article_id"))).alias("l")))
    return (affected.select("userid").join(kept, "userid", "left")
            .select("userid", F.coalesce(F.col("l.article_id"), F.array().cast("array<bigint>"))
                    .alias("recommendations")))


def users_to_refresh(updated: DataFrame) -> DataFrame:
    return updated.where(F.size("recommendations") == 0).select("userid")


def refresh_lists(users: DataFrame, ratings: DataFrame, articles: DataFrame, k: int,
                  lam: float = DEFAULT_LAMBDA, n: int = DEFAULT_TOP_N, n_articles: int | None = None,
                  **kw) -> DataFrame:
    """Fold-in + top-n for ``users`` over all their ratings; a user with no candidate gets an empty list."""
    mine = ratings.join(users.select(F.col("userid").alias("user_id")), "user_id", "left_semi")
    if n_articles is None:
        n_articles = articles.count()
    factors = als.fold_in(mine, articles, k, lam, n_articles)
    ranked = topn.recommend(factors, articles, mine, n=n, k=k, n_articles=n_articles, **kw)
    lists = topn.to_lists(ranked, n, require_full=False)
    return (users.join(lists, "userid", "left")
            .select("userid", F.coalesce("recommendations", F.array().cast("array<bigint>")).alias("recommendations")))


def upsert(table: DataFrame, rows: DataFrame, key: str = "userid") -> DataFrame:
    return table.join(rows.select(key), key, "left_anti").unionByName(rows)


def changed_lists(table: DataFrame, batch_ratings: DataFrame, all_ratings: DataFrame | Callable[[DataFrame], DataFrame],
                  articles: DataFrame, k: int, lam: float = DEFAULT_LAMBDA, n: int = DEFAULT_TOP_N, n_articles: int | None = None,
                  **kw) -> DataFrame:
    """One batch, set-wise: the new lists of every listed user who rated something
    (articles removed; an emptied list refreshed by fold-in, possibly still empty).

    ``all_ratings`` may be a function that gives the ratings of some users (``userid``).
    """
    updated = materialize(apply_ratings(table, batch_ratings), "updated_lists")
    empty = users_to_refresh(updated)
    kept = updated.where(F.size("recommendations") > 0)
    if not empty.take(1):  # most batches empty no list: skip the fold-in entirely
        return kept
    ratings = all_ratings(empty) if callable(all_ratings) else all_ratings
    refreshed = refresh_lists(empty, ratings, articles, k, lam, n, n_articles, **kw)
    return kept.unionByName(refreshed)


def update_lists(table: DataFrame, batch_ratings: DataFrame, all_ratings: DataFrame, articles: DataFrame,
                 k: int, lam: float = DEFAULT_LAMBDA, n: int = DEFAULT_TOP_N, n_articles: int | None = None,
                 **kw) -> DataFrame:
    """The whole table after one batch: ``changed_lists`` upserted by userid."""
    return upsert(table, changed_lists(table, batch_ratings, all_ratings, articles, k, lam, n, n_articles, **kw))


# ------------------------------------------------------------ the stream

@dataclass
class StreamState:
    store: Store           # lists, streamed ratings, article factors
    base_ratings: DataFrame | None = None  # ratings the model was trained on; None: those kept in the store
    articles: DataFrame | None = None      # article factors (id, f); None: those of the snapshot a batch works on
    k: int = als.DEFAULT_RANK
    lam: float = DEFAULT_LAMBDA
    n: int = DEFAULT_TOP_N
    n_articles: int | None = None
    rereads: bool = True   # a stream without its checkpoint gets all messages again
    offset: int = 0        # added to the query's batch ids
    fanout: int = FANOUT
    retention: float = RETENTION_SECONDS
    log: list = field(default_factory=list)  # results of the batches of this run


def _read_text(spark: SparkSession, path: str) -> str | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream_in = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream_in, "UTF-8")
    finally:
        stream_in.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def batch_offset(state: StreamState, checkpoint_location: str) -> int:
    """What is added to the query's batch ids; decided when its checkpoint is new, kept with it."""
    spark = state.store.spark
    marker = f"{checkpoint_location.rstrip('/')}/_offset"
    text = _read_text(spark, marker)
    if text:
        return int(text)

    def forget(snap: Snapshot):
        kept = [p for p in snap.parts(STREAMED) if p.last < 0]
        return None if len(kept) == len(snap.parts(STREAMED)) else ({STREAMED: kept}, {})

    if state.rereads:
        state.store.update(forget)
    offset = state.store.snapshot().fact("last") + 1
    _write_text(spark, marker, str(offset))
    return offset


def store_batch(state: StreamState, batch: DataFrame, number: int) -> tuple[Part | None, int]:
    """The batch's good ratings as a data folder (none: no folder) and the number of its rejects; nothing is committed."""
    decoded = materialize(decode_ratings(batch), "decoded")
    good, rejects = split_decoded(decoded)
    n_good, n_rejects = good.count(), rejects.count()
    part = None
    if n_good:
        rows = good.select(*[F.col(f.name).cast(f.dataType) for f in RATINGS.fields]).withColumn("batch", F.lit(number).cast("long"))
        part = state.store.write(rows, STREAMED, "user_id", n_good, first=number, last=number)
    discard(decoded)
    return part, n_rejects


def process_batch(state: StreamState, batch: DataFrame, batch_id: int) -> dict:
    store, number = state.store, batch_id + state.offset
    if number <= store.snapshot().fact("last"):  # a replay of what is committed
        result = {"batch_id": number, "rejects": 0, "unknown_users": 0, "base": store.snapshot().fact("version"), "replayed": True}
        state.log.append(result)
        return result
    part, n_rejects = store_batch(state, batch, number)
    unknown = 0

    def change(snap: Snapshot):
        nonlocal unknown
        now = Snapshot(snap.number, snap.tables | {STREAMED: (*snap.parts(STREAMED), *([part] if part else []))}, snap.facts)
        facts = {"last": number, "applied": number}
        # ratings that the lists have not taken in: this batch, after the batch job some before
        since = snap.fact("applied")
        late = Snapshot(snap.number, {STREAMED: tuple(p for p in now.parts(STREAMED) if p.last > since)}, snap.facts)
        new = stored_ratings(store, late).where(F.col("batch") > since).select(*_COLUMNS)
        if not late.parts(STREAMED) or not snap.parts(LISTS):
            unknown = new.select("user_id").distinct().count()
            return {STREAMED: now.parts(STREAMED)}, facts
        raters = materialize(new.select(F.col("user_id").alias("userid")).distinct(), "raters")

        def ratings_of(users: DataFrame) -> DataFrame:
            mine = stored_ratings(store, now, users).select(*_COLUMNS)
            return mine if state.base_ratings is None else state.base_ratings.select(*_COLUMNS).unionByName(
                stored_ratings(store, now, users, base=False).select(*_COLUMNS))

        articles, n_articles = state.articles, state.n_articles
        if articles is None:
            articles, n_articles = loaded_factors(article_factors(store, snap)), snap.facts.get("n_articles")
        changed = materialize(changed_lists(read_lists(store, snap, raters), new, ratings_of, articles, state.k, state.lam, state.n, n_articles),
                              "changed_lists")
        n_changed = changed.count()
        # raters without a list are ignored, as the keyed lookup does; they are counted
        unknown = raters.join(changed.select("userid"), "userid", "left_anti").count()
        tables = {STREAMED: now.parts(STREAMED)}
        if n_changed:
            delta = store.write(changed.withColumn("batch", F.lit(number).cast("long")), LISTS, "userid", n_changed, first=number, last=number)
            tables[LISTS] = [*snap.parts(LISTS), delta]
        discard(changed)
        discard(raters)
        return tables, facts

    done = store.update(change)
    maintain(store, state.fanout, state.retention)
    result = {"batch_id": number, "rejects": n_rejects, "unknown_users": unknown, "base": done.fact("version")}
    state.log.append(result)
    return result


def run_stream(messages: DataFrame, state: StreamState, checkpoint_location: str,
               available_now: bool = False, interval: str = TRIGGER_INTERVAL):
    """Start the updater on any streaming DataFrame with a string ``value`` column."""
    state.offset = batch_offset(state, checkpoint_location)
    w = (messages.select(F.col("value").cast("string").alias("value")).writeStream
         .foreachBatch(lambda df, bid: process_batch(state, df, bid))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def kafka_messages(spark: SparkSession, servers: str, topic: str = "ratings") -> DataFrame:
    """Message source on a Kafka topic (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).load().selectExpr("CAST(value AS STRING) AS value"))


def text_messages(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(folder)
