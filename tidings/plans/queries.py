"""The registered queries: one per operator family row of the coverage list.

Every query reads the driver tables (or data Spark derives from them) in
full.  Doubles that come out of linear algebra are rounded to 6 decimals so
the DuckDB oracle can be compared value by value.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions import documents
from tidings.functions.dates import display_date, timestamp_to_millis
from tidings.functions.hashing import string_hash32
from tidings.functions.messages import decode_ratings, encode_ratings
from tidings.operators import als, changes, ingest, topn, views
from tidings.plans import fixtures as fx
from tidings.plans import jobs
from tidings.session import checkpoint_dir, discard, materialize
from tidings.sources.archive import explode_docs, missing_months, parse_archive_text
from tidings.sources.tables import raw_users_from_customer, read_table, users_from_raw
from tidings.streaming import archive as archive_stream_source
from tidings.streaming import ratings as stream

R = 6  # rounding of linear-algebra doubles


def _factor_cols(df: DataFrame, k: int = fx.ORACLE_K) -> DataFrame:
    return df.select("id", *[F.round(F.col("f")[i], R).alias(f"f{i}") for i in range(k)])


def _ranked(df: DataFrame, score: bool = False) -> DataFrame:
    cols = ["userid", "rank", "article_id"] + ([F.round("score", R).alias("score")] if score else [])
    return df.select(*cols)


# ---------------------------------------------------------------- ratings

def ratings_typed(spark: SparkSession, d: str) -> DataFrame:
    return fx.ratings(spark, d, "events")


def distinct_articles(spark: SparkSession, d: str) -> DataFrame:
    return fx.ratings(spark, d, "events").select("article_id").distinct()


def ratings_of_users(spark: SparkSession, d: str) -> DataFrame:
    users = fx.stream_users(spark, d)
    return views.lookup(fx.ratings(spark, d, "events"), "user_id", users, "userid")


# ---------------------------------------------------------------- factors

def _init(spark, d):
    return als.init_factors(fx.ratings(spark, d, "events"), "article_id", fx.ORACLE_K, fx.ORACLE_SEED, "arith")


def init_factors(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(_init(spark, d))


def factor_entries(spark: SparkSession, d: str) -> DataFrame:
    return _init(spark, d).select("id", F.posexplode("f").alias("dim", "value")).select(
        "id", "dim", F.round("value", R).alias("value"))


def _terms(spark, d):
    fixed = materialize(_init(spark, d), "factors")
    return als.normal_equation_terms(fx.ratings(spark, d, "events"), fixed, "user_id", "article_id", fx.ORACLE_K, n_fixed=fixed.count())


def gram_sums(spark: SparkSession, d: str) -> DataFrame:
    t = _terms(spark, d)
    return t.select(F.col("id").alias("user_id"), *[F.round(F.col("terms")[i], R).alias(n)
                                                     for i, n in enumerate(["g00", "g01", "g11"])])


def weighted_vector_sums(spark: SparkSession, d: str) -> DataFrame:
    t = _terms(spark, d)
    return t.select(F.col("id").alias("user_id"), F.round(F.col("terms")[3], R).alias("b0"),
                    F.round(F.col("terms")[4], R).alias("b1"))


# ---------------------------------------------------------------- half-steps and training (M1, M2)

_iterations: dict = {}


def _one_iteration(spark, d):
    key = (id(spark), spark.sparkContext.applicationId, d)
    if key not in _iterations:
        _iterations[key] = _first_iteration(spark, d)
    return _iterations[key]


def _first_iteration(spark, d):
    r = fx.ratings(spark, d, "events")
    by_user = als.layout_side(r, "user_id", "article_id")
    v0 = _init(spark, d)
    u1 = materialize(als.half_step(by_user, v0, fx.ORACLE_K), "factors")
    by_article = als.layout_side(r, "article_id", "user_id")
    v1 = materialize(als.half_step(by_article, u1, fx.ORACLE_K), "factors")
    by_user.release()
    by_article.release()
    return u1, v1


def als_user_halfstep(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(_one_iteration(spark, d)[0])


def als_article_halfstep(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(_one_iteration(spark, d)[1])


def als_user_factors(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(fx.model(spark, d, "events").users)


def als_article_factors(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(fx.model(spark, d, "events").articles)


def als_user_factors_orders(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(fx.model(spark, d, "orders").users)


def als_article_factors_orders(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(fx.model(spark, d, "orders").articles)


def als_residual_k35(spark: SparkSession, d: str) -> DataFrame:
    """Rank 35 on R-orders: every user's factors solve the user's normal equations to 1e-8."""
    r = fx.ratings(spark, d, "orders")
    m = fx.model(spark, d, "orders", k=35, init_mode="hash")
    by_user = als.layout_side(r, "user_id", "article_id", n_rows=m.n_ratings)
    users = materialize(als.half_step(by_user, m.articles, 35, n_fixed=m.n_articles), "factors")
    by_user.free()
    res = als.normal_equation_residuals(r, "user_id", "article_id", users, m.articles, als.DEFAULT_LAMBDA, side=by_user)
    solved = materialize(res.select("id", (F.col("residual") < 1e-8).alias("solved")), "solved")
    by_user.release()
    discard(users)
    return solved


# ---------------------------------------------------------------- scoring and top-N (D-J4, D-J5, H3, M3)

def _rec(spark, d, source, n, mask=True):
    m = fx.model(spark, d, source)
    r = fx.ratings(spark, d, source) if mask else None
    return topn.recommend(m.users, m.articles, r, n=n, k=m.k, n_users=m.n_users, n_articles=m.n_articles)


def als_scores(spark: SparkSession, d: str) -> DataFrame:
    """Top-10 by raw score (no mask of rated articles)."""
    return _ranked(_rec(spark, d, "events", 10, mask=False), score=True)


def als_unrated_scores(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(_rec(spark, d, "events", 10), score=True)


def als_recommend_any(spark: SparkSession, d: str) -> DataFrame:
    lists = topn.to_lists(_rec(spark, d, "events", 10), 10, require_full=False)
    return topn.lists_to_rows(lists)


def als_recommend_full(spark: SparkSession, d: str) -> DataFrame:
    lists = topn.to_lists(_rec(spark, d, "events", 50), 50, require_full=True)
    return topn.lists_to_rows(lists)


def als_recommend_full_orders(spark: SparkSession, d: str) -> DataFrame:
    lists = topn.to_lists(_rec(spark, d, "orders", 10), 10, require_full=True)
    return topn.lists_to_rows(lists)


# ---------------------------------------------------------------- fold-in (M4)

def _fold(spark, d):
    m = fx.model(spark, d, "events_before")
    users = fx.stream_users(spark, d)
    mine = views.lookup(fx.ratings(spark, d, "events"), "user_id", users, "userid")
    return m, mine, als.fold_in(mine, m.articles, m.k, n_articles=m.n_articles)


def fold_in_factors(spark: SparkSession, d: str) -> DataFrame:
    return _factor_cols(_fold(spark, d)[2])


def fold_in_topn(spark: SparkSession, d: str) -> DataFrame:
    m, mine, u = _fold(spark, d)
    ranked = topn.recommend(u, m.articles, mine, n=10, k=m.k, n_articles=m.n_articles)
    return topn.lists_to_rows(topn.to_lists(ranked, 10, require_full=False))


# ---------------------------------------------------------------- ingest

def article_id_hash(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "pages").select("page_id", "url", string_hash32("url").alias("id"))


def _articles(spark, d):
    docs = parse_archive_text(fx.archive_documents(spark, d).withColumnRenamed("m", "month"), "body")
    return ingest.articles_from_docs(explode_docs(docs, "archive", keep=["month"]))


def archive_docs(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d)
    return a.select("id", "web_url", "pub_date", F.col("headline.main").alias("title"), "month")


def archive_months(spark: SparkSession, d: str) -> DataFrame:
    """Month walk over the archive built from ``orders`` dates, reporting months without documents."""
    months = read_table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return missing_months(months)


def article_routes(spark: SparkSession, d: str) -> DataFrame:
    return ingest.route_articles(_articles(spark, d)).select("id", "month", "route")


def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    o = o.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return ingest.temporal_split(o, "month", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "month", "route")


def _work(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _stored(run: jobs.Ingested) -> DataFrame:
    words = F.get_json_object("doc", "$.word_count").cast("bigint").alias("word_count")
    return run.articles.select("id", "month", "route", words)


def archive_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The ingest job end to end: archive files on shared storage -> table by month; untyped fields are kept."""
    root = _work(spark, "ingest")
    paths = jobs.archive_files_from_documents(fx.archive_documents(spark, d), os.path.join(root, "archive"))
    return _stored(jobs.run_ingest(spark, paths, os.path.join(root, "articles"), multi_line=False))


def archive_ingest_two_runs(spark: SparkSession, d: str) -> DataFrame:
    """Half of every month's files, then all files: like one run, nothing lost or doubled."""
    root = _work(spark, "ingest")
    docs = fx.archive_documents(spark, d)
    even, odd = docs.where("chunk % 2 = 0"), docs.where("chunk % 2 = 1")
    first = jobs.archive_files_from_documents(even, os.path.join(root, "even"))
    second = jobs.archive_files_from_documents(odd, os.path.join(root, "odd"))
    out = os.path.join(root, "articles")
    jobs.run_ingest(spark, first, out, multi_line=False)
    return _stored(jobs.run_ingest(spark, second + first, out, multi_line=False))


def _streamed_archive(spark, d):
    """Half of every month's files, and when they have been taken in the others, through the file stream."""
    root = _work(spark, "ingest")
    docs = fx.archive_documents(spark, d)
    out, log = os.path.join(root, "articles"), []
    for half in (0, 1):
        jobs.archive_files_from_documents(docs.where(F.col("chunk") % 2 == half), os.path.join(root, "archive", f"half{half}"))
        texts = archive_stream_source.archive_texts(spark, os.path.join(root, "archive"), multi_line=False)
        archive_stream_source.run_archive_stream(texts, out, os.path.join(root, "checkpoint"), log=log).awaitTermination()
    return out


def archive_stream(spark: SparkSession, d: str) -> DataFrame:
    """The archive folder as a checkpointed file stream: ends like one run over all files."""
    out = _streamed_archive(spark, d)
    articles = spark.read.parquet(out).withColumn("month", F.col("month").cast("string"))
    return _stored(jobs.Ingested(articles, articles.limit(0), []))


def archive_stream_months(spark: SparkSession, d: str) -> DataFrame:
    """The counts by month that the stream keeps."""
    return archive_stream_source.month_counts(spark, _streamed_archive(spark, d)).select("month", "articles", "stored")


def archive_ingest_undated(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a date are split within the month of their archive, before the dated ones."""
    root = _work(spark, "ingest")
    paths = jobs.archive_files_from_documents(fx.archive_documents(spark, d, undated=True), os.path.join(root, "archive"))
    run = jobs.run_ingest(spark, paths, os.path.join(root, "articles"), multi_line=False)
    return run.articles.select("id", "month", "route", "pub_date")


def archive_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Every third text is cut off: it is reported, and the others of its month are ingested."""
    root = _work(spark, "ingest")
    docs = fx.archive_documents(spark, d)
    cut = F.when(F.col("chunk") % 3 == 0, F.expr("left(body, length(body) - 20)")).otherwise(F.col("body"))
    paths = jobs.archive_files_from_documents(docs.withColumn("body", cut), os.path.join(root, "archive"))
    run = jobs.run_ingest(spark, paths, os.path.join(root, "articles"), multi_line=False)
    rows = run.articles.select("month", F.lit(1).alias("a"), F.lit(0).alias("r")).unionByName(
        run.rejects.select("month", F.lit(0).alias("a"), F.lit(1).alias("r")))
    return rows.groupBy("month").agg(F.sum("a").alias("articles"), F.sum("r").alias("rejects"))


_batch_runs: dict = {}


def _store(spark, name):
    return stream.open_store(spark, _work(spark, name), buckets=8)


def _batch(spark, d):
    key = (id(spark), spark.sparkContext.applicationId, d)
    if key not in _batch_runs:
        _batch_runs[key] = jobs.run_batch(fx.ratings(spark, d, "events"), _store(spark, "batch"), k=fx.ORACLE_K,
                                          n=10, init_mode="arith", seed=fx.ORACLE_SEED)
    return _batch_runs[key]


def batch_job_lists(spark: SparkSession, d: str) -> DataFrame:
    """The batch recommender job: stored full top-10 lists, read back from the store's newest commit."""
    return topn.lists_to_rows(stream.read_lists(_batch(spark, d)["store"]))


def stored_article_factors(spark: SparkSession, d: str) -> DataFrame:
    stored = stream.article_factors(_batch(spark, d)["store"])
    return stored.select("articleId", F.posexplode("latentFactors").alias("dim", "value")).select(
        "articleId", "dim", F.round("value", R).alias("value"))


# ---------------------------------------------------------------- messages

def encode_rating_messages(spark: SparkSession, d: str) -> DataFrame:
    enc = encode_ratings(fx.ratings(spark, d, "events"))
    parts = F.split("value", ",")
    return enc.select(F.col("key"), F.concat_ws(",", F.slice(parts, 1, 2)).alias("ids"),
                      F.element_at(parts, 3).cast("double").alias("rating"))


def _messages(spark, d):
    ev = fx.events_ratings(spark, d).join(read_table(spark, d, "events").select("event_id", "event_type"),
                                          "event_id")
    u, a, r = (F.col(c).cast("string") for c in ("user_id", "article_id", "rating"))
    value = (F.when(F.col("event_type") == "error", F.concat_ws(",", F.lit("x"), a, r))
             .when(F.col("event_type") == "signup", F.concat_ws(",", u, a))
             .when(F.col("event_type") == "view", F.concat(F.lit(" "), u, F.lit(" , "), a, F.lit(" ,"), r))
             .when(F.col("event_type") == "click", F.concat_ws(",", u, a, F.lit("abc")))
             .otherwise(F.concat_ws(",", u, a, r)))
    return ev.select("event_id", value.alias("value"))


def decode_rating_messages(spark: SparkSession, d: str) -> DataFrame:
    m = _messages(spark, d)
    return decode_ratings(m).select(*[F.col(c) for c in ("user_id", "article_id", "rating", "ok")])


# ---------------------------------------------------------------- list maintenance

def _updated(spark, d):
    return stream.apply_ratings(fx.lists_table(spark, d), fx.events_ratings(spark, d, "after").drop("event_id"))


def apply_ratings(spark: SparkSession, d: str) -> DataFrame:
    return topn.lists_to_rows(_updated(spark, d))


def users_to_refresh(spark: SparkSession, d: str) -> DataFrame:
    return stream.users_to_refresh(_updated(spark, d))


def upsert_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return topn.lists_to_rows(stream.upsert(fx.lists_table(spark, d), _updated(spark, d)))


def _stream_run(spark, state, name, ratings):
    """Ratings as text messages through the updater, until all are taken in."""
    root = state.store.root
    encode_ratings(ratings).select("value").repartition(2).write.text(f"{root}-{name}")
    stream.run_stream(stream.text_messages(spark, f"{root}-{name}"), state, f"{root}-{name}-checkpoint", available_now=True).awaitTermination()


def stream_apply_ratings(spark: SparkSession, d: str) -> DataFrame:
    """The same update through Structured Streaming: text messages -> foreachBatch -> commits of the store."""
    m = fx.model(spark, d, "events_before")
    store = _store(spark, "stream")
    stream.put_model(store, fx.lists_table(spark, d), m.articles)
    stream.put_base_ratings(store, fx.ratings(spark, d, "events_before"))
    _stream_run(spark, stream.StreamState(store, k=m.k, n=fx.TABLE_N), "in", fx.events_ratings(spark, d, "after").drop("event_id"))
    return topn.lists_to_rows(stream.read_lists(store))


def _history_store(spark, d, name):
    m = fx.model(spark, d, "events_before")
    store = _store(spark, name)
    stream.put_model(store, fx.lists_table(spark, d), m.articles)
    return store, stream.StreamState(store, fx.ratings(spark, d, "events_before"), k=m.k, n=fx.TABLE_N, rereads=False)


def _retrain(spark, d, store):
    jobs.run_batch(fx.ratings(spark, d, "events_before"), store, k=fx.ORACLE_K, n=fx.TABLE_N, init_mode="arith", seed=fx.ORACLE_SEED)


def stream_then_batch_lists(spark: SparkSession, d: str) -> DataFrame:
    """Stream, batch job on base and streamed ratings, stream on its new version: what readers see in the end."""
    store, state = _history_store(spark, d, "loop")
    _stream_run(spark, state, "in1", fx.events_ratings(spark, d, "middle").drop("event_id"))
    _retrain(spark, d, store)
    _stream_run(spark, state, "in2", fx.events_ratings(spark, d, "late").drop("event_id"))
    return topn.lists_to_rows(stream.read_lists(store))


def batch_beside_open_stream(spark: SparkSession, d: str) -> DataFrame:
    """The batch job runs while a stream batch is half written, and the batch is taken in afterwards: nothing is lost or doubled."""
    store, state = _history_store(spark, d, "beside")
    _stream_run(spark, state, "in1", fx.events_ratings(spark, d, "middle").drop("event_id"))
    late = encode_ratings(fx.events_ratings(spark, d, "late").drop("event_id")).select("value")
    stream.store_batch(state, late, store.snapshot().fact("last") + 1)  # its ratings are written, it is not committed
    _retrain(spark, d, store)
    stream.process_batch(state, late, store.snapshot().fact("last") + 1 - state.offset)
    return topn.lists_to_rows(stream.read_lists(store))


def stream_rejects(spark: SparkSession, d: str) -> DataFrame:
    """A stream of all messages, malformed ones among them: what was stored and what was rejected."""
    store, state = _history_store(spark, d, "rejects")
    _messages(spark, d).select("value").repartition(2).write.text(f"{store.root}-in")
    stream.run_stream(stream.text_messages(spark, f"{store.root}-in"), state, f"{store.root}-checkpoint", available_now=True).awaitTermination()
    return stream.stored_ratings(store).select(F.lit("stored").alias("kind")).groupBy("kind").agg(F.count("*").alias("n")).unionByName(
        spark.range(1).select(F.lit("rejected").alias("kind"), F.lit(sum(x["rejects"] for x in state.log)).cast("bigint").alias("n")))


# ---------------------------------------------------------------- views

def article_listing(spark: SparkSession, d: str) -> DataFrame:
    a = _articles(spark, d).select("id", F.col("headline.main").alias("title"), F.col("web_url").alias("url"))
    sort = views.parse_sort(["-headline.main", "web_url", "no_such_key"], views.ARTICLE_SORT_KEYS,
                            {"headline.main": "title", "web_url": "url"})
    return views.listing(a, sort, limit=views.ARTICLE_PAGE, tiebreak="id")


def article_listing_default(spark: SparkSession, d: str) -> DataFrame:
    """The plain page view: no sort parameter, one page."""
    a = _articles(spark, d).select("id", F.col("headline.main").alias("title"), F.col("web_url").alias("url"))
    return views.listing(a, views.parse_sort(None, views.ARTICLE_SORT_KEYS), limit=views.ARTICLE_PAGE)


def article_json(spark: SparkSession, d: str) -> DataFrame:
    return views.article_json(_articles(spark, d))


def ratings_listing(spark: SparkSession, d: str) -> DataFrame:
    r = fx.events_ratings(spark, d).select(F.col("event_id").alias("id"), F.col("user_id").alias("user"),
                                           F.col("article_id").alias("article"))
    sort = views.parse_sort(["user", "-article", "rating"], views.RATING_SORT_KEYS)
    return views.listing(r, sort, tiebreak="id")


def recommendations_listing(spark: SparkSession, d: str) -> DataFrame:
    lists = fx.full_lists(spark, d)
    sort = views.parse_sort(["-recommendations", "userid"], views.RECOMMENDATION_SORT_KEYS)
    out = views.listing(lists, sort)
    return out.select("userid", F.array_join("recommendations", ",").alias("recommendations"), "pos")


def users_listing(spark: SparkSession, d: str) -> DataFrame:
    u = users_from_raw(raw_users_from_customer(spark, d)).withColumnsRenamed(
        {"creation_date": "creationDate", "update_date": "updateDate"})
    sort = views.parse_sort(["-creationDate", "username"], views.USER_SORT_KEYS)
    out = views.listing(u, sort, tiebreak="id")
    return out.select("id", "username", "email", display_date("creationDate").alias("created"),
                      display_date("updateDate").alias("updated"), "pos")


def users_listing_default(spark: SparkSession, d: str) -> DataFrame:
    """All users without a sort parameter: in the order of the key."""
    u = users_from_raw(raw_users_from_customer(spark, d))
    return views.listing(u, [], tiebreak="id").select("id", "username", "email", "pos")


def lookup_by_key(spark: SparkSession, d: str) -> DataFrame:
    found = views.lookup(fx.full_lists(spark, d), "userid", fx.stream_users(spark, d))
    return topn.lists_to_rows(found)


def lookup_one_user(spark: SparkSession, d: str) -> DataFrame:
    """First-match point lookup: the list of the user behind the latest event."""
    ev = read_table(spark, d, "events")
    latest = ev.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(1).first()["user_id"]  # one scalar
    return topn.lists_to_rows(views.lookup_one(fx.full_lists(spark, d), "userid", latest))


def user_dates(spark: SparkSession, d: str) -> DataFrame:
    raw = raw_users_from_customer(spark, d)
    typed = users_from_raw(raw)
    return typed.select("id", timestamp_to_millis("creation_date").alias("creation_millis"),
                        timestamp_to_millis("update_date").alias("update_millis"),
                        F.date_format("creation_date", "yyyy-MM-dd HH:mm:ss").alias("created"))


def rating_json(spark: SparkSession, d: str) -> DataFrame:
    r = fx.events_ratings(spark, d).select(F.col("event_id").alias("id"), F.col("user_id").alias("user"),
                                           F.col("article_id").alias("article"), F.round(F.col("rating") * 500).alias("rating"))
    return documents.rating_json(r)


def recommendation_json(spark: SparkSession, d: str) -> DataFrame:
    return documents.list_json(fx.full_lists(spark, d))


def user_json(spark: SparkSession, d: str) -> DataFrame:
    return documents.user_json(users_from_raw(raw_users_from_customer(spark, d)))


def decode_user_json(spark: SparkSession, d: str) -> DataFrame:
    """Stored users read back; by segment, some texts are cut off, some have no name, some no id."""
    segment = read_table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    texts = user_json(spark, d).join(segment, "id")
    broken = (F.when(F.col("c_mktsegment") == "BUILDING", F.expr("left(json, length(json) - 5)"))
              .when(F.col("c_mktsegment") == "MACHINERY", F.regexp_replace("json", '"username"', '"name"'))
              .when(F.col("c_mktsegment") == "FURNITURE", F.regexp_replace("json", '"id"', '"key"')).otherwise(F.col("json")))
    out = documents.decode_user_json(texts.select("id", broken.alias("json")).withColumnRenamed("id", "customer"))
    return out.where("ok").select("id", "username", "email", timestamp_to_millis("creation_date").alias("creation_millis"),
                                  timestamp_to_millis("update_date").alias("update_millis"))


def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    n = views.graph_nodes(fx.full_lists(spark, d))
    return n.select("id", "label", F.round("x", R).alias("x"), F.round("y", R).alias("y"), "size", "color")


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return views.graph_edges(fx.full_lists(spark, d))


def graph_json(spark: SparkSession, d: str) -> DataFrame:
    return views.graph_json(fx.full_lists(spark, d))


# ---------------------------------------------------------------- table changes

def _customer_users(spark, d):
    return read_table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
                                                   F.col("c_mktsegment").alias("segment"))


def _new_users(spark, d, existing):
    s = read_table(spark, d, "supplier").select(F.col("s_suppkey"), F.col("s_name").alias("username"))
    return changes.append_sequential_ids(existing, s, "id", ["s_suppkey"])


def append_sequential_ids(spark: SparkSession, d: str) -> DataFrame:
    u = _customer_users(spark, d)
    return _new_users(spark, d, u).select("id", "s_suppkey", "username")


def _customer_changes(spark, d):
    snap = _customer_users(spark, d)
    c = read_table(spark, d, "customer")
    deletes = c.where(F.col("c_acctbal") < 0).select(F.lit(3).cast("bigint").alias("seq"), F.lit("delete").alias("op"),
                                                      F.col("c_custkey").alias("id"),
                                                      F.lit(None).cast("string").alias("username"),
                                                      F.lit(None).cast("string").alias("segment"))
    rename = c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
        F.lit(1).cast("bigint").alias("seq"), F.lit("update").alias("op"), F.col("c_custkey").alias("id"),
        F.upper("c_name").alias("username"), F.lit(None).cast("string").alias("segment"))
    move = c.where(F.col("c_nationkey") == 3).select(
        F.lit(2).cast("bigint").alias("seq"), F.lit("update").alias("op"), F.col("c_custkey").alias("id"),
        F.lit(None).cast("string").alias("username"), F.lit("MOVED").alias("segment"))
    inserts = _new_users(spark, d, snap).select(F.lit(4).cast("bigint").alias("seq"), F.lit("insert").alias("op"),
                                                "id", "username", F.lit("NEW").alias("segment"))
    return snap, deletes.unionByName(rename).unionByName(move).unionByName(inserts)


def apply_changes(spark: SparkSession, d: str) -> DataFrame:
    snap, ch = _customer_changes(spark, d)
    return changes.apply_changes(snap, ch, "id", ["username", "segment"])


def stored_changes(spark: SparkSession, d: str) -> DataFrame:
    """The same changes applied copy-on-write to a stored table, in two commits."""
    snap, ch = _customer_changes(spark, d)
    store = _store(spark, "users")
    changes.put_table(store, "users", snap, "id")
    first = ch.where("op = 'update'")  # these have the lower numbers
    for part in (first, ch.where("op <> 'update'")):
        changes.apply_to_store(store, "users", snap.schema, part, "id")
    return changes.read_table(store, "users", snap.schema)


AS_OF = "2020-06-01 12:00:00"  # fixed edit time of the change fixture (deterministic)


def apply_user_changes(spark: SparkSession, d: str) -> DataFrame:
    """Edits stamp update_date, inserts stamp both dates; deletes drop the row."""
    snap = users_from_raw(raw_users_from_customer(spark, d))
    c = read_table(spark, d, "customer")
    none_s, none_t = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    edits = c.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.lit(1).cast("bigint").alias("seq"), F.lit("update").alias("op"), F.col("c_custkey").alias("id"),
        F.lower("c_name").alias("username"), none_s.alias("email"), none_t.alias("creation_date"),
        none_t.alias("update_date"))
    drops = c.where(F.col("c_acctbal") < 0).select(
        F.lit(2).cast("bigint").alias("seq"), F.lit("delete").alias("op"), F.col("c_custkey").alias("id"),
        none_s.alias("username"), none_s.alias("email"), none_t.alias("creation_date"), none_t.alias("update_date"))
    new = _new_users(spark, d, snap).select(
        F.lit(3).cast("bigint").alias("seq"), F.lit("insert").alias("op"), "id", "username",
        none_s.alias("email"), none_t.alias("creation_date"), none_t.alias("update_date"))
    ch = changes.stamp_changes(edits.unionByName(drops).unionByName(new), AS_OF)
    cols = ["username", "email", "creation_date", "update_date"]
    out = changes.apply_changes(snap, ch, "id", cols)
    return out.select("id", "username", "email", timestamp_to_millis("creation_date").alias("creation_millis"),
                      timestamp_to_millis("update_date").alias("update_millis"))


QUERIES = {
    "ratings_typed": ratings_typed,
    "distinct_articles": distinct_articles,
    "ratings_of_users": ratings_of_users,
    "init_factors": init_factors,
    "factor_entries": factor_entries,
    "gram_sums": gram_sums,
    "weighted_vector_sums": weighted_vector_sums,
    "als_user_halfstep": als_user_halfstep,
    "als_article_halfstep": als_article_halfstep,
    "als_user_factors": als_user_factors,
    "als_article_factors": als_article_factors,
    "als_user_factors_orders": als_user_factors_orders,
    "als_article_factors_orders": als_article_factors_orders,
    "als_residual_k35": als_residual_k35,
    "als_scores": als_scores,
    "als_unrated_scores": als_unrated_scores,
    "als_recommend_any": als_recommend_any,
    "als_recommend_full": als_recommend_full,
    "als_recommend_full_orders": als_recommend_full_orders,
    "fold_in_factors": fold_in_factors,
    "fold_in_topn": fold_in_topn,
    "article_id_hash": article_id_hash,
    "archive_docs": archive_docs,
    "archive_months": archive_months,
    "article_routes": article_routes,
    "temporal_split": temporal_split,
    "archive_ingest": archive_ingest,
    "archive_ingest_two_runs": archive_ingest_two_runs,
    "archive_ingest_undated": archive_ingest_undated,
    "archive_stream": archive_stream,
    "archive_stream_months": archive_stream_months,
    "archive_rejects": archive_rejects,
    "batch_job_lists": batch_job_lists,
    "stored_article_factors": stored_article_factors,
    "encode_rating_messages": encode_rating_messages,
    "decode_rating_messages": decode_rating_messages,
    "apply_ratings": apply_ratings,
    "users_to_refresh": users_to_refresh,
    "upsert_recommendations": upsert_recommendations,
    "stream_apply_ratings": stream_apply_ratings,
    "stream_then_batch_lists": stream_then_batch_lists,
    "batch_beside_open_stream": batch_beside_open_stream,
    "stream_rejects": stream_rejects,
    "article_listing": article_listing,
    "article_listing_default": article_listing_default,
    "users_listing_default": users_listing_default,
    "article_json": article_json,
    "ratings_listing": ratings_listing,
    "recommendations_listing": recommendations_listing,
    "users_listing": users_listing,
    "lookup_by_key": lookup_by_key,
    "lookup_one_user": lookup_one_user,
    "user_dates": user_dates,
    "rating_json": rating_json,
    "recommendation_json": recommendation_json,
    "user_json": user_json,
    "decode_user_json": decode_user_json,
    "graph_nodes": graph_nodes,
    "graph_edges": graph_edges,
    "graph_json": graph_json,
    "append_sequential_ids": append_sequential_ids,
    "apply_changes": apply_changes,
    "apply_user_changes": apply_user_changes,
    "stored_changes": stored_changes,
}
