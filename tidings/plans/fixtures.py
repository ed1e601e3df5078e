"""Inputs derived from the driver tables, and trained models shared by the queries.

Rating sources:
* R-events: user ``user_id``, article ``props.k``, rating ``value / 500``;
  events before ``EVENT_CUT`` are the history, later ones the stream.
* R-orders: user ``o_custkey``, article ``l_partkey``, rating ``l_quantity / 50``.

Oracle-checked models use k=2 and the arithmetic initialisation, which
integer SQL reproduces; everything else uses the hash initialisation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.operators import als, topn
from tidings.session import materialize
from tidings.sources.tables import ratings_from_events, ratings_from_orders, read_table

# Fixed values of the fixtures (shared with the oracle SQL).
EVENT_CUT = "2024-01-15 00:00:00"
SECOND_CUT = "2024-01-23 00:00:00"
ORACLE_K = 2
ORACLE_SEED = 1
TABLE_N = 2            # short lists, so some run empty in the stream
ARCHIVE_EPOCH = "2016-12-01"
DOCS_PER_FILE = 50
TITLE_PATTERN = "<title>(.*?)</title>"

_models: dict = {}


def events_ratings(spark: SparkSession, d: str, part: str = "all") -> DataFrame:
    ev = read_table(spark, d, "events")
    if part == "before":
        ev = ev.where(F.col("ts") < F.lit(EVENT_CUT).cast("timestamp_ntz"))
    elif part == "after":
        ev = ev.where(F.col("ts") >= F.lit(EVENT_CUT).cast("timestamp_ntz"))
    elif part == "middle":
        ev = ev.where((F.col("ts") >= F.lit(EVENT_CUT).cast("timestamp_ntz")) & (F.col("ts") < F.lit(SECOND_CUT).cast("timestamp_ntz")))
    elif part == "late":
        ev = ev.where(F.col("ts") >= F.lit(SECOND_CUT).cast("timestamp_ntz"))
    return (ev.select(F.col("event_id"), F.col("user_id").cast("bigint").alias("user_id"),
                      F.get_json_object("props", "$.k").try_cast("bigint").alias("article_id"),
                      (F.col("value") / 500.0).alias("rating"))
            .where(F.col("user_id").isNotNull() & F.col("article_id").isNotNull() & F.col("rating").isNotNull()))


def stream_users(spark: SparkSession, d: str) -> DataFrame:
    """Users with activity after the cut (the ones the stream touches)."""
    return events_ratings(spark, d, "after").select(F.col("user_id").alias("userid")).distinct()


def ratings(spark: SparkSession, d: str, source: str) -> DataFrame:
    if source == "events":
        return ratings_from_events(spark, d)
    if source == "events_before":
        return events_ratings(spark, d, "before").drop("event_id")
    if source == "orders":
        return ratings_from_orders(spark, d)
    raise ValueError(source)


def model(spark: SparkSession, d: str, source: str = "events", k: int = ORACLE_K,
          init_mode: str = "arith", iterations: int = 3) -> als.Model:
    key = (id(spark), spark.sparkContext.applicationId, d, source, k, init_mode, iterations)
    if key not in _models:
        _models[key] = als.train(ratings(spark, d, source), k=k, iterations=iterations, seed=ORACLE_SEED,
                                 init_mode=init_mode)
    return _models[key]


def lists_table(spark: SparkSession, d: str, n: int = TABLE_N) -> DataFrame:
    """Recommendation table (userid, recommendations) of the history model, full lists only."""
    key = (id(spark), spark.sparkContext.applicationId, d, "lists", n)
    if key not in _models:
        m = model(spark, d, "events_before")
        r = ratings(spark, d, "events_before")
        ranked = topn.recommend(m.users, m.articles, r, n=n, k=m.k, n_users=m.n_users, n_articles=m.n_articles)
        _models[key] = materialize(topn.to_lists(ranked, n, require_full=True), "lists")
    return _models[key]


def full_lists(spark: SparkSession, d: str, n: int = 10) -> DataFrame:
    """Recommendation table of the model of all events: full lists of ten."""
    key = (id(spark), spark.sparkContext.applicationId, d, "full_lists", n)
    if key not in _models:
        m = model(spark, d, "events")
        ranked = topn.recommend(m.users, m.articles, ratings(spark, d, "events"), n=n, k=m.k, n_users=m.n_users,
                                n_articles=m.n_articles, n_ratings=m.n_ratings)
        _models[key] = materialize(topn.to_lists(ranked, n, require_full=True), "lists")
    return _models[key]


UNDATED_CHARS = 6000  # pages longer than this have no date in the undated archive


def archive_documents(spark: SparkSession, d: str, undated: bool = False) -> DataFrame:
    """Monthly archive JSON documents built from ``pages`` (at most DOCS_PER_FILE docs each).

    ``word_count`` stands for the fields that the engine doesn't type but must keep.
    """
    pages = read_table(spark, d, "pages").select("page_id", "url", "html")
    day = F.date_add(F.lit(ARCHIVE_EPOCH).cast("date"), (F.col("page_id") / 3).cast("int"))
    date = F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'")
    if undated:
        date = F.when(F.length("html") <= UNDATED_CHARS, date)
    doc = F.struct(F.col("url").alias("web_url"), date.alias("pub_date"), F.length("html").alias("word_count"),
                   F.struct(F.regexp_extract("html", TITLE_PATTERN, 1).alias("main")).alias("headline"))
    grouped = (pages.select(F.date_format(day, "yyyy-MM").alias("m"), F.floor(F.col("page_id") / DOCS_PER_FILE)
                            .alias("chunk"), doc.alias("doc"))
               .groupBy("m", "chunk").agg(F.collect_list("doc").alias("docs")))  # <= DOCS_PER_FILE per group
    return grouped.select("m", "chunk", F.to_json(F.struct(F.struct("docs").alias("response"))).alias("body"))

