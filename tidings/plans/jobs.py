"""The two batch jobs of the engine: article ingest and the batch recommender.

Outputs go under a folder on shared storage (callers pass it; the queries use
the session's checkpoint folder).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.operators import als, ingest, topn
from tidings.session import DEFAULT_ITERATIONS, DEFAULT_LAMBDA, DEFAULT_RANK, DEFAULT_TOP_N, discard, materialize, table_exists
from tidings.sources.archive import START_MONTH, START_YEAR, read_archives, walk_files
from tidings.sources.snapshots import Store
from tidings.streaming.ratings import STREAMED, put_model, stored_ratings


@dataclass
class Ingested:
    articles: DataFrame         # the whole table after the run
    rejects: DataFrame          # raw, month_file, month of texts that aren't archives, of this run
    missing: list[str]          # months of the walk without a file


def run_ingest(spark: SparkSession, archive_paths: list[str], out: str, multi_line: bool = True,
               missing: list[str] | None = None) -> Ingested:
    """Archive files (one document per month, or JSON lines) -> articles routed stored / stream.

    One plan over every month.  Malformed texts don't stop the others: they go to
    ``<out>_rejects``, by source file.  Runs may overlap (see ``operators.ingest``).
    """
    articles = spark.createDataFrame([], "id int, web_url string, pub_date string, route string, month string")
    rejects = spark.createDataFrame([], "raw string, month_file string, month string")
    if archive_paths:
        months, rejects = ingest.take_texts(read_archives(spark, archive_paths, multi_line=multi_line), out)
        if table_exists(spark, f"{out.rstrip('/')}_months"):  # kept by the archive stream
            ingest.count_months(spark, out, months)
    if table_exists(spark, out):
        articles = spark.read.parquet(out).withColumn("month", F.col("month").cast("string"))
    return Ingested(articles, rejects, missing or [])


def run_ingest_walk(spark: SparkSession, root: str, out: str, start_year: int = START_YEAR, start_month: int = START_MONTH,
                    months: int = 12) -> Ingested:
    """The walk over ``<root>/<year>/<month>.json`` from a month backwards; months without a file are reported."""
    found, missing = walk_files(spark, root, start_year, start_month, months)
    return run_ingest(spark, found, out, missing=missing)


def run_batch(ratings: DataFrame | None, store: Store, k: int = DEFAULT_RANK, iterations: int = DEFAULT_ITERATIONS,
              lam: float = DEFAULT_LAMBDA, n: int = DEFAULT_TOP_N, init_mode: str = "hash", seed: int = 1) -> dict:
    """Train, recommend full top-n lists, store lists and article factors as one commit.

    ``ratings``: those from before the stream (None: as kept in the store).  The stream's ratings that are committed when the
    job begins are trained on and masked too; later ones are applied by the stream's next batch.
    """
    snap = store.snapshot()
    columns = ["user_id", "article_id", "rating"]
    stored = stored_ratings(store, snap, base=ratings is None).select(*columns)
    if ratings is None:
        ratings = stored
    elif any(p.last >= 0 for p in snap.parts(STREAMED)):
        ratings = ratings.select(*columns).unionByName(stored)
    # read by training and by the rated-article mask; recomputable if an executor is lost
    ratings = ratings.persist(StorageLevel.MEMORY_AND_DISK)
    m = als.train(ratings, k=k, iterations=iterations, lam=lam, init_mode=init_mode, seed=seed, persist=False)
    ranked = topn.recommend(m.users, m.articles, ratings, n=n, k=k, n_users=m.n_users, n_articles=m.n_articles,
                            n_ratings=m.n_ratings)
    lists = materialize(topn.to_lists(ranked, n, require_full=True), "lists")
    ratings.unpersist()
    done = put_model(store, lists, m.articles, taken=snap.fact("last"))
    discard(lists)
    return {"version": done.fact("version"), "store": store, "model": m}


def archive_files_from_documents(documents: DataFrame, root: str) -> list[str]:
    """Write (m, body) JSON documents as JSON-lines files, one folder per month; returns the folders."""
    documents.select(F.col("m").alias("month"), "body").write.mode("overwrite").partitionBy("month").text(root)
    return [root]
