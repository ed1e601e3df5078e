"""Article ingest: archive documents -> articles with a stable id -> 75/25 routing.

Per archive month the oldest ``floor(0.75 * n)`` documents (by ``pub_date``, nulls
first, then id) are *stored*, the rest go to the *stream*.  Both parts come from
one rank, so they are disjoint and complete even on ties.  The month is that of
the archive file a document came from, whatever its date.

The table is partitioned by month.  A run replaces what its own files put there
before and keeps what other files did; the months it touches are routed anew as
a whole, so several runs, in any order and overlapping, end like one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.hashing import string_hash32
from tidings.operators.ranking import cut_index, group_ranks
from tidings.session import delete_path, materialize, table_exists
from tidings.sources.archive import explode_docs, parse_archive_text, split_archive_rejects

# Share of each month kept as stored articles, and the two route names.
STORED_FRACTION = 0.75
STORED = "stored"
STREAM = "stream"
# the partition of articles that have neither an archive month nor a date
UNDATED = "undated"


def with_article_id(docs: DataFrame, url_col: str = "web_url") -> DataFrame:
    """``id`` = 32-bit string hash of the URL (signed; may be negative)."""
    return docs.withColumn("id", string_hash32(url_col))


def temporal_split(df: DataFrame, month_col: str, order, fraction: float = STORED_FRACTION,
                   partitions: int | None = None) -> DataFrame:
    """Adds ``route``: stored for rank <= floor(fraction * month count), else stream."""
    ranked = group_ranks(df, month_col, order, "_rank", "_n", partitions)
    return (ranked.withColumn("route", F.when(F.col("_rank") <= cut_index(F.col("_n"), fraction), F.lit(STORED))
                              .otherwise(F.lit(STREAM)))
            .drop("_rank", "_n"))


def articles_from_docs(docs: DataFrame) -> DataFrame:
    """Document rows -> articles: id, all document columns, month (the archive's where known, else the date's)."""
    dated = F.substring("pub_date", 1, 7)
    return with_article_id(docs).withColumn("month", F.coalesce("month", dated) if "month" in docs.columns else dated)


def route_articles(articles: DataFrame, partitions: int | None = None) -> DataFrame:
    """Oldest 75% of each month stored, newest 25% streamed (nulls sort first, as ascending)."""
    return temporal_split(articles, "month", [F.col("pub_date").asc_nulls_first(), F.col("id"), F.col("web_url")],
                          STORED_FRACTION, partitions)


def merge_routed(new: DataFrame, sources: DataFrame, path: str) -> list[str]:
    """Put ``new`` articles (with ``month`` and ``source``) into the table at ``path``; returns the months that were routed anew.

    ``sources``: ``source, month`` of every file of the run, also of those without an article.
    """
    spark = new.sparkSession
    new = new.withColumn("month", F.coalesce("month", F.lit(UNDATED)))
    sources = materialize(sources.select("source", F.coalesce("month", F.lit(UNDATED)).alias("month")).distinct(), "sources")
    touched = {r["month"] for r in new.select("month").union(sources.select("month")).distinct().collect()}  # a name a month
    if table_exists(spark, path):
        old = spark.read.parquet(path).where(F.col("month").cast("string").isin(list(touched)))
        old = old.withColumn("month", F.col("month").cast("string")).drop("route")
        new = new.unionByName(old.join(F.broadcast(sources.select("source").distinct()) if sources.count() < 100_000
                                       else sources.select("source").distinct(), "source", "left_anti"),
                              allowMissingColumns=True)
    routed = materialize(route_articles(new), "routed")
    left = {r["month"] for r in routed.select("month").distinct().collect()}
    (routed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
    for month in touched - left:  # nothing of these is left
        delete_path(spark, f"{path.rstrip('/')}/month={month}")
    return sorted(touched)


def take_texts(texts: DataFrame, path: str) -> tuple[list[str], DataFrame]:
    """Archive texts (``body, month_file, month``) into the table at ``path``: (months routed anew, rejects).

    Malformed texts don't stop the others: they go to ``<path>_rejects``, by source file.
    """
    files = parse_archive_text(texts)
    good, bad = split_archive_rejects(files)
    docs = explode_docs(good, keep=["month", "month_file"]).withColumnRenamed("month_file", "source")
    rejects = materialize(bad.select("raw", "month_file", "month"), "rejects")
    sources = files.select(F.col("month_file").alias("source"), "month")
    (rejects.withColumn("source", F.sha1("month_file")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source").parquet(f"{path.rstrip('/')}_rejects"))
    return merge_routed(articles_from_docs(docs), sources, path), rejects


def count_months(spark: SparkSession, path: str, months: list[str]) -> None:
    """Brings the counts in ``<path>_months`` up to date for some months of the table at ``path``."""
    if not months:
        return
    counts = f"{path.rstrip('/')}_months"
    articles = spark.read.parquet(path).where(F.col("month").cast("string").isin(months))
    now = materialize(articles.groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count("*").alias("articles"), F.count_if(F.col("route") == STORED).alias("stored"), F.count_distinct("source").alias("files")), "months")
    now.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(counts)
    for month in set(months) - {r["month"] for r in now.select("month").collect()}:  # nothing of these is left; a name a month
        delete_path(spark, f"{counts}/month={month}")
