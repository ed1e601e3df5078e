"""Table access and the rating / user / archive inputs derived from the driver tables.

``read_table`` is the single entry point for stored collections: parquet by
default; any other Spark source (for example a document-store connector) by
``fmt`` + options, if its jar is on the classpath.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.dates import millis_to_timestamp


def table_path(root: str, name: str) -> str:
    plain = os.path.join(root, f"{name}.parquet")
    return plain if os.path.exists(plain) or "://" in root else os.path.join(root, name)


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    if fmt == "parquet":
        return spark.read.options(**options).parquet(table_path(root, name))
    return spark.read.format(fmt).options(**options).load()


def ratings_from_events(spark: SparkSession, root: str) -> DataFrame:
    """R-events: user ``user_id``, article ``props.k``, rating ``value/500``."""
    ev = read_table(spark, root, "events")
    return ev.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("article_id"),
        (F.col("value") / 500.0).alias("rating"),
    ).where(F.col("user_id").isNotNull() & F.col("article_id").isNotNull() & F.col("rating").isNotNull())


def ratings_from_orders(spark: SparkSession, root: str) -> DataFrame:
    """R-orders (the scale source): user ``o_custkey``, article ``l_partkey``, rating ``l_quantity/50``."""
    li = read_table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, root, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("article_id"),
                    (F.col("l_quantity") / 50.0).alias("rating")))


def stored_ratings(df: DataFrame) -> DataFrame:
    """Stored form (userId, articleId, rating) -> canonical (user_id, article_id, rating)."""
    return df.select(F.col("userId").cast("bigint").alias("user_id"),
                     F.col("articleId").cast("bigint").alias("article_id"),
                     F.col("rating").cast("double").alias("rating"))


def web_ratings(df: DataFrame) -> DataFrame:
    """Web form (id, user, article, rating:int) -> canonical."""
    return df.select(F.col("user").cast("bigint").alias("user_id"),
                     F.col("article").cast("bigint").alias("article_id"),
                     F.col("rating").cast("double").alias("rating"))


def raw_users_from_customer(spark: SparkSession, root: str) -> DataFrame:
    """Raw user documents: epoch millis with -1 for an absent date."""
    c = read_table(spark, root, "customer").select("c_custkey", "c_name")
    absent = (F.col("c_custkey") % 5) == 0
    millis = F.lit(1_500_000_000_000) + F.col("c_custkey") * F.lit(86_400_000)
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("username"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com"))).alias("email"),
        F.when(absent, F.lit(-1)).otherwise(millis).cast("bigint").alias("creation_millis"),
        F.when(absent, F.lit(-1)).otherwise(millis + F.lit(3_600_000)).cast("bigint").alias("update_millis"),
    )


def users_from_raw(raw: DataFrame) -> DataFrame:
    """Typed user view; -1 millis means absent (not 1 ms before the epoch)."""
    return raw.select("id", "username", "email",
                      millis_to_timestamp("creation_millis").alias("creation_date"),
                      millis_to_timestamp("update_millis").alias("update_date"))
