"""JSON forms of ratings, recommendation lists and users, written and read.

Reading is tolerant: a text that isn't such a document gives ``ok`` false, not an error.
The keys and the -1 for an absent date are fixed values of the stored form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.dates import millis_to_timestamp, timestamp_to_millis

_KEEP_NULLS = {"ignoreNullFields": "false"}
RATING = "id bigint, user bigint, article bigint, rating bigint, _corrupt_record string"
LISTS = "userid bigint, recommendations array<bigint>, _corrupt_record string"
USER = "id bigint, username string, password string, email string, creationDate bigint, updateDate bigint, _corrupt_record string"


def rating_json(ratings: DataFrame) -> DataFrame:
    """``id, json`` of ``id, user, article, rating``; the stored rating is a whole number."""
    return ratings.select("id", F.to_json(F.struct("id", "user", "article", F.col("rating").cast("bigint").alias("rating")), _KEEP_NULLS)
                          .alias("json"))


def list_json(lists: DataFrame) -> DataFrame:
    return lists.select("userid", F.to_json(F.struct("userid", "recommendations"), _KEEP_NULLS).alias("json"))


def user_json(users: DataFrame) -> DataFrame:
    """``id, json`` of users; a password is written if there is such a column."""
    fields = ["id", "username"] + (["password"] if "password" in users.columns else []) + ["email"]
    dates = [timestamp_to_millis(c).alias(k) for c, k in (("creation_date", "creationDate"), ("update_date", "updateDate"))]
    return users.select("id", F.to_json(F.struct(*fields, *dates), _KEEP_NULLS).alias("json"))


def _read(texts: DataFrame, schema: str, col: str, needed: list[str]) -> tuple[DataFrame, Column]:
    d = texts.withColumn("_j", F.from_json(F.col(col), schema))
    ok = F.col("_j").isNotNull() & F.col("_j._corrupt_record").isNull()
    for c in needed:
        ok = ok & F.col(f"_j.{c}").isNotNull()
    return d, F.coalesce(ok, F.lit(False))


def decode_rating_json(texts: DataFrame, col: str = "json") -> DataFrame:
    d, ok = _read(texts, RATING, col, ["id", "user", "article", "rating"])
    return d.withColumn("ok", ok).select("_j.id", "_j.user", "_j.article", "_j.rating", "ok", F.col(col).alias("raw"))


def decode_list_json(texts: DataFrame, col: str = "json") -> DataFrame:
    d, ok = _read(texts, LISTS, col, ["userid", "recommendations"])
    return d.withColumn("ok", ok).select("_j.userid", "_j.recommendations", "ok", F.col(col).alias("raw"))


def decode_user_json(texts: DataFrame, col: str = "json") -> DataFrame:
    """Only the name is needed: without an id it is -1, email and dates may be absent."""
    d, ok = _read(texts, USER, col, ["username"])
    return d.withColumn("ok", ok).select(
        F.coalesce("_j.id", F.lit(-1)).alias("id"), "_j.username", "_j.email", millis_to_timestamp("_j.creationDate").alias("creation_date"),
        millis_to_timestamp("_j.updateDate").alias("update_date"), "ok", F.col(col).alias("raw"))
