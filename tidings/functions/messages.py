"""Rating messages: one text value ``user_id,article_id,rating`` per event.

Decode is tolerant (ANSI mode is on in Spark 4): a missing or non-numeric
field becomes null instead of failing the batch; rows with a null user or
article are rejects.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode_ratings(ratings: DataFrame) -> DataFrame:
    """(user_id, article_id, rating) -> (key null, value text)."""
    return ratings.select(
        F.lit(None).cast("string").alias("key"),
        F.concat_ws(",", F.col("user_id").cast("string"), F.col("article_id").cast("string"),
                    F.col("rating").cast("string")).alias("value"),
    )


def _field(parts: Column, i: int, typ: str) -> Column:
    raw = F.trim(F.try_element_at(parts, F.lit(i)))
    return raw.try_cast(typ)


def decode_columns(value: Column) -> list[Column]:
    parts = F.split(value, ",")
    return [
        _field(parts, 1, "bigint").alias("user_id"),
        _field(parts, 2, "bigint").alias("article_id"),
        _field(parts, 3, "double").alias("rating"),
    ]


def decode_ratings(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """All rows decoded, plus ``ok`` (user and article present)."""
    out = messages.select(*decode_columns(F.col(value_col)), F.col(value_col).alias("raw"))
    return out.withColumn("ok", F.col("user_id").isNotNull() & F.col("article_id").isNotNull())


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = decoded.where("ok").select("user_id", "article_id", "rating")
    rejects = decoded.where("not ok").select("raw")
    return good, rejects
