"""Sinks: message topics or text files, stored factor tables, versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_messages(messages: DataFrame, fmt: str = "text", path: str | None = None, **options) -> None:
    """(key, value) rows to a message topic (``fmt="kafka"``, needs the connector) or to text files.

    Each partition writes its own messages; the sink flushes and closes.
    """
    if fmt == "kafka":
        messages.select("key", "value").write.format("kafka").options(**options).save()
    elif fmt == "text":
        messages.select("value").write.mode("append").text(path)
    else:
        raise ValueError(f"unknown message sink {fmt!r}")


def stored_factors(factors: DataFrame) -> DataFrame:
    """(id, f) -> stored form (articleId, latentFactors)."""
    return factors.select(F.col("id").alias("articleId"), F.col("f").alias("latentFactors"))


def loaded_factors(stored: DataFrame) -> DataFrame:
    """Stored form -> (id, f)."""
    return stored.select(F.col("articleId").cast("bigint").alias("id"), F.col("latentFactors").alias("f"))
