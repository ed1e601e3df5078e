"""The archive as a file stream: new monthly files are taken in as they appear.

Spark's file source and its checkpoint remember which files were read.  A micro-batch puts its files'
articles into the table and routes only the months anew that these files touch; counts by month are
kept beside the table.  A replayed batch replaces what its files put there before, so the table ends as after one
run over all files (see ``operators.ingest``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.operators import ingest
from tidings.sources.archive import archive_month


def archive_texts(spark: SparkSession, folder: str, multi_line: bool = True, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of archive texts below a folder: ``body, month_file, month`` (as ``sources.archive.read_archives``)."""
    reader = spark.readStream.format("text").option("wholetext", multi_line).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    files = reader.load(folder).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("month_file"))
    return files.where(F.trim("body") != "").withColumn("month", archive_month(F.col("month_file")))


def run_archive_stream(texts: DataFrame, out: str, checkpoint_location: str, available_now: bool = True, interval: str = "1 minute",
                       log: list | None = None):
    """Start taking in archive texts; ``log`` gets the months that each batch has routed anew."""

    def take(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        months, rejects = ingest.take_texts(batch, out)
        ingest.count_months(batch.sparkSession, out, months)
        if log is not None:
            log.append({"batch_id": batch_id, "months": months, "rejects": rejects.count()})

    w = texts.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_location)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def month_counts(spark: SparkSession, out: str) -> DataFrame:
    """``month, articles, stored, files`` of the table."""
    rows = spark.read.schema("articles long, stored long, files long, month string").parquet(f"{out.rstrip('/')}_months")
    return rows.select("month", "articles", "stored", "files")
