"""Monthly article archives: one JSON document per month, ``response.docs[]``.

The archive is a file source (``<root>/<year>/<month>.json``); all months are
read by one job with an explicit schema, never one job per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.schemas import ARCHIVE, ARCHIVE_DOC

# The first archive month of the walk.
START_YEAR = 2017
START_MONTH = 3


def month_sequence(spark: SparkSession, start_year: int = START_YEAR, start_month: int = START_MONTH,
                   count: int = 12) -> DataFrame:
    """The walk start, start-1 month, ... (January wraps to the previous December)."""
    start = F.make_date(F.lit(start_year), F.lit(start_month), F.lit(1))
    months = F.sequence(start, F.add_months(start, -(count - 1)), F.expr("interval -1 month"))
    return (spark.range(1).select(F.posexplode(months).alias("step", "d"))
            .select("step", F.year("d").alias("year"), F.month("d").alias("month")))


def walk_files(spark: SparkSession, root: str, start_year: int = START_YEAR, start_month: int = START_MONTH,
               count: int = 12) -> tuple[list[str], list[str]]:
    """Files ``<root>/<year>/<month>.json`` of the walk that exist, and the months ('yyyy-MM') without one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found, missing = [], []
    for m in month_sequence(spark, start_year, start_month, count).collect():  # one row a month
        path = f"{root.rstrip('/')}/{m['year']}/{m['month']}.json"
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            found.append(path)
        else:
            missing.append(f"{m['year']:04d}-{m['month']:02d}")
    return found, missing


def archive_month(path: Column) -> Column:
    """'yyyy-MM' of an archive file: ``month=yyyy-MM`` or ``<year>/<month>.json`` in its path, else null."""
    named = F.regexp_extract(path, r"month=(\d{4}-\d{2})", 1)
    year, month = F.regexp_extract(path, r"/(\d{4})/(\d{1,2})\.json$", 1), F.regexp_extract(path, r"/(\d{4})/(\d{1,2})\.json$", 2)
    return (F.when(named != "", named)
            .when(year != "", F.concat(year, F.lit("-"), F.lpad(month, 2, "0"))))


def read_archives(spark: SparkSession, paths: list[str], multi_line: bool = True) -> DataFrame:
    """Archive texts: ``body``, ``month_file`` (the source file) and ``month`` (its archive month, or null).

    ``multi_line=True``: one (pretty-printed) document per file, as the archive
    API returns a month; ``False``: JSON lines, one document per line.
    """
    files = (spark.read.text(paths, wholetext=multi_line, recursiveFileLookup=True)
             .select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("month_file")))
    return files.where(F.trim("body") != "").withColumn("month", archive_month(F.col("month_file")))


def parse_archive_text(df: DataFrame, col: str = "body") -> DataFrame:
    """Archive documents held as text (a file or an HTTP body column) -> typed rows; malformed ones are marked."""
    return df.withColumn("archive", F.from_json(F.col(col), ARCHIVE, {"mode": "PERMISSIVE"}))


def split_archive_rejects(parsed: DataFrame, col: str = "body") -> tuple[DataFrame, DataFrame]:
    """(documents that parsed, those that did not: ``raw`` and all other columns)."""
    ok = F.coalesce(F.col("archive._corrupt_record").isNull() & F.col("archive.response").isNotNull(), F.lit(False))
    return parsed.where(ok), parsed.where(~ok).withColumnRenamed(col, "raw").drop("archive")


def explode_docs(archives: DataFrame, archive_col: str = "archive", keep: list[str] | None = None) -> DataFrame:
    """One row per document: its typed fields and the whole of it as JSON (``doc``); no documents, no row."""
    keep = keep or []
    docs = archives.select(*keep, F.explode(F.col(f"{archive_col}.response.docs")).alias("doc"))
    return docs.withColumn("_d", F.from_json("doc", ARCHIVE_DOC)).select(*keep, "_d.*", "doc")


def missing_months(present: DataFrame, month_col: str = "month") -> DataFrame:
    """Walk from the newest month present back to the oldest, one month at a time,
    and report each month with whether the archive has it (a gap is reported, the
    walk goes on).  ``present`` holds 'yyyy-MM' strings; the walk is generated
    from the two bounds only, so it never collects the months.
    """
    d = F.to_date(F.concat(F.col(month_col), F.lit("-01")))
    bounds = present.agg(F.max(d).alias("hi"), F.min(d).alias("lo"))
    walk = bounds.select(F.posexplode(F.sequence("hi", "lo", F.expr("interval -1 month"))).alias("step", "d"))
    have = present.select(F.col(month_col).alias("m")).distinct().withColumn("present", F.lit(True))
    return (walk.select("step", F.date_format("d", "yyyy-MM").alias("m"), F.year("d").alias("year"),
                        F.month("d").alias("month"))
            .join(have, "m", "left")
            .select("step", "year", "month", F.coalesce("present", F.lit(False)).alias("present")))
