"""Helpers shared by the training-data operators.

Documents are addressed by ``(doc_id, _h)``, ``_h`` a 128-bit hash of the text: rows that agree in
both are the same document twice and get the same answer, so repeated or null ids need no
row numbering.  A null text counts as an empty one.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.session import checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}  # A-Z only
OUT_ROWS = 50_000  # rows per Arrow batch sent back to Spark


def lower_words(text: str) -> list[bytes]:
    """``WORD.findall(text.translate(LOWER))`` in UTF-8: bytes know no other case and white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_key(text):
    """128 bits of a text column."""
    return F.unhex(F.md5(text))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, _h, text`` of any table that has ``doc_id`` and ``text``; other columns are left out."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text")).select("doc_id", text_key(F.col("text")).alias("_h"), "text")


def same_doc(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_h"] == b["_h"])


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


class Scope:
    """The tables written within a ``with`` block, so that they can be deleted when a result has been written."""

    _open: list[Scope] = []

    def __init__(self):
        self.tables: list[Table] = []

    def __enter__(self) -> Scope:
        Scope._open.append(self)
        return self

    def __exit__(self, *error) -> None:
        Scope._open.remove(self)
        if Scope._open:  # what is left belongs to the block around
            Scope._open[-1].tables += self.tables

    def drop(self, but: Table | None = None) -> None:
        """Delete the tables, except one; only when nothing that is still to run reads them."""
        for t in self.tables:
            if t is not but:
                t.drop()
        self.tables = [] if but is None else [but]


class Table:
    """A written intermediate table in the shared checkpoint folder.

    What its query has shuffled is deleted as soon as the table is written.
    """

    FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, df: DataFrame, name: str, partition_by: list[str] | None = None):
        self.spark = df.sparkSession
        self.path = f"{checkpoint_dir(self.spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd")
        before = self.spark.conf.get(self.FREE, "false")
        self.spark.conf.set(self.FREE, "true")
        try:
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path)
        finally:
            self.spark.conf.set(self.FREE, before)
        self.schema = df.schema
        if Scope._open:
            Scope._open[-1].tables.append(self)

    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; only when nothing that is still to run reads them."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def batches(schema: pa.Schema, columns: dict[str, np.ndarray | list]):
    """Slices of equally long columns as Arrow batches."""
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], type=f.type, from_pandas=True) for f in schema]
    for i in range(0, n, OUT_ROWS):
        yield pa.RecordBatch.from_arrays([a.slice(i, OUT_ROWS) for a in arrays], schema=schema)
