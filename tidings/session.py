"""Session construction and the shared checkpoint folder.

Library code never invents a cluster folder: it reads ``spark.checkpoint.dir``
from the session.  Only a local master (tests, bench) falls back to a fresh
scratch folder when the setting is absent.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Fixed values used by the reference jobs (batch and fold-in).
DEFAULT_ITERATIONS = 3
DEFAULT_RANK = 35
DEFAULT_LAMBDA = 0.1
DEFAULT_TOP_N = 10


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidings", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # one BLAS thread per Python worker: Spark already runs one task per core
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, installing it on the context.

    Order: a folder already set on the context, then ``spark.checkpoint.dir``
    from the session conf.  A local master with neither gets a scratch folder;
    a cluster master with neither is an error (a machine-local folder would not
    survive the loss of an executor).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/DBFS) for this cluster")
        configured = tempfile.mkdtemp(prefix="tidings-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder with at least one entry that Spark would read is there."""
    p, fs = _hadoop(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """What a query shuffles is deleted when it ends, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts lineage like a checkpoint, and the result carries no constraints of the
    plan that produced it (a checkpointed plan keeps them, which can confuse
    filter inference when an output column is an alias of an input one).
    """
    return materialize_parts(df.sparkSession, [df], name)


def materialize_parts(spark: SparkSession, parts: Iterable[DataFrame], name: str = "table") -> DataFrame:
    """``materialize`` of a union whose parts are written one after the other: only one part's shuffles take disk at a time."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    with freeing_shuffles(spark):
        for part in parts:
            part.write.mode("append").parquet(path)
    out = spark.read.parquet(path)
    out._tidings_path = path
    return out


def materialized(df: DataFrame, name: str = "table") -> DataFrame:
    """``df``, written if it isn't yet."""
    return df if getattr(df, "_tidings_path", None) else materialize(df, name)


def discard(df: DataFrame | None) -> None:
    """Delete the files of a ``materialize`` result that nothing is going to read any more."""
    path = getattr(df, "_tidings_path", None)
    if path:
        delete_path(df.sparkSession, path)
