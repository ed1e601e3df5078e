"""Exact global row positions and per-group ranks without single-task windows.

``row_number() over (order by ...)`` without a partition runs in one task, and
``over (partition by g ...)`` puts a hot group in one task.  Here the data is
range-partitioned on the sort key (Spark samples the key, so a hot group is
spread over many tasks), sorted within partitions, and numbered as
``offset[partition] + index within partition``.  Only the per-partition
counts (one row per partition) and per-group first positions (one row per
group) are aggregated, both bounded and partially aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import materialize

_MAX_BROADCAST_GROUPS = 1_000_000


def _sort_cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_positions(df: DataFrame, order, pos_col: str = "pos", partitions: int | None = None) -> DataFrame:
    """Add ``pos`` = 0-based position of the row in the total order ``order``.

    Give a total order (add a unique tie-break column) for a deterministic result.
    """
    cols = _sort_cols(order)
    # without an explicit count AQE sizes the range partitions (merging only neighbours, so order holds)
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ordered = (ranged.sortWithinPartitions(*cols)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    # pin partition ids and in-partition indexes as data (they are not recomputable)
    ordered = materialize(ordered, "ordered")
    counts = ordered.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (ordered.join(F.broadcast(offsets), "_pid")
            .withColumn(pos_col, (F.col("_off") + local).cast("bigint"))
            .drop("_pid", "_mid", "_off"))


def group_ranks(df: DataFrame, group: str, order, rank_col: str = "rank", size_col: str | None = "group_size",
                partitions: int | None = None) -> DataFrame:
    """1-based rank inside ``group`` by ``order`` (and the group's size), skew-proof."""
    cols = [F.col(group)] + _sort_cols(order)
    pos = with_positions(df, cols, "_pos", partitions)
    # null is a group like any other
    stats = pos.groupBy(F.col(group).alias("_g")).agg(F.min("_pos").alias("_first"), F.count("*").alias("_size"))
    n_groups = stats.count()
    stats = F.broadcast(stats) if n_groups <= _MAX_BROADCAST_GROUPS else stats
    out = (pos.join(stats, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
           .withColumn(rank_col, (F.col("_pos") - F.col("_first") + 1).cast("bigint")))
    if size_col:
        out = out.withColumnRenamed("_size", size_col)
    return out.drop("_pos", "_first", "_size")


def cut_index(count: Column, fraction: float) -> Column:
    """floor(count * fraction): the truncating multiply of the split."""
    return F.floor(count * F.lit(fraction)).cast("bigint")
