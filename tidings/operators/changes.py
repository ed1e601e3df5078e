"""Table changes applied set-wise: inserts, updates of listed fields, deletes.

``changes`` rows: (seq, op, <key>, <columns>), op in insert | update | delete,
a null column in an update means "unchanged".  Per key the last insert or
delete (by seq) resets the row; later updates then set their non-null columns,
the latest update winning per column.  An update of a missing key does
nothing (no upsert).  Everything is a partial aggregation per key plus joins:
no per-row calls and no collected groups.

``apply_to_store`` does the same to a stored table, copy-on-write: only buckets that hold a changed
key are read and written again, and one commit puts them in the place of the old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.operators.ranking import with_positions
from tidings.sources.snapshots import Snapshot, Store


def stamp_changes(changes: DataFrame, as_of, created_col: str = "creation_date",
                  updated_col: str = "update_date") -> DataFrame:
    """Fill the edit times of change rows: inserts get both stamps, updates the update stamp.

    ``as_of`` is a timestamp Column or literal (pass ``F.current_timestamp()`` for "now");
    a stamp already present in the change row is kept.
    """
    ts = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return (changes
            .withColumn(created_col, F.when(F.col("op") == "insert", F.coalesce(F.col(created_col), ts))
                        .otherwise(F.col(created_col)))
            .withColumn(updated_col, F.when(F.col("op").isin("insert", "update"), F.coalesce(F.col(updated_col), ts))
                        .otherwise(F.col(updated_col))))


def apply_changes(snapshot: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One aggregation of the changes per key, one full outer join with the snapshot."""
    reset = F.when(F.col("op").isin("insert", "delete"), F.col("seq"))
    edit = lambda c: F.when((F.col("op") == "update") & F.col(c).isNotNull(), F.col("seq"))
    per_key = changes.groupBy(F.col(key).alias("_k")).agg(
        F.max_by(F.struct("op", *columns), reset).alias("_r"), F.max(reset).alias("_rs"),
        *[x for c in columns for x in (F.max_by(F.col(c), edit(c)).alias(f"_u_{c}"), F.max(edit(c)).alias(f"_us_{c}"))])
    snap = snapshot.select(F.col(key).alias("_sk"), F.lit(True).alias("_in"), *[F.col(c).alias(f"_s_{c}") for c in columns])
    both = snap.join(per_key, F.col("_sk") == F.col("_k"), "full_outer")
    # a row exists after the changes if its last reset is an insert, or there is no reset and it was in the snapshot
    exists = F.when(F.col("_rs").isNotNull(), F.col("_r.op") == "insert").otherwise(F.coalesce("_in", F.lit(False)))

    def value(c: str):
        before = F.when(F.col("_rs").isNotNull(), F.col(f"_r.{c}")).otherwise(F.col(f"_s_{c}"))
        # the latest edit counts if no reset came after it
        edited = F.col(f"_us_{c}").isNotNull() & (F.col("_rs").isNull() | (F.col(f"_us_{c}") > F.col("_rs")))
        return F.when(edited, F.col(f"_u_{c}")).otherwise(before).alias(c)

    return both.where(exists).select(F.coalesce("_sk", "_k").alias(key), *[value(c) for c in columns])


def append_sequential_ids(existing: DataFrame, new_rows: DataFrame, key: str, order) -> DataFrame:
    """New rows get ids max(existing key) + 1 + position in ``order`` (no collision after deletes)."""
    base = existing.agg(F.coalesce(F.max(key) + 1, F.lit(0))).first()[0]  # one scalar
    pos = with_positions(new_rows, order, "_p")
    return pos.withColumn(key, (F.lit(base) + F.col("_p")).cast("bigint")).drop("_p")


def put_table(store: Store, table: str, rows: DataFrame, key: str) -> Snapshot:
    """``rows`` as a table of the store, by bucket of the key (replaces what the table held)."""
    part = store.write(rows, table, key)
    return store.update(lambda snap: ({table: [part]}, {}))


def read_table(store: Store, table: str, schema: T.StructType, snapshot: Snapshot | None = None) -> DataFrame:
    return store.read(snapshot or store.snapshot(), table, schema).drop("bucket")


def apply_to_store(store: Store, table: str, schema: T.StructType, changes: DataFrame, key: str) -> list[int]:
    """Applies change rows to a stored table; returns the buckets that were written again.

    Changes that another job commits meanwhile stay: the buckets are worked out again on its snapshot.
    """
    columns = [f.name for f in schema.fields if f.name != key]
    touched = store.buckets_of(changes.where(F.col(key).isNotNull()), key)

    def change(snap: Snapshot):
        if not touched:
            return None
        old = store.read(snap, table, schema, touched).drop("bucket")
        new = apply_changes(old, changes, key, columns)
        return {table: store.replace_buckets(snap, table, new, key, touched)}, {}

    store.update(change)
    return touched
