"""Key-ordered pages and batches, without a global window.

``row_number`` over an unpartitioned order would move every row into one task.
Here rows are range partitioned and sorted, numbered inside each partition, and
shifted by the sizes of the partitions before theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowferry.functions.keys import after, any_null, as_keys, column, folded, normal_forms, total_order
from rowferry.sources.workdir import write_through


def keyset_page(
    df: DataFrame, keys: str | Sequence[str], cursor: Sequence | None, size: int, collation: str | None = None
) -> DataFrame:
    """The next ``size`` rows after the cursor in key order, ties by the other columns.

    Under a collation keys are paged in its order: those that are equal in it
    lie together, and none of them follows a cursor that is one of them.
    """
    keys = as_keys(keys)
    order = normal_forms(df, keys, collation)
    if cursor is None:
        rows = df
    elif collation is None:
        rows = df.where(after(keys, cursor))
    else:
        names = [f"_k{i}" for i in range(len(keys))]
        marks = [folded(F.lit(v), collation) if isinstance(v, str) else F.lit(v) for v in cursor]
        rows = df.withColumns(dict(zip(names, order))).where(after(names, marks)).drop(*names)
    ties = [] if collation is None else [column(k) for k in keys]
    return rows.orderBy(*[c.asc_nulls_first() for c in (*order, *ties)], *total_order(df, keys)).limit(size)


def number_rows(df: DataFrame, keys: str | Sequence[str] = (), collation: str | None = None) -> DataFrame:
    """Adds ``row_no``, the position (from 1) of each row in key order.

    Ties are ordered by the remaining columns. The reading task comes last in
    the order, so a run of equal rows is split over partitions like any other.
    The sorted rows are written out once: partition sizes and positions must
    stem from the same partitioning.
    """
    keys = as_keys(keys)
    order = [c.asc_nulls_first() for c in normal_forms(df, keys, collation)]
    order += total_order(df, keys if collation is None else ())
    order.append(F.col("_task").asc())
    placed = (
        df.withColumn("_task", F.spark_partition_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_task")
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_pos", 33), "_pos": F.col("_pos").bitwiseAND((1 << 33) - 1)})
    )
    placed = write_through(placed, "numbered")
    # One row per partition, so this window is as small as the partition count.
    before = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
        )
    )
    return (
        placed.join(F.broadcast(before), "_part")
        .withColumn("row_no", F.col("_before") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_before")
    )


def with_batches(df: DataFrame, keys: str | Sequence[str], size: int, done: int = 0, collation: str | None = None) -> DataFrame:
    """Adds ``row_no`` and ``batch_no``; batches are numbered on from ``done``."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    batch = F.expr(f"(row_no - 1) div {int(size)}") + F.lit(int(done) + 1)
    return number_rows(df, keys, collation).withColumn("batch_no", batch.cast("long"))


def batch_manifest(
    df: DataFrame, keys: str | Sequence[str], size: int, done: int = 0, collation: str | None = None
) -> DataFrame:
    """Number, first and last key and row count of every batch.

    Only key columns are shuffled. With one key column the ends are plain
    values, with several they are structs.
    """
    keys = as_keys(keys)
    batches = with_batches(df.select(*map(column, keys)), keys, size, done, collation)
    key = column(keys[0]) if len(keys) == 1 else F.struct(*map(column, keys))
    ends = F.min(key), F.max(key)
    if collation is not None:
        # Ties in the collation's order are in binary order.
        at = F.when(~any_null(keys), F.struct(*normal_forms(batches, keys, collation), key))
        ends = F.min_by(key, at), F.max_by(key, at)
    return batches.groupBy("batch_no").agg(ends[0].alias("first_pk"), ends[1].alias("last_pk"), F.count(F.lit(1)).alias("n_rows"))


def keyset_resume(
    df: DataFrame, keys: str | Sequence[str], last: Sequence, batches_done: int, size: int
) -> DataFrame:
    """Rows a checkpoint has not covered, batch numbers carrying on."""
    return with_batches(df.where(after(keys, last)), keys, size, batches_done).drop("row_no")


def offset_page(df: DataFrame, offset: int, size: int, numbered: bool = True) -> DataFrame:
    """A page by position, for queries that do not return the key.

    The order is total over all columns. Rows are numbered by all tasks;
    ``numbered=False`` has one task keep the first ``offset + size`` rows
    instead, for callers who know that those are few.
    """
    if not numbered:
        return df.orderBy(*total_order(df)).offset(offset).limit(size)
    return number_rows(df).where(F.col("row_no").between(offset + 1, offset + size)).drop("row_no")


def key_cuts(df: DataFrame, key: str, ranges: int) -> list:
    """At most ``ranges - 1`` key values that cut the rows into like shares, for any type that can be sorted.

    They are the ends of Spark's range partitions, so a string key is cut like a number. Cuts only decide which
    range a row is loaded with.
    """
    if ranges < 2:
        return []
    keys = df.select(column(key).alias("k")).where(F.col("k").isNotNull())
    parts = keys.repartitionByRange(ranges, "k").groupBy(F.spark_partition_id()).agg(F.max("k").alias("k")).collect()
    return sorted({r["k"] for r in parts})[:-1]
