"""Column mapping, deletes and the counters of a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import as_keys, column
from rowferry.operators.paging import with_batches
from rowferry.operators.profile import deleted_keys
from rowferry.spec import DestSpec


def map_columns(source: DataFrame, spec: DestSpec) -> DataFrame:
    """Source columns by name; columns only the destination has get defaults."""
    columns = [
        column(f.name) if f.name in source.columns else F.lit(spec.defaults.get(f.name))
        for f in spec.schema.fields
    ]
    return source.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, spec.schema.fields)])


def delta_apply(dest: DataFrame, source: DataFrame, keys: str | Sequence[str], flag: str) -> DataFrame:
    """The destination without the rows that are flagged in the source."""
    keys = list(as_keys(keys))
    return dest.join(deleted_keys(source, keys, flag).distinct(), keys, "left_anti")


def delta_effect(
    dest: DataFrame, source: DataFrame, keys: str | Sequence[str], flag: str, batch_size: int
) -> DataFrame:
    """Deletes attempted, rows they remove, and delete batches."""
    keys = list(as_keys(keys))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    asked = deleted_keys(source, keys, flag).select(*map(column, keys), one.alias("asked"), zero.alias("held"))
    held = dest.select(*map(column, keys), zero.alias("asked"), one.alias("held"))
    # Both sides meet in one aggregation, folded per task before its shuffle.
    per_key = asked.unionByName(held).groupBy(*map(column, keys)).agg(F.sum("asked").alias("asked"), F.sum("held").alias("held"))
    attempted = F.coalesce(F.sum("asked"), F.lit(0))
    return per_key.agg(
        attempted.alias("rows_attempted"),
        F.coalesce(F.sum(F.when(F.col("asked") > 0, F.col("held"))), F.lit(0)).alias("rows_removed"),
        F.ceil(attempted / F.lit(batch_size)).cast("long").alias("n_batches"),
    )


def batch_metrics(rows: DataFrame, keys: str | Sequence[str], accepted: str, size: int, done: int = 0) -> DataFrame:
    """Rows processed, inserted and rejected per key-ordered batch.

    ``rows`` has the key and a boolean column naming the accepted ones.
    """
    keys = as_keys(keys)
    last = column(keys[0]) if len(keys) == 1 else F.struct(*map(column, keys))
    return (
        with_batches(rows.select(*map(column, keys), accepted), keys, size, done)
        .groupBy("batch_no")
        .agg(
            F.count(F.lit(1)).alias("rows_processed"),
            F.count_if(F.col(accepted)).alias("rows_inserted"),
            F.count_if(~F.col(accepted)).alias("rows_rejected"),
            F.max(last).alias("last_pk"),
            F.max("row_no").alias("rows_done"),
        )
    )


def load_progress(metrics: DataFrame, total: int) -> DataFrame:
    """Rows done at the end of each batch, in per cent of the query's rows.

    The position of a batch's last row is the running total already, so no
    window over the batches is needed. Without rows the share is NULL.
    """
    share = F.try_divide(F.col("rows_done") * 100.0, F.lit(total).cast("long"))
    return metrics.withColumn("pct", F.round(share, 2))
