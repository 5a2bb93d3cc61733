"""Counts and catalogues taken before a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import any_null, as_keys, column
from rowferry.sources.template import query_schema


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def is_flagged(flag: str) -> Column:
    """A row is deleted when its flag equals 1; a NULL flag keeps it."""
    return column(flag) == 1


def deleted_count(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.count_if(is_flagged(flag)).alias("n_deleted"))


def deleted_keys(df: DataFrame, keys: str | Sequence[str], flag: str) -> DataFrame:
    return df.where(is_flagged(flag)).select(*map(column, as_keys(keys)))


def key_profile(df: DataFrame, keys: str | Sequence[str], name: str) -> DataFrame:
    """Whether columns would do as a key: rows, distinct keys, NULLs, ends.

    Stands in for the primary-key catalogue that file tables lack. Copies are
    folded per task before the shuffle.
    """
    keys = as_keys(keys)
    key = column(keys[0]) if len(keys) == 1 else F.struct(*map(column, keys))
    nulls = any_null(keys)
    return (
        df.groupBy(*map(column, keys))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count_if(~nulls).alias("n_distinct"),
            F.coalesce(F.sum(F.when(nulls, F.col("n"))), F.lit(0)).alias("n_null"),
            F.min(F.when(~nulls, key)).alias("min_key"),
            F.max(F.when(~nulls, key)).alias("max_key"),
        )
        .select(F.lit(name).alias("table_name"), "*", (F.col("n_rows") == F.col("n_distinct")).alias("is_unique"))
    )


def table_schema(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The columns of several tables in ordinal order, with NULLs observed."""
    return stack([query_schema(df).select(F.lit(n).alias("table_name"), "*") for n, df in tables.items()])


def preflight_report(
    required: Sequence[tuple[str, str]], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Existence of each required table and column, and the rows found.

    ``tables`` holds the tables that exist.
    """
    rows = []
    for table in dict.fromkeys(t for t, _ in required):
        df = tables.get(table)
        if df is None:
            spark = next(iter(tables.values())).sparkSession
            base = spark.range(1).select(F.lit(None).cast("long").alias("n_rows"))
        else:
            base = df.agg(F.count(F.lit(1)).alias("n_rows"))
        entries = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(df is not None).alias("table_exists"),
                F.lit(df is not None and column in df.columns).alias("column_exists"),
                F.col("n_rows"),
            )
            for t, column in required
            if t == table
        ]
        rows.append(base.select(F.inline(F.array(*entries))))
    return stack(rows)
