"""External databases through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.keys import column

from rowferry.sources.template import render


def range_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Options that make Spark read ``column`` in parallel stripes.

    The bounds only shape the stripes; rows outside them are still read.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_query(spark: SparkSession, url: str, query: str, options: Mapping[str, str]) -> DataFrame:
    """The result of a query that the database itself runs."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", f"({query}) q")
        .load()
    )


def range_scan(
    spark: SparkSession,
    url: str,
    template: str,
    table: str,
    column: str,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A query read by many tasks, each taking a stripe of the key.

    Bounds come from one MIN/MAX that the database answers from its key index.
    """
    options = dict(options or {})
    query = render(template, table)
    ends = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM ({query}) b"
    row = read_query(spark, url, ends, options).first()
    if row["lo"] is None:
        return read_query(spark, url, query, options)
    stripes = range_options(column, row["lo"], row["hi"], partitions)
    return read_query(spark, url, query, {**options, **stripes})


def predicate_scan(
    spark: SparkSession,
    url: str,
    template: str,
    table: str,
    column: str,
    cuts: Sequence,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """As ``range_scan`` with given cut points, for keys spread unevenly."""
    return spark.read.jdbc(
        url,
        f"({render(template, table)}) q",
        predicates=stripe_predicates(column, cuts),
        properties=dict(properties or {}),
    )


def stripe_predicates(column: str, cuts: Sequence) -> list[str]:
    """Predicates that together cover every row once, NULL keys included."""
    if not cuts:
        return ["1 = 1"]
    cuts = sorted(set(cuts))
    lits = [_sql_literal(c) for c in cuts]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(lits, lits[1:])]
    return [f"{column} <= {lits[0]} OR {column} IS NULL", *inner, f"{column} > {lits[-1]}"]


def _sql_literal(value) -> str:
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def append(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> None:
    """Append accepted rows.

    One duplicate key aborts the whole save, and each partition commits alone,
    so rows must have passed ``operators.classify`` before.
    """
    (
        df.write.format("jdbc")
        .options(**(options or {}))
        .option("url", url)
        .option("dbtable", table)
        .mode("append")
        .save()
    )


def existing_keys(
    spark: SparkSession, url: str, table: str, keys: Sequence[str], options: Mapping[str, str]
) -> DataFrame:
    """The keys a destination table holds, for the conflict check."""
    return read_query(spark, url, f"SELECT {', '.join(keys)} FROM {table}", options).select(
        *[column(k) for k in keys]
    )
