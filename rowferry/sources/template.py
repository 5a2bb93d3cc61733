"""Templated extract: the user's SELECT, bound to a table and planned by Spark.

Predicates are applied to the *result* of the query, never spliced into its
text, so WHERE, GROUP BY, LIMIT or window clauses inside it keep their meaning
and Catalyst still moves the predicate to the scan wherever that is allowed.
"""

from __future__ import annotations

from collections import Counter

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.keys import column

PLACEHOLDER = "{{table}}"


class QueryError(ValueError):
    """The extract query cannot be used."""


def render(template: str, table: str) -> str:
    """Bind every placeholder and drop one trailing semicolon."""
    text = template.replace(PLACEHOLDER, table).strip()
    return text[:-1].rstrip() if text.endswith(";") else text


def extract(spark: SparkSession, template: str, table: str) -> DataFrame:
    df = spark.sql(render(template, table))
    twice = [n for n, c in Counter(df.columns).items() if c > 1]
    if twice:
        raise QueryError(f"query returns duplicate column names: {twice}")
    return df


def check_query(spark: SparkSession, template: str, table: str) -> tuple[bool, str | None]:
    """Whether a query is valid, and the error class if not. Runs no job."""
    try:
        extract(spark, template, table)
    except (ParseException, AnalysisException) as e:
        return False, e.getCondition() or type(e).__name__
    except QueryError:
        return False, "DUPLICATE_COLUMN"
    return True, None


def query_schema(df: DataFrame) -> DataFrame:
    """Columns of a query result with their types and observed NULL counts.

    Names and types come from analysis alone; the counts take one aggregate
    over the rows, because the declared nullability of file sources is always
    'yes'.
    """
    counts = [F.count(column(n)).alias(f"c{i}") for i, n in enumerate(df.columns)]
    # One aggregate row; the explode below has as many rows as the query has columns.
    totals = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    entries = [
        F.struct(
            F.lit(i + 1).cast("int").alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"c{i}")).alias("n_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return totals.select(F.inline(F.array(*entries)))
