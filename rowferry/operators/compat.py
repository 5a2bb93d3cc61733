"""Does a source schema fit a destination?

Schemas are rows ``(pair, column_name, data_type, is_nullable)``, so that any
number of table pairs is compared in one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.types import types_compatible

ERROR, WARNING = "error", "warning"


def compare_schemas(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Source and destination columns side by side, with the issue flags."""
    s = source.select(
        "pair", "column_name", F.col("data_type").alias("s_type"), F.col("is_nullable").alias("s_null"), F.lit(True).alias("in_s")
    )
    d = dest.select(
        "pair", "column_name", F.col("data_type").alias("d_type"), F.col("is_nullable").alias("d_null"), F.lit(True).alias("in_d")
    )
    both = F.col("in_s").isNotNull() & F.col("in_d").isNotNull()
    return s.join(d, ["pair", "column_name"], "full_outer").select(
        "pair",
        "column_name",
        F.col("in_d").isNull().alias("missing"),
        F.col("in_s").isNull().alias("extra"),
        (both & ~types_compatible("s_type", "d_type")).alias("type"),
        (both & (F.col("s_null") == "YES") & (F.col("d_null") == "NO")).alias("nullable"),
    )


def schema_report(source: DataFrame, dest: DataFrame) -> DataFrame:
    """One row per issue. Only a column missing in the destination is an error."""

    def issue(flag, level, name):
        return F.when(F.col(flag), F.struct(F.lit(level).alias("level"), F.lit(name).alias("issue")))

    issues = F.array(
        issue("missing", ERROR, "missing_in_destination"),
        issue("extra", WARNING, "extra_in_destination"),
        issue("type", WARNING, "type"),
        issue("nullable", WARNING, "nullable"),
    )
    report = compare_schemas(source, dest).select("pair", "column_name", F.inline(issues))
    return report.where(F.col("level").isNotNull())


def schema_verdict(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Per table pair: compatible when it has no error."""
    flags = ("extra", "type", "nullable")
    warnings = sum(F.count_if(F.col(f)) for f in flags)
    return (
        compare_schemas(source, dest)
        .groupBy("pair")
        .agg(F.count_if(F.col("missing")).alias("n_errors"), warnings.alias("n_warnings"))
        .select("pair", (F.col("n_errors") == 0).alias("is_compatible"), "n_errors", "n_warnings")
    )


def dest_pk_report(dest: DataFrame, pk: str) -> DataFrame:
    """What is wrong with each destination table's key column.

    ``dest`` is ``(table_name, column_name, column_key, extra)``.
    """
    here = F.col("column_name") == pk
    extra = F.lower(F.coalesce(F.col("extra"), F.lit("")))
    found = dest.groupBy("table_name").agg(
        F.bool_or(here).alias("found"),
        F.bool_or(here & F.equal_null("column_key", F.lit("PRI"))).alias("primary"),
        F.bool_or(here & F.contains(extra, F.lit("auto_increment"))).alias("auto"),
    )
    errors = F.array(
        F.when(~F.col("found"), F.lit("not_found")),
        F.when(F.col("found") & ~F.col("primary"), F.lit("not_primary")),
        F.when(F.col("auto"), F.lit("auto_increment")),
    )
    return found.select("table_name", F.explode(errors).alias("error")).where(F.col("error").isNotNull())
