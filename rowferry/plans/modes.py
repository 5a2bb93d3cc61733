"""Decisions before a run, as columns over a table of job states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The modes and the texts of their reasons.
MODES = ("full", "incremental", "delta")
FORCED = "Manually forced"
EMPTY_DESTINATION = "Destination table is empty"
DELETED_FOUND = "Found %s deleted records in source"
KEY_FOUND = "Primary key column '%s' found"
NO_KEY = "No primary key found, defaulting to full load"
INVALID_MODE = "Invalid mode: %s. Valid modes are: full, incremental, delta"


def pk_choice(source_columns: DataFrame, configured: Column, by: str) -> DataFrame:
    """The key to page by: the configured one if it is a primary key column,
    else the first primary key column, else the configured one.

    ``source_columns`` is ``(<by>, ordinal, column_name, column_key)``.
    """
    primary = F.equal_null("column_key", F.lit("PRI"))
    first = F.min_by("column_name", F.when(primary, F.col("ordinal")))
    return (
        source_columns.withColumn("_cfg", configured)
        .groupBy(by)
        .agg(
            F.max("_cfg").alias("_cfg"),
            F.bool_or(primary & (F.col("column_name") == F.col("_cfg"))).alias("_is_pri"),
            F.bool_or(primary).alias("has_pk"),
            first.alias("_first"),
        )
        .select(
            by,
            F.when(F.col("_is_pri") | ~F.col("has_pk"), F.col("_cfg")).otherwise(F.col("_first")).alias("pk"),
            "has_pk",
        )
    )


def mode_columns() -> tuple[Column, Column]:
    """Mode and reason from ``dest_rows, has_flag, flagged, has_pk, pk``."""
    empty = F.col("dest_rows") == 0
    delta = F.col("has_flag") & (F.col("flagged") > 0)
    mode = F.when(empty, "full").when(delta, "delta").when(F.col("has_pk"), "incremental").otherwise("full")
    reason = (
        F.when(empty, EMPTY_DESTINATION)
        .when(delta, F.format_string(DELETED_FOUND, F.col("flagged")))
        .when(F.col("has_pk"), F.format_string(KEY_FOUND, F.col("pk")))
        .otherwise(NO_KEY)
    )
    return mode, reason


def mode_detect(states: DataFrame) -> DataFrame:
    mode, reason = mode_columns()
    return states.withColumns({"mode": mode, "reason": reason})


def mode_forced(states: DataFrame, forced: Column) -> DataFrame:
    """Forced modes: a known mode is taken as it is, any other is an error."""
    known = forced.isin(*MODES)
    error = F.format_string(INVALID_MODE, forced)
    return states.withColumns(
        {
            "mode": F.when(known, forced),
            "reason": F.when(known, F.lit(FORCED)).otherwise(error),
        }
    )


def fresh_start(states: DataFrame) -> DataFrame:
    """Whether stored state is dropped first: on demand, or when an unfinished
    load's destination is empty."""
    clears = F.col("force") | ((F.col("dest_rows") == 0) & F.col("has_checkpoint"))
    return states.withColumn("clears", clears)
