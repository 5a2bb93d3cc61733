"""Watermarks, checkpoints, the delete log and the run history.

Every state table is a history of writes with a ``seq``; the current entry of a
key is the one with the highest ``seq``. Writes only ever append, so a lost
executor or a dead run cannot damage an earlier entry, and the functions here
are plain aggregates that combine per task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.keys import column, key_text, normal_forms
from rowferry.operators.profile import stack
from rowferry.operators.sketches import SKETCH, merge_sketches, quantile_kind
from rowferry.sources.table import next_seq
from rowferry.sources.workdir import empty, fold_files, rows_of, struct_type

WATERMARK_KEY = ("job", "source_table", "dest_table", "pk")
CHECKPOINT_KEY = ("job", "source_table", "dest_table", "mode")
DELETE_KEY = ("job", "source_table", "dest_table", "record_id")
IN_PROGRESS, COMPLETED, CLEARED = "in_progress", "completed", "cleared"

WATERMARKS = (
    "job string, source_table string, dest_table string, pk string, value string, value_type string, seq long"
)
CHECKPOINTS = (
    "job string, source_table string, dest_table string, mode string, last_pk string, pk_type string, "
    "batch_no long, rows_processed long, rows_inserted long, status string, seq long"
)
DELETES = "job string, source_table string, dest_table string, record_id string, processed int, seq long"
RUNS = (
    "job string, run_id string, source_table string, dest_table string, mode string, reason string, "
    "rows_processed long, rows_inserted long, rows_rejected long, rows_attempted long, rows_removed long, "
    "status string, error string, started timestamp, ended timestamp, seconds double, seq long"
)
BATCHES = (
    "job string, run_id string, batch_no long, rows_processed long, rows_inserted long, "
    "rows_rejected long, last_pk string, rows_done long, pct double, seq long"
)
SKETCHES = f"job string, source_table string, dest_table string, run_id string, {SKETCH}, seq long"
SCHEMA_ISSUES = "job string, run_id string, column_name string, level string, issue string, seq long"
KEYS = {"watermarks": WATERMARK_KEY, "checkpoints": CHECKPOINT_KEY, "deletes": DELETE_KEY}
TABLES = {
    "watermarks": WATERMARKS,
    "checkpoints": CHECKPOINTS,
    "deletes": DELETES,
    "runs": RUNS,
    "batches": BATCHES,
    "schema_issues": SCHEMA_ISSUES,
    "sketches": SKETCHES,
}


def latest(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last write of every key."""
    rest = [c for c in history.columns if c not in keys and c != "seq"]
    if len(rest) == 1:
        last = F.max_by(rest[0], "seq").alias(rest[0])
        return history.groupBy(*keys).agg(last, F.max("seq").alias("seq"))
    return (
        history.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "seq").alias("_v"), F.max("seq").alias("seq"))
        .select(*keys, "_v.*", "seq")
    )


def upsert(history: DataFrame, writes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current entries after more writes; the last write wins."""
    return latest(history.unionByName(writes, allowMissingColumns=True), keys)


def watermark_lookup(history: DataFrame) -> DataFrame:
    return latest(history, WATERMARK_KEY)


def highest(rows: DataFrame, key: str, collation: str | None = None) -> Column:
    """The greatest key, as an aggregate; in the collation's order, then in binary order."""
    if collation is None:
        return F.max(column(key))
    return F.max_by(column(key), F.struct(*normal_forms(rows, [key], collation), column(key)))


def watermark_advance(processed: DataFrame, key: str, collation: str | None = None) -> DataFrame:
    """The key to continue after: the highest one processed, rejects included.

    Without rows the value is NULL and the old watermark stays.
    """
    return processed.agg(key_text(highest(processed, key, collation), processed.schema[key].dataType).alias("new_value"))


def checkpoint_lookup(history: DataFrame) -> DataFrame:
    """Loads that can be resumed."""
    return latest(history, CHECKPOINT_KEY).where(F.col("status") == IN_PROGRESS)


def checkpoint_complete(current: DataFrame, match: Column) -> DataFrame:
    status = F.when(match, F.lit(COMPLETED)).otherwise(F.col("status"))
    return current.withColumn("status", status)


def scope(source_table: str | None = None, dest_table: str | None = None, mode: str | None = None) -> Column:
    """Entries of one mode, of one table pair, or all of them."""
    cond = F.lit(True)
    for name, value in (("source_table", source_table), ("dest_table", dest_table), ("mode", mode)):
        if value is not None:
            cond = cond & F.equal_null(F.col(name), F.lit(value))
    return cond


def state_clear(current: DataFrame, within: Column) -> tuple[DataFrame, DataFrame]:
    """The entries that stay, and how many go."""
    return current.where(~within), current.agg(F.count_if(within).alias("n_cleared"))


def delete_log_merge(log: DataFrame, flagged: DataFrame) -> DataFrame:
    """Add ids not logged yet as unprocessed; known ids keep their state."""
    new = flagged.select("record_id").distinct().join(log, "record_id", "left_anti")
    return log.select("record_id", "processed").unionByName(new.withColumn("processed", F.lit(0)))


def delete_log_pending(log: DataFrame) -> DataFrame:
    return log.where(F.col("processed") == 0).select("record_id")


def delete_log_mark(log: DataFrame, done: DataFrame) -> DataFrame:
    """Mark ids as processed."""
    marks = done.select("record_id").distinct().withColumn("_done", F.lit(1))
    return log.join(marks, "record_id", "left").select("record_id", F.coalesce("_done", "processed").alias("processed"))


def run_summary(runs: DataFrame, by: Sequence[str] = ("mode",)) -> DataFrame:
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).cast("long").alias("rows_processed"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.sum("seconds").alias("seconds"),
    )


def entries_per_job(*tables: DataFrame) -> DataFrame:
    """State entries of each job; jobs never share entries."""
    return stack([t.select("job") for t in tables]).groupBy("job").agg(F.count(F.lit(1)).alias("n_entries"))


class StateStore:
    """The state tables of all jobs, as append-only Parquet."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._last: dict[str, int] = {}

    def history(self, table: str) -> DataFrame:
        try:
            return self.spark.read.schema(TABLES[table]).parquet(f"{self.path}/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, TABLES[table])

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{table}")

    def compact(self, table: str) -> None:
        """Fold a keyed table to its current entries, each run having left a file."""
        fold_files(latest(self.history(table), KEYS[table]), f"{self.path}/{table}")

    def put(self, table: str, seq: int, **values) -> None:
        schema = struct_type(TABLES[table])
        row = [{**values, "seq": seq}.get(n) for n in schema.names]
        self.append(table, rows_of(self.spark, [row], schema))

    def seq(self, table: str) -> int:
        """A number after all of the table's, whatever the clock says."""
        if table not in self._last:
            self._last[table] = self.history(table).agg(F.max("seq")).first()[0] or 0
        self._last[table] = next_seq(self._last[table])
        return self._last[table]

    def of_job(self, table: str, job) -> DataFrame:
        return self.history(table).where(
            (F.col("job") == job.name) & scope(job.source_table, job.dest_table)
        )

    def watermark(self, job, pk: str) -> tuple[str, str] | None:
        row = watermark_lookup(self.of_job("watermarks", job).where(F.col("pk") == pk)).first()
        return None if row is None or row["value"] is None else (row["value"], row["value_type"])

    def checkpoint(self, job, mode: str = "full"):
        return checkpoint_lookup(self.of_job("checkpoints", job).where(F.col("mode") == mode)).first()

    def key_sketch(self, job, pk: str):
        """The sketches of all of the job's runs as one; None before the first."""
        mine = self.of_job("sketches", job).where(F.col("pk") == pk)
        kind = mine.agg(F.max_by("pk_type", "seq")).first()[0]
        if kind is None:
            return None
        dtype = struct_type(f"k {kind}")["k"].dataType
        return merge_sketches(mine.where(F.col("pk_type") == kind), quantile_kind(dtype)).first()

    def delete_log(self, job) -> DataFrame:
        return latest(self.of_job("deletes", job), DELETE_KEY)

    def clear(self, job, seq: int, mode: str | None = None) -> None:
        """Forget watermark and checkpoint; the delete log and history stay.

        A single mode only clears that checkpoint.
        """
        where = {"job": job.name, "source_table": job.source_table, "dest_table": job.dest_table}
        if mode is None:
            for pk in {r["pk"] for r in self.of_job("watermarks", job).select("pk").distinct().collect()}:
                self.put("watermarks", seq, **where, pk=pk)
        modes = [mode] if mode else ["full", "incremental", "delta"]
        for m in modes:
            if self.checkpoint(job, m) is not None:
                self.put("checkpoints", seq, **where, mode=m, status=CLEARED)
