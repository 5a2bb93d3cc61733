"""One synchronisation run, composed of the DataFrame operators.

Order of effects: data and rejects (one commit), then watermark, checkpoint,
batch metrics, run history. A run that dies anywhere may simply be repeated:
rows that are already there come back as duplicates and change nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.keys import DELETED, DUPLICATE_KEY, after_watermark, column, key_text, typed_key
from rowferry.functions.types import spark_type_name
from rowferry.operators.classify import classify
from rowferry.operators.constraints import classify_constrained, has_constraints, key_columns
from rowferry.operators.compat import ERROR, dest_pk_report, schema_report
from rowferry.operators.loads import batch_metrics, load_progress
from rowferry.operators.paging import key_cuts
from rowferry.operators.profile import deleted_keys
from rowferry.operators.sketches import key_sketch, sketch_cuts
from rowferry.plans import state as S
from rowferry.plans.modes import FORCED, INVALID_MODE, MODES, mode_columns
from rowferry.sources.table import ConflictError, DestTable
from rowferry.sources.template import check_query, extract, render
from rowferry.sources.workdir import rows_of, write_through
from rowferry.spec import DestSpec, JobSpec


#: Attempts at a load whose ground other writers take away.
RETRIES = 5

# The texts of refused runs.
NO_TABLE = "Source table '%s' does not exist"
BAD_QUERY = "SQL query syntax error: %s"
BAD_SCHEMA = "Schema validation failed: %s"
NO_COLUMN = "Column '%s' exists in source but not in destination"
NO_KEY_COLUMN = "Primary key column '%s' not found in destination table"
NOT_PRIMARY = "Column '%s' is not a PRIMARY KEY in destination table"
IDENTITY_KEY = "Destination primary key '%s' has AUTO_INCREMENT"
KEY_NOT_IN_QUERY = "Primary key column '%s' not found in query result"


class SyncError(RuntimeError):
    """A run that must not go on."""


@dataclass
class RunResult:
    run_id: str
    mode: str = "unknown"
    reason: str = ""
    rows_processed: int = 0
    rows_inserted: int = 0
    rows_rejected: int = 0
    rows_attempted: int = 0
    rows_removed: int = 0
    status: str = "completed"
    error: str | None = None


SCHEMA_ROWS = "pair string, column_name string, data_type string, is_nullable string"


def dest_schema_rows(spark: SparkSession, pair: str, spec: DestSpec) -> DataFrame:
    rows = [
        (pair, f.name, spark_type_name(f.dataType), "YES" if f.nullable and f.name not in spec.primary_key else "NO")
        for f in spec.schema.fields
    ]
    return rows_of(spark, rows, SCHEMA_ROWS)


def source_schema_rows(spark: SparkSession, pair: str, df: DataFrame) -> DataFrame:
    """A query's columns count as nullable, as its metadata knows no better."""
    rows = [(pair, f.name, spark_type_name(f.dataType), "YES") for f in df.schema.fields]
    return rows_of(spark, rows, SCHEMA_ROWS)


def job_schema_report(source: DataFrame, spec: DestSpec) -> DataFrame:
    """All differences between a query and its destination, warnings included."""
    spark = source.sparkSession
    return schema_report(source_schema_rows(spark, "job", source), dest_schema_rows(spark, "job", spec))


def dest_key_rows(spark: SparkSession, spec: DestSpec) -> DataFrame:
    rows = [
        ("dest", n, "PRI" if n in spec.primary_key else "", "auto_increment" if n in spec.identity else "")
        for n in spec.schema.names
    ]
    return rows_of(spark, rows, "table_name string, column_name string, column_key string, extra string")


def schema_errors(source: DataFrame, spec: DestSpec, pk: tuple[str, ...], issues: list | None = None) -> list[str]:
    """Reasons to refuse the run; type and NULL differences only warn.

    ``issues`` may pass the rows of ``job_schema_report``, at most a few per column.
    """
    issues = job_schema_report(source, spec).collect() if issues is None else issues
    missing = {r["column_name"] for r in issues if r["level"] == ERROR}
    errors = [NO_COLUMN % c for c in source.columns if c in missing]
    texts = {"not_found": NO_KEY_COLUMN, "not_primary": NOT_PRIMARY, "auto_increment": IDENTITY_KEY}
    for k in pk:
        found = {r["error"] for r in dest_pk_report(dest_key_rows(source.sparkSession, spec), k).collect()}
        errors += [text % k for error, text in texts.items() if error in found]
    return errors


def save_issues(job: JobSpec, store: S.StateStore, run_id: str, issues: list) -> None:
    """Keep what the run's schema check found, warnings included."""
    seq = store.seq("schema_issues")
    rows = [(job.name, run_id, r["column_name"], r["level"], r["issue"], seq) for r in issues]
    if rows:
        store.append("schema_issues", rows_of(store.spark, rows, S.SCHEMA_ISSUES))


def preflight(spark: SparkSession, job: JobSpec) -> None:
    if not spark.catalog.tableExists(job.source_table):
        raise SyncError(NO_TABLE % job.source_table)


def choose_pk(job: JobSpec) -> tuple[str, ...]:
    declared = job.source_keys
    if declared and not set(job.primary_key) <= set(declared):
        return declared[:1]
    return job.primary_key


def start_fresh(job: JobSpec, store: S.StateStore, empty: bool) -> bool:
    if job.force_full_refresh or (empty and store.checkpoint(job) is not None):
        store.clear(job, max(store.seq("watermarks"), store.seq("checkpoints")))
        return True
    return False


def record_id(keys: tuple[str, ...]) -> Column:
    return key_text(keys[0]) if len(keys) == 1 else F.to_json(F.struct(*keys))


def flagged_rows(job: JobSpec, table: DataFrame, store: S.StateStore, pk: tuple[str, ...]) -> DataFrame:
    """Flagged rows of the source table, or only those not deleted before."""
    flagged = deleted_keys(table, pk, job.deleted_flag).withColumn("record_id", record_id(pk))
    if job.deletes == "all":
        return flagged
    done = store.delete_log(job).where(F.col("processed") == 1).select("record_id")
    return flagged.join(done, "record_id", "left_anti")


def detect_mode(
    spark: SparkSession, job: JobSpec, empty: bool, store: S.StateStore, pk: tuple[str, ...]
) -> tuple[str, str]:
    table = spark.table(job.source_table)
    has_flag = job.deleted_flag in table.columns
    flagged = 0
    if has_flag and not empty:
        flagged = flagged_rows(job, table, store, pk).count()
    mode, reason = mode_columns()
    # Literals over a local relation are worked out while planning, without a job.
    row = (
        spark.sql("SELECT * FROM VALUES (0)")
        .select(
            F.lit(0 if empty else 1).alias("dest_rows"),
            F.lit(has_flag).alias("has_flag"),
            F.lit(flagged).cast("long").alias("flagged"),
            F.lit(bool(job.source_keys)).alias("has_pk"),
            F.lit(pk[0]).alias("pk"),
        )
        .select(mode.alias("mode"), reason.alias("reason"))
        .first()
    )
    return row["mode"], row["reason"]


def _load(
    job: JobSpec,
    source: DataFrame,
    existing: Callable[[], DataFrame | None],
    dest: DestTable,
    result: RunResult,
    key: str,
    store: S.StateStore,
    deleted: DataFrame | None = None,
) -> tuple[DataFrame, str | None]:
    """Classify, write and commit; counters are read back from the files, as
    metrics of a running job may count a repeated task twice.

    Where another writer's commit took away what the rows were classified
    against, all of it is done again.
    """
    for attempt in range(RETRIES):
        base = dest.snapshot()
        try:
            if has_constraints(dest.spec):
                # Any visible row may hold one of the unique keys, wherever the load begins.
                outcome = classify_constrained(source, dest.spec, dest.read().select(*map(column, key_columns(dest.spec))), deleted)
            else:
                outcome = classify(source, dest.spec, existing(), split=job.split_hot_keys)
            done = dest.insert(outcome, result.run_id, base)
            break
        except ConflictError:
            if attempt == RETRIES - 1:
                raise
    result.rows_processed += done.accepted + done.rejected
    result.rows_inserted += done.accepted
    result.rows_rejected += done.rejected
    rows = dest.run_rows(done, key)
    if job.key_sketches and done.accepted + done.rejected:
        _save_sketch(job, store, key_sketch(rows, key), result.run_id)
    if not done.accepted + done.rejected:
        return rows, None
    return rows, S.watermark_advance(rows, key, dest.spec.key_collation).first()["new_value"]


def _save_sketch(job: JobSpec, store: S.StateStore, sketch: DataFrame, run_id: str) -> None:
    where = {"job": job.name, "source_table": job.source_table, "dest_table": job.dest_table, "run_id": run_id, "seq": store.seq("sketches")}
    store.append("sketches", sketch.withColumns({n: F.lit(v) for n, v in where.items()}))


def _save_batches(
    job: JobSpec,
    store: S.StateStore,
    rows: DataFrame,
    dest: DestTable,
    result: RunResult,
    total: int,
    rows_before: int = 0,
    batches_before: int = 0,
) -> None:
    """Batch counters of the rows just loaded, counted on from earlier ones."""
    keys = dest.spec.primary_key
    outcome = rows.withColumn("accepted", F.col("_reason").isNull())
    metrics = batch_metrics(outcome, keys, "accepted", job.batch_size, batches_before)
    metrics = metrics.withColumn("rows_done", F.col("rows_done") + F.lit(rows_before))
    last = key_text("last_pk") if len(keys) == 1 else F.to_json("last_pk")
    table = load_progress(metrics, total).select(
        F.lit(job.name).alias("job"),
        F.lit(result.run_id).alias("run_id"),
        "batch_no",
        "rows_processed",
        "rows_inserted",
        "rows_rejected",
        last.alias("last_pk"),
        "rows_done",
        "pct",
        F.lit(store.seq("batches")).alias("seq"),
    )
    store.append("batches", table)


def full_load(
    spark: SparkSession,
    job: JobSpec,
    dest: DestTable,
    store: S.StateStore,
    result: RunResult,
    ranges: int = 1,
    stop_after: int | None = None,
) -> None:
    """Copy all rows; with several key ranges, each is committed on its own
    and a repeated load skips those a checkpoint covers.

    ``stop_after`` leaves the remaining ranges to a later call.
    """
    source = extract(spark, job.query, job.source_table)
    pk = dest.spec.primary_key[0]
    dtype = dest.spec.schema[pk].dataType
    kind, key = dtype.simpleString(), typed_key(source, pk, dtype)
    point = store.checkpoint(job)
    done, batches = None, 0
    if point is not None and point["last_pk"] is not None:
        done, batches = (point["last_pk"], point["pk_type"]), point["batch_no"]
        result.rows_processed, result.rows_inserted = point["rows_processed"], point["rows_inserted"]
        source = source.where(after_watermark(key, *done))
    # Without the key every row is a reject, which one range finds out.
    cuts = sketch_cuts(store.key_sketch(job, pk), ranges) if job.key_sketches and ranges > 1 else []
    if not cuts and pk in source.columns:
        cuts = key_cuts(source.select(key.alias(pk)), pk, ranges)
    # With one range the rows processed are the total.
    total = result.rows_processed + source.count() if cuts and job.batch_history else None
    bounds = list(zip([None, *cuts], [*cuts, None]))
    where = {"job": job.name, "source_table": job.source_table, "dest_table": job.dest_table, "mode": "full"}
    fresh = dest.is_empty()
    for i, (lo, hi) in enumerate(bounds):

        def within(col):
            above = F.lit(True) if lo is None else col > F.lit(lo)
            return above if hi is None else above & (col <= F.lit(hi))

        def existing(low=lo, wanted=within(column(pk))):
            if fresh:
                return None
            if dest.spec.key_collation is not None:
                # Ranges are cut in binary order, so equal keys may lie on either side of a cut.
                return dest.keys()
            return held_keys(dest, wanted, None if low is None else F.col("high") > F.lit(low))

        # NULL keys, and those that do not fit the type, go with the first range.
        part = source.where(within(key) | key.isNull() if lo is None else within(key))
        before = result.rows_processed
        rows, last = _load(job, part, existing, dest, result, pk, store)
        if job.batch_history:
            _save_batches(job, store, rows, dest, result, total or result.rows_processed, before, batches)
        batches += -(-(result.rows_processed - before) // job.batch_size)
        last = last or (done[0] if done else None)
        finished = i == len(bounds) - 1
        store.put(
            "checkpoints",
            store.seq("checkpoints"),
            **where,
            last_pk=last,
            pk_type=kind,
            batch_no=batches,
            rows_processed=result.rows_processed,
            rows_inserted=result.rows_inserted,
            status=S.COMPLETED if finished else S.IN_PROGRESS,
        )
        done = (last, kind) if last is not None else done
        if i + 1 == stop_after and not finished:
            return
    if job.seed_watermark and done is not None:
        save_watermark(job, store, pk, *done)


def held_keys(dest: DestTable, fresh: Column, files: Column | None = None) -> DataFrame:
    """The destination's keys that loaded ones may meet: those in the loaded range, from the files whose upper bound
    ``files`` lets through. Both are conditions in the order of the destination's collation."""
    return dest.keys(after=files).where(fresh)


def save_watermark(job: JobSpec, store: S.StateStore, pk: str, value: str, kind: str) -> None:
    store.put(
        "watermarks",
        store.seq("watermarks"),
        job=job.name,
        source_table=job.source_table,
        dest_table=job.dest_table,
        pk=pk,
        value=value,
        value_type=kind,
    )


def incremental_load(
    spark: SparkSession,
    job: JobSpec,
    dest: DestTable,
    store: S.StateStore,
    result: RunResult,
    pk: str,
    flagged: DataFrame | None = None,
) -> None:
    """Insert rows whose key lies after the watermark and is not there yet.

    Rows whose key is in ``flagged`` are refused as deleted.
    """
    source = extract(spark, job.query, job.source_table)
    if pk not in source.columns:
        raise SyncError(KEY_NOT_IN_QUERY % pk)
    value, kind = store.watermark(job, pk) or (None, None)
    # The key that is paged by need not be the destination's key.
    dtype = dest.spec.schema[pk].dataType if pk in dest.spec.schema.names else source.schema[pk].dataType
    collation = dest.spec.key_collation if pk in dest.spec.primary_key else None
    fresh = after_watermark(typed_key(source, pk, dtype), value, kind, collation)
    first = pk == dest.spec.primary_key[0] and value is not None

    def existing():
        if pk not in dest.spec.primary_key:
            held = dest.keys()
        else:
            files = after_watermark("high", value, kind, collation) if first else None
            held = held_keys(dest, after_watermark(pk, value, kind, collation), files)
        if flagged is None:
            return held
        gone = flagged.distinct().withColumn("_why", F.lit(DELETED))
        return held.withColumn("_why", F.lit(DUPLICATE_KEY)).unionByName(gone)

    rows, last = _load(job, source.where(fresh), existing, dest, result, pk, store, flagged)
    if job.batch_history:
        _save_batches(job, store, rows, dest, result, result.rows_processed)
    if last is not None:
        save_watermark(job, store, pk, last, dtype.simpleString())


def delta_load(
    spark: SparkSession, job: JobSpec, dest: DestTable, store: S.StateStore, result: RunResult, pk: tuple[str, ...]
) -> None:
    """Remove rows flagged in the source, keeping a log of the ids.

    The log is written first and marked last: ids of a run that dies in
    between stay pending.
    """
    flagged = flagged_rows(job, spark.table(job.source_table), store, pk)
    apply_deletes(job, dest, store, flagged, result, pk)


def apply_deletes(
    job: JobSpec, dest: DestTable, store: S.StateStore, flagged: DataFrame, result: RunResult, pk: tuple[str, ...]
) -> None:
    def entries(ids: DataFrame, processed: int) -> DataFrame:
        return ids.select(
            F.lit(job.name).alias("job"),
            F.lit(job.source_table).alias("source_table"),
            F.lit(job.dest_table).alias("dest_table"),
            "record_id",
            F.lit(processed).alias("processed"),
            F.lit(store.seq("deletes")).alias("seq"),
        )

    # Pinned: every step below must see the same ids, and the source is read once.
    ids = write_through(flagged.where(F.col("record_id").isNotNull()), "flagged")
    result.rows_attempted += ids.count()
    new = ids.select("record_id").distinct().join(store.delete_log(job), "record_id", "left_anti")
    store.append("deletes", entries(new, 0))
    if not dest.has_run(f"{result.run_id}-delete"):
        result.rows_removed += dest.delete(ids.select(*map(column, pk)), f"{result.run_id}-delete")
    pending = S.delete_log_pending(store.delete_log(job))
    done = pending.join(ids.select("record_id").distinct(), "record_id", "left_semi")
    store.append("deletes", entries(done, 1))


def run_mode(
    spark: SparkSession, job: JobSpec, dest: DestTable, store: S.StateStore, result: RunResult, ranges: int = 1
) -> None:
    pk = choose_pk(job)
    if result.mode == "full":
        full_load(spark, job, dest, store, result, ranges)
    elif result.mode == "incremental":
        incremental_load(spark, job, dest, store, result, pk[0])
    else:
        delta_load(spark, job, dest, store, result, pk)
        if job.combined:
            # Rows deleted just now must not come back with the inserts.
            flagged = deleted_keys(spark.table(job.source_table), dest.spec.primary_key, job.deleted_flag)
            incremental_load(spark, job, dest, store, result, pk[0], flagged)


def sync(
    spark: SparkSession,
    job: JobSpec,
    dest: DestTable,
    store: S.StateStore,
    force_mode: str | None = None,
    ranges: int = 1,
) -> RunResult:
    """One run. Failures end in the result and the history, not in a raise."""
    result = RunResult(run_id=uuid.uuid4().hex)
    started = datetime.now(timezone.utc)
    try:
        preflight(spark, job)
        empty = dest.is_empty()
        start_fresh(job, store, empty)
        valid, error = check_query(spark, job.query, job.source_table)
        if not valid:
            raise SyncError(BAD_QUERY % f"{error}: {render(job.query, job.source_table)}")
        source = extract(spark, job.query, job.source_table)
        issues = job_schema_report(source, dest.spec).collect()
        save_issues(job, store, result.run_id, issues)
        errors = schema_errors(source, dest.spec, job.primary_key, issues)
        if errors:
            raise SyncError(BAD_SCHEMA % ", ".join(errors))
        if job.truncate:
            dest.truncate(f"{result.run_id}-truncate")
            empty = True
        if force_mode is None:
            result.mode, result.reason = detect_mode(spark, job, empty, store, choose_pk(job))
        elif force_mode in MODES:
            result.mode, result.reason = force_mode, FORCED
        else:
            raise SyncError(INVALID_MODE % force_mode)
        run_mode(spark, job, dest, store, result, ranges)
    except Exception as e:
        result.status, result.error = "failed", str(e)
    ended = datetime.now(timezone.utc)
    store.put(
        "runs",
        store.seq("runs"),
        job=job.name,
        source_table=job.source_table,
        dest_table=job.dest_table,
        started=started,
        ended=ended,
        seconds=(ended - started).total_seconds(),
        **result.__dict__,
    )
    return result
