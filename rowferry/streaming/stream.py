"""The same loads inside ``foreachBatch``.

Spark may hand a micro-batch over twice after a failure. Each batch is one
commit named after the streaming query and the batch id, so a repetition is
recognised and has no second effect. The query's id lives in its checkpoint: a
stream with a new checkpoint counts batches from 0 again under another id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowferry.functions.keys import after_watermark, column, typed_key, typed_value
from rowferry.operators.classify import classify
from rowferry.operators.constraints import classify_constrained, has_constraints, key_columns
from rowferry.operators.profile import is_flagged
from rowferry.plans import state as S
from rowferry.plans.sync import RunResult, apply_deletes, held_keys, record_id, save_watermark
from rowferry.sources.table import DestTable
from rowferry.spec import JobSpec

LATE = ("drop", "fill")


def batch_token(job: JobSpec, batch: DataFrame, batch_id: int) -> str:
    """Names a micro-batch; stable over restarts from one checkpoint."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{job.name}-{query}-{batch_id}" if query else f"{job.name}-{batch_id}"


def insert_batch(job: JobSpec, dest: DestTable, store: S.StateStore, late: str):
    """Insert one micro-batch.

    ``late='drop'`` leaves out keys up to the watermark stored before the batch;
    ``'fill'`` inserts them where absent.
    """
    if late not in LATE:
        raise ValueError(f"late must be one of {LATE}")
    pk = dest.spec.primary_key[0]

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{batch_token(job, batch, batch_id)}-insert"
        mark = store.watermark(job, pk)
        done = dest.log.run(run_id)
        if done is None:
            base = dest.snapshot()
            key = typed_key(batch, pk, dest.spec.schema[pk].dataType)
            mark_of = mark or (None, None)
            # A stream shows a row once, so rows without a key must reach the rejects now.
            collation = dest.spec.key_collation
            rows = batch if late == "fill" else batch.where(after_watermark(key, *mark_of, collation) | key.isNull())
            files = None if mark is None else after_watermark("high", *mark_of, collation)
            held = dest.keys() if late == "fill" else held_keys(dest, after_watermark(pk, *mark_of, collation), files)
            if has_constraints(dest.spec):
                outcome = classify_constrained(rows, dest.spec, dest.read().select(*map(column, key_columns(dest.spec))))
            else:
                outcome = classify(rows, dest.spec, held, split=job.split_hot_keys)
            done = dest.insert(outcome, run_id, base)
        last = S.watermark_advance(dest.run_rows(done), pk, dest.spec.key_collation).first()["new_value"]
        if last is None:
            return
        kind = dest.spec.schema[pk].dataType.simpleString()
        ahead = batch.sparkSession.range(1).where(
            F.lit(True) if mark is None else after_watermark(typed_value(last, kind), *mark, dest.spec.key_collation)
        )
        if not ahead.isEmpty():
            save_watermark(job, store, pk, last, kind)

    return run


def delete_batch(job: JobSpec, dest: DestTable, store: S.StateStore):
    """Delete the rows one micro-batch flags, with the delete log kept."""
    pk = dest.spec.primary_key

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = batch_token(job, batch, batch_id)
        flagged = batch.where(is_flagged(job.deleted_flag)).select(*map(column, pk)).withColumn("record_id", record_id(pk))
        apply_deletes(job, dest, store, flagged, RunResult(run_id=run_id), pk)

    return run


def _start(stream: DataFrame, handler, checkpoint: str, **trigger) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_inserts(
    stream: DataFrame,
    job: JobSpec,
    dest: DestTable,
    store: S.StateStore,
    checkpoint: str,
    late: str = "drop",
    **trigger,
) -> StreamingQuery:
    return _start(stream, insert_batch(job, dest, store, late), checkpoint, **trigger)


def stream_deletes(
    stream: DataFrame, job: JobSpec, dest: DestTable, store: S.StateStore, checkpoint: str, **trigger
) -> StreamingQuery:
    return _start(stream, delete_batch(job, dest, store), checkpoint, **trigger)
