"""One ordered stream of inserts and deletes per key, whose state lives in the state store.

The stream itself knows which keys are in and which were deleted, so a micro-batch
meets neither the destination's keys nor a delete log. Keys are dealt by hash to a fixed
number of slots, whose keys are settled and kept together, as a call of Python for every
key would cost far more than its work. The destination receives what each batch settled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rowferry.functions.keys import DUPLICATE_KEY, column, key_json, normal_forms
from rowferry.operators.classify import conform
from rowferry.operators.profile import is_flagged
from rowferry.sources.table import DestTable
from rowferry.sources.workdir import file_system, write_through
from rowferry.spec import DestSpec, JobSpec
from rowferry.streaming.stream import batch_token

INSERT, DELETE, LATE = "insert", "delete", "late"
#: What is known of a key: that it is in, or that it was deleted, and at which place in the order.
IN, GONE = 1, 2
#: Slots that the keys are dealt to. A checkpoint holds for one number of slots only. What is known of a slot's keys is
#: read and written together: a thousand keys, or about 20 KB, where there are 16 million.
SLOTS = 1 << 14
#: Rows travel as text that keeps all of their digits.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def settle(events: list[tuple[int, bool, str]], known: int, at: int) -> tuple[list[tuple[str, str]], int, int]:
    """(row, outcome) of a key's events (place, is a delete, row), taken in order, and what is known then.

    The first insert is taken and later ones are duplicates. A delete takes out what is in; then a later insert is
    taken again, and one that is not later than the delete is late. An insert and a delete within one batch leave
    nothing to do.
    """
    out: list[list] = []
    for place, flagged, row in sorted(events):
        if flagged:
            if known == IN and out and out[-1][1] == INSERT:
                out.pop()
            elif known == IN:
                out.append([row, DELETE])
            known, at = GONE, place if known != GONE else max(at, place)
        elif known == IN:
            # Before a last insert, so that a delete finds that insert at the end.
            out.insert(len(out) - 1 if out and out[-1][1] == INSERT else len(out), [row, DUPLICATE_KEY])
        elif known == GONE and place <= at:
            out.append([row, LATE])
        else:
            out.append([row, INSERT])
            known, at = IN, place
    return [tuple(o) for o in out], known, at


def _settled(ttl_ms: int | None):
    """What is done for a slot of keys. Its state is the JSON of what is known of each key: (what, at, until), ``until``
    being the time in milliseconds at which a deleted key is forgotten, if ever."""

    def run(slot, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = None if ttl_ms is None else state.getCurrentProcessingTimeMs()
        known = json.loads(state.get[0]) if state.exists else {}
        events: dict[str, list] = {}
        if not state.hasTimedOut:
            for f in frames:
                for key, *event in zip(f["key"].tolist(), f["place"].tolist(), f["flagged"].tolist(), f["text"].tolist()):
                    events.setdefault(key, []).append(tuple(event))
        out = []
        for key, of_key in events.items():
            settled, what, at = settle(of_key, *known.get(key, (0, 0))[:2])
            out += settled
            known[key] = (what, at) if now is None or what != GONE else (what, at, now + ttl_ms)
        if now is not None:
            known = {k: v for k, v in known.items() if len(v) < 3 or v[2] > now or k in events}
        if known:
            state.update((json.dumps(known, separators=(",", ":")),))
        elif state.exists:
            state.remove()
        first = min((v[2] for v in known.values() if len(v) > 2), default=None)
        if first is not None:
            state.setTimeoutDuration(max(1, first - now))
        if out:
            yield pd.DataFrame(out, columns=["text", "outcome"])

    return run


def settled_stream(stream: DataFrame, job: JobSpec, spec: DestSpec, order: Column, ttl_seconds: int | None = None) -> DataFrame:
    """The rows of a stream as text with their outcome: insert, delete, or the reason of a reject.

    ``order`` is a number by which a key's events are ordered; at one place inserts come before deletes. Rows that do
    not fit the destination are rejected before and occupy no key. A deleted key is remembered for ``ttl_seconds``
    (for ever if None), so that inserts from before its deletion that come late do not bring it back.
    """
    kept = T.StructType([*spec.schema.fields, T.StructField("_flagged", T.BooleanType()), T.StructField("_place", T.LongType())])
    wide = DestSpec(kept, spec.primary_key, defaults=spec.defaults, max_length=spec.max_length, key_collation=spec.key_collation)
    source = stream.withColumns({"_flagged": F.coalesce(is_flagged(job.deleted_flag), F.lit(False)), "_place": order.cast("long")})
    rows = conform(source, wide)
    text = F.to_json(F.struct(*map(column, spec.schema.names)), JSON)
    forms = normal_forms(rows, spec.primary_key, spec.key_collation)
    has_key = forms[0].isNotNull()
    for form in forms[1:]:
        has_key = has_key & form.isNotNull()
    key = key_json(rows, spec.primary_key, spec.key_collation)
    good = rows.where(has_key & (F.col("_reason").isNull() | F.col("_flagged")))
    good = good.select(key.alias("key"), F.coalesce("_place", F.lit(0)).alias("place"), F.col("_flagged").alias("flagged"), text.alias("text"))
    good = good.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(SLOTS)))
    timeout = GroupStateTimeout.NoTimeout if ttl_seconds is None else GroupStateTimeout.ProcessingTimeTimeout
    changes = good.groupBy("slot").applyInPandasWithState(
        _settled(None if ttl_seconds is None else ttl_seconds * 1000), "text string, outcome string", "known string", "append", timeout)
    bad = rows.where(~F.col("_flagged") & F.col("_reason").isNotNull()).select(F.col("_row").alias("text"), F.col("_reason").alias("outcome"))
    return changes.unionByName(bad)


def apply_batch(job: JobSpec, dest: DestTable):
    """Apply what a micro-batch settled: its deletes, then its inserts and rejects. A repeated batch has no effect."""
    names, keys = dest.spec.schema.names, dest.spec.primary_key

    def run(batch: DataFrame, batch_id: int) -> None:
        token = batch_token(job, batch, batch_id)
        # Read once: every use would run the stateful step again.
        done = write_through(batch, "settled")
        row = F.from_json("text", dest.spec.schema, JSON)
        gone = done.where(F.col("outcome") == DELETE)
        if not dest.has_run(f"{token}-delete") and not gone.isEmpty():
            dest.delete(gone.select(row.alias("r")).select(*[F.col("r").getField(k).alias(k) for k in keys]), f"{token}-delete")
        rest = done.where(F.col("outcome") != DELETE)
        if not dest.has_run(f"{token}-insert") and not rest.isEmpty():
            reason = F.when(F.col("outcome") != INSERT, F.col("outcome"))
            rest = rest.select(F.when(reason.isNull(), row).alias("r"), reason.alias("_reason"), F.when(reason.isNotNull(), F.col("text")).alias("_row"))
            dest.insert(rest.select(*[F.col("r").getField(n).alias(n) for n in names], "_reason", "_row"), f"{token}-insert")

    return run


def stream_keyed(
    stream: DataFrame, job: JobSpec, dest: DestTable, checkpoint: str, order: Column, ttl_seconds: int | None = None, **trigger
) -> StreamingQuery:
    """Keep a destination in step with a stream of inserts and deletes (rows with the job's flag).

    The stream's state is the authority on which keys are in, so the destination must be empty when a stream begins and
    have no other writer of rows.
    """
    fs, where = file_system(dest.spark, checkpoint)
    if not fs.exists(where) and not dest.is_empty():
        raise ValueError("a keyed stream begins with an empty destination")
    changes = settled_stream(stream, job, dest.spec, order, ttl_seconds)
    return (
        changes.writeStream.foreachBatch(apply_batch(job, dest))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
