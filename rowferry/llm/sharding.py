"""Operator 10: shards of near equal bytes by longest-processing-time scheduling."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import write_through

LAW = "bytes"


def assign(sizes: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """Items, largest first, each to the shard with the least so far, through a heap. Ties by item and shard number."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out.append((item, shard))
    return out


def _slots(batches):
    """Number the rows of each shard within this task."""
    task = TaskContext.get().partitionId()
    seen: dict[int, int] = {}
    for batch in batches:
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        local = np.empty(len(shards), np.int64)
        order = np.argsort(shards, kind="stable")
        kinds, first, counts = np.unique(shards[order], return_index=True, return_counts=True)
        for shard, at, n in zip(kinds.tolist(), first, counts):
            done = seen.get(shard, 0)
            local[order[at : at + n]] = np.arange(done, done + n)
            seen[shard] = done + int(n)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(shards), task, np.int64)), pa.array(local)],
            names=[*batch.schema.names, "task", "local"],
        )


def shard(docs: DataFrame, shards: int = 16, fine: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its shard, and a slot that is gapless from 0 within the shard.

    Rows of equal text stay together; their sizes (UTF-8 bytes and one more) add up. A group that makes up at least
    1 / (shards * fine) of all bytes is an item for the heap by itself, and there can be ``shards * fine`` of them at
    most. Smaller groups go by the hash of their text into as many bundles, each an item. So the driver schedules at
    most ``2 * shards * fine`` items whatever the input, and the same number of rows is broadcast. With few rows
    nearly every bundle is one group and the schedule is that of the groups themselves; with many, a bundle is about
    1 / fine of a shard, which bounds the difference between shards. One group larger than a shard cannot be split.

    NULL text counts as empty, and stays together with empty texts. Ids are carried, never compared, so NULL and
    repeated ids are rows like any other. Other columns are not read. An empty table gives no rows.

    Slots need the number of a shard's rows in earlier tasks. The rows, without their text, are therefore written once
    together with their task's number; a repeated task cannot shift them.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = write_through(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("text_key"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    pieces = shards * fine
    big = (
        rows.groupBy("text_key")
        .agg(F.sum("size").alias("bytes"))
        .where(F.col("bytes") * F.lit(pieces) >= F.lit(total))
        .select("text_key", F.concat(F.lit("group "), F.hex("text_key")).alias("alone"))
    )
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("text_key"), F.lit(pieces)).cast("string"))
    items = rows.join(F.broadcast(big), "text_key", "left").withColumn("item", F.coalesce("alone", bundle))
    loads = items.groupBy("item").agg(F.sum("size").alias("bytes")).collect()
    plan = assign([(r.item, r.bytes) for r in loads], shards)
    plan_rows = spark.createDataFrame(
        pa.table({"item": pa.array([p[0] for p in plan], pa.string()), "shard": pa.array([p[1] for p in plan], pa.int32())})
    )
    dealt = items.join(F.broadcast(plan_rows), "item").select("doc_id", "size", "text_crc32", "shard")
    schema = T.StructType([*dealt.schema.fields, T.StructField("task", T.LongType()), T.StructField("local", T.LongType())])
    placed = write_through(dealt.mapInArrow(_slots, schema), "shard-slots")
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        placed.groupBy("shard", "task")
        .agg(F.count("*").alias("n"))
        .select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    return placed.join(firsts, ["shard", "task"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("first") + F.col("local")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
