"""The stream with state of its own, and polling by key as a source."""

import json
import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.keys import DUPLICATE_KEY
from rowferry.sources.keyset import KeysetReader, as_text, register
from rowferry.spec import DestSpec, JobSpec
from rowferry.streaming import keyed
from rowferry.streaming.keyed import DELETE, GONE, IN, INSERT, LATE, settle, stream_keyed

SCHEMA = T.StructType().add("id", "long").add("v", "string").add("at", "timestamp")
SPEC = DestSpec(SCHEMA, "id", buckets=2, max_length={"v": 5})
JOB = JobSpec("keyed", "s", "d", "id")


def test_events_of_one_key():
    assert settle([(1, False, "a"), (2, False, "b")], 0, 0) == ([("b", DUPLICATE_KEY), ("a", INSERT)], IN, 1)
    assert settle([(3, True, "a")], IN, 1) == ([("a", DELETE)], GONE, 3)
    assert settle([(2, False, "a")], GONE, 3) == ([("a", LATE)], GONE, 3)
    assert settle([(4, False, "a"), (5, True, "x"), (6, False, "b")], GONE, 3) == ([("b", INSERT)], IN, 6)
    assert settle([(4, True, "x"), (5, False, "b"), (6, True, "y")], IN, 1) == ([("x", DELETE)], GONE, 6)
    assert settle([(1, False, "a"), (1, True, "a")], 0, 0) == ([], GONE, 1)


def test_batches_in_order_and_restarts(spark, place, tmp_path):
    """Six files, one a batch, the stream stopped between them; the destination follows a loop over the events."""
    dest, _ = place(SPEC)
    rng = random.Random(7)
    schema, source = SCHEMA.json(), tmp_path / "in"
    wide = T.StructType([*SCHEMA.fields, T.StructField("is_deleted", T.IntegerType()), T.StructField("seq", T.LongType())])
    state, rejected, n = {}, 0, 0
    for i in range(6):
        rows = []
        for _ in range(60):
            n += 1
            key, flag = rng.randint(0, 40), int(rng.random() < 0.3)
            long_ = rng.random() < 0.05
            rows.append((key, "too long" if long_ else f"v{n}"[:5], datetime(2024, 1, 1, 0, 0, 0, n), flag, n))
            if flag:
                state.pop(key, None)
            elif long_ or key in state:
                rejected += 1
            else:
                state[key] = rows[-1][1:3]
        rows.append((None, "x", None, 0, n))
        rejected += 1
        rng.shuffle(rows)
        spark.createDataFrame(rows, wide).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(wide).option("maxFilesPerTrigger", 1).parquet(str(source))
        stream_keyed(stream, JOB, dest, str(tmp_path / "c"), F.col("seq")).awaitTermination()
        assert {r.id: (r.v, r.at) for r in dest.read().collect()} == state
    assert dest.rejects().count() == rejected and dest.snapshot().rows == len(state)
    before = dest.snapshot().version
    stream_keyed(stream, JOB, dest, str(tmp_path / "c"), F.col("seq")).awaitTermination()
    assert dest.snapshot().version == before
    with pytest.raises(ValueError):
        stream_keyed(stream, JOB, dest, str(tmp_path / "other"), F.col("seq"))
    assert schema


def test_keys_are_settled_slot_by_slot(spark, place, tmp_path, monkeypatch):
    """A call of Python and a row of state serve many keys."""
    monkeypatch.setattr(keyed, "SLOTS", 8)
    dest, _ = place(SPEC)
    df = spark.range(300).select("id", F.lit("a").alias("v"), F.lit(None).cast("timestamp").alias("at"), F.explode(F.array(F.lit(0), (F.col("id") % 3 == 0).cast("int"))).alias("is_deleted"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = stream_keyed(stream, JOB, dest, str(tmp_path / "c"), F.col("is_deleted"))
    query.awaitTermination()
    assert {r.id for r in dest.read().collect()} == {i for i in range(300) if i % 3} and dest.rejects().count() == 200
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 8


def test_a_slot_forgets_its_deleted_keys_one_by_one():
    class State:
        held, now, until, hasTimedOut = None, 1000, None, False
        exists = property(lambda self: self.held is not None)
        get = property(lambda self: self.held)

        def getCurrentProcessingTimeMs(self):
            return self.now

        def update(self, held):
            self.held = held

        def remove(self):
            self.held = None

        def setTimeoutDuration(self, ms):
            self.until = self.now + ms

    def batch(*events):
        return iter([pd.DataFrame(events, columns=["key", "place", "flagged", "text"])])

    state, run = State(), keyed._settled(100)
    got = [tuple(r) for f in run((0,), batch(("a", 1, True, "-a"), ("b", 1, False, "+b")), state) for r in f.itertuples(index=False)]
    assert got == [("+b", "insert")] and state.until == 1100
    state.now = 1050
    assert [tuple(r) for f in run((0,), batch(("c", 5, True, "-c"), ("a", 1, False, "+a")), state) for r in f.itertuples(index=False)] == [("+a", "late")]
    assert state.until == 1150
    state.now, state.hasTimedOut = 1150, True
    assert list(run((0,), iter([]), state)) == [] and set(json.loads(state.held[0])) == {"b"}


def test_a_batch_does_not_read_the_destination(spark, place, tmp_path, monkeypatch):
    dest, _ = place(SPEC)
    df = spark.range(50).select("id", F.lit("a").alias("v"), F.lit(None).cast("timestamp").alias("at"), F.lit(0).alias("is_deleted"))
    df.write.parquet(str(tmp_path / "in"))
    monkeypatch.setattr(type(dest), "keys", lambda *a, **k: pytest.fail("the keys were read"))
    monkeypatch.setattr(type(dest), "read", lambda *a, **k: pytest.fail("the rows were read"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    stream_keyed(stream, JOB, dest, str(tmp_path / "c"), F.lit(0)).awaitTermination()
    assert dest.snapshot().rows == 50


@pytest.mark.parametrize("kind", ["long", "timestamp", "timestamp_ntz", "string", "date"])
def test_polling_by_key(spark, tmp_path, kind):
    """New keys only, batch by batch, for keys of several types; the checkpoint holds the watermark."""
    register(spark)
    make = {"long": F.col("id"), "timestamp": F.timestamp_micros(F.col("id") * 86_400_000_001), "timestamp_ntz": F.timestamp_micros(F.col("id") * 86_400_000_001).cast("timestamp_ntz"),
            "string": F.format_string("k%05d", F.col("id")), "date": F.date_from_unix_date(F.col("id").cast("int"))}[kind]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def grow(low, high):
        spark.range(low, high, 1, 3).select(make.alias("k"), F.col("id").alias("n")).write.mode("append").parquet(path)

    def poll():
        stream = spark.readStream.format("keyset").option("path", path).option("key", "k").option("ranges", "4").load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out)
        query.awaitTermination()
        return sorted(r.n for r in spark.read.parquet(out).collect())

    grow(0, 90)
    assert poll() == list(range(90)) and poll() == list(range(90))
    grow(90, 120)
    assert poll() == list(range(120))
    rows = spark.read.parquet(out)
    assert rows.select("k").exceptAll(spark.range(120).select(make.alias("k"))).isEmpty()


def test_ranges_open_their_files_only(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(0, 1000, 1, 10).write.parquet(path)
    reader = KeysetReader({"path": path, "key": "id", "ranges": "5"}, T.StructType().add("id", "long"))
    parts = reader.partitions({"after": "499"}, reader.latestOffset())
    assert 2 <= len(parts) <= 6 and all(len(p.files) <= 3 for p in parts)
    assert sorted(i for p in parts for b in reader.read(p) for i in b["id"].to_pylist()) == list(range(500, 1000))
    assert reader.partitions({"after": "999"}, {"after": "999"}) == [] and as_text(None) is None
