"""Snapshots, delete bitmaps, file skipping, and writers that work at once."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.classify import classify
from rowferry.sources import table as table_module
from rowferry.sources.log import Snapshot
from rowferry.sources.table import ConflictError, DestTable
from rowferry.spec import DestSpec

SPEC = DestSpec(T.StructType().add("id", "long").add("v", "string"), "id", buckets=4)


def rows(dest):
    return sorted(tuple(r) for r in dest.read().collect())


def frame(spark, ids, v="a"):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def prepared(dest, df):
    """A writer that has classified and written, but not committed."""
    base = dest.snapshot()
    return dest.write(classify(df, dest.spec, dest.keys())), base


# -- deletes -----------------------------------------------------------------


def test_bitmaps_of_many_commits(spark, place):
    """Deletes hit the versions of a key that are visible, in whichever folder and part of a file they are."""
    dest, _ = place(SPEC)
    dest.load(spark.range(0, 150_000).select("id", F.lit("a").alias("v")))
    assert dest.delete(spark.range(0, 150_000, 3), "d1") == 50_000
    dest.load(spark.range(0, 300, 3).select("id", F.lit("b").alias("v")))
    assert dest.delete(spark.range(0, 300, 2), "d2") == 150
    now = {r["id"]: r["v"] for r in dest.read().collect()}
    gone = set(range(0, 300, 2))
    assert now == {**{i: "a" for i in range(150_000) if i % 3 and i not in gone}, **{i: "b" for i in range(0, 300, 3) if i not in gone}}
    assert dest.snapshot().rows == len(now) and len(dest.snapshot().marks) == 2
    assert dest.delete(spark.range(0, 300, 2), "d3") == 0


def test_reading_deletes_moves_no_row(spark, place):
    dest, _ = place(SPEC)
    dest.load(frame(spark, range(40)))
    dest.delete(frame(spark, [7]), "d")
    text = plan(dest.read())
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # The only exchange is the bitmaps' own.
    assert text.count("Exchange") == text.count("BroadcastExchange") and "BuildRight" in text


def test_more_bitmaps_than_may_be_broadcast(spark, place, monkeypatch):
    dest, _ = place(SPEC)
    dest.load(frame(spark, range(40)))
    dest.delete(frame(spark, [7, 8]), "d")
    before = rows(dest)
    monkeypatch.setattr(table_module, "BROADCAST_MARKS", 0)
    assert rows(dest) == before and "SortMergeJoin" in plan(dest.read())


def test_compaction_of_worn_buckets(spark, place):
    dest, _ = place(SPEC)
    dest.load(frame(spark, range(200)))
    buckets = {r.id: r.b for r in dest.read().select("id", F.pmod(F.xxhash64("id"), F.lit(4)).alias("b")).collect()}
    worn = [i for i, b in buckets.items() if b == 2][:30]
    dest.delete(frame(spark, [*worn, *[i for i, b in buckets.items() if b == 1][:1]]), "d")
    before = rows(dest)
    dest.compact("c", min_deleted=0.3)
    now = dest.snapshot()
    assert rows(dest) == before and list(now.dead.values()) == [(2,)] and now.rows == len(before)
    assert dest.delete(frame(spark, [before[0][0]]), "d2") == 1
    dest.compact("c2")
    assert rows(dest) == before[1:] and not dest.snapshot().dead and not dest.snapshot().marks


def test_truncate_and_history(spark, place):
    dest, _ = place(SPEC)
    for i in range(3):
        dest.load(frame(spark, [i]), f"r{i}")
    dest.truncate("t")
    dest.compact("c")
    assert dest.is_empty() and [dest.has_run(r) for r in ("r0", "r2", "t", "x")] == [True, True, True, False]
    assert sorted(r.kind for r in dest.commits().collect()) == ["insert"] * 3 + ["truncate"]
    dest.load(frame(spark, [9]), "r9")
    assert dest.commits().count() == 5 and dest.has_run("r0") and rows(dest) == [(9, "a")]


# -- file skipping -------------------------------------------------------------


def test_files_of_other_keys_are_not_opened(spark, place):
    dest, _ = place(SPEC)
    for i in range(5):
        dest.load(spark.range(1000 * i, 1000 * i + 1000).select("id", F.lit("a").alias("v")), f"r{i}")
    every = len(dest.keys().inputFiles())
    assert every == 20
    above = dest.keys(after=F.col("high") > 3999)
    assert len(above.inputFiles()) == 4 and above.agg(F.min("id")).first()[0] >= 4000
    assert dest.keys(after=F.col("high") > 5000).count() == 0
    one = dest.keys(matching=spark.createDataFrame([(2500,), (99_999,)], "id long"))
    assert len(one.inputFiles()) == 1 and not one.where("id = 2500").isEmpty()
    # Bounds alone would let these through: even keys are there, odd ones in the same range are not.
    other = DestTable(spark, dest.path + "-even", SPEC)
    other.load(spark.range(0, 2000, 2).select("id", F.lit("a").alias("v")))
    held = other.keys(matching=spark.range(1, 60, 2)).inputFiles()
    assert len(held) < 4 and len(other.keys(matching=spark.range(0, 60, 2)).inputFiles()) == 4


def test_skipping_never_loses_a_key(spark, place):
    """Composite and text keys, a collation, values that are no keys, and deleted rows."""
    spec = DestSpec(T.StructType().add("a", "string").add("b", "integer"), ("a", "b"), buckets=3, filter_chunks=3, key_collation="UTF8_LCASE")
    dest, _ = place(spec)
    df = spark.range(500).select(F.concat(F.lit("K"), F.col("id") % 50).alias("a"), (F.col("id") / 50).cast("int").alias("b"))
    dest.load(df)
    asked = df.where("b < 3").select(F.lower("a").alias("a"), F.col("b").cast("string").alias("b")).unionByName(
        spark.createDataFrame([("k1", "x"), (None, "1")], "a string, b string"))
    found = dest.keys(matching=asked)
    assert found.where("b < 3").count() == 150
    dest.delete(df.where("b = 0"), "d")
    assert dest.keys(matching=asked).where("b < 3").count() == 100


# -- writers at once -----------------------------------------------------------


def test_two_writers_lose_and_double_nothing(spark, place):
    dest, _ = place(SPEC)
    dest.load(frame(spark, [0]), "r0")
    other = DestTable(spark, dest.path, SPEC)
    first, base_1 = prepared(dest, frame(spark, [*range(0, 60), None], "first"))
    second, base_2 = prepared(other, frame(spark, [0, *range(40, 100)], "second"))
    a, b = dest.commit(first, "w1", base_1), other.commit(second, "w2", base_2)
    assert (a.version, b.version) == (2, 3)
    assert rows(dest) == sorted([(0, "a"), *[(i, "first") for i in range(1, 60)], *[(i, "second") for i in range(60, 100)]])
    assert (a.accepted, a.rejected, b.accepted, b.rejected) == (59, 2, 40, 21) and dest.snapshot().rows == 100
    reasons = {(r.run_id, r.reason): r.n for r in dest.rejects().groupBy("run_id", "reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {("w1", "null_key"): 1, ("w1", "duplicate_key"): 1, ("w2", "duplicate_key"): 21}
    outcome = {r["_reason"]: r["n"] for r in other.run_rows(b).groupBy("_reason").agg(F.count("*").alias("n")).collect()}
    assert outcome == {None: 40, "duplicate_key": 21}
    dest.compact("c")
    assert len(rows(dest)) == 100 and dest.snapshot().rows == 100


def test_a_number_is_given_once(spark, place):
    dest, _ = place(SPEC)
    assert dest.log.claim(Snapshot(1, run_id="a")) and not dest.log.claim(Snapshot(1, run_id="b"))
    assert dest.has_run("a") and not dest.has_run("b")


def test_a_writer_that_keeps_losing_tries_again(spark, place, monkeypatch):
    """Others commit between the check and the claim, twice; rows that meet theirs are masked once."""
    dest, _ = place(SPEC)
    other = DestTable(spark, dest.path, SPEC)
    seq, base = prepared(dest, frame(spark, range(10), "mine"))
    claim, rivals = dest.log.claim, iter([[1, 50], [2, 51]])

    def late(snapshot):
        taken = next(rivals, None)
        if taken:
            other.load(frame(spark, taken, "theirs"), f"t{taken[0]}")
        return claim(snapshot)

    monkeypatch.setattr(dest.log, "claim", late)
    done = dest.commit(seq, "w", base)
    assert done.version == 3 and (done.accepted, done.rejected) == (8, 2)
    assert rows(dest) == sorted([(i, "theirs" if i in (1, 2) else "mine") for i in range(10)] + [(50, "theirs"), (51, "theirs")])


def test_deletes_meet_inserts_of_others(spark, place, monkeypatch):
    """A delete that loses looks again, so it also removes what was inserted meanwhile."""
    dest, _ = place(SPEC)
    dest.load(frame(spark, [1, 2, 3]), "r")
    other = DestTable(spark, dest.path, SPEC)
    claim, rivals = dest.log.claim, iter([[4, 5]])

    def late(snapshot):
        taken = next(rivals, None)
        if taken:
            other.load(frame(spark, taken), "t")
        return claim(snapshot)

    monkeypatch.setattr(dest.log, "claim", late)
    assert dest.delete(frame(spark, [1, 4, 9]), "d") == 2 and rows(dest) == [(2, "a"), (3, "a"), (5, "a")]


def test_conflicts_that_no_order_explains(spark, place):
    dest, _ = place(SPEC)
    dest.load(frame(spark, [1, 2]), "r")
    seq, base = prepared(dest, frame(spark, [1, 7], "new"))
    dest.delete(frame(spark, [1]), "d")
    with pytest.raises(ConflictError):
        dest.commit(seq, "w", base)
    assert rows(dest) == [(2, "a")] and not dest.has_run("w")
    seq, base = prepared(dest, frame(spark, [8]))
    dest.truncate("t")
    with pytest.raises(ConflictError):
        dest.commit(seq, "w2", base)
    # Deletes elsewhere are no conflict.
    dest.load(frame(spark, [1, 2]), "r2")
    seq, base = prepared(dest, frame(spark, [5]))
    dest.delete(frame(spark, [2]), "d2")
    dest.commit(seq, "w3", base)
    assert rows(dest) == [(1, "a"), (5, "a")]


def test_compaction_meets_writers(spark, place, monkeypatch):
    """Rows inserted meanwhile stay; a delete meanwhile makes it start again."""
    dest, _ = place(SPEC)
    dest.load(frame(spark, range(20)), "r")
    other = DestTable(spark, dest.path, SPEC)
    write, rivals = dest.write, iter([lambda: other.load(frame(spark, [50]), "t"), None])

    def slow(classified):
        seq = write(classified)
        rival = next(rivals, None)
        if rival:
            rival()
        return seq

    monkeypatch.setattr(dest, "write", slow)
    dest.compact("c")
    assert len(dest.snapshot().live) == 2 and len(rows(dest)) == 21
    rivals = iter([lambda: other.delete(frame(spark, [3]), "d")])
    dest.compact("c2")
    assert len(dest.snapshot().live) == 1 and not dest.snapshot().marks and len(rows(dest)) == 20 and not [r for r in rows(dest) if r[0] == 3]
