import pytest
from pyspark.sql import types as T

from rowferry.spec import DestSpec, JobSpec
from rowferry.streaming.stream import delete_batch, insert_batch, stream_inserts

SPEC = DestSpec(T.StructType().add("id", "long").add("v", "string"), "id", buckets=4)
JOB = JobSpec("s", "src", "dst", "id")


def frame(spark, *ids):
    return spark.createDataFrame([(i, "a") for i in ids], "id long, v string")


def ids(dest):
    return sorted(r.id for r in dest.read().collect())


def test_files_arrive_one_by_one(spark, place, tmp_path):
    dest, store = place(SPEC)
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for part in [(1, 2, 2), (3, None), ()]:
        frame(spark, *part).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(SPEC.schema).parquet(inbox)
        stream_inserts(stream, JOB, dest, store, checkpoint).awaitTermination()
    assert ids(dest) == [1, 2, 3]
    assert sorted(r.reason for r in dest.rejects().collect()) == ["duplicate_key", "null_key"]
    assert store.watermark(JOB, "id") == ("3", "bigint")


def test_repeated_batch_has_no_second_effect(spark, place):
    dest, store = place(SPEC)
    run = insert_batch(JOB, dest, store, "drop")
    for _ in range(2):
        run(frame(spark, 1, 2), 0)
    assert ids(dest) == [1, 2] and dest.commits().count() == 1 and dest.rejects().count() == 0


@pytest.mark.parametrize("late, expected", [("drop", [5, 6]), ("fill", [3, 5, 6])])
def test_late_keys(spark, place, late, expected):
    dest, store = place(SPEC)
    run = insert_batch(JOB, dest, store, late)
    run(frame(spark, 5), 0)
    run(frame(spark, 3, 6), 1)
    assert ids(dest) == expected
    run(frame(spark, 4), 2)
    assert store.watermark(JOB, "id") == ("6", "bigint")


def test_deletes(spark, place):
    dest, store = place(SPEC)
    dest.load(frame(spark, 1, 2, 3))
    run = delete_batch(JOB, dest, store)
    batch = spark.createDataFrame([(1, 1), (2, 0), (3, None), (9, 1)], "id long, is_deleted int")
    for _ in range(2):
        run(batch, 0)
    assert ids(dest) == [2, 3]
    assert {(r.record_id, r.processed) for r in store.delete_log(JOB).collect()} == {("1", 1), ("9", 1)}


def test_unknown_late_rule(spark, place):
    with pytest.raises(ValueError):
        insert_batch(JOB, *place(SPEC), "keep")
