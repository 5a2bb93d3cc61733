import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.classify import classify
from rowferry.spec import DestSpec, JobSpec

SPEC = DestSpec(T.StructType().add("id", "long").add("v", "string"), "id", buckets=4)


def rows(dest):
    return sorted(tuple(r) for r in dest.read().collect())


def frame(spark, ids, v="a"):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v string")


def test_insert_reads_back(spark, place):
    dest, _ = place(SPEC)
    assert dest.is_empty() and rows(dest) == [] and dest.rejects().count() == 0
    dest.insert(classify(frame(spark, [1, 1, 2, None]), SPEC), "r1")
    assert rows(dest) == [(1, "a"), (2, "a")]
    assert {(r.run_id, r.reason, r.row) for r in dest.rejects().collect()} == {
        ("r1", "duplicate_key", '{"id":1,"v":"a"}'), ("r1", "null_key", '{"v":"a"}'),
    }
    assert dest.has_run("r1") and not dest.has_run("r2")


def test_uncommitted_files_are_invisible(spark, place):
    dest, _ = place(SPEC)
    dest.load(frame(spark, [1]))
    dest.write(classify(frame(spark, [2]), SPEC))
    assert rows(dest) == [(1, "a")]
    dest.insert(classify(frame(spark, [2, 3]), SPEC, dest.keys()), "r2")
    assert rows(dest) == [(1, "a"), (2, "a"), (3, "a")]


def test_delete_empties_buckets(spark, place):
    dest, _ = place(SPEC)
    dest.load(frame(spark, range(40)))
    assert dest.delete(frame(spark, range(40)), "d") == 40
    assert dest.is_empty()
    dest.load(frame(spark, [1], "again"), "r2")
    assert rows(dest) == [(1, "again")]


def test_delete_one_bucket_only(spark, place, tmp_path):
    dest, _ = place(SPEC)
    dest.load(frame(spark, range(40)))
    assert dest.delete(frame(spark, [7, 7, 99]), "d") == 1
    assert rows(dest) == [(i, "a") for i in range(40) if i != 7]
    assert len(list((tmp_path / "t" / "dest" / "deletes").glob("seq=*/bucket=*"))) == 1
    assert dest.delete(frame(spark, [99]), "d2") == 0 and not dest.has_run("d2")
    # A key deleted before may come back.
    dest.insert(classify(frame(spark, [7, 8], "b"), SPEC, dest.keys()), "r")
    assert (7, "b") in rows(dest) and (8, "a") in rows(dest)


def test_compact_and_truncate(spark, place):
    dest, _ = place(SPEC)
    for i in range(3):
        dest.insert(classify(frame(spark, [i, None]), SPEC), f"r{i}")
    dest.delete(frame(spark, [1]), "d")
    before = rows(dest)
    dest.compact("c")
    assert rows(dest) == before == [(0, "a"), (2, "a")]
    assert dest.read().select(F.input_file_name()).distinct().count() <= SPEC.buckets
    assert "seq" not in dest.read().columns and dest.rejects().count() == 3
    assert dest.commits().count() == 5 and len(dest.commits().inputFiles()) == 1
    dest.truncate("t")
    assert dest.is_empty() and dest.rejects().count() == 3


def test_vacuum(spark, place):
    dest, _ = place(SPEC)
    assert dest.vacuum() == 0
    dest.insert(classify(frame(spark, [*range(40), None]), SPEC), "r")
    dest.delete(frame(spark, [7]), "d")
    dest.write(classify(frame(spark, [99]), SPEC))
    before = rows(dest)
    assert dest.vacuum() == 1  # the run never committed
    dest.compact("c")
    assert dest.vacuum() == 1 + len({r[0] for r in dest.read().select(F.pmod(F.xxhash64("id"), F.lit(4))).collect()})
    assert rows(dest) == before and dest.rejects().count() == 1
    assert dest.vacuum() == 0


def test_delete_writes_keys_only(spark, place, tmp_path):
    """What a delete writes follows its keys, not the table; older rows go, later ones with the key stay."""
    dest, _ = place(SPEC)
    wide = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v"))
    dest.load(wide)
    table = sum(f.stat().st_size for f in (tmp_path / "t" / "dest" / "rows").rglob("*.parquet"))
    assert dest.delete(spark.range(0, 20_000, 2_000), "d") == 10
    written = sum(f.stat().st_size for f in (tmp_path / "t" / "dest" / "deletes").rglob("*.parquet"))
    assert written * 100 < table and dest.read().count() == 19_990
    dest.load(frame(spark, [2_000], "back"), "r")
    assert dest.delete(spark.range(4_000, 4_001), "d2") == 0
    assert dest.read().where("id = 2000").first().v == "back"
    dest.compact("c")
    assert dest.read().count() == 19_991 and dest.delete(spark.range(2_000, 2_001), "d3") == 1


def test_only_live_directories_are_read(spark, place):
    dest, _ = place(SPEC)
    dest.load(frame(spark, range(40)))
    dest.delete(frame(spark, [7]), "d")
    plan = dest.read()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_collated_delete(spark, place):
    spec = DestSpec(T.StructType().add("id", "string").add("v", "integer"), "id", buckets=4, key_collation="UTF8_LCASE_RTRIM")
    dest, _ = place(spec)
    dest.load(spark.createDataFrame([("Ab", 1), ("c", 2)], "id string, v int"))
    assert dest.delete(spark.createDataFrame([("aB ",)], "id string"), "d") == 1
    assert [r.id for r in dest.read().collect()] == ["c"]


def test_string_and_composite_keys(spark, place):
    spec = DestSpec(T.StructType().add("a", "string").add("b", "integer"), ("a", "b"), buckets=3)
    dest, _ = place(spec)
    df = spark.createDataFrame([("10", 1), ("9", 1), ("9", 2)], "a string, b int")
    dest.insert(classify(df, spec), "r")
    assert dest.delete(df.where("a = '9' and b = 1"), "d") == 1
    assert sorted(tuple(r) for r in dest.read().collect()) == [("10", 1), ("9", 2)]


def test_specs_are_checked():
    with pytest.raises(ValueError):
        DestSpec(T.StructType().add("a", "string"), "id")
    with pytest.raises(ValueError):
        JobSpec("j", "s", "d", batch_size=-1)
    with pytest.raises(ValueError):
        JobSpec("j", "s", "d", deletes="some")
    job = JobSpec("j", "s", "d", "", query="", batch_size=0)
    assert (job.primary_key, job.query, job.batch_size) == (("id",), "SELECT * FROM {{table}}", 1000)
