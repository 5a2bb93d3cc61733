import dataclasses

import pytest
from pyspark.sql import types as T

from rowferry.plans import state as S
from rowferry.plans.sync import RunResult, full_load, sync
from rowferry.sources.table import DestTable
from rowferry.spec import DestSpec, JobSpec

SPEC = DestSpec(T.StructType().add("id", "long").add("v", "string"), "id", buckets=4)
JOB = JobSpec("j", "sync_src", "d", "id", query="SELECT id, v FROM {{table}}", source_keys=("id",))


def source(spark, rows, ddl="id long, v string"):
    spark.createDataFrame(rows, ddl).createOrReplaceTempView("sync_src")


def ids(dest):
    return sorted(r.id for r in dest.read().collect())


def run(spark, job, dest, store, mode=None, **kw):
    result = sync(spark, job, dest, store, **kw)
    assert result.status == "completed", result.error
    assert mode is None or result.mode == mode
    return result


def test_full_then_incremental_then_nothing(spark, place):
    dest, store = place(SPEC)
    source(spark, [(1, "a"), (2, "b"), (2, "c"), (None, "d")])
    r = run(spark, JOB, dest, store, "full")
    assert (r.rows_processed, r.rows_inserted, r.rows_rejected) == (4, 2, 2)
    # A full load does not seed the watermark: the next run scans all and fills holes.
    assert store.watermark(JOB, "id") is None
    source(spark, [(0, "late"), (1, "changed"), (2, "b"), (5, "new")])
    r = run(spark, JOB, dest, store, "incremental")
    assert (r.rows_processed, r.rows_inserted) == (4, 2) and ids(dest) == [0, 1, 2, 5]
    assert store.watermark(JOB, "id") == ("5", "bigint")
    # Updates and late low keys are not seen any more.
    source(spark, [(1, "changed"), (3, "late"), (5, "new")])
    r = run(spark, JOB, dest, store, "incremental")
    assert r.rows_processed == 0 and ids(dest) == [0, 1, 2, 5]
    assert store.watermark(JOB, "id") == ("5", "bigint")
    assert [x.v for x in dest.read().where("id = 1").collect()] == ["a"]


def test_watermark_passes_rejected_rows(spark, place):
    dest, store = place(SPEC)
    dest.load(spark.createDataFrame([(9, "x")], "id long, v string"))
    source(spark, [(9, "y")])
    r = run(spark, JOB, dest, store, "incremental")
    assert (r.rows_processed, r.rows_inserted, r.status) == (1, 0, "completed")
    assert store.watermark(JOB, "id") == ("9", "bigint")


def test_seeded_watermark(spark, place):
    dest, store = place(SPEC)
    source(spark, [(1, "a"), (7, "b")])
    run(spark, dataclasses.replace(JOB, seed_watermark=True), dest, store, "full")
    assert store.watermark(JOB, "id") == ("7", "bigint")


FLAGGED = "id long, v string, is_deleted int"


def test_delta_is_sticky(spark, place):
    dest, store = place(SPEC)
    dest.load(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string"))
    source(spark, [(1, "a", 0), (2, "b", 1), (3, "c", None), (4, "d", 0), (5, "e", 1)], FLAGGED)
    r = run(spark, JOB, dest, store, "delta")
    assert (r.rows_attempted, r.rows_removed) == (2, 1) and ids(dest) == [1, 3]
    assert r.reason == "Found 2 deleted records in source"
    log = {(x.record_id, x.processed) for x in store.delete_log(JOB).collect()}
    assert log == {("2", 1), ("5", 1)}
    r = run(spark, JOB, dest, store, "delta")
    assert (r.rows_attempted, r.rows_removed) == (2, 0)
    assert store.history("deletes").count() == 4


def test_pending_deletes_let_inserts_through(spark, place):
    dest, store = place(SPEC)
    job = dataclasses.replace(JOB, deletes="pending")
    dest.load(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    source(spark, [(1, "a", 0), (2, "b", 1), (4, "d", 0)], FLAGGED)
    run(spark, job, dest, store, "delta")
    run(spark, job, dest, store, "incremental")
    # The incremental load copies flagged rows too.
    assert ids(dest) == [1, 2, 4]


def test_combined_run(spark, place):
    dest, store = place(SPEC)
    job = dataclasses.replace(JOB, combined=True)
    dest.load(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    store.put("watermarks", 1, job="j", source_table="sync_src", dest_table="d", pk="id", value="2", value_type="bigint")
    source(spark, [(1, "a", 0), (2, "b", 1), (4, "d", 0), (5, "e", 1)], FLAGGED)
    r = run(spark, job, dest, store, "delta")
    assert ids(dest) == [1, 4] and (r.rows_removed, r.rows_inserted, r.rows_rejected) == (1, 1, 1)
    assert [x.reason for x in dest.rejects().collect()] == ["deleted"]


def test_no_declared_key_means_full(spark, place):
    dest, store = place(SPEC)
    dest.load(spark.createDataFrame([(1, "a")], "id long, v string"))
    source(spark, [(1, "a"), (2, "b")])
    r = run(spark, dataclasses.replace(JOB, source_keys=()), dest, store, "full")
    assert (r.rows_processed, r.rows_inserted) == (2, 1) and ids(dest) == [1, 2]


@pytest.mark.parametrize("rows", [[(i, "v") for i in range(100)], [(i % 10, "v") for i in range(100)], [(None, "v")] * 5])
def test_full_load_in_ranges(spark, place, rows):
    source(spark, rows)
    dest, store = place(SPEC)
    job = dataclasses.replace(JOB, batch_size=10, batch_history=True)
    result = RunResult("a", "full")
    full_load(spark, job, dest, store, result, ranges=4)
    assert ids(dest) == sorted({k for k, _ in rows if k is not None})
    assert result.rows_processed == len(rows)
    batches = store.history("batches").orderBy("batch_no", "seq").collect()
    assert sum(b.rows_processed for b in batches) == len(rows)
    assert [b.batch_no for b in batches] == list(range(1, len(batches) + 1))
    assert batches[-1].rows_done == len(rows) and batches[-1].pct == 100.0


def test_resume(spark, place):
    source(spark, [(i, "v") for i in range(100)] + [(None, "n")])
    dest, store = place(SPEC)
    first = RunResult("a", "full")
    full_load(spark, dataclasses.replace(JOB, split_hot_keys=False), dest, store, first, ranges=4, stop_after=2)
    point = store.checkpoint(JOB)
    assert point["rows_processed"] == first.rows_processed and 0 < dest.read().count() < 100
    again = RunResult("b", "full")
    full_load(spark, JOB, dest, store, again, ranges=4)
    assert ids(dest) == list(range(100)) and store.checkpoint(JOB) is None
    # Counters carry on and no row is read twice.
    assert again.rows_processed == 101 and again.rows_inserted == 100 and dest.rejects().count() == 1


def test_crash_between_data_and_state(spark, place, monkeypatch):
    """Data committed, state not: the repetition changes nothing."""
    dest, store = place(SPEC)
    dest.load(spark.createDataFrame([(1, "a")], "id long, v string"))
    source(spark, [(1, "a"), (2, "b"), (3, "c")])

    def die(self, table, seq, **values):
        if table != "runs":
            raise OSError("gone")
        real(self, table, seq, **values)

    real = S.StateStore.put
    monkeypatch.setattr(S.StateStore, "put", die)
    assert sync(spark, JOB, dest, store).status == "failed"
    monkeypatch.undo()
    assert ids(dest) == [1, 2, 3] and store.watermark(JOB, "id") is None
    r = run(spark, JOB, dest, store, "incremental")
    assert r.rows_inserted == 0 and ids(dest) == [1, 2, 3] and store.watermark(JOB, "id") == ("3", "bigint")


def test_crash_before_commit(spark, place, monkeypatch):
    dest, store = place(SPEC)
    source(spark, [(1, "a")])

    def die(*a, **k):
        raise OSError("gone")

    monkeypatch.setattr(DestTable, "commit", die)
    assert sync(spark, JOB, dest, store).status == "failed"
    monkeypatch.undo()
    assert dest.is_empty()
    run(spark, JOB, dest, store, "full")
    assert ids(dest) == [1]


def test_crash_inside_a_delta(spark, place, monkeypatch):
    dest, store = place(SPEC)
    dest.load(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    source(spark, [(2, "b", 1)], FLAGGED)
    real = DestTable.delete

    def die(*a, **k):
        raise OSError("gone")

    monkeypatch.setattr(DestTable, "delete", die)
    assert sync(spark, JOB, dest, store).status == "failed"
    monkeypatch.setattr(DestTable, "delete", real)
    assert [r.processed for r in store.delete_log(JOB).collect()] == [0]
    run(spark, JOB, dest, store, "delta")
    assert ids(dest) == [1] and [r.processed for r in store.delete_log(JOB).collect()] == [1]


def test_failures_are_recorded(spark, place):
    dest, store = place(SPEC)
    source(spark, [(1, "a")])
    bad = {
        "missing": dataclasses.replace(JOB, source_table="nowhere"),
        "syntax": dataclasses.replace(JOB, query="SELEC id FROM {{table}}"),
        "column": dataclasses.replace(JOB, query="SELECT id, v, 1 AS more FROM {{table}}"),
        "key": dataclasses.replace(JOB, primary_key=("v",)),
    }
    errors = {k: sync(spark, j, dest, store).error for k, j in bad.items()}
    assert "does not exist" in errors["missing"]
    assert "syntax error" in errors["syntax"]
    assert "'more' exists in source but not in destination" in errors["column"]
    assert "'v' is not a PRIMARY KEY" in errors["key"]
    assert sync(spark, JOB, dest, store, force_mode="merge").error.startswith("Invalid mode: merge")
    assert {r["mode"] for r in store.history("runs").collect()} == {"unknown"}
    assert store.history("runs").where("status = 'failed'").count() == 5
    auto = DestSpec(SPEC.schema, "id", identity=("id",))
    assert "AUTO_INCREMENT" in sync(spark, JOB, *place(auto, "auto")).error


def test_forced_and_refreshed(spark, place):
    dest, store = place(SPEC)
    source(spark, [(1, "a"), (3, "c")])
    run(spark, JOB, dest, store, "incremental", force_mode="incremental")
    assert store.watermark(JOB, "id") == ("3", "bigint")
    source(spark, [(1, "a"), (2, "b"), (3, "c")])
    assert run(spark, JOB, dest, store, "incremental").rows_processed == 0
    # A refresh clears the state but neither truncates nor forces a full load.
    r = run(spark, dataclasses.replace(JOB, force_full_refresh=True), dest, store, "incremental")
    assert (r.rows_processed, r.rows_inserted) == (3, 1) and ids(dest) == [1, 2, 3]
    r = run(spark, dataclasses.replace(JOB, truncate=True), dest, store, "full")
    assert r.rows_inserted == 3 and ids(dest) == [1, 2, 3]


def test_stale_checkpoint_of_an_empty_destination(spark, place):
    dest, store = place(SPEC)
    store.put("checkpoints", 1, job="j", source_table="sync_src", dest_table="d", mode="full", last_pk="50",
              pk_type="bigint", batch_no=1, rows_processed=5, rows_inserted=5, status=S.IN_PROGRESS)
    source(spark, [(1, "a"), (60, "b")])
    run(spark, JOB, dest, store, "full")
    assert ids(dest) == [1, 60]


def test_jobs_share_no_state(spark, place):
    dest, store = place(SPEC)
    other, _ = place(SPEC, "other")
    source(spark, [(1, "a")])
    run(spark, JOB, dest, store, force_mode="incremental")
    r = run(spark, dataclasses.replace(JOB, name="k"), other, store, force_mode="incremental")
    assert r.rows_inserted == 1


def test_string_and_time_keys(spark, place):
    spec = DestSpec(T.StructType().add("id", "string").add("v", "string"), "id", buckets=2)
    dest, store = place(spec)
    source(spark, [("9", "a"), ("10", "b")], "id string, v string")
    run(spark, JOB, dest, store, force_mode="incremental")
    assert store.watermark(JOB, "id") == ("9", "string")
    stamps = DestSpec(T.StructType().add("id", T.TimestampNTZType()).add("v", "string"), "id", buckets=2)
    dest, store = place(stamps, "stamps")
    for k in ("2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002"):
        spark.sql(f"SELECT timestamp_ntz'{k}' AS id, 'x' AS v").createOrReplaceTempView("sync_src")
        r = run(spark, JOB, dest, store, force_mode="incremental")
        assert r.rows_inserted == 1
    assert dest.read().count() == 2


def test_large_integers(spark, place):
    dest, store = place(SPEC)
    source(spark, [(2**53, "a")])
    run(spark, JOB, dest, store, force_mode="incremental")
    source(spark, [(2**53, "a"), (2**53 + 1, "b")])
    assert run(spark, JOB, dest, store, "incremental").rows_inserted == 1


def test_schema_warnings_do_not_stop_a_run(spark, place):
    from rowferry.plans.sync import job_schema_report

    spec = DestSpec(T.StructType().add("id", "long").add("v", "integer", False).add("w", "string"), "id")
    dest, store = place(spec)
    source(spark, [(1, "7")])
    run(spark, JOB, dest, store, "full")
    assert [tuple(r) for r in dest.read().collect()] == [(1, 7, None)]
    got = {(r.column_name, r.level, r.issue) for r in job_schema_report(spark.table("sync_src"), spec).collect()}
    assert got == {
        ("id", "warning", "nullable"), ("v", "warning", "type"), ("v", "warning", "nullable"),
        ("w", "warning", "extra_in_destination"),
    }


def test_source_key_differs_from_the_configured_one(spark, place):
    """The source's own key is paged by and stored; the destination's decides conflicts."""
    spec = DestSpec(T.StructType().add("id", "long").add("n", "integer"), "id", buckets=4)
    dest, store = place(spec)
    job = JobSpec("j", "sync_src", "d", "id", query="SELECT id, n FROM {{table}}", source_keys=("n", "m"))
    dest.load(spark.createDataFrame([(7, 1)], "id long, n int"))
    source(spark, [(7, 1), (3, 2), (1, 3)], "id long, n int")
    r = run(spark, job, dest, store, "incremental")
    assert r.reason == "Primary key column 'n' found" and (r.rows_processed, r.rows_inserted) == (3, 2)
    assert store.watermark(job, "n") == ("3", "int")
    source(spark, [(7, 1), (3, 2), (1, 3), (0, 4), (3, 5)], "id long, n int")
    r = run(spark, job, dest, store, "incremental")
    assert (r.rows_processed, r.rows_inserted) == (2, 1) and ids(dest) == [0, 1, 3, 7]
    source(spark, [(7, 1, 1), (9, 4, 1)], "id long, n int, is_deleted int")
    r = run(spark, job, dest, store, "delta")
    assert r.rows_removed == 2 and ids(dest) == [1, 3]
