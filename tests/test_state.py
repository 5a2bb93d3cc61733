import pytest

from rowferry.plans import state as S
from rowferry.spec import JobSpec

JOB = JobSpec("j", "src_t", "dst_t", "id")
OTHER = JobSpec("k", "src_t", "dst_t", "id")


def put_mark(store, job, seq, value, kind="bigint"):
    store.put("watermarks", seq, job=job.name, source_table=job.source_table, dest_table=job.dest_table,
              pk="id", value=value, value_type=kind)


def put_point(store, job, seq, status, last="5"):
    store.put("checkpoints", seq, job=job.name, source_table=job.source_table, dest_table=job.dest_table, mode="full",
              last_pk=last, pk_type="bigint", batch_no=seq, rows_processed=0, rows_inserted=0, status=status)


@pytest.fixture
def store(spark, tmp_path):
    return S.StateStore(spark, str(tmp_path))


def test_watermark_last_write_wins(store):
    assert store.watermark(JOB, "id") is None
    put_mark(store, JOB, 1, "10")
    put_mark(store, JOB, 2, "9")
    put_mark(store, OTHER, 3, "77")
    assert store.watermark(JOB, "id") == ("9", "bigint")
    assert store.watermark(JOB, "other") is None


def test_checkpoint_states(store):
    put_point(store, JOB, 1, S.IN_PROGRESS)
    assert store.checkpoint(JOB)["last_pk"] == "5"
    put_point(store, JOB, 2, S.COMPLETED)
    assert store.checkpoint(JOB) is None
    put_point(store, JOB, 3, S.IN_PROGRESS, "8")
    assert store.checkpoint(JOB)["last_pk"] == "8"


def test_clear_keeps_log_history_and_other_jobs(store, spark):
    for job in (JOB, OTHER):
        put_mark(store, job, 1, "10")
        put_point(store, job, 1, S.IN_PROGRESS)
    store.put("deletes", 1, job="j", source_table="src_t", dest_table="dst_t", record_id="1", processed=1)
    store.put("runs", 1, job="j", run_id="r", mode="full", status="completed")
    store.clear(JOB, 9)
    assert store.watermark(JOB, "id") is None and store.checkpoint(JOB) is None
    assert store.watermark(OTHER, "id") is not None and store.checkpoint(OTHER) is not None
    assert store.delete_log(JOB).count() == 1 and store.history("runs").count() == 1
    put_mark(store, JOB, 10, "11")
    assert store.watermark(JOB, "id") == ("11", "bigint")


def test_clear_one_mode(store):
    put_mark(store, JOB, 1, "10")
    put_point(store, JOB, 1, S.IN_PROGRESS)
    store.clear(JOB, 2, "full")
    assert store.checkpoint(JOB) is None and store.watermark(JOB, "id") is not None


def test_advance(spark):
    df = spark.createDataFrame([(9,), (10,), (None,)], "id long")
    assert S.watermark_advance(df, "id").first()[0] == "10"
    assert S.watermark_advance(df.where("id > 99"), "id").first()[0] is None


def test_delete_log(spark):
    log = spark.createDataFrame([("1", 1), ("2", 0)], "record_id string, processed int")
    ids = spark.createDataFrame([("1",), ("2",), ("3",), ("3",)], "record_id string")
    merged = S.delete_log_merge(log, ids)
    assert {tuple(r) for r in merged.collect()} == {("1", 1), ("2", 0), ("3", 0)}
    assert {r[0] for r in S.delete_log_pending(merged).collect()} == {"2", "3"}
    marked = S.delete_log_mark(merged, ids.where("record_id > '2'"))
    assert {tuple(r) for r in marked.collect()} == {("1", 1), ("2", 0), ("3", 1)}


def test_latest_keeps_a_row_together(spark):
    """The columns of the newest write, NULLs included."""
    h = spark.createDataFrame([("a", "x", "y", 1), ("a", None, "z", 2)], "k string, u string, v string, seq long")
    assert [tuple(r) for r in S.latest(h, ["k"]).collect()] == [("a", None, "z", 2)]


def test_clear_scopes(spark):
    rows = [("a", "s1", "d1", "full"), ("a", "s1", "d1", "delta"), ("b", "s2", "d1", "full")]
    df = spark.createDataFrame(rows, "job string, source_table string, dest_table string, mode string")
    for within, n in ((S.scope("s1", "d1", "full"), 1), (S.scope("s1", "d1"), 2), (S.scope(), 3)):
        kept, cleared = S.state_clear(df, within)
        assert (kept.count(), cleared.first()[0]) == (3 - n, n)


def test_run_summary(spark):
    runs = spark.createDataFrame(
        [("full", 5, "completed", 1.0), ("full", 7, "failed", 0.5), ("delta", None, "failed", 0.1)],
        "mode string, rows_processed long, status string, seconds double")
    got = {(r.mode, r.n_runs, r.rows_processed, r.n_failed) for r in S.run_summary(runs).collect()}
    assert got == {("full", 2, 12, 1), ("delta", 1, 0, 1)}


def test_compact(store, spark):
    for seq in range(1, 6):
        put_mark(store, JOB, seq, str(seq))
        put_mark(store, OTHER, seq, "x")
    store.compact("watermarks")
    assert store.watermark(JOB, "id") == ("5", "bigint") and store.history("watermarks").count() == 2
    put_mark(store, JOB, 6, "6")
    store.compact("watermarks")
    assert store.watermark(JOB, "id") == ("6", "bigint") and store.watermark(OTHER, "id")[0] == "x"
