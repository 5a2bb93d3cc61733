from pyspark.sql import functions as F

from rowferry.operators import paging
from rowferry.operators.loads import batch_metrics, load_progress


def test_numbers_follow_the_key(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v"))
    rows = paging.number_rows(df, "k").collect()
    assert sorted(r.row_no for r in rows) == list(range(1, 5001))
    assert all(r.row_no == r.k + 1 for r in rows)


def test_copies_of_one_key_are_split(spark):
    """A third of the rows are equal; every row still gets its own number."""
    df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    numbered = paging.number_rows(df, "k")
    assert numbered.select("row_no").distinct().count() == 60_000
    ends = numbered.where("k = 5").agg(F.min("row_no"), F.max("row_no"), F.count("*")).first()
    assert ends[1] - ends[0] + 1 == ends[2] == 20_000 + 1


def test_copies_land_in_several_partitions(spark):
    df = spark.range(0, 60_000, 1, 8).select(F.lit(1).alias("k"), F.spark_partition_id().alias("_task"))
    parts = df.repartitionByRange(8, F.col("k").asc(), F.col("_task").asc()).groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in parts.collect()) < 30_000


def test_manifest(spark):
    df = spark.createDataFrame([(k,) for k in [5, 3, 9, 1, 7, 7, 7]], "k int")
    rows = {tuple(r) for r in paging.batch_manifest(df, "k", 3).collect()}
    assert rows == {(1, 1, 5, 3), (2, 7, 7, 3), (3, 9, 9, 1)}
    assert paging.batch_manifest(df.where("k > 9"), "k", 3).count() == 0
    assert {r.batch_no for r in paging.batch_manifest(df, "k", 3, done=10).collect()} == {11, 12, 13}


def test_manifest_loses_no_tie(spark):
    """Naive keyset paging over a repeated key skips ties cut by a page end."""
    line = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    n = paging.batch_manifest(line, "l_orderkey", 1000).agg(F.sum("n_rows")).first()[0]
    assert n == line.count()


def test_pages(spark):
    df = spark.createDataFrame([(None,), (3,), (1,), (2,)], "k int")
    assert [r.k for r in paging.keyset_page(df, "k", None, 2).collect()] == [None, 1]
    assert [r.k for r in paging.keyset_page(df, "k", [1], 2).collect()] == [2, 3]


def test_deep_offset_equals_shallow(spark, monkeypatch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "user_id", "event_id")
    shallow = paging.offset_page(events, 400, 50, numbered=False).collect()
    assert sorted(paging.offset_page(events, 400, 50).collect()) == sorted(shallow)


def test_page_is_a_top_n(spark):
    page = paging.keyset_page(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "o_orderkey", [7], 5)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThan(o_orderkey,7)" in plan


def test_key_cuts(spark):
    df = spark.range(1000)
    assert len(paging.key_cuts(df, "id", 4)) == 3
    assert paging.key_cuts(df, "id", 1) == []
    text = df.select(F.col("id").cast("string").alias("id"))
    cuts = paging.key_cuts(text, "id", 4)
    assert len(cuts) == 3 and all(isinstance(c, str) for c in cuts) and cuts == sorted(cuts)
    assert paging.key_cuts(df.where("id < 0"), "id", 4) == []


def test_metrics_and_progress(spark):
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(1, 8)], "k int, ok boolean")
    metrics = batch_metrics(df, "k", "ok", 3)
    got = {tuple(r) for r in load_progress(metrics, 7).collect()}
    assert got == {(1, 3, 1, 2, 3, 3, 42.86), (2, 3, 2, 1, 6, 6, 85.71), (3, 1, 0, 1, 7, 7, 100.0)}
    assert [r.pct for r in load_progress(metrics.limit(1), 0).collect()] == [None]
