"""Table differences, key sketches, rank index, collated order, names with dots."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators import diff, paging
from rowferry.operators.classify import classify
from rowferry.operators.diff import diff_tree, table_diff
from rowferry.operators.ranks import RankIndex
from rowferry.operators.sketches import key_sketch, merge_sketches, overlap, quantile_kind, sketch_cuts, sketch_profile
from rowferry.plans.state import watermark_advance
from rowferry.plans.sync import sync
from rowferry.spec import DestSpec, JobSpec


def outcome(df, *keys):
    return sorted((tuple(r[k] for k in keys) + (r["change"], r["source_n"], r["dest_n"]) for r in df.collect()), key=str)


# -- differences ---------------------------------------------------------------


def test_diff_against_full_comparison(spark):
    rng = random.Random(4)
    left = [(i, rng.choice("abc"), rng.choice([None, 1.5, 2.5])) for i in range(3000)]
    right = [r for r in left if rng.random() > 0.01] + [(i, "x", None) for i in range(5000, 5010)]
    right = [(i, "changed", v) if rng.random() < 0.01 else (i, s, v) for i, s, v in right] + [right[5]]
    a, b = (spark.createDataFrame(r, "id long, s string, v double").repartition(3) for r in (left, right))
    x, y = ({}, {})
    for side, rows in ((x, left), (y, right)):
        for r in rows:
            side.setdefault(r[0], []).append(r)
    want = sorted(((k, "missing" if k not in y else "extra" if k not in x else "changed", len(x.get(k, [])), len(y.get(k, [])))
                   for k in {*x, *y} if sorted(x.get(k, []), key=str) != sorted(y.get(k, []), key=str)), key=str)
    assert outcome(table_diff(a, b, "id"), "id") == want and len(want) > 50
    whole = diff_tree(a, b, "id", level=0).collect()
    assert [tuple(r) for r in whole] == [(0, 3000, len(right), True)]
    assert diff_tree(a, a, "id", level=2).where("differs").isEmpty()
    leaves = diff_tree(a, b, "id", level=diff.LEVELS).where("differs").count()
    assert leaves == len({r.leaf for r in spark.createDataFrame([(w[0],) for w in want], "id long").select(F.pmod(F.xxhash64("id"), F.lit(65536)).alias("leaf")).collect()})


def test_equal_leaves_are_not_shuffled(spark):
    """Rows of leaves that agree are dropped at the scan; only the others reach the comparison's exchange."""
    a = spark.range(20_000).select("id", F.lit("v").alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, F.lit("w")).otherwise(F.col("v")))
    out = table_diff(a, b, "id")
    assert outcome(out, "id") == [(77, "changed", 1, 1)]
    metrics = out._jdf.queryExecution().executedPlan()
    text = metrics.toString()
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    plan = metrics.finalPhysicalPlan() if hasattr(metrics, "finalPhysicalPlan") else metrics
    found = []

    def walk(node):
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if node.nodeName() in ("ShuffleQueryStage", "AdaptiveSparkPlan"):
            walk(node.plan() if node.nodeName() == "ShuffleQueryStage" else node.executedPlan())

    walk(plan)
    assert found and max(found) < 20


def test_diff_of_odd_values(spark):
    """NULL keys, NULLs that trade places, copies that would cancel out, other types, collated keys, empty sides."""
    kinds = "k string, a string, b string"
    a = spark.createDataFrame([(None, "x", None), ("K", None, "y"), ("c", "1", "1"), ("c", "1", "1")], kinds)
    b = spark.createDataFrame([(None, "x", None), ("k", "y", None), ("c", "1", "1")], kinds)
    assert outcome(table_diff(a, b, "k"), "k") == [("K", "missing", 1, 0), ("c", "changed", 2, 1), ("k", "extra", 0, 1)]
    assert outcome(table_diff(a, b, "k", collation="UTF8_LCASE"), "k") == [("K", "changed", 1, 1), ("c", "changed", 2, 1)]
    text = spark.createDataFrame([("1", "2"), ("3", "x")], "id string, v string")
    typed = spark.createDataFrame([(1, 2), (3, None)], "id int, v long")
    assert table_diff(text, typed, "id").isEmpty()
    assert table_diff(typed.where("id < 0"), typed, "id").count() == 2 and table_diff(typed, typed, ("id", "v")).isEmpty()


# -- sketches --------------------------------------------------------------------


@pytest.mark.parametrize("kind,make", [
    ("bigint", lambda c: c), ("double", lambda c: c / 8), ("date", lambda c: F.date_from_unix_date((c % 30_000).cast("int"))),
    ("timestamp", lambda c: F.timestamp_seconds(c)), ("string", lambda c: c.cast("string"))])
def test_sketches_merge_within_their_bounds(spark, kind, make):
    rows = spark.range(60_000).select(make(F.xxhash64("id") % 100_000).cast(kind).alias("k"), (F.col("id") % 5).alias("run"))
    rows = rows.withColumn("k", F.when(F.rand(3) < 0.01, None).otherwise(F.col("k")))
    rows.cache()
    each = [key_sketch(rows.where(F.col("run") == i), "k") for i in range(5)]
    stacked = each[0]
    for one in each[1:]:
        stacked = stacked.unionByName(one)
    q = quantile_kind(rows.schema["k"].dataType)
    merged = merge_sketches(stacked, q)
    got = sketch_profile(merged, q).first()
    n, nulls, distinct = rows.agg(F.count("*"), F.count_if(F.col("k").isNull()), F.count_distinct("k")).first()
    assert (got.n_rows, got.n_null) == (n, nulls) and abs(got.n_distinct - distinct) < 0.05 * distinct
    cuts = sketch_cuts(merged.first(), 8)
    if kind == "string":
        assert cuts == [] and got.at_ranks is None
    else:
        sizes = [rows.where(F.col("k") <= c).count() / (n - nulls) for c in cuts]
        assert len(cuts) == 7 and all(abs(s - (i + 1) / 8) < 0.02 for i, s in enumerate(sizes))
    common = overlap(each[0], each[1]).first()[0]
    true = rows.where("run = 0 and k is not null").select("k").intersect(rows.where("run = 1").select("k")).count()
    assert abs(common - true) < 0.1 * distinct
    rows.unpersist()


def test_sketch_of_nothing(spark):
    one = key_sketch(spark.createDataFrame([], "k long"), "k")
    assert sketch_profile(one, "bigint").first()[1:3] == (0, 0)
    assert sketch_cuts(None, 4) == [] and sketch_cuts(one.first(), 1) == []


def test_runs_leave_sketches_and_cut_by_them(spark, place, monkeypatch):
    dest, store = place(DestSpec(T.StructType().add("id", "long").add("v", "string"), "id", buckets=2))
    job = JobSpec("j", "t_sketches", "d", "id", key_sketches=True)
    rows = spark.range(4000).select("id", F.lit("a").alias("v"))
    rows.createOrReplaceTempView("t_sketches")
    assert sync(spark, job, dest, store).rows_inserted == 4000
    assert store.history("sketches").count() == 1 and store.key_sketch(job, "id")["n_rows"] == 4000
    monkeypatch.setattr("rowferry.plans.sync.key_cuts", lambda *a: pytest.fail("the source was read for cuts"))
    dest.truncate("again")
    result = sync(spark, job, dest, store, ranges=4)
    assert (result.status, result.rows_inserted) == ("completed", 4000), result
    sizes = [r.n for r in dest.commits().where("kind = 'insert'").join(
        dest.read().select(F.input_file_name().alias("f")).select(F.regexp_extract("f", "seq=([0-9]+)", 1).cast("long").alias("seq")), "seq").groupBy("seq").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 1200


# -- rank index --------------------------------------------------------------------


def test_pages_read_their_ranges_only(spark, tmp_path):
    df = spark.range(10_000).select((F.col("id") % 2500).alias("k"), F.col("id").alias("v")).repartition(4)
    df = df.unionByName(spark.createDataFrame([(None, -1), (None, -2)], "k long, v long"))
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    index = RankIndex.build(df, "k", str(tmp_path / "ranks"), ranges=16)
    assert index.fences().agg(F.sum("n")).first()[0] == 10_002 and index.fences().count() == 16
    order = sorted(((r.k is not None, r.k or 0), r.v) for r in df.collect())
    for offset, size in ((0, 3), (4990, 40), (9_990, 50), (20_000, 5)):
        page = index.page(df, "k", offset, size)
        got = sorted((r.row_no, r.v) for r in page.collect())
        assert got == [(offset + 1 + i, v) for i, (_, v) in enumerate(order[offset : offset + size])]
    rows, before = index._range(df, "k", 4991, 5030)
    assert rows.count() < 2 * 10_002 / 16 + 100 and before > 4000
    assert "PushedFilters: [" in rows._jdf.queryExecution().executedPlan().toString()
    after = index.resume(df, "k", [1200], 10)
    assert index.rank(df, "k", [1200]) == 2 + 1201 * 4 and [r.row_no for r in after.orderBy("row_no").collect()] == list(range(4807, 4817))
    assert {r.k for r in after.collect()} == {1201, 1202, 1203}


def test_index_of_text_and_of_nothing(spark, tmp_path):
    df = spark.range(500).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    index = RankIndex.build(df, "k", str(tmp_path / "a"), ranges=4)
    assert [r.k for r in index.page(df, "k", 250, 2).orderBy("row_no").collect()] == sorted(f"k{i}" for i in range(500))[250:252]
    none = RankIndex.build(df.where("k = ''"), "k", str(tmp_path / "b"))
    assert none.page(df.where("k = ''"), "k", 0, 5).count() == 0


# -- collated order -----------------------------------------------------------------

WORDS = ["b", "B ", "a", "A", "c", "B", "Ab", "aB", None]


def test_pages_in_collated_order(spark):
    df = spark.createDataFrame([(w, i) for i, w in enumerate(WORDS)], "k string, i int").repartition(3)
    fold = lambda w: w.rstrip(" ").lower()
    order = sorted(WORDS, key=lambda w: (w is not None, w and fold(w), w))
    page = lambda cursor, n: [r.k for r in paging.keyset_page(df, "k", cursor, n, "UTF8_LCASE_RTRIM").collect()]
    assert page(None, 20) == order
    # A cursor that is any of the equal keys has all of them behind it.
    assert page(["aB"], 20) == page(["AB "], 20) == [w for w in order if w and fold(w) > "ab"]
    batches = paging.batch_manifest(df, "k", 3, collation="UTF8_LCASE_RTRIM").orderBy("batch_no").collect()
    assert [(r.first_pk, r.last_pk, r.n_rows) for r in batches] == [("A", "a", 3), ("Ab", "B", 3), ("B ", "c", 3)]
    assert watermark_advance(df, "k", "UTF8_LCASE_RTRIM").first()[0] == "c"


def test_runs_under_a_collation(spark, place):
    """The watermark is in the collation's order: keys equal to it are not seen again, whatever their case."""
    spec = DestSpec(T.StructType().add("k", "string").add("v", "integer"), "k", buckets=2, key_collation="UTF8_LCASE")
    dest, store = place(spec)
    job = JobSpec("j", "t_collated", "d", "k", source_keys=("k",), seed_watermark=True)
    spark.createDataFrame([("b", 1), ("B", 2), ("a", 3), ("D", 4)], "k string, v int").createOrReplaceTempView("t_collated")
    first = sync(spark, job, dest, store)
    assert (first.rows_inserted, first.rows_rejected) == (3, 1) and store.watermark(job, "k")[0] == "D"
    spark.createDataFrame([("d", 5), ("C", 6), ("e", 7), ("E", 8), ("Z", 9)], "k string, v int").createOrReplaceTempView("t_collated")
    second = sync(spark, job, dest, store)
    assert (second.mode, second.rows_processed, second.rows_inserted) == ("incremental", 3, 2)
    assert sorted(r.k.lower() for r in dest.read().collect()) == ["a", "b", "d", "e", "z"]
    assert store.watermark(job, "k")[0] == "Z"


# -- names ----------------------------------------------------------------------------


def test_names_with_dots(spark, place):
    schema = T.StructType().add("a.b", "long").add("x`y", "string").add("v w", "double")
    df = spark.createDataFrame([(1, "p", 1.0), (1, "q", 2.0), (2, None, None), (None, "r", 3.0)], schema)
    for collation in (None, "UTF8_LCASE"):
        spec = DestSpec(schema, ("a.b", "x`y") if collation else "a.b", buckets=2, key_collation=collation)
        assert classify(df, spec).where("_reason is null").count() == 2
    spec = DestSpec(schema, "a.b", buckets=2)
    dest, _ = place(spec)
    dest.insert(classify(df, spec), "r1")
    dest.insert(classify(df, spec, dest.keys()), "r2")
    assert sorted(r["a.b"] for r in dest.read().collect()) == [1, 2] and dest.keys(matching=df.select("`a.b`")).count() == 2
    assert dest.delete(df.select("`a.b`").where("`a.b` = 1"), "d") == 1 and dest.read().count() == 1
    assert paging.batch_manifest(df, "a.b", 2).count() == 2 and paging.keyset_page(df, "a.b", [1], 5).count() == 1
    assert table_diff(df, df.where("`a.b` = 1"), "a.b").count() == 2
