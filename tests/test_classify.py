from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.classify import accepted, classify, reject_table
from rowferry.spec import DestSpec


def spec(ddl="id long, v string", key="id", **kw):
    return DestSpec(T.StructType.fromDDL(ddl), key, **kw)


def outcome(df):
    return Counter((*r[:-2], r._reason) for r in df.collect())


def test_first_row_wins_rest_rejected(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c")], "id long, v string")
    assert outcome(classify(df, spec())) == Counter(
        {(1, "a", None): 1, (1, "a", "duplicate_key"): 1, (1, "b", "duplicate_key"): 1, (2, "c", None): 1}
    )


def test_row_checks_in_order(spark):
    df = spark.createDataFrame(
        [(None, None, "1"), (1, None, "x"), (2, "ok", "x"), (3, "toolong", "7"), (4, "ok", "7"), (5, "ok", None)],
        "id long, name string, n string",
    )
    s = spec("id long, name string not null, n int", max_length={"name": 3})
    got = {(r.id, r._reason) for r in classify(df, s).collect()}
    assert got == {
        (None, "null_key"), (1, "not_null:name"), (2, "bad_cast:n"), (3, "too_long:name"), (4, None), (5, None),
    }


def test_failed_row_does_not_occupy_the_key(spark):
    df = spark.createDataFrame([(1, None), (1, "b")], "id long, v string")
    got = {(r.v, r._reason) for r in classify(df, spec("id long, v string not null")).collect()}
    assert got == {(None, "not_null:v"), ("b", None)}


def test_bad_cast_of_the_key(spark):
    df = spark.createDataFrame([("x", "a"), ("7", "b")], "id string, v string")
    got = {(r.id, r._reason) for r in classify(df, spec()).collect()}
    assert got == {(None, "bad_cast:id"), (7, None)}


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "id long")
    full = spec("id long, a int not null, b int, c int not null", defaults={"a": 5})
    row = classify(df, full).first()
    assert (row.a, row.b, row._reason) == (5, None, "not_null:c")


def test_existing_keys_conflict(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "id long, v string")
    held = spark.createDataFrame([(2,), (9,)], "id int")
    got = outcome(classify(df, spec(), held))
    assert got == Counter(
        {(1, "a", None): 1, (2, "b", "duplicate_key"): 1, (2, "c", "duplicate_key"): 1, (3, "d", None): 1}
    )


def test_key_collation(spark):
    df = spark.createDataFrame([("Ab", 1), ("aB ", 2), ("c", 3)], "id string, v int")
    held = spark.createDataFrame([("C",)], "id string")
    exact = classify(df, spec("id string, v int"), held)
    assert exact.where("_reason is null").count() == 3
    folded = classify(df, spec("id string, v int", key_collation="UTF8_LCASE_RTRIM"), held)
    assert {(r.v, r._reason) for r in folded.collect()} == {(1, None), (2, "duplicate_key"), (3, "duplicate_key")}


def test_empty_and_all_null(spark):
    none = spark.createDataFrame([], "id long, v string")
    assert classify(none, spec()).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], "id long, v string")
    assert [r._reason for r in classify(nulls, spec()).collect()] == ["null_key"] * 2
    assert accepted(nulls, "id").count() == 0


def test_reject_json(spark):
    df = spark.createDataFrame([("x", "a"), ("1", "b"), ("1", "c")], "id string, v string")
    got = {(r.reason, r.row) for r in reject_table(classify(df, spec()), "r").collect()}
    assert got == {("bad_cast:id", '{"id":"x","v":"a"}'), ("duplicate_key", '{"id":"1","v":"c"}')}


def test_columns_without_an_order(spark):
    df = spark.sql("SELECT 1L AS id, map('a', 1) AS v UNION ALL SELECT 1L, map('b', 2)")
    got = classify(df, DestSpec(df.schema, "id")).collect()
    assert sorted(str(r._reason) for r in got) == ["None", "duplicate_key"]


def hot(spark):
    """One key holds a third of the rows; most of them are copies of one row."""
    return spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("v"), F.col("id"))).alias("v"),
    )


def test_hot_key_is_split(spark):
    df = hot(spark)
    split, plain = classify(df, spec()), classify(df, spec(), split=False)
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    taken = classify(df, spec(), spark.createDataFrame([(7,)], "id long"))
    assert taken.where("id = 7 and _reason is null").isEmpty()
    assert taken.count() == 30_000
    # Both branches read one shuffle of the source.
    for df in (split, taken):
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_behind_a_join_on_it(spark, monkeypatch):
    """All rows of the hot key come out of one task of the query; runs of them are ranked apart."""
    monkeypatch.setattr("rowferry.operators.classify.RUN_BITS", 6)
    names = spark.createDataFrame([(7, "seven")], "id long, name string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = hot(spark).join(names.hint("merge"), "id", "left").select("id", "v")
        most = df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most > 10_000
        lost = classify(df, spec()).where("_reason is not null").groupBy(F.spark_partition_id()).count()
        sizes = sorted(r["count"] for r in lost.collect())
        assert sum(sizes) == 10_000 and len(sizes) >= 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    plain = classify(df, spec(), split=False)
    assert classify(df, spec()).exceptAll(plain).isEmpty()


@pytest.mark.parametrize("split", [True, False])
def test_reason_of_a_held_key_holds_for_all_its_rows(spark, split):
    held = spark.createDataFrame([(7, "deleted"), (7, "duplicate_key"), (8, "duplicate_key")], "id long, _why string")
    got = classify(hot(spark), spec(), held, split=split)
    assert {r._reason: r["count"] for r in got.where("id = 7").groupBy("_reason").count().collect()} == {"deleted": 10_001}
    assert got.where("id = 8").first()._reason == "duplicate_key"


def test_rejected_rows_are_spread(spark):
    """A third of the rows has a NULL key; they are not sent to one task."""
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"), F.lit("v").alias("v")
    )
    plan = classify(df, spec(), split=False)
    sizes = plan.where("_reason = 'null_key'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 10_000


ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.sampled_from(["a", "bb", "ccc"]))),
    max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.sets(st.integers(0, 6)), st.booleans())
def test_nothing_is_lost(spark, rows, held, split):
    """accepted + rejected = source; keys unique; same as a loop over the rows."""
    s = spec("id long, v string not null", max_length={"v": 2})
    df = spark.createDataFrame(rows, "id long, v string").repartition(3)
    existing = spark.createDataFrame([(k,) for k in held], "id long")
    got = Counter((r.id, r.v, r._reason) for r in classify(df, s, existing, split=split).collect())
    want, taken = Counter(), set(held)
    for k, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "")):
        if k is None:
            reason = "null_key"
        elif v is None:
            reason = "not_null:v"
        elif len(v) > 2:
            reason = "too_long:v"
        elif k in taken:
            reason = "duplicate_key"
        else:
            reason = None
            taken.add(k)
        want[(k, v, reason)] += 1
    assert got == want


@pytest.mark.parametrize("key", ["l_orderkey", ("l_orderkey", "l_linenumber")])
def test_both_ways_to_accept_agree(spark, key):
    line = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a = accepted(line, key)
    s = DestSpec(line.schema, key)
    from rowferry.functions.keys import total_order

    b = classify(line, s, order=total_order(line, s.primary_key)).where("_reason is null").drop("_reason", "_row")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
