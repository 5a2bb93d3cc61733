"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rowferry.operators.classify import accepted, classify
from rowferry.spec import DestSpec
from scenarios.queries import QUERIES

SF = "/root/testdata/sf0.001"
#: Queries of the engine that are one plan; runs and streams have written by the time they return.
LAZY = [n for n in QUERIES if not n.startswith(("sync_", "stream_", "full_load_resumed"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "Existing RDD"):
        assert bad not in text


def test_classify_is_one_shuffle(spark):
    line = spark.read.parquet(f"{SF}/lineitem.parquet")
    held = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"))
    text = plan(classify(line, DestSpec(line.schema, "l_orderkey"), held, split=False))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    # Of the destination only the key is read.
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_accepted_prunes_before_the_shuffle(spark):
    text = plan(accepted(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_orderkey"))
    below = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and text.count("Exchange") == 1


def test_incremental_reads_only_new_keys(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan(entry.queries()["incremental_accepted"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert text.count("GreaterThan(o_orderkey,749)") >= 2


def test_key_only_queries_read_key_columns(spark):
    text = plan(entry.queries()["delta_deleted_ids"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_a_join_on_a_hot_key_sorts_nothing(spark, tmp_path):
    """All rows of a hot key are in one task, which must not hold them to sort them."""
    rows = spark.range(60).selectExpr("id l_orderkey", "1 l_linenumber", "id l_partkey", "id l_suppkey", "if(id % 9 = 0, 'A', 'N') l_returnflag")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    out = entry.queries()["full_load_joined_hot_keys"](spark, str(tmp_path))
    assert "ShuffledHashJoin" in plan(out) and "SortMergeJoin" not in plan(out)
    assert sorted((r.l_orderkey, r.n_flag) for r in out.where("outcome = 'accepted'").collect()) == [(0, 7), (1, 53)]
