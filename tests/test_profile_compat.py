from pyspark.sql import functions as F

from rowferry.operators import compat, profile
from rowferry.operators.loads import delta_effect, map_columns
from rowferry.plans import modes
from rowferry.spec import DestSpec


def test_key_profile(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (5,)], "k int")
    assert tuple(profile.key_profile(df, "k", "t").first()) == ("t", 4, 2, 1, 1, 5, False)
    assert tuple(profile.key_profile(df.where("k = 9"), "k", "t").first()) == ("t", 0, 0, 0, None, None, True)
    two = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert profile.key_profile(two, ["a", "b"], "t").first().is_unique


def test_null_flag_is_not_deleted(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 2)], "k int, f int")
    assert profile.deleted_count(df, "f").first()[0] == 1
    assert [r.k for r in profile.deleted_keys(df, "k", "f").collect()] == [1]


def test_schema_report(spark):
    s = spark.createDataFrame(
        [("p", "id", "int", "YES"), ("p", "name", "varchar", "YES"), ("p", "email", "varchar", "YES"), ("p", "note", "text", "YES"),
         ("q", "id", "int", "YES"), ("q", "at", "date", "YES")], "pair string, column_name string, data_type string, is_nullable string")
    d = spark.createDataFrame(
        [("p", "id", "bigint", "YES"), ("p", "name", "int", "YES"), ("p", "note", "longtext", "NO"), ("p", "created", "date", "YES"),
         ("q", "id", "bigint", "YES"), ("q", "at", "datetime", "YES")], "pair string, column_name string, data_type string, is_nullable string")
    assert {tuple(r) for r in compat.schema_report(s, d).collect()} == {
        ("p", "email", "error", "missing_in_destination"),
        ("p", "created", "warning", "extra_in_destination"),
        ("p", "name", "warning", "type"),
        ("p", "note", "warning", "nullable"),
    }
    assert {tuple(r) for r in compat.schema_verdict(s, d).collect()} == {("p", False, 1, 3), ("q", True, 0, 0)}


def test_dest_pk(spark):
    d = spark.createDataFrame(
        [("ok", "id", "PRI", ""), ("nopk", "x", "PRI", ""), ("notpri", "id", None, None), ("auto", "id", "PRI", "AUTO_INCREMENT"),
         ("both", "id", "MUL", "auto_increment")], "table_name string, column_name string, column_key string, extra string")
    assert {tuple(r) for r in compat.dest_pk_report(d, "id").collect()} == {
        ("nopk", "not_found"), ("notpri", "not_primary"), ("auto", "auto_increment"), ("both", "not_primary"), ("both", "auto_increment"),
    }


def test_map_columns(spark):
    schema = spark.createDataFrame([], "a int, b string, c double").schema
    row = map_columns(spark.createDataFrame([(1,)], "a long"), DestSpec(schema, "a", defaults={"c": 1.5})).first()
    assert tuple(row) == (1, None, 1.5)


def test_delta_effect(spark):
    src = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 0)], "k int, f int")
    dst = spark.createDataFrame([(1,), (3,)], "k int")
    assert tuple(delta_effect(dst, src, "k", "f", 2).first()) == (3, 1, 2)
    assert tuple(delta_effect(dst, src.where("k > 2"), "k", "f", 2).first()) == (0, 0, 0)


def test_modes(spark):
    df = spark.createDataFrame(
        [(0, True, 5, True), (3, True, 5, True), (3, False, 0, True), (3, True, 0, True), (3, False, 0, False)],
        "dest_rows long, has_flag boolean, flagged long, has_pk boolean").withColumn("pk", F.lit("id"))
    assert [r.mode for r in modes.mode_detect(df).collect()] == ["full", "delta", "incremental", "incremental", "full"]


def test_pk_choice(spark):
    df = spark.createDataFrame(
        [("is", 1, "a", "PRI"), ("is", 2, "id", "PRI"), ("not", 2, "b", "PRI"), ("not", 1, "a", "PRI"), ("none", 1, "a", None)],
        "case string, ordinal int, column_name string, column_key string")
    got = {tuple(r) for r in modes.pk_choice(df, F.lit("id"), "case").collect()}
    assert got == {("is", "id", True), ("not", "a", True), ("none", "id", False)}


def test_preflight(spark):
    t = spark.range(3)
    got = {tuple(r) for r in profile.preflight_report([("t", "id"), ("t", "x"), ("u", "id")], {"t": t}).collect()}
    assert got == {("t", "id", True, True, 3), ("t", "x", True, False, 3), ("u", "id", False, False, None)}
