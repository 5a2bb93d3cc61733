"""Conversions, lengths and dead letters; sequence numbers; the work folder; delete keys that are no values."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.classify import classify
from rowferry.plans.state import StateStore
from rowferry.sources import table as table_module
from rowferry.sources import workdir
from rowferry.spec import DestSpec


def outcomes(df):
    return sorted((r._reason or "", json.loads(r._row) if r._row else None) for r in df.collect())


def test_length_comes_from_the_type(spark):
    spec = DestSpec(T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.VarcharType(3))]), "id")
    out = classify(spark.createDataFrame([(1, "abc"), (2, "abcdef"), (3, None)], "id long, v string"), spec).collect()
    assert {r.id: r._reason for r in out} == {1: None, 2: "too_long:v", 3: None}


def test_refused_conversion_is_a_reject(spark):
    spec = DestSpec(T.StructType.fromDDL("id long, n long"), "id")
    source = spark.createDataFrame([(1, "2024-01-01"), (2, None)], "id long, n string").withColumn("n", F.to_date("n"))
    out = classify(source, spec).collect()
    assert {r.id: r._reason for r in out} == {1: "bad_cast:n", 2: None}


@pytest.mark.parametrize("split", [True, False])
def test_dead_letters_show_the_source(spark, split):
    spec = DestSpec(T.StructType.fromDDL("id long, n long"), "id")
    rows = [("7", "008"), ("7", "009"), ("8", "x")]
    got = outcomes(classify(spark.createDataFrame(rows, "id string, n string"), spec, split=split))
    assert got == [("", None), ("bad_cast:n", {"id": "8", "n": "x"}), ("duplicate_key", {"id": "7", "n": "009"})]


def test_state_outlives_a_clock_set_back(spark, tmp_path, monkeypatch):
    store = StateStore(spark, str(tmp_path))
    entry = {"job": "j", "source_table": "s", "dest_table": "d", "pk": "id", "value_type": "bigint"}
    store.put("watermarks", store.seq("watermarks"), value="1", **entry)
    monkeypatch.setattr(table_module.time, "time_ns", lambda: 1000)
    later = StateStore(spark, str(tmp_path))
    later.put("watermarks", later.seq("watermarks"), value="2", **entry)
    assert later.history("watermarks").orderBy(F.desc("seq")).first()["value"] == "2"


def test_work_folder_of_a_cluster_is_never_local(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        workdir.work_path(Session(), "x")


def test_delete_skips_keys_that_are_no_values(spark, place):
    spec = DestSpec(T.StructType.fromDDL("id long, v string"), "id")
    dest, _ = place(spec)
    dest.load(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"))
    assert dest.delete(spark.createDataFrame([("1",), ("x",), (None,)], "id string"), "d") == 1
    assert [r.id for r in dest.read().collect()] == [2]
