"""What can be checked without a database: stripes and options."""

import pytest
from pyspark.sql import functions as F

from rowferry.sources.jdbc import append, range_options, range_scan, stripe_predicates


def test_stripes_cover_every_row_once(spark):
    df = spark.createDataFrame([(v,) for v in [None, -5, 0, 3, 3, 7, 100]], "k int")
    for cuts in ([], [3], [0, 3, 7], [3, 3]):
        hits = sum(F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in stripe_predicates("k", cuts))
        assert {r[0] for r in df.select(hits).collect()} == {1}


def test_text_cuts_are_quoted():
    assert stripe_predicates("k", ["o'x"])[1] == "k > 'o''x'"


def test_options():
    assert range_options("id", 1, 9, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        range_options("id", 1, 9, 0)


class Recorder:
    """Stands in for a session and a writer, and notes what it is asked."""

    def __init__(self, ends=None):
        self.ends, self.calls, self.set = ends, [], {}
        self.read = self.write = self

    def format(self, name):
        assert name == "jdbc"
        self.set = {}
        return self

    def options(self, **kw):
        self.set.update(kw)
        return self

    def option(self, key, value):
        self.set[key] = value
        return self

    def mode(self, mode):
        self.set["mode"] = mode
        return self

    def load(self):
        self.calls.append(self.set)
        return self

    save = load

    def first(self):
        return self.ends


def test_range_scan_asks_for_the_ends_first():
    db = Recorder({"lo": 3, "hi": 90})
    range_scan(db, "jdbc:x", "SELECT * FROM {{table}};", "t", "id", 4, {"user": "u"})
    ends, rows = db.calls
    assert ends["dbtable"] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM (SELECT * FROM t) b) q"
    assert "numPartitions" not in ends
    assert rows == {
        "user": "u", "url": "jdbc:x", "dbtable": "(SELECT * FROM t) q",
        "partitionColumn": "id", "lowerBound": "3", "upperBound": "90", "numPartitions": "4",
    }


def test_range_scan_of_an_empty_table():
    db = Recorder({"lo": None, "hi": None})
    range_scan(db, "jdbc:x", "SELECT * FROM {{table}}", "t", "id", 4)
    assert "partitionColumn" not in db.calls[1]


def test_append_options():
    db = Recorder()
    append(db, "jdbc:x", "t", {"batchsize": "1000"})
    assert db.calls == [{"batchsize": "1000", "url": "jdbc:x", "dbtable": "t", "mode": "append"}]
