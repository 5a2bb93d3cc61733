"""Several unique keys, checks and foreign keys against a loop over the rows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators import constraints
from rowferry.operators.constraints import accepted_rows, classify_constrained
from rowferry.plans.sync import sync
from rowferry.sources.table import ConflictError, DestTable
from rowferry.sources.workdir import write_through
from rowferry.spec import DestSpec, JobSpec

SCHEMA = T.StructType().add("id", "long").add("a", "string").add("b", "integer").add("c", "double")
SPEC = DestSpec(SCHEMA, "id", unique={"ab": ("a", "b"), "c": "c"}, buckets=2)


def in_turn(rows, held=()):
    """Reasons by row, rows taken in order."""
    taken = [{r[0] for r in held}, {r[1:3] for r in held if None not in r[1:3]}, {r[3] for r in held if r[3] is not None}]
    out = []
    for r in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        if r[0] is None:
            out.append((*r, "null_key"))
            continue
        keys = [r[0], None if None in r[1:3] else r[1:3], r[3]]
        broken = [i for i, (k, t) in enumerate(zip(keys, taken)) if k is not None and k in t]
        if broken:
            out.append((*r, ("duplicate_key", "duplicate_key:ab", "duplicate_key:c")[broken[0]]))
            continue
        out.append((*r, None))
        for k, t in zip(keys, taken):
            if k is not None:
                t.add(k)
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:5] for r in df.select("id", "a", "b", "c", "_reason").collect()), key=str)


def some(rng, n, ids, letters, numbers):
    pick = lambda values: rng.choice([None, *values]) if rng.random() < 0.1 else rng.choice(values)
    return [(pick(range(ids)), pick(letters), pick(range(numbers)), pick([x / 4 for x in range(numbers * 3)])) for _ in range(n)]


@pytest.mark.parametrize("limit", [20_000, 5])
def test_against_a_loop(spark, limit):
    rng = random.Random(3)
    rows, held = some(rng, 400, 150, "abcdefgh", 12), [(900, "a", 1, 0.25), (901, "h", None, None), (5, "z", 0, 77.0)]
    df, old = spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(held, SCHEMA)
    assert got(classify_constrained(df, SPEC, in_turn=limit)) == in_turn(rows)
    out = classify_constrained(df, SPEC, old, in_turn=limit)
    assert got(out) == in_turn(rows, held)
    assert out.where("_reason is not null and _row is null").isEmpty()


def test_a_loser_leaves_its_keys_free(spark):
    """A chain in which every second row is accepted, and a hot key."""
    n = 60
    rows = [(i, "x", i // 2, None) if i % 2 else (i, None, None, float(i // 2)) for i in range(0)]
    rows += [(i, "k", (i + 1) // 2, float(i // 2)) for i in range(n)]
    assert got(classify_constrained(spark.createDataFrame(rows, SCHEMA), SPEC, in_turn=1)) == in_turn(rows)
    hot = [(i, "hot", 1, float(i)) for i in range(500)]
    out = classify_constrained(spark.createDataFrame(hot, SCHEMA).repartition(4), SPEC, in_turn=0)
    assert out.where("_reason is null").count() == 1 and out.where("_reason = 'duplicate_key:ab'").count() == 499


def test_rounds_are_few_at_random(spark):
    edges = spark.range(0, 20_000).select(F.col("id").alias("row_no"), F.lit(2).alias("n_keys"), F.explode(F.array(
        F.concat(F.lit("a"), F.xxhash64("id", F.lit(1)) % 9000), F.concat(F.lit("b"), F.xxhash64("id", F.lit(2)) % 9000))).alias("key"))
    rows = {}
    for r in edges.collect():
        rows.setdefault(r.row_no, []).append(r.key)
    taken, want = set(), set()
    for i in sorted(rows):
        if taken.isdisjoint(rows[i]):
            taken.update(rows[i])
            want.add(i)
    assert {r.row_no for r in accepted_rows(edges, in_turn=100).collect()} == want


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """Every row waits for the one before; the rounds follow the blocks, not the chain."""
    written = []
    monkeypatch.setattr(constraints, "write_through", lambda df, label: written.append(label) or write_through(df, label))
    chain = spark.range(0, 300).select(F.col("id").alias("row_no"), F.lit(2).alias("n_keys"), F.explode(F.transform(F.array(F.col("id"), F.col("id") + 1), lambda k: k.cast("string"))).alias("key"))
    won = accepted_rows(chain, in_turn=200)
    assert sorted(r.row_no for r in won.collect()) == list(range(0, 300, 2))
    assert len(written) <= 6


def test_checks_and_foreign_keys(spark):
    spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, 3)], "x string, y int").createOrReplaceTempView("parents")
    spec = DestSpec(SCHEMA, "id", unique={"c": "c"}, checks={"positive": "b > 0", "small": "c < 10 AND b < 100"},
                    foreign_keys={"parent": (("a", "b"), "parents", ("x", "y"))})
    rows = [(1, "a", 1, 1.0), (2, "a", 2, 1.0), (3, "b", 2, 1.0), (4, None, 3, 2.0), (5, "a", -1, 3.0), (6, "b", 2, 11.0), (7, "b", None, 4.0), (None, "a", 1, 5.0),
            (8, "a", 1, None), (8, "a", 1, 9.0)]
    out = {(r.id, r.c): r._reason for r in classify_constrained(spark.createDataFrame(rows, SCHEMA), spec).collect()}
    assert out == {(1, 1.0): None, (2, 1.0): "foreign_key:parent", (3, 1.0): "duplicate_key:c", (4, 2.0): None, (5, 3.0): "check:positive",
                   (6, 11.0): "check:small", (7, 4.0): None, (None, 5.0): "null_key", (8, None): None, (8, 9.0): "duplicate_key"}


def test_microseconds_and_zeros_are_told_apart(spark):
    spec = DestSpec(T.StructType().add("id", "long").add("t", "timestamp").add("z", "double"), "id", unique={"t": "t", "z": "z"})
    rows = spark.sql("SELECT * FROM VALUES (1L, timestamp'2020-01-01 00:00:00.000001', 1D), (2L, timestamp'2020-01-01 00:00:00.000002', -0D), "
                     "(3L, timestamp'2020-01-02', 0D), (4L, timestamp'2020-01-01 00:00:00.000001', 3D) AS v(id, t, z)")
    rows = rows.withColumn("z", F.when(F.col("id") == 2, F.lit(0.0) * -1).otherwise(F.col("z")))
    assert {r.id: r._reason for r in classify_constrained(rows, spec).collect()} == {1: None, 2: None, 3: "duplicate_key:z", 4: "duplicate_key:t"}


def test_whole_runs_and_writers(spark, place):
    """A full and an incremental run; a key freed by a delete; a writer that must start again."""
    dest, store = place(SPEC)
    job = JobSpec("j", "t_constraints", "d", "id", source_keys=("id",), seed_watermark=True)
    spark.createDataFrame([(1, "a", 1, 1.0), (2, "a", 1, 2.0), (3, "b", 1, 1.0)], SCHEMA).createOrReplaceTempView("t_constraints")
    result = sync(spark, job, dest, store)
    assert (result.status, result.rows_inserted, result.rows_rejected) == ("completed", 1, 2), result
    spark.createDataFrame([(4, "a", 2, 1.0), (5, "a", 2, 5.0), (6, "a", 1, 6.0)], SCHEMA).createOrReplaceTempView("t_constraints")
    result = sync(spark, job, dest, store)
    assert (result.mode, result.rows_inserted, result.rows_rejected) == ("incremental", 1, 2)
    assert {(r.reason, r.row[:7]) for r in dest.rejects().where("row like '%:4,%' or row like '%:6,%'").collect()} == {
        ("duplicate_key:c", '{"id":4'), ("duplicate_key:ab", '{"id":6')}
    dest.delete(spark.createDataFrame([(1,)], "id long"), "d")
    out = classify_constrained(spark.createDataFrame([(7, "a", 1, 1.0)], SCHEMA), SPEC, dest.read())
    base, other = dest.snapshot(), DestTable(spark, dest.path, SPEC)
    seq = dest.write(out)
    other.insert(classify_constrained(spark.createDataFrame([(8, "a", 1, 8.0)], SCHEMA), SPEC, other.read()), "other")
    with pytest.raises(ConflictError):
        dest.commit(seq, "late", base)
    assert sorted(r.id for r in dest.read().collect()) == [5, 8]


def test_specs_are_checked():
    with pytest.raises(ValueError):
        DestSpec(SCHEMA, "id", unique={"x": ("nope",)})
    with pytest.raises(ValueError):
        DestSpec(SCHEMA, "id", foreign_keys={"x": (("nope",), "t", ("y",))})
