from collections import Counter

import numpy as np
import pytest

from rowferry.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines, line_key

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(SPACE).translate(UPPER)


def brute(docs, often):
    return {i: (t if t is None else "\n".join(x for x in t.split("\n") if key(x) not in often)) for i, t in docs}


def frequent(docs, least):
    seen = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    return {k for k, n in seen.items() if n >= least}


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


DOCS = [(i, f"Only {i}\nshared line\n\tSHARED Line \r\n\nEvery {i % 2}\x85") for i in range(12)] + [
    (50, None), (51, ""), (52, "shared line"), (53, "\n"), (54, "É\né\n" + "long " * 50_000)]


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    low, high = rng.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    held = CuckooFilter(4000)
    assert held.insert(low[:4000], high[:4000]) and held.contains(low[:4000], high[:4000]).all()
    assert held.contains(low[4000:], high[4000:]).mean() < 0.01
    held.delete(low[:2000], high[:2000])
    held = CuckooFilter.load(held.dump())
    assert held.contains(low[2000:4000], high[2000:4000]).all() and held.contains(low[:2000], high[:2000]).mean() < 0.02
    assert not CuckooFilter(1).insert(low, high)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_both_ways(spark, tmp_path, broadcast_bytes):
    for name, docs, least in (("small", DOCS, 10), ("table", [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()], 4)):
        index = LineIndex(spark, f"{tmp_path}/{name}", least, shard_keys=20, broadcast_bytes=broadcast_bytes)
        rows = frame(spark, docs).repartition(3)
        index.insert(rows)
        out = index.apply(rows, inserted=True).collect()
        often = frequent(docs, least)
        want = brute(docs, often)
        assert {r.doc_id: r.text for r in out} == want
        assert {r.doc_id: r.n_lines for r in out} == {i: (t or "").count("\n") + 1 for i, t in docs}
        assert sum(r.n_dropped for r in out) == sum(key(x) in often for _, t in docs for x in (t or "").split("\n"))


def test_reversible(spark, tmp_path):
    """Inserting and deleting a batch restores counts, filters and answers; unseen documents are answered exactly."""
    first, second = DOCS[:9], [(100 + i, f"shared line\nlate {i % 3}\nmore") for i in range(30)]
    index = LineIndex(spark, f"{tmp_path}/index", 10, shard_keys=2)

    def state():
        counts = {(bytes(r.key), r.docs) for r in index.counts().collect() if r.docs}
        return counts, {bytes(r.key) for r in index.frequent().collect()}, {r.doc_id: r.text for r in index.apply(frame(spark, DOCS + second)).collect()}

    index.insert(frame(spark, first))
    before = state()
    assert before[2] == brute(DOCS + second, frequent(first, 10))
    index.insert(frame(spark, second))
    both = state()
    assert both[2] == brute(DOCS + second, frequent(first + second, 10)) and both[1] == {line_key(k.encode()) for k in frequent(first + second, 10)}
    index.delete(frame(spark, second))
    assert state() == before


def test_thousands_of_shards(spark, tmp_path):
    """Every line frequent, few keys to a shard: both ways drop the same, and no filter holds more than a few keys."""
    docs = [(i, "\n".join(f"line {k}" for k in range(i % 5, 3000, 5)) + f"\nown {i}") for i in range(50)]
    outs = []
    for bytes_ in (64 << 20, 0):
        index = LineIndex(spark, f"{tmp_path}/{bytes_}", 10, shard_keys=2, broadcast_bytes=bytes_)
        index.insert(frame(spark, docs).repartition(4))
        assert index.shards == 2048 and index.frequent().count() == 3000
        sizes = [len(r.filter) for r in index.filters().collect()]
        assert len(sizes) > 1000 and max(sizes) <= 64
        outs.append({r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in index.apply(frame(spark, docs)).collect()})
    assert outs[0] == outs[1] == {i: (f"own {i}", 601, 600) for i, _ in docs}


def test_shards_grow_with_the_index(spark, tmp_path):
    """Inserts that need more shards build all filters anew; deleting them again restores the answers."""
    index = LineIndex(spark, f"{tmp_path}/index", 2, shard_keys=4)
    first = [(i, "a\nb\nc") for i in range(3)]
    second = [(10 + i, "\n".join(f"l{k}" for k in range(100))) for i in range(2)]
    index.insert(frame(spark, first))
    assert index.shards == 1
    index.insert(frame(spark, second))
    assert index.shards == 32 and {r.text for r in index.apply(frame(spark, first + second)).collect()} == {""}
    index.delete(frame(spark, second))
    assert index.frequent().count() == 3
    assert {r.text for r in index.apply(frame(spark, first + second)).collect()} == {"", second[0][1]}


def test_edges(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(None, "a b", 1)] * 10 + [(1, "a b\nc", 2)], "doc_id long, text string, n_lines int")
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted((r.text, r.n_lines, r.n_dropped) for r in out.collect()) == [("", 1, 1)] * 10 + [("c", 2, 1)]
    kept = dedup_lines(spark.createDataFrame([(i, "ab\nabcd") for i in range(10)], "doc_id long, text string"), min_chars=3)
    assert {r.text for r in kept.collect()} == {"ab"}
