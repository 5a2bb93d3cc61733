import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from rowferry.llm import common, minhash
from rowferry.llm.minhash import components, near_duplicates, shingle_sets, signature

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    seen = {p for ids in holders.values() for p in combinations(sorted(ids), 2)}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in seen:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert any(not kept for _, _, kept in want.values())
    assert got(near_duplicates(docs)) == want


@pytest.mark.parametrize("small_bucket", [32, 3])
def test_groups_passages_and_chains(spark, small_bucket):
    """Copies, variants of one text, unlike texts with one passage, and a chain whose ends are unlike."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(4000)]
    base = rng.choices(words, k=60)
    texts = ["Same text of five words"] * 30 + ["same  TEXT of five words\n"]
    for _ in range(60):
        variant = list(base)
        for _ in range(rng.randint(0, 3)):
            variant[rng.randrange(60)] = rng.choice(words)
        texts.append(" ".join(variant))
    passage = rng.choices(words, k=50)
    texts += [" ".join(rng.choices(words, k=k) + passage + rng.choices(words, k=k)) for k in (5, 8, 12, 30) for _ in range(12)]
    chain = rng.choices(words, k=80)
    for _ in range(12):
        chain = chain[7:] + rng.choices(words, k=7)
        texts.append(" ".join(chain))
    texts += ["one", "one two", "one two three four five", "One two", None, "", " \n"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    assert got(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), small_bucket=small_bucket)) == brute(docs)


def test_edges(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "a b c d e f", "x"), (None, "a b c d e f", "y"), (7, "g h i j k l", "x"), (7, "g h i j k l", "y"), (None, None, "z")]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, kept string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == [
        ("7", "7", False), ("7", "7", True), ("None", "None", False), ("None", "None", True), ("None", "None", True)]


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 800).astype(np.uint64)
    b = np.concatenate([a[:700], rng.integers(0, 2**63, 100).astype(np.uint64)])
    assert abs((signature(a) == signature(b)).mean() - 700 / 900) < 0.12


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert dict(map(tuple, components(edges).collect())) == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_only_nodes_in_buckets_are_dealt_by_their_signatures(spark):
    """Of forty unlike texts and a pair of near copies only the pair's signatures go through the rounds."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(9000)], k=80)) for _ in range(40)]
    texts.append(texts[0] + " end")
    steps = minhash.NearDuplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    members = steps.members()
    low = steps.lows(members)
    assert low.count() == members.select("node").distinct().count() < 10
    assert members.where("size < 2 or pivot > node").isEmpty() and members.select("key", "node").distinct().count() == members.count()
    links = steps.verified(members.where("node <> pivot").selectExpr("node a", "pivot b").distinct(), low)
    assert links.count() == 1


def test_pairs_are_dealt_texts_and_compared_once(spark, monkeypatch):
    """A pair that was compared is not compared again the other way round, and rounds write no sets of shingles."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(9000)]
    base = rng.choices(words, k=60)
    texts = [" ".join(base), " ".join(base[:57] + rng.choices(words, k=3)), " ".join(base[:50] + rng.choices(words, k=10))]
    labels = []
    monkeypatch.setattr(minhash, "write_through", lambda df, label, write=minhash.write_through: (labels.append(label), write(df, label))[1])
    steps = minhash.NearDuplicates(spark.createDataFrame(list(enumerate(texts + texts[:1])), "doc_id long, text string").coalesce(1))
    members = steps.members()
    node = [r.node for r in members.select("node").distinct().orderBy("node").collect()]
    low = steps.lows(members)
    pairs = spark.createDataFrame([(node[1], node[0]), (node[0], node[1]), (node[2], node[0])], "a long, b long")
    assert [tuple(r) for r in steps.verified(pairs, low).collect()] == [(node[1], node[0])]
    assert steps.compared[0].count() == 2
    assert steps.verified(pairs.selectExpr("b a", "a b"), low).isEmpty() and steps.compared[1].isEmpty()
    assert "near-sets" not in labels


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_nodes_are_first_rows_of_classes_with_words(spark, broadcast_rows):
    rows = [(5, "a b c"), (3, "A  b c"), (None, "a b c"), (3, "a b c"), (7, "d"), (8, None), (9, " ")]
    steps = minhash.NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), broadcast_rows=broadcast_rows)
    assert sorted((r.doc_id, r.text) for r in steps.nodes().collect()) == [(3, "A  b c"), (7, "d")]


def test_texts_are_handed_on_in_small_batches(spark, monkeypatch):
    """24 MB of texts in one task reach Python a few MB at a time, and the session keeps its settings."""

    def bounded(step):
        def run(batches):
            for batch in batches:
                if batch.nbytes > 6 << 20:
                    raise ValueError(f"{batch.nbytes} bytes in a batch")
                yield from step(iter([batch]))

        return run

    def sketched(step):
        return lambda batches: step(b for batch in batches for b in bounded(iter)(iter([batch])))

    keys = list(common.BATCHES)
    before = [spark.conf.get(k, None) for k in keys]
    read = []
    sketches, packed = minhash._sketches, minhash._packed
    monkeypatch.setattr(minhash, "_sketches", lambda at, names: sketched(sketches(at, names)))
    monkeypatch.setattr(minhash, "_packed", bounded(packed))
    monkeypatch.setattr(minhash, "write_through", lambda df, label, write=minhash.write_through: (read.append(spark.conf.get(keys[0])), write(df, label))[1])
    texts = "concat(array_join(transform(sequence(1, 1200), i -> concat('w', id div 2, 'x', i)), ' '), if(id % 2 = 0, '', ' end'))"
    docs = spark.range(0, 2400, 1, 1).selectExpr("id AS doc_id", f"{texts} AS text")
    out = near_duplicates(docs)
    assert set(read) == {"256"}
    assert out.where("kept").count() == 1200 and out.where("component_id <> doc_id - doc_id % 2").isEmpty()
    assert [spark.conf.get(k, None) for k in keys] == before


def test_batches_of_the_session_stay(spark):
    key, other = common.BATCHES
    before = spark.conf.get(other, None)
    mine = spark.conf.get(key, None)
    spark.conf.set(key, "1000")
    try:
        with pytest.raises(ValueError), common.small_batches(spark):
            assert spark.conf.get(key) == "1000" and spark.conf.get(other) == common.BATCHES[other]
            raise ValueError
        assert spark.conf.get(key) == "1000" and spark.conf.get(other, None) == before
    finally:
        spark.conf.unset(key) if mine is None else spark.conf.set(key, mine)
