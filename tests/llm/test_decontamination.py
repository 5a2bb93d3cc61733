import hashlib
import random
import re

import numpy as np
import pytest

from rowferry.llm import decontamination as dc
from rowferry.llm.decontamination import find_overlaps, winnow

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        n = min(window, len(w))
        runs = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if runs and tuple(own[i : i + n]) in runs:
                hit.update(range(i, i + n))
                if item_id is not None:
                    found.add(str(item_id))
    return len(own), len(hit), sorted(found), bool(hit)


def got(df):
    return sorted(((r.doc_id, (r.n_words, r.n_hit, list(r["items"]), r.contaminated)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_against_brute_force(spark, monkeypatch, bits):
    """With a small bitmap nearly everything passes it, and the join decides."""
    monkeypatch.setattr(dc, "FILTER_BITS", bits)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "x1", "LONG"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([1, 2, 3, 5, 9, 10, 10, 11, 25, 40, 60])]
    items += [(20, items[9][1]), (20, items[9][1]), (None, items[8][1]), (21, None), (22, "..."), (None, None)]
    docs = []
    for i in range(120):
        parts = rng.choices(vocabulary[20:], k=rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            source = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(source) - 4))
            parts += source[a : a + rng.choice([4, 9, 10, 11, 30])] + rng.choices(vocabulary[20:], k=rng.randint(0, 12))
        docs.append((i, rng.choice([" ", "\n", ", ", " -- "]).join(p.upper() if rng.random() < 0.3 else p for p in parts)))
    docs += [(None, items[9][1]), (3, items[10][1]), (3, items[10][1]), (500, None), (501, ""), (502, "!?"),
             (503, "x " * 200_000 + items[9][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = find_overlaps(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got(out) == sorted(((i, brute(t, items)) for i, t in docs), key=repr)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "items", "contaminated"]


def test_winnow_guarantee():
    """Equal runs of the window have equal fingerprints, whatever is around them."""
    rng = np.random.default_rng(0)
    run = rng.integers(0, 2**63, 10).astype(np.uint64)
    marks = {tuple(winnow(np.concatenate([rng.integers(0, 2**63, k).astype(np.uint64), run]), 10, 5)[k : k + 1]) for k in range(12)}
    assert len(marks) == 1


def test_edges(spark):
    empty_docs, empty_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "some words", "z", True)], "doc_id long, text string, items string, contaminated boolean")
    items = spark.createDataFrame([(7, "SOME, words!", "k")], "item_id long, text string, window string")
    assert find_overlaps(empty_docs, items).count() == 0
    row = find_overlaps(docs, empty_items).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    row = find_overlaps(docs, items, carry=False).first()
    assert (row.n_words, row.n_hit, list(row["items"]), row.contaminated) == (2, 2, ["7"], True) and "text" not in row
    assert hashlib.sha256(b"7").hexdigest() == hashlib.sha256(",".join(row["items"]).encode()).hexdigest()
