import math

import numpy as np
import pytest

from rowferry.llm import hard_negatives as H
from rowferry.llm import queries
from rowferry.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor):
    """Over all rows, for every anchor; rows in table order."""
    some = [(k, i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for k, (i, v, lab) in enumerate(rows)
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, i, label, v in some:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m, lab) for m, j, lab, w in some if len(w) == len(v) and m != k)
        for score, j, _, _ in [s for s in scored if s[3] == label][:5]:
            hits = [s for s in scored if s[3] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:10]
            out += [(i, j, r + 1, s[1], -score, -s[0]) for r, s in enumerate(hits)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    x = np.floor(256 * np.array([r[1] for r in rows], float)).astype(int)
    ids = np.array([r[0] for r in rows])
    labels = np.array([(lab + 1) % 10 if i % 7 == 0 else lab for i, _, lab in rows])
    want = []
    for a in np.flatnonzero(ids % 100 == 0):
        score = x @ x[a]
        order = np.lexsort((ids, -score))
        for p in [o for o in order if labels[o] == labels[a] and o != a][:5]:
            fits = [o for o in order if labels[o] != labels[a] and 30 * score[p] <= 100 * score[o] <= 90 * score[p]][:10]
            want += [(ids[a], ids[p], r + 1, ids[o], score[p], score[o]) for r, o in enumerate(fits)]
    assert len(want) > 500
    assert got(queries.QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.1")) == sorted(want)


@pytest.mark.parametrize("anchors_most,rows_most", [(1 << 15, 1 << 17), (3, 40)])
def test_groups_lengths_and_ties(spark, anchors_most, rows_most):
    """A third of equal vectors, vectors of two lengths and of very unlike norms, few distinct values, one label rare."""
    rng = np.random.default_rng(8)
    vectors = [rng.normal(size=6).tolist() for _ in range(150)] + [(rng.normal(size=6) * 40).tolist() for _ in range(30)]
    vectors += [[0.5, 0.25, 0.0, 0.0, 0.0, 1.0]] * 120 + rng.integers(-1, 2, (60, 6)).tolist() + rng.normal(size=(25, 3)).tolist()
    labels = [int(x) for x in rng.integers(0, 3, len(vectors))]
    labels[0] = 9
    rows = [(int(i), [float(c) for c in v], lab) for i, v, lab in zip(rng.permutation(len(vectors)), vectors, labels)]
    out = hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), H.F.col("vec_id") % 4 == 0, anchors_most=anchors_most, rows_most=rows_most)
    want = brute(rows, lambda i: i % 4 == 0)
    assert got(out) == want and len(want) > 1000


def test_lists_end_early():
    """A tight cluster of anchors certifies its best rows after a small part of the list."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=32)
    rows = np.concatenate([centre + 0.2 * rng.normal(size=(200, 32)), rng.normal(size=(20_000, 32))])
    members = centre + 0.05 * rng.normal(size=(20, 32))
    order, bounds = H.bound_lists(members, rows, centre / np.linalg.norm(centre))
    lengths = np.linalg.norm(members, axis=1)
    assert (lengths[:, None] * bounds + 1e-9 >= members @ rows[order].T).all()
    best = H.Best(len(members), 5)

    def offer(active, start, stop, scores):
        i, j = np.nonzero(scores >= best.last[active][:, None])
        best.offer(active[i], np.round(scores[i, j] * 1000), order[start + j], order[start + j])

    made = H.walk(lambda m, s, e: members[m] @ rows[order[s:e]].T, bounds, lengths, lambda: best.last / 1000, offer)
    assert made < 0.3 * members.shape[0] * len(rows)


def test_large_numbers_are_exact():
    a, b = np.full((1, 4), 1 << 25, np.int32), np.array([[1 << 25, 1 << 25, 1 << 25, (1 << 25) - 1]], np.int32)
    assert int(H.products(a, b)[0, 0]) == 4 * (1 << 50) - (1 << 25)


def test_edges(spark):
    one = [1.0, 0.5]
    rows = [(0, one, 1), (0, one, 1), (1, one, 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 2), (None, one, 1), (4, None, 1), (5, one, None),
            (6, [1.0, None], 2), (7, [float("nan"), 1.0], 2), (8, [1.0], 1), (9, [], 2), (10, [-1.0, -1.0], 1), (11, [1e30, 0.0], 3)]
    wide = spark.createDataFrame(rows, SCHEMA).coalesce(1).selectExpr("*", "1 AS row", "'x' AS id", "2 AS slice", "3 AS `a.b`")
    out = got(hard_negatives(wide, H.F.col("vec_id") < 2))
    assert out == brute(rows, lambda i: i < 2) and {r[3] for r in out} == {2, 3}
    assert hard_negatives(spark.createDataFrame([], SCHEMA), H.F.col("vec_id") == 0).count() == 0
    assert hard_negatives(wide, H.F.lit(False)).count() == 0
