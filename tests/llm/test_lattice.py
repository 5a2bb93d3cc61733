import numpy as np
import pytest

from rowferry.llm import lattice, queries
from rowferry.llm.lattice import cells, e8, minimal_vectors, near_duplicate_vectors, units

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """vec_id: (links, component, kept), over all pairs in blocks."""
    ids = [i for i, _ in rows]
    good = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for size in {len(rows[k][1]) for k in good}:
        some = [k for k in good if len(rows[k][1]) == size]
        unit = units(np.array([rows[k][1] for k in some], np.float32).astype(float))
        for start in range(0, len(some), 1000):
            a, b = np.nonzero(unit[start : start + 1000] @ unit.T >= 0.95)
            for p, q in zip((a + start).tolist(), b.tolist()):
                if p < q:
                    links[some[p]] += 1
                    links[some[q]] += 1
                    parent[root(some[p])] = root(some[q])
    least = {}
    for k, i in enumerate(ids):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, links[k], least[root(k)], least[root(k)] == i) for k, i in enumerate(ids))


def got(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def variants(rng, centre, noise, n):
    return [(centre + noise * rng.normal(size=len(centre)) / np.sqrt(len(centre))).astype(np.float32).tolist() for _ in range(n)]


@pytest.mark.parametrize("block", [512, 16])
def test_groups_of_variants_and_copies(spark, monkeypatch, block):
    """Copies, a group of near copies in split buckets, chains of links, and a thousand others."""
    monkeypatch.setattr(lattice, "BLOCK", block)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1000, 64)).astype(np.float32).tolist()
    for size in (2, 3, 150):
        centre = rng.normal(size=64)
        vectors += variants(rng, centre / np.linalg.norm(centre), 0.1, size)
    vectors += [vectors[0]] * 40 + [vectors[-1]] * 7
    a, b = rng.normal(size=(2, 64))
    vectors += [(np.cos(t) * a + np.sin(t) * b).astype(np.float32).tolist() for t in np.arange(0, 1.5, 0.12)]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vectors)), vectors)]
    want = brute(rows)
    assert got(near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5))) == want
    assert max(n for _, n, _, _ in want) >= 150


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/check_s/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows)
    out = got(queries.QUERIES["op13_lattice"](spark, "/root/testdata/check_s"))
    assert sum(n for _, n, _, _ in out) >= 0.995 * sum(n for _, n, _, _ in want)
    assert [r[2:] for r in out] == [r[2:] for r in want] and all(a[1] <= b[1] for a, b in zip(out, want))


def test_recall_at_the_threshold():
    """Pairs at a cosine of 0.95 meet in nine cases of ten at least; unlike ones hardly ever."""
    rng = np.random.default_rng(2)

    def met(cosine, n=4000):
        a, b = units(rng.normal(size=(n, 64))), rng.normal(size=(n, 64))
        b = units(b - (a * b).sum(1, keepdims=True) * a)
        k, m = cells(a), cells(cosine * a + np.sqrt(1 - cosine**2) * b)
        return ((k == m[:, :, :1]).any((1, 2)) | (m == k[:, :, :1]).any((1, 2))).mean()

    assert met(0.95) > 0.95 and met(0.97) > 0.99 and met(0.99) > 0.9995 and met(0.3) < 0.005


def test_lattice_points():
    """Decoded points are the nearest of all near ones, and belong to the lattice."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 3
    z = e8(x)
    steps = minimal_vectors()
    assert steps.shape == (240, 8) and np.allclose((steps**2).sum(1), 2)
    around = ((x[:, None] - z[:, None] - steps) ** 2).sum(2)
    assert (((x - z) ** 2).sum(1)[:, None] <= around + 1e-12).all()
    assert ((2 * z) % 2 == (2 * z[:, :1]) % 2).all() and (z.sum(1) % 2 == 0).all()


def test_edges(spark):
    one = [1.0, 2.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, one), (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (10, [-1.0, -2.0]), (11, [1e38, 2e38]), (12, [1e-38, 2e-38]), (7, one)]
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "'x' AS copy", "2 AS kept", "3 AS `a.b`")
    out = got(near_duplicate_vectors(wide))
    assert out == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
                   (7, 4, 7, True), (7, 4, 7, True), (8, 4, 7, False), (9, 0, 9, True), (10, 0, 10, True), (11, 4, 7, False), (12, 4, 7, False)]
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    none = near_duplicate_vectors(spark.createDataFrame([(None, one), (None, None), (3, one)], SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in none) == [
        ("3", 1, "3", True), ("None", 0, "None", True), ("None", 1, "3", False)]
