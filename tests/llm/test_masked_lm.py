import random

import numpy as np
import pytest

from rowferry.llm import masked_lm as lm

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def model(docs):
    return lm.train(docs.where("doc_id % 5 > 0 and doc_id < 4000").repartition(3))


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    w = {k: rng.standard_normal(s) * 0.3 for k, s in lm.SHAPES.items()}
    around, targets = rng.integers(0, lm.PAD + 1, (7, 4)), rng.integers(0, lm.PAD, 7)
    targets[1] = targets[0]
    around[2] = around[3]
    g = lm.gradients(w, around, targets)
    places = {"embed": (around[2, 1], 3), "mix": (5, 6), "mix_bias": (4,), "classes": (3, targets[0] // 64), "class_bias": (9,),
              "words": (targets[0] // 64, 2, 5), "word_bias": (targets[0] // 64, targets[0] % 64)}
    for name, at in places.items():
        kept, ends = w[name][at], []
        for d in (1e-5, -1e-5):
            w[name][at] = kept + d
            ends.append(-lm.log_probs(w, around, targets).mean())
        w[name][at] = kept
        assert abs((ends[0] - ends[1]) / 2e-5 - g[name][at]) < 1e-6, name


def test_maxima_are_taken_where_logits_are_large_only(monkeypatch):
    rng = np.random.default_rng(1)
    around, targets = rng.integers(0, lm.PAD + 1, (500, 4)), rng.integers(0, lm.PAD, 500)
    small = {k: (rng.standard_normal(s) * 0.2).astype(np.float32) for k, s in lm.SHAPES.items()}
    steep = {k: v * 500 if k in ("classes", "words") else v for k, v in small.items()}
    assert lm._bound(small["words"], small["word_bias"]).max() < lm.SAFE < lm._bound(steep["words"], steep["word_bias"]).min()
    assert lm._forward(small, around, targets)[2].max(1).min() > 0 and lm._forward(steep, around, targets)[2].max() == 0
    got, far = lm.log_probs(small, around, targets), lm.log_probs(steep, around, targets)
    assert np.isfinite(far).all() or far.min() == -np.inf and not np.isnan(far).any()
    monkeypatch.setattr(lm, "SAFE", -1.0)
    assert np.allclose(got, lm.log_probs(small, around, targets), atol=1e-4)
    monkeypatch.undo()


def test_probabilities_sum_to_one():
    w = lm.start_weights()
    around = np.repeat([[1, 2, 3, lm.PAD]], lm.PAD, 0)
    assert abs(np.exp(lm.log_probs(w, around, np.arange(lm.PAD))).sum() - 1) < 1e-4


def test_scores_against_brute_force(spark, docs, model):
    some = docs.where("doc_id in (0, 5, 10, 4001)")
    texts = {r.doc_id: r.text for r in some.collect()}
    for r in lm.score(some, model).collect():
        words = texts[r.doc_id].translate({c: c + 32 for c in range(65, 91)}).encode().split()
        data = np.frombuffer(b" ".join(words), np.uint8)
        starts, ends, _ = lm.word_spans(data, np.array([0, len(data)]), lm.NOT_SPACE)
        ids = model.ids(lm.word_hashes(data, starts, ends), ends - starts).tolist()
        total = 0.0
        for i, target in enumerate(ids):
            near = [ids[j] if 0 <= j < len(ids) else lm.PAD for j in (i - 2, i - 1, i + 1, i + 2)]
            total += float(lm.log_probs(model.weights, np.array([near]), np.array([target]))[0])
        assert r.n_tokens == len(words) and abs(r.log_prob - total) < 1e-3 * len(words)


def test_held_out(spark, docs, model):
    """Texts that were not learnt from are likelier than their shuffled words, and than under word frequencies alone."""
    held = docs.where("doc_id % 5 = 0 and doc_id < 4000 and length(text) > 500").limit(300).collect()
    rng = random.Random(0)
    rows = []
    for r in held:
        words = r.text.split()
        rng.shuffle(words)
        rows += [(r.doc_id, r.text), (-1 - r.doc_id, " ".join(words))]
    out = {r.doc_id: r.mean_log_prob for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    real, mixed = [out[r.doc_id] for r in held], [out[-1 - r.doc_id] for r in held]
    assert np.mean(real) > np.mean(mixed)
    counts = np.ones(lm.PAD)
    all_ids = []
    for r in docs.where("doc_id % 5 > 0 and doc_id < 4000").collect():
        data = np.frombuffer(r.text.encode(), np.uint8)
        starts, ends, _ = lm.word_spans(data, np.array([0, len(data)]), lm.NOT_SPACE)
        np.add.at(counts, model.ids(lm.word_hashes(data, starts, ends), ends - starts), 1)
    for r in held:
        data = np.frombuffer(r.text.encode(), np.uint8)
        starts, ends, _ = lm.word_spans(data, np.array([0, len(data)]), lm.NOT_SPACE)
        all_ids.append(np.log(counts / counts.sum())[model.ids(lm.word_hashes(data, starts, ends), ends - starts)].mean())
    assert np.mean(real) > np.mean(all_ids)


def test_edges(spark, model):
    rows = [(1, None, 1.0), (1, "", 2.0), (None, " \n", 3.0), (2, "the", 4.0), (3, "the " * 300_000, 5.0)]
    out = lm.score(spark.createDataFrame(rows, "doc_id long, text string, log_prob double"), model).collect()
    assert [r.n_tokens for r in out] == [0, 0, 0, 1, 300_000]
    assert out[0].log_prob == 0 and out[0].mean_log_prob is None and out[3].log_prob < 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty, lm.train(empty)).count() == 0
