"""Words beyond the network's vocabulary are scored by their own counts."""

import random

import numpy as np

from rowferry.llm import common
from rowferry.llm import masked_lm as lm
from rowferry.llm.queries import op7_masked_lm

SF = "/root/testdata/sf0.01"


def spans(text):
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = lm.word_spans(data, np.array([0, len(data)]), lm.NOT_SPACE)
    return lm.word_hashes(data, starts, ends), ends - starts


def test_every_word_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 300")
    texts = [r.text for r in docs.collect()]
    counts = lm.word_counts(docs)
    model = lm.train(docs, counts=counts)
    n_of = {}
    for text in texts:
        for word in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split():
            n_of[word] = n_of.get(word, 0) + 1
    assert {r.n for r in counts.select("n").collect()} == set(n_of.values()) and counts.count() == len(n_of)
    known = set(model.hashes.tolist())
    hashed = {w: int(spans(w.decode())[0][0]) for w in n_of}
    seen, new = [0] * 64, [1] * 64
    for word, n in n_of.items():
        if hashed[word] not in known:
            seen[min(63, len(word))] += n
            new[min(63, len(word))] += n == 1
    assert sum(seen) > 0
    rows = [(k, t) for k, t in enumerate(texts[:40])] + [(40, "zqxvzqxv " * 3), (41, "z" * 70), (42, None), (None, texts[0]), (None, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = {r.doc_id: r.log_prob for r in lm.score(frame, model).collect()}
    out = lm.score(frame, model, counts=counts).collect()
    assert len(out) == len(rows) and sum(r.doc_id is None for r in out) == 2
    by_id = dict(rows[:43]) | {None: texts[0]}
    for r in out:
        total = 0.0
        for word in (by_id[r.doc_id] or "").translate({c: c + 32 for c in range(65, 91)}).encode().split():
            kind = min(63, len(word))
            if word not in n_of:
                spelt = len(word) * np.log(256 - 6 - 26) + max(0, len(word) - 62) * np.log(2)
                total += np.log(new[kind] / (seen[kind] + new[kind])) - spelt
            elif hashed[word] not in known:
                total += np.log(n_of[word] / (seen[kind] + new[kind]))
        assert abs(r.log_prob - plain[r.doc_id] - total) < 1e-3 + 1e-6 * abs(total), r.doc_id


def test_random_strings_are_less_likely_than_text(spark, tmp_path):
    """Strings of letters of the lengths of a text's words; the network alone knows them by length only."""
    rng = random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 600 and length(text) > 500")
    texts = {r.doc_id: r.text for r in docs.limit(100).collect()}
    made = [(-1 - k, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in w) for w in t.split())) for k, t in texts.items()]
    docs.union(spark.createDataFrame(made, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r.mean_log_prob for r in op7_masked_lm(spark, str(tmp_path)).collect()}
    assert all(out[k] > out[-1 - k] for k in texts)


def test_frequent_words_are_scored_where_texts_are_read(spark, monkeypatch):
    """The table of frequent words changes no score, and what it holds is not joined."""
    rng = random.Random(2)
    common = [f"c{i}" for i in range(lm.KNOWN + 400)]
    rows = [(k, " ".join([*rng.sample(common, 1500), *common[-40:], f"rare{k}"])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counts = lm.word_counts(docs)
    model = lm.train(docs, counts=counts)
    more = docs.union(spark.createDataFrame([(40, "never seen c1 c2 " * 3), (41, None)], docs.schema))
    written = []
    monkeypatch.setattr(lm, "write_through", lambda df, label, write=lm.write_through: written.append((label, write(df, label))) or written[-1][1])

    def scored(frequent, places):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        monkeypatch.setattr(lm, "PLACES", places)
        out = {r.doc_id: r.log_prob for r in lm.score(more, model, counts=counts).collect()}
        return out, [df for label, df in written if label == "lm-scores"][-1].selectExpr("sum(size(_lm_rest)) n").first().n

    (none, joined), (some, fewer), (all_, least) = scored(0, 1 << 8), scored(200, 1 << 8), scored(1 << 18, 1 << 20)
    assert joined > fewer > least >= 2
    for k, want in none.items():
        assert abs(some[k] - want) < 1e-6 and abs(all_[k] - want) < 1e-6
    words, logs = lm.frequent_words(counts, model)
    n_of = {r.word: r.n for r in lm.beyond(counts, model).collect()}
    kept = np.flatnonzero(logs >= 0)
    assert len(kept) > 0.98 * len(n_of)
    assert all(abs(logs[k] - np.log(n_of[int(words[k].astype(np.int64))])) < 1e-12 for k in kept.tolist())


def test_numbers_of_words_whose_hashes_begin_alike(monkeypatch):
    rng = np.random.default_rng(4)
    hashes = np.unique(np.concatenate([rng.integers(0, 2**64, 300, np.uint64), (np.uint64(7) << np.uint64(48)) + rng.integers(0, 2**40, 30, np.uint64), np.array([0, 2**64 - 1], np.uint64)]))
    known, numbers = hashes[::2], rng.permutation(len(hashes[::2]))
    model = lm.MaskedModel(known, numbers, {})
    sizes = rng.integers(1, 100, len(hashes))
    number = dict(zip(known.tolist(), numbers.tolist()))
    want = [number.get(h, lm.KNOWN + min(n, lm.MEMBERS - 1)) for h, n in zip(hashes.tolist(), sizes.tolist())]
    assert model.several.sum() >= 1 and model.ids(hashes, sizes).tolist() == want
    assert lm.MaskedModel(known[:0], numbers[:0], {}).ids(hashes[:1], sizes[:1]).tolist() == [lm.KNOWN + min(int(sizes[0]), lm.MEMBERS - 1)]
    assert lm.MaskedModel(known[:1], np.array([5]), {}).ids(known, np.ones(len(known), np.int64)).tolist() == [5] + [lm.KNOWN + 1] * (len(known) - 1)


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    """Words are hashed in pieces of a fixed number of bytes, far fewer than those of a chunk of rows."""
    text = " ".join(random.Random(3).choices(["a", "Bc", "déf", "w" * 200], k=3000)).encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]), common.NOT_SPACE)
    got = common.word_hashes(data, starts, ends)
    for piece in (1, 100, 1 << 30):
        monkeypatch.setattr(common, "PIECE", piece)
        assert (common.word_hashes(data, starts, ends) == got).all()
    assert len(set(got.tolist())) == 4
