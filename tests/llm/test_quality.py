import re
from collections import Counter

import numpy as np

from rowferry.llm.quality import features, fit_votes, rate_quality

SF = "/root/testdata/sf0.1"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(runs)
    hit = {i + j for i, r in enumerate(runs) if often[r] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures(spark):
    texts = [None, "", " \n\t", "a b c d e", "a b c d e f a b c d e", "a " * 40, "x\ny\nx\n\n\n x", "# $ é\x0bü\x85w v",
             "\n".join(["a b c d e f g"] * 3), "a b c d e a b c d", "word " * 30_000 + "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[m] for m in MEASURES) for r in features(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    table = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 1500")
    got = {r.doc_id: tuple(r[m] for m in MEASURES) for r in features(table).collect()}
    assert got == {r.doc_id: brute(r.text) for r in table.collect()}


def test_agrees_with_labels(spark):
    out = rate_quality(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.999 * len(good)
    assert sum(r.kept for r in bad) <= 0.02 * len(bad)
    assert all(not r.kept for r in rows if r.base_failed)


def votes(text):
    """The eight rules, written out."""
    text = text or ""
    words = WORD.findall(text)
    n, chars, symbols, _, repeats = brute(text)
    upper, ends, distinct = sum("A" <= c <= "Z" for c in text), sum(c in ".!?" for c in text), len(set(words)) ** 2
    if not n:
        return (0,) * 8

    def vote(bad, good):
        return -1 if bad else int(good)

    return (
        vote(chars > 14 * n or chars < 2 * n, 3 * n <= chars <= 11 * n), vote(symbols * 10 > n, symbols * 50 < n), vote(symbols * 25 > chars, symbols * 100 < chars),
        vote(upper * 2 > chars, upper * 5 < chars), vote(repeats * 5 > n, repeats * 20 < n), vote(n >= 20 and distinct < 4 * n, n < 20 or distinct > 8 * n),
        vote(n >= 40 and ends * 80 < n, ends * 40 >= n), vote(ends * 2 > n + 4, ends * 3 <= n + 4),
    )


def posteriors(rows, rounds=200):
    """EM over all rows at once: class 0 is good, class r + 1 breaks rule r."""
    v = np.array(rows)
    n, rules = v.shape
    chance = np.empty((rules + 1, rules, 3))
    chance[:] = [0.15, 0.1, 0.75]
    chance[0] = [0.02, 0.08, 0.9]
    for r in range(rules):
        chance[r + 1, r] = [0.9, 0.05, 0.05]
    share = np.array([0.9] + [0.1 / rules] * rules)

    def resolve():
        logs = np.log(share)[None] + sum(np.log(chance[:, r, :])[:, v[:, r] + 1].T for r in range(rules))
        each = np.exp(logs - logs.max(1, keepdims=True))
        return each / each.sum(1, keepdims=True)

    for _ in range(rounds):
        part = resolve()
        new = (1 + part.sum(0)) / (1 + part.sum(0)).sum()
        for r in range(rules):
            seen = 1 + np.stack([part[v[:, r] == x].sum(0) for x in (-1, 0, 1)], 1)
            chance[:, r] = seen / seen.sum(1, keepdims=True)
        done, share = np.abs(new - share).max() < 1e-9, new
        if done:
            break
    return resolve()[:, 0]


def test_verdicts_against_a_loop(spark):
    """Posterior and verdict of every document of a whole table, from rules and EM written anew."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = dict(zip(texts, posteriors([votes(t) for t in texts.values()])))
    out = rate_quality(docs).collect()
    assert len(out) == len(texts) and any(not r.kept and not r.base_failed for r in out)
    for r in out:
        n, *_, repeats = brute(r.text)
        failed = n < 10 or 100 * repeats > 20 * n
        assert abs(r.posterior - want[r.doc_id]) < 1e-6 and r.base_failed == failed and r.kept == (not failed and want[r.doc_id] >= 0.5)


def test_em_finds_planted_accuracy():
    """Two rules that mostly agree on a fault and one that votes by chance."""
    patterns = [((1, 1, 1), 850), ((1, 1, -1), 50), ((-1, -1, 1), 80), ((-1, -1, -1), 6), ((-1, 1, 1), 7), ((1, -1, 1), 7)]
    model = fit_votes(patterns)
    assert model.posterior((1, 1, 1)) > 0.95 and model.posterior((-1, -1, 1)) < 0.05 and model.posterior((1, 1, -1)) > 0.5


def test_edges(spark):
    assert rate_quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, None, "x"), (1, "short", "y"), (None, "a b c d e f g h i j k.", "z")], "doc_id long, text string, kept string")
    rows = rate_quality(docs).collect()
    assert [r.kept for r in rows][:2] == [False, False] and len(rows) == 3 and rows[0].text is None
