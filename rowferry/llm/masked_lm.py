"""Operator 7: documents scored by masked pseudo-likelihood under a bidirectional window network trained in numpy.

The network tells frequent words apart and gives all others a probability by length; a distributed table of the counts
of all words completes that to the probability of the word itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NOT_SPACE, any_names, chunks, utf8, without, word_hashes, word_spans, write_through

#: Target words are numbered class * MEMBERS + member; the last class holds all other words by their length, within
#: which ``word_counts`` tell them apart.
CLASSES = MEMBERS = 64
KNOWN = (CLASSES - 1) * MEMBERS
PAD = CLASSES * MEMBERS
SIDE = 2
WIDTH, HIDDEN = 16, 32
#: Words of an Adam step, and words scored at once.
BATCH = SCORED = 8192
ROUNDS = 2
#: Distinct words that a task holds while it counts.
HELD = 1 << 20
#: Logits up to this size need not be taken less their maxima: the product of two sums of 64 exponentials is a float.
SAFE = 30.0
#: Words beyond the vocabulary whose counts are sent to the tasks that score, and the places of their table: 16 MB.
FREQUENT, PLACES = 1 << 18, 1 << 20
#: The length of an Adam step.
RATE = 0.02
BLOCK = 4096
#: Byte values that a word may hold: no white space, and A-Z are a-z.
LETTERS = int(np.sum(NOT_SPACE)) - 26

SHAPES = {
    "embed": (PAD + 1, WIDTH), "mix": (2 * SIDE * WIDTH, HIDDEN), "mix_bias": (HIDDEN,), "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,), "words": (CLASSES, HIDDEN, MEMBERS), "word_bias": (CLASSES, MEMBERS),
}


def start_weights(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scale = {"embed": 0.1, "mix": 0.1, "classes": 0.1, "words": 0.1}
    return {k: (rng.standard_normal(shape) * scale.get(k, 0)).astype(np.float32) for k, shape in SHAPES.items()}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def shaped(vector: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = vector[at : at + size].reshape(shape)
        at += size
    return out


@dataclass
class MaskedModel:
    """The vocabulary (hashes of the KNOWN most frequent words, sorted, with their numbers) and the weights."""

    hashes: np.ndarray
    numbers: np.ndarray
    weights: dict[str, np.ndarray]

    def __post_init__(self):
        """Per first 16 bits of a hash, where hashes with these bits begin, and whether two or more of them have these."""
        starts = np.searchsorted(self.hashes, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
        self.first = np.minimum(starts, max(0, len(self.hashes) - 1))
        self.several = np.diff(starts, append=len(self.hashes)) > 1

    def ids(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Word numbers of the network; a word that is not in the vocabulary has that of its length in bytes."""
        out = KNOWN + np.minimum(sizes, MEMBERS - 1)
        if len(self.hashes):
            bits = (hashes >> np.uint64(48)).astype(np.int64)
            at = self.first.take(bits)
            known = self.hashes.take(at) == hashes
            again = np.flatnonzero(self.several.take(bits) & ~known)
            if len(again):
                at[again] = np.minimum(np.searchsorted(self.hashes, hashes[again]), len(self.hashes) - 1)
                known[again] = self.hashes[at[again]] == hashes[again]
            out = np.where(known, self.numbers.take(at), out)
        return out


def contexts(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The words on both sides of each word, PAD beyond the ends of its row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = np.full(len(ids) + SIDE * len(first), PAD)
    at = np.arange(len(ids)) + SIDE * (row + 1)
    line[at] = ids
    return np.stack([line[at + d] for d in (*range(-SIDE, 0), *range(1, SIDE + 1))], 1)


def _runs(numbers: np.ndarray) -> list[int]:
    """Where each run of equal numbers starts, and the end."""
    return [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]


def _bound(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """What no logit exceeds in size, as hidden units are within 1."""
    return (np.abs(weights).sum(-2) + np.abs(bias)).max(-1)


def _forward(w: dict[str, np.ndarray], around: np.ndarray, targets: np.ndarray):
    """The inputs and hidden units of words sorted by target; logits of the classes and, of each word's own class, of its
    members, less their maxima where they may be large; and the slices of equal class. Sorted rows make every class a slice without copying."""
    inputs = w["embed"].take(around, 0).reshape(len(targets), 2 * SIDE * WIDTH)
    hidden = inputs @ w["mix"]
    hidden += w["mix_bias"]
    np.tanh(hidden, out=hidden)
    of_class = hidden @ w["classes"]
    of_class += w["class_bias"]
    if not _bound(w["classes"], w["class_bias"]) <= SAFE:
        of_class -= of_class.max(1, keepdims=True)
    of_word = np.empty((len(targets), MEMBERS), hidden.dtype)
    kinds = targets // MEMBERS
    bounds = _runs(kinds)
    slices = [(int(kinds[a]), a, b) for a, b in zip(bounds, bounds[1:])] if len(kinds) else []
    bounds = _bound(w["words"], w["word_bias"])
    for kind, a, b in slices:
        own = of_word[a:b]
        np.matmul(hidden[a:b], w["words"][kind], out=own)
        own += w["word_bias"][kind]
        if not bounds[kind] <= SAFE:
            own -= own.max(1, keepdims=True)
    return inputs, hidden, of_class, of_word, slices


def log_probs(w: dict[str, np.ndarray], around: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """The log-probability of each word given those around it: that of its class, and of it within the class."""
    order = np.argsort(targets.astype(np.int16), kind="stable")
    targets, rows = targets[order], np.arange(len(targets))
    _, _, of_class, of_word, _ = _forward(w, around.take(order, 0), targets)
    own = of_class[rows, targets // MEMBERS] + of_word[rows, targets % MEMBERS]
    np.exp(of_class, out=of_class)
    np.exp(of_word, out=of_word)
    out = np.empty(len(targets), own.dtype)
    # Products with ones are sums, several times as fast.
    out[order] = own - np.log((of_class @ np.ones(CLASSES, own.dtype)) * (of_word @ np.ones(MEMBERS, own.dtype)))
    return out


def gradients(w: dict[str, np.ndarray], around: np.ndarray, targets: np.ndarray, g: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """Of the mean negative log-probability, by hand; in the arrays of ``g``, which hold zeros, if given."""
    n = len(targets)
    order = np.argsort(targets.astype(np.int16), kind="stable")
    around, targets, rows = around.take(order, 0), targets[order], np.arange(n)
    inputs, hidden, of_class, of_word, slices = _forward(w, around, targets)
    for logits, at in ((of_class, targets // MEMBERS), (of_word, targets % MEMBERS)):
        # From logits to the error of the softmax, in place.
        np.exp(logits, out=logits)
        logits /= (logits @ np.full(logits.shape[1], n, logits.dtype))[:, None]
        logits[rows, at] -= 1 / n
    g = {k: np.zeros_like(v) for k, v in w.items()} if g is None else g
    ones = np.ones(n, hidden.dtype)
    np.matmul(hidden.T, of_class, out=g["classes"])
    np.matmul(ones, of_class, out=g["class_bias"])
    back = of_class @ w["classes"].T
    for kind, a, b in slices:
        np.matmul(hidden[a:b].T, of_word[a:b], out=g["words"][kind])
        np.matmul(ones[a:b], of_word[a:b], out=g["word_bias"][kind])
        back[a:b] += of_word[a:b] @ w["words"][kind].T
    hidden *= hidden
    back *= np.subtract(1, hidden, out=hidden)
    np.matmul(inputs.T, back, out=g["mix"])
    np.matmul(ones, back, out=g["mix_bias"])
    spread = (back @ w["mix"].T).reshape(-1, WIDTH)
    used = around.ravel().astype(np.int16)
    order = np.argsort(used, kind="stable")
    used = used[order]
    at = _runs(used)[:-1]
    # As complex numbers two columns are added at once.
    twos = spread.take(order, 0).view(np.result_type(spread.dtype, np.complex64))
    g["embed"][used[at]] = np.add.reduceat(twos, at).view(spread.dtype)
    return g


class Adam:
    """Steps along gradients scaled by their running moments, over one flat vector."""

    def __init__(self, size: int, rate: float = RATE):
        self.rate, self.t = rate, 0
        self.mean, self.square, self.by, self.over = (np.zeros(size, np.float32) for _ in range(4))

    def step(self, vector: np.ndarray, g: np.ndarray) -> None:
        self.t += 1
        by, over = self.by, self.over
        np.subtract(g, self.mean, out=by)
        by *= 0.1
        self.mean += by
        np.multiply(g, g, out=by)
        by -= self.square
        by *= 0.01
        self.square += by
        # A plain float, as a NumPy double would turn the whole step into doubles.
        bias = math.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        np.multiply(self.mean, self.rate * bias, out=by)
        np.sqrt(self.square, out=over)
        over += 1e-8
        by /= over
        vector -= by


def _words(column: pa.Array):
    """Yield (first row, last row, hashes, sizes, first word of each row) for runs of rows."""
    data, offsets = utf8(column)
    for i, j in chunks(offsets):
        piece = data[offsets[i] : offsets[j]]
        starts, ends, first = word_spans(piece, offsets[i : j + 1] - offsets[i], NOT_SPACE)
        yield i, j, word_hashes(piece, starts, ends), ends - starts, first


def _count(batches):
    """The distinct words of a task with their counts, combined before they are handed on, ``HELD`` or more at a time."""
    held, n_held = [], 0

    def combined():
        words, sizes, counts = (np.concatenate(c) for c in zip(*held))
        words, at, back = np.unique(words, return_index=True, return_inverse=True)
        return words, sizes[at], np.bincount(back, counts, len(words)).astype(np.int64)

    def handed(words, sizes, counts):
        for at in range(0, len(words), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(words[part]), pa.array(sizes[part]), pa.array(counts[part])], names=["word", "size", "n"])

    for batch in batches:
        for _, _, hashes, sizes, _ in _words(batch.column("text")):
            words, at, counts = np.unique(hashes.view(np.int64), return_index=True, return_counts=True)
            held.append((words, sizes[at].astype(np.int32), counts))
            n_held += len(words)
            if n_held > 2 * HELD:
                held = [combined()]
                n_held = len(held[0][0])
                if n_held > HELD:
                    yield from handed(*held[0])
                    held, n_held = [], 0
    if held:
        yield from handed(*combined())


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every word of the whole table by its hash, with its length in bytes and its count: a table that grows with the
    input and stays distributed. Written once."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text")).where(F.col("text").isNotNull())
    counted = texts.mapInArrow(_count, "word long, size int, n long")
    return write_through(counted.groupBy("word").agg(F.max("size").alias("size"), F.sum("n").alias("n")), "lm-words")


def vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and numbers of the KNOWN most frequent words of the whole table, ties by hash."""
    top = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(KNOWN).select("word").collect()]
    hashes = np.array(top, np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], order.astype(np.int64)


def beyond(counts: DataFrame, model: MaskedModel) -> DataFrame:
    """The counts of the words outside the vocabulary."""
    known = counts.sparkSession.createDataFrame(pd.DataFrame({"word": model.hashes.view(np.int64)}), "word long")
    return counts.join(known, "word", "left_anti")


def class_totals(counts: DataFrame, model: MaskedModel) -> tuple[np.ndarray, np.ndarray]:
    """Per length class: occurrences of the words outside the vocabulary, and how many of these words occur once, plus
    one. The latter is what a word that was never counted may claim."""
    others = beyond(counts, model).groupBy(F.least("size", F.lit(MEMBERS - 1)).alias("kind"))
    seen, new = np.zeros(MEMBERS), np.ones(MEMBERS)
    for r in others.agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")).collect():
        seen[r.kind], new[r.kind] = r.n, 1 + r.once
    return seen, new


def frequent_words(counts: DataFrame, model: MaskedModel) -> tuple[np.ndarray, np.ndarray]:
    """A table of fixed size with words outside the vocabulary and the logarithms of their counts: a word's place is given by the first bits of
    its hash, and the most frequent word of a place has it. Empty places have a negative value.

    Candidates are the words of as many of the highest levels of counts as have ``FREQUENT`` words at most."""
    others, level = beyond(counts, model), F.floor(8 * F.log2("n"))
    least, total = None, 0
    # At most 8 * 63 rows.
    for r in sorted(others.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += r["count"]
        if total > FREQUENT:
            break
        least = r.level
    words, logs = np.zeros(PLACES, np.uint64), np.full(PLACES, -1.0)
    if least is not None:
        found = others.where(level >= least).select("word", "n").toArrow()
        hashes, n = np.asarray(found["word"]).view(np.uint64), np.asarray(found["n"])
        order = np.lexsort((hashes, n))
        at = _places(hashes[order], PLACES)
        # Of words with the same place the last one stays.
        words[at], logs[at] = hashes[order], np.log(n[order].astype(np.float64))
    return words, logs


def _places(hashes: np.ndarray, places: int) -> np.ndarray:
    return (hashes >> np.uint64(65 - places.bit_length())).astype(np.int64)


def log_share(n: Column, size: Column, totals: tuple[np.ndarray, np.ndarray]) -> Column:
    """The log-probability of a word outside the vocabulary within its length class: its share of the class by count.

    A word without a count shares what the class keeps for new words evenly with all strings of its length; in the last
    class every byte beyond the first length halves it. The shares of a class sum to one at most.
    """
    seen, new = totals
    kind = F.least(size, F.lit(MEMBERS - 1)) + 1
    by_class = [F.array(*(F.lit(float(x)) for x in per)) for per in (np.log(seen + new), np.log(new))]
    spelt = size * float(np.log(LETTERS)) + F.greatest(F.lit(0), size - (MEMBERS - 2)) * float(np.log(2))
    return F.coalesce(F.log(n.cast("double")), F.element_at(by_class[1], kind) - spelt) - F.element_at(by_class[0], kind)


def _train(shared, salts: int):
    """One pass over a task's texts from the shared weights; emits the weights times the number of words, in blocks."""

    def run(batches):
        model: MaskedModel = shared.value
        vector, total = flat(model.weights).copy(), 0
        w, adam, slope = shaped(vector), Adam(len(vector)), np.empty_like(vector)
        for batch in batches:
            for _, _, hashes, sizes, first in _words(batch.column("text")):
                ids = model.ids(hashes, sizes)
                around = contexts(ids, first)
                for at in range(0, len(ids), BATCH):
                    slope.fill(0)
                    gradients(w, around[at : at + BATCH], ids[at : at + BATCH], shaped(slope))
                    adam.step(vector, slope)
                total += len(ids)
        if total:
            parts = range(0, len(vector), BLOCK)
            sums = [(vector[at : at + BLOCK].astype(np.float64) * total).tobytes() for at in parts]
            # The root of the number of tasks, so that no group of the two levels has more rows than that.
            salt = TaskContext.get().partitionId() % salts
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array([salt] * len(sums), pa.int32()), pa.array([total] * len(sums), pa.int64()), pa.array(sums, pa.binary())],
                names=["block", "salt", "n", "weights"],
            )

    return run


def _sum_block(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float64) for x in frame["weights"])
    head = frame.iloc[0]
    return pd.DataFrame({"block": [head["block"]], "salt": [head["salt"]], "n": [frame["n"].sum()], "weights": [total.tobytes()]})


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, seed: int = 11, counts: DataFrame | None = None) -> MaskedModel:
    """A network of all words of ``docs``.

    The vocabulary comes from the word counts of the whole table, ``word_counts(docs)`` if not given. Then every text is learnt from once: a hash of the
    text deals it to one of ``rounds`` rounds, in which each task makes one pass of Adam steps over its texts of the
    round, starting from common weights; the weights of all tasks are averaged by their number of words, block by
    block and in two levels, and are the next round's start. The driver holds one model, whose size is fixed. Tables
    without words leave the weights as they start.
    """
    texts = docs.select(F.col(f"`{text_col}`").alias("text")).where(F.col("text").isNotNull())
    hashes, numbers = vocabulary(word_counts(docs, text_col) if counts is None else counts)
    weights = start_weights(seed)
    schema = "block int, salt int, n long, weights binary"
    for number in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(MaskedModel(hashes, numbers, weights))
        own = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == number)
        salts = math.isqrt(max(1, own.rdd.getNumPartitions())) + 1
        made = write_through(own.mapInArrow(_train(shared, salts), schema), "lm-weights")
        sums = made.groupBy("block", "salt").applyInPandas(_sum_block, schema).groupBy("block").applyInPandas(_sum_block, schema)
        blocks = sorted((r.block, r.n, bytes(r.weights)) for r in sums.collect())
        if blocks:
            vector = np.concatenate([np.frombuffer(x, np.float64) / n for _, n, x in blocks])
            weights = shaped(vector.astype(np.float32))
    return MaskedModel(hashes, numbers, weights)


@any_names
def score(docs: DataFrame, model: MaskedModel, text_col: str = "text", counts: DataFrame | None = None) -> DataFrame:
    """``docs`` less the text, with ``n_tokens``, ``log_prob`` (sum over its words of the log-probability given the two
    words on either side), ``mean_log_prob`` and ``perplexity``.

    With ``counts``, the ``word_counts`` of the texts learnt from, every word is scored itself: the words that the
    network knows by length only are joined with their counts (see ``log_share``), the frequent ones of them where the
    texts are read (see ``frequent_words``), all others in a join of tables. Without, these get the network's probability
    of their length, not of the word.

    NULL, empty and word-less texts have no tokens, a sum of 0 and NULL means. Repeated rows and NULL ids are rows like
    any other; columns named like added ones are replaced. An empty table gives no rows.
    """
    docs = without(docs, "n_tokens", "log_prob", "mean_log_prob", "perplexity", "_lm_row", "_lm_rest")
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if i != at]
    fields = [*(docs.schema.fields[i] for i in kept), T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType())]
    if counts is not None:
        word = T.StructType.fromDDL("word long, size int, times int")
        fields += [T.StructField("_lm_row", T.LongType()), T.StructField("_lm_rest", T.ArrayType(word))]
    schema, complete = T.StructType(fields), counts is not None
    names, shared = schema.names, docs.sparkSession.sparkContext.broadcast(model)
    if complete:
        totals = class_totals(counts, model)
        of_class, table = np.log(sum(totals)), docs.sparkSession.sparkContext.broadcast(frequent_words(counts, model))

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n_tokens, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            rest, ends, n_rest = [], np.zeros(batch.num_rows + 1, np.int32), 0
            for i, j, hashes, sizes, first in _words(batch.column(at)):
                ids = shared.value.ids(hashes, sizes)
                around = contexts(ids, first)
                logs = np.zeros(len(ids) + 1)
                for k in range(0, len(ids), SCORED):
                    logs[k + 1 : k + 1 + SCORED] = log_probs(shared.value.weights, around[k : k + SCORED], ids[k : k + SCORED])
                if complete:
                    other, (frequent, log_n) = np.flatnonzero(ids >= KNOWN), table.value
                    place = _places(hashes[other], len(frequent))
                    found = (frequent[place] == hashes[other]) & (log_n[place] >= 0)
                    at_found = other[found]
                    logs[at_found + 1] += log_n[place[found]] - of_class[ids[at_found] - KNOWN]
                    other = other[~found]
                total = np.cumsum(logs)
                n_tokens[i:j] = np.diff(first)
                sums[i:j] = total[first[1:]] - total[first[:-1]]
                if complete:
                    # Each word once for every row that has it.
                    of_row, hashes = np.searchsorted(first, other, "right") - 1, hashes[other].view(np.int64)
                    order = np.lexsort((hashes, of_row))
                    of_row, hashes, sizes = of_row[order], hashes[order], sizes[other][order]
                    new = np.ones(len(order), bool)
                    new[1:] = (of_row[1:] != of_row[:-1]) | (hashes[1:] != hashes[:-1])
                    at_new = np.flatnonzero(new)
                    times = np.diff(np.append(at_new, len(order)))
                    rest.append((hashes[at_new], sizes[at_new].astype(np.int32), times.astype(np.int32)))
                    ends[i + 1 : j + 1] = n_rest + np.searchsorted(of_row[at_new], np.arange(j - i), "right")
                    n_rest += len(at_new)
            made = [*(batch.column(c) for c in kept), pa.array(n_tokens), pa.array(sums)]
            if complete:
                columns = [np.concatenate(c) for c in zip(*rest)] if rest else [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)]
                words = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["word", "size", "times"])
                made += [pa.array(np.arange(row, row + batch.num_rows)), pa.ListArray.from_arrays(pa.array(ends), words)]
                row += batch.num_rows
            yield pa.RecordBatch.from_arrays(made, names=names)

    scored = docs.mapInArrow(run, schema)
    if complete:
        scored = write_through(scored, "lm-scores")
        words = scored.select("_lm_row", F.inline("_lm_rest")).join(counts.select("word", "n"), "word", "left")
        share = log_share(F.col("n"), F.col("size"), totals)
        shares = words.select("_lm_row", (F.col("times") * share).alias("_lm_rest"))
        sums = shares.groupBy("_lm_row").agg(F.sum("_lm_rest").alias("_lm_rest"))
        scored = scored.drop("_lm_rest").join(sums, "_lm_row", "left")
        scored = scored.withColumn("log_prob", F.col("log_prob") + F.coalesce("_lm_rest", F.lit(0.0))).drop("_lm_row", "_lm_rest")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return scored.withColumn("mean_log_prob", mean).withColumn("perplexity", F.exp(-F.col("mean_log_prob")))
