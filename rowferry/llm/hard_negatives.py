"""Operator 12: hard negatives by anchor-clustered shared lists with certified termination."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_through
from .vectors import matrices, usable

#: Steps per unit of a component, and the bound of the integers.
STEPS, BOUND = 256, 1 << 25
#: Anchors and rows that one task holds at most, about; fewest rows worth a task.
ANCHORS, ROWS, FEW = 1 << 15, 1 << 17, 1 << 11
#: Anchors that the clusters are fitted on, anchors per cluster there, and clusters at most.
SAMPLE, PER_CLUSTER, CLUSTERS = 2048, 16, 32
#: Rows of a list that are scored at once: the first step and the largest one.
STEP, STEPS_MOST = 256, 4096
#: Members that walk together.
TOGETHER = 512

_FOUND = "anchor long, at int, score long, id long, row long"


def _integers(batches):
    """Numbers the rows and adds their vectors as integers, floor(256 x); rows that take no part are dropped."""
    task, row = TaskContext.get().partitionId(), 0
    for batch in batches:
        column = batch.column("vec")
        good = usable(column) & ~np.asarray(batch.column("label").is_null()) & ~np.asarray(batch.column("id").is_null())
        raw, dims = [None] * batch.num_rows, np.zeros(batch.num_rows, np.int32)
        for at, values in matrices(column, np.flatnonzero(good)):
            whole = np.clip(np.floor(values * STEPS), -BOUND, BOUND).astype(np.int32)
            dims[at] = whole.shape[1]
            for i, v in zip(at, whole):
                raw[i] = v.tobytes()
        number = (np.int64(task) << 40) + np.arange(row, row + batch.num_rows)
        row += batch.num_rows
        made = [pa.array(raw, pa.binary()), pa.array(dims), pa.array(number)]
        out = pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), batch.column("anchor"), *made], names=["id", "label", "anchor", "vec", "dim", "row"])
        yield out.filter(pa.array(good))


def matrix(raw) -> np.ndarray:
    """Vectors of one length as integers."""
    raw = list(raw)
    return np.frombuffer(b"".join(raw), np.int32).reshape(len(raw), -1)


def fitted(raw: list[bytes], seed: int = 5) -> np.ndarray:
    """Unit centres of clusters of anchors, by a few rounds of spherical k-means."""
    x = matrix(raw).astype(float)
    x = x[np.linalg.norm(x, axis=1) > 0]
    if not len(x):
        return np.zeros((0, x.shape[1]))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    k = max(1, min(CLUSTERS, len(x) // PER_CLUSTER))
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(8):
        near = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles where all sums are small enough, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**52:
        return a.astype(float) @ b.astype(float).T
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The first ``k`` rows of each slot, by falling score, then rising id and row number."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # slot, score, id, row
        self.last = np.full(slots, -np.inf)  # the score that a row must reach now

    def offer(self, slot, score, id_, row):
        if not len(slot):
            return
        slot, score, id_, row = (np.concatenate([h, x]) for h, x in zip(self.held, (slot, score.astype(np.int64), id_, row)))
        order = np.lexsort((row, id_, -score, slot))
        slot = slot[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = order[place < self.k]
        self.held = [slot[place < self.k], score[kept], id_[kept], row[kept]]
        full = place == self.k - 1
        self.last[slot[full]] = score[order[full]]


def walk(scores_of, bounds: np.ndarray, lengths: np.ndarray, need, offer) -> int:
    """Members walk one list, sorted by falling ``bounds``, in steps; each stops once the bound, times its own length,
    is below what it needs. Returns how many scores were made.

    ``scores_of(members, start, stop)`` gives exact scores; ``need()`` the least score, per member, that still counts;
    ``offer(members, start, stop, scores)`` takes them.
    """
    active, start, step, made = np.arange(len(lengths)), 0, STEP, 0
    while start < len(bounds):
        # The product of two rounded lengths and a cosine: a relative slack, and one step for zero.
        reach = lengths[active] * bounds[start]
        active = active[reach + np.abs(reach) * 1e-9 + 1e-6 >= need()[active]]
        if not len(active):
            break
        stop = min(len(bounds), start + step)
        offer(active, start, stop, scores_of(active, start, stop))
        made += len(active) * (stop - start)
        start, step = stop, min(2 * step, STEPS_MOST)
    return made


def bound_lists(members: np.ndarray, rows: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' order by falling bound for a cluster, and these bounds for a member of length 1.

    A row at angle t from the centre is at least t - w away from members within w of it, so a member's inner product
    with it is at most both lengths times cos(max(0, t - w)).
    """
    def angles(x):
        length = np.linalg.norm(x, axis=1)
        return length, np.arccos(np.clip(x @ centre / np.where(length > 0, length, 1), -1, 1))

    length, turn = angles(rows)
    own, spread = angles(members)
    wide = spread[own > 0].max(initial=0.0)
    bound = length * np.cos(np.maximum(0, turn - wide - 1e-7))
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def clusters(anchors: np.ndarray, centres: np.ndarray | None):
    """The anchors' places, cluster by cluster, with the centre."""
    if centres is None or not len(centres):
        yield np.arange(len(anchors)), np.zeros(anchors.shape[1])
        return
    near = (anchors.astype(float) @ centres.T).argmax(1)
    for c in np.unique(near):
        yield np.flatnonzero(near == c), centres[c]


def _result(anchors: pd.DataFrame, found: list) -> pd.DataFrame:
    """found: (anchor place, at, score, id, row) arrays."""
    place, at, score, id_, row = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 5))
    return pd.DataFrame({"anchor": anchors["row"].to_numpy()[place.astype(np.int64)], "at": at.astype(np.int32), "score": score, "id": id_, "row": row})


def _positives(centres: dict, k: int):
    """Best rows of the anchor's own label in one slice."""

    def find(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if not len(anchors) or not len(rows):
            return _result(anchors, found)
        a, b = matrix(anchors["vec"]), matrix(rows["r_vec"])
        a_label, b_label, b_row, b_id = (x.to_numpy() for x in (anchors["label"], rows["r_label"], rows["r_row"], rows["r_id"]))
        a_row = anchors["row"].to_numpy()
        by_label = np.argsort(b_label, kind="stable")
        for members, centre in clusters(a, centres.get(a.shape[1])):
            for label in np.unique(a_label[members]):
                own = members[a_label[members] == label]
                low, high = np.searchsorted(b_label[by_label], [label, label + 1])
                some = by_label[low:high]
                order, bounds = bound_lists(a[own].astype(float), b[some].astype(float), centre)
                some = some[order]
                for first in range(0, len(own), TOGETHER):
                    found.append(nearest(a, b, a_row, b_row, b_id, own[first : first + TOGETHER], some, bounds))
        return _result(anchors, found)

    def nearest(a, b, a_row, b_row, b_id, own, some, bounds):
        best = Best(len(own), k)

        def offer(active, start, stop, scores):
            at = some[start:stop]
            i, j = np.nonzero((scores >= best.last[active][:, None]) & (b_row[at][None] != a_row[own[active]][:, None]))
            best.offer(active[i], scores[i, j], b_id[at[j]], b_row[at[j]])

        lengths = np.linalg.norm(a[own].astype(float), axis=1)
        walk(lambda m, s, e: products(a[own[m]], b[some[s:e]]), bounds, lengths, lambda: best.last, offer)
        slot, score, id_, row = best.held
        return own[slot], np.zeros(len(slot), np.int64), score, id_, row

    return find


def _negatives(centres: dict, k: int, band: tuple[int, int]):
    """Best rows of other labels within each positive's band in one slice."""

    def find(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if not len(anchors) or not len(rows):
            return _result(anchors, found)
        a, b = matrix(anchors["vec"]), matrix(rows["r_vec"])
        a_label, b_label, b_row, b_id = (x.to_numpy() for x in (anchors["label"], rows["r_label"], rows["r_row"], rows["r_id"]))
        most = max(len(s) for s in anchors["scores"])
        for members, centre in clusters(a, centres.get(a.shape[1])):
            order, bounds = bound_lists(a[members].astype(float), b.astype(float), centre)
            for first in range(0, len(members), TOGETHER):
                some = members[first : first + TOGETHER]
                allowed = limits([anchors["scores"].iat[m] for m in some], most)
                found.append(within(a, b, a_label, b_label, b_row, b_id, some, order, bounds, *allowed))
        return _result(anchors, found)

    def limits(scores, most):
        """Scores allowed for each positive; a missing one allows none."""
        low, high = np.full((len(scores), most), np.inf), np.full((len(scores), most), -np.inf)
        for i, s in enumerate(scores):
            s = np.asarray(s, np.int64)
            low[i, : len(s)], high[i, : len(s)] = -(-band[0] * s // 100), band[1] * s // 100
        low[low > high] = np.inf
        return low, high

    def within(a, b, a_label, b_label, b_row, b_id, some, order, bounds, low, high):
        most = low.shape[1]
        best = Best(low.size, k)

        def need():
            return np.maximum(low, best.last.reshape(low.shape)).min(1)

        def offer(active, start, stop, scores):
            at = order[start:stop]
            other = b_label[at][None] != a_label[some[active]][:, None]
            last = best.last.reshape(low.shape)
            for p in range(most):
                least = np.maximum(low[active, p], last[active, p])
                i, j = np.nonzero(other & (scores >= least[:, None]) & (scores <= high[active, p][:, None]))
                best.offer(active[i] * most + p, scores[i, j], b_id[at[j]], b_row[at[j]])

        lengths = np.linalg.norm(a[some].astype(float), axis=1)
        walk(lambda m, s, e: products(a[some[m]], b[order[s:e]]), bounds, lengths, need, offer)
        slot, score, id_, row = best.held
        return some[slot // most], slot % most, score, id_, row

    return find


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k of the slices' best; all but k of each task go before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90),
                   anchors_most: int = ANCHORS, rows_most: int = ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(256 x), held within +-2**25; a score is an inner product of these integers, exactly. An
    anchor's positives are its first rows of the same label, by falling score, then id; its hard negatives for a
    positive the first rows of other labels whose score is within ``band`` per cent of the positive's.

    ``anchors`` is a condition on the rows. Anchors and rows form a grid: a task has some of the anchors (fewer than
    2**15) and a slice of the rows (2**17 at most), so the join is in blocks, of stated queries with all rows. In a task
    the anchors are clustered around centres, fitted once on a sample of 2,048 anchors at most (which changes how far
    lists are walked, not what is found). For each cluster the slice is sorted once by an upper bound of the inner
    products, from the angle to the centre and the cluster's widest angle; every member walks that list until the bound
    certifies that nothing behind it can enter its best or the band. The slices' best meet in a ranking that is pruned
    before its shuffle. The outcome is exact.

    Rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part; vectors of different
    lengths never meet. Rows that repeat an id are rows of their own, ordered by their place in the table. A positive
    score below 0 has an empty band. Other columns are not read. An empty table, or no anchors, gives no rows.
    """
    spark = rows.sparkSession
    q = lambda c: F.col(f"`{c}`")
    named = rows.select(q(id_col).cast("long").alias("id"), q(label_col).cast("long").alias("label"),
                        F.coalesce(anchors, F.lit(False)).alias("anchor"), q(vec_col).alias("vec"))
    table = write_through(named.mapInArrow(_integers, "id long, label long, anchor boolean, vec binary, dim int, row long"), "negatives-rows")
    n, n_anchors = table.agg(F.count("*"), F.count_if("anchor")).first()
    groups = max(1, math.ceil(n_anchors / anchors_most))
    slices = max(1, math.ceil(n / rows_most), min(math.ceil(n / FEW), 2 * spark.sparkContext.defaultParallelism))

    taken = table.where("anchor").select("dim", "vec").orderBy(F.xxhash64("row")).limit(SAMPLE).collect()
    centres = {d: fitted([r["vec"] for r in taken if r["dim"] == d]) for d in {r["dim"] for r in taken}}

    def grid(left: DataFrame, find) -> DataFrame:
        left = left.withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int"))
        left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
        # Both sides may come from one table; names of their own keep their columns apart.
        right = table.select("id", "label", "vec", "row", "dim").toDF("r_id", "r_label", "r_vec", "r_row", "r_dim")
        right = right.withColumn("r_slice", F.pmod(F.xxhash64("r_row"), F.lit(slices)).cast("int"))
        right = right.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("r_part"))
        both = left.groupBy("dim", "part", "slice").cogroup(right.groupBy("r_dim", "r_part", "r_slice"))
        return both.applyInPandas(find, _FOUND)

    own = table.where("anchor").select("id", "label", "vec", "dim", "row")
    nearest = _first(grid(own, _positives(centres, positives)), ["anchor"], positives)
    nearest = write_through(nearest.select("anchor", "rank", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "negatives-positives")
    lists = nearest.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "positive_score"))), lambda s: s["positive_score"]).alias("scores"))
    asked = own.join(lists, F.col("row") == F.col("anchor")).select("id", "label", "vec", "dim", "row", "scores")
    found = _first(grid(asked, _negatives(centres, negatives, band)), ["anchor", "at"], negatives)
    found = found.select("anchor", (F.col("at") + 1).alias("which"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = own.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = nearest.withColumnRenamed("rank", "which").join(names, "anchor")
    return found.join(pairs, ["anchor", "which"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
