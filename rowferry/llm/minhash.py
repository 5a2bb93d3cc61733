"""Operator 8: near-duplicates by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (
    ASCII_LOWER, NOT_SPACE, any_names, chunks, gram_hashes, mix, small_batches, utf8, without, word_hashes, word_spans, write_through,
)

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 4
#: Bands whose buckets are compared with one of their nodes in a round.
ROUND = 8
#: Values that the permutations rearrange; shingles are dealt to them by hash.
DOMAIN = 1 << 20
#: Cells in which shingles are counted together by hash: 4 MB.
CELLS = 1 << 20
#: A bucket of more classes than this is not compared pair by pair.
SMALL_BUCKET = 32

#: Pairs whose texts are unpacked together.
UNPACKED = 256

_LOWER = ASCII_LOWER.tobytes()

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def permutations(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The two permutations of the domain. The second is repeated at its end, so that a shift is a slice."""
    if seed not in _tables:
        rng = np.random.default_rng(seed)
        first = rng.permutation(DOMAIN).astype(np.int32)
        second = rng.permutation(DOMAIN).astype(np.int32)
        _tables[seed] = first, np.concatenate([second, second[: BANDS * ROWS]])
    return _tables[seed]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of the second permutation, shifted by k places, over the
    shingles' places in the first. One slice of the table has all coordinates of a shingle."""
    first, second = permutations()
    places = first[(shingles & np.uint64(DOMAIN - 1)).astype(np.int64)]
    rows = np.lib.stride_tricks.sliding_window_view(second, BANDS * ROWS)
    out = rows[places[:512]].min(0)
    for i in range(512, len(places), 512):
        np.minimum(out, rows[places[i : i + 512]].min(0), out=out)
    return out


def bands(signature_: np.ndarray) -> np.ndarray:
    """A 64-bit key per band."""
    keys = np.zeros(BANDS, np.uint64)
    values = signature_.reshape(BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        keys = mix(keys + values[:, r] + np.uint64(1))
    return mix(keys ^ (np.arange(BANDS, dtype=np.uint64) << np.uint64(56))).view(np.int64)


def shingle_sets(texts: pa.Array):
    """Yield, per row, the sorted distinct 64-bit shingles of its words; fewer words than a shingle are one together."""
    data, offsets = utf8(texts)
    for i, j in chunks(offsets):
        piece = ASCII_LOWER[data[offsets[i] : offsets[j]]]
        starts, ends, first = word_spans(piece, offsets[i : j + 1] - offsets[i], NOT_SPACE)
        words = word_hashes(piece, starts, ends, False)
        grams = gram_hashes(words, SHINGLE)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= SHINGLE:
                yield np.unique(grams[a : b - SHINGLE + 1])
            elif b > a:
                yield gram_hashes(words[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def _sketches(text_at: int, names: list[str]):
    """Adds the row's number, the digest of its words (NULL without any), its shingles, bands' keys and the low bytes
    of the signature."""

    def make(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            copies, sizes, keys, low = [], [], [], []
            for text in batch.column(text_at):
                words = (text.as_py() or "").encode().translate(_LOWER).split()
                copies.append(hashlib.md5(b" ".join(words)).digest() if words else None)
            for shingles in shingle_sets(batch.column(text_at)):
                sizes.append(len(shingles))
                full = signature(shingles) if len(shingles) else np.zeros(BANDS * ROWS, np.int32)
                keys.append(bands(full))
                low.append(full.astype(np.uint8).tobytes())
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(flat))
            rows = (np.int64(task) << 40) + np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows), pa.array(copies, pa.binary()), pa.array(sizes, pa.int64()), lists, pa.array(low, pa.binary())],
                names=names,
            )

    return make


def _sets(batches):
    for batch in batches:
        made = [s.view(np.int64) for s in shingle_sets(batch.column("text"))]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in made])]).astype(np.int32)
        flat = np.concatenate(made) if made else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], names=["node", "shingles"]
        )


def _sketch_cells(shingles: np.ndarray) -> np.ndarray:
    """The cells that count these shingles."""
    return (mix(shingles.view(np.uint64)) & np.uint64(CELLS - 1)).astype(np.int64)


def _count_shingles(batches):
    """How many of the task's shingles fall into each cell."""
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        flat = np.asarray(batch.column("shingles").flatten())
        if len(flat):
            counts += np.bincount(_sketch_cells(flat), minlength=CELLS)
    used = np.flatnonzero(counts)
    for i in range(0, len(used), 1 << 16):
        some = used[i : i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["cell", "n"])


def _rarest_first(shared):
    """The sizes of sets and their rarest shingles, as many as can be the first that two similar sets share."""

    def cut(batches):
        sketch = shared.value
        for batch in batches:
            sizes, prefixes = [], []
            for shingles in batch.column("shingles"):
                values = np.asarray(shingles.values)
                n = len(values)
                seen = sketch[_sketch_cells(values)]
                sizes.append(n)
                prefixes.append(values[np.lexsort((values, seen))][: n + (-PERCENT * n // 100) + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))], names=["node", "n", "prefix"])

    return cut


def _alike(batches):
    """Pairs whose signatures agree in half of the coordinates; at the threshold three quarters do, within a few hundredths."""
    for batch in batches:
        n = batch.num_rows
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, -1) for c in ("a_low", "b_low"))
        yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(1) >= 0.5) if n else pa.array([], pa.bool_()))


def _packed(batches):
    for batch in batches:
        packed = [zlib.compress(x.as_buffer(), 1) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], names=["node", "text"])


def _similar(batches):
    """The pairs whose full sets reach the threshold. Rows come sorted by ``b``, whose set is made once for a run of them.
    A few texts at a time are unpacked."""
    for batch in batches:
        keep = []
        for part in (batch.slice(i, UNPACKED) for i in range(0, batch.num_rows, UNPACKED)):
            b = np.asarray(part.column("b"))
            new = np.ones(len(b), bool)
            new[1:] = b[1:] != b[:-1]
            ones, others = (
                shingle_sets(pa.array([zlib.decompress(x.as_buffer()) for x in texts], pa.large_binary()))
                for texts in (part.column("a_text"), part.column("b_text").filter(pa.array(new)))
            )
            other = None
            for one, begins in zip(ones, new.tolist()):
                if begins:
                    other = next(others)
                shared = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * shared >= PERCENT * (len(one) + len(other) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of the edges (a, b): the least node that can be reached.

    Labels spread to neighbours and jump to the label's own label, so the rounds grow with the logarithm of the longest
    path. Each round is written, and only counts of changed labels reach the driver.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = write_through(edges.select(F.inline(ways)), "near-edges")
    labels = both.groupBy("a").agg(F.min("b").alias("other"))
    labels = write_through(labels.select(F.col("a").alias("node"), F.least("a", "other").alias("label")), "near-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        top = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        jumped = spread.join(top, "label").select("node", "old", F.least("label", "top").alias("label"))
        jumped = write_through(jumped, "near-labels")
        labels = jumped.select("node", "label")
        if not jumped.where("label <> old").limit(1).count():
            return labels


class NearDuplicates:
    """The steps of the operator over one written table of sketches."""

    def __init__(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", small_bucket: int = SMALL_BUCKET,
                 broadcast_rows: int = 4_000_000, stars: int = 2):
        self.small_bucket, self.broadcast_rows, self.stars = small_bucket, broadcast_rows, stars
        self.text_col, self.id_col = text_col, id_col
        docs = without(docs, "n_shingles", "component_id", "kept", "_row", "_copy", "_bands", "_low", "_stays")
        self.columns = docs.columns
        fields = "_row long, _copy binary, n_shingles long, _bands array<long>, _low binary"
        schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(fields).fields])
        made = docs.mapInArrow(_sketches(docs.columns.index(text_col), schema.names), schema)
        self.rows = write_through(made, "near-sketches")
        doc_id = F.col(f"`{id_col}`")
        first = F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.col("_row").alias("row")))
        classes = self.rows.where(F.col("_copy").isNotNull()).groupBy("_copy").agg(first.alias("first"), F.count("*").alias("n"))
        #: One row per class of equal word sequences: its digest, its first row, which is the node, that row's id, its size.
        self.classes = write_through(
            classes.select("_copy", F.col("first.row").alias("node"), F.col("first.id").alias("id"), "n"), "near-classes"
        )
        #: Pairs whose full sets were compared, for each time that some were.
        self.compared: list[DataFrame] = []

    def nodes(self) -> DataFrame:
        """The rows that are nodes. Other rows of their classes are sent to the rows where they are few, so that the bands'
        keys stay where they are."""
        with_words = self.rows.where(F.col("_copy").isNotNull())
        repeated = self.classes.where("n > 1").select("_copy", "node")
        others = with_words.select("_copy", "_row").join(repeated, "_copy").where("_row <> node").select("_row")
        others = write_through(others, "near-others")
        if others.count() <= self.broadcast_rows:
            return with_words.join(F.broadcast(others), "_row", "left_anti")
        return with_words.join(self.classes.select(F.col("node").alias("_row")), "_row", "left_semi")

    def members(self) -> DataFrame:
        """Nodes in buckets (``key``) of two or more, with the bucket's band, size and least node."""
        each = self.nodes().select(F.col("_row").alias("node"), F.posexplode("_bands").alias("band", "key"))
        # One shuffle by key; a join with the buckets' sizes would take the keys through a second one.
        bucket = W.partitionBy("key")
        each = each.withColumns({"pivot": F.min("node").over(bucket), "size": F.count("*").over(bucket)})
        return write_through(each.where("size > 1"), "near-buckets")

    def of_nodes(self, nodes: DataFrame, *columns: str) -> DataFrame:
        """Rows of distinct nodes, which are sent to the rows where they are few."""
        wanted = write_through(nodes.distinct(), "near-nodes")
        few = wanted.count() <= self.broadcast_rows
        wanted = wanted.withColumnRenamed("node", "_row")
        return self.rows.join(F.broadcast(wanted) if few else wanted, "_row", "left_semi").select("_row", *map(F.col, columns))

    def lows(self, members: DataFrame) -> DataFrame:
        """The signatures that pairs are guessed by, of nodes in buckets only: few of all, and met in every round."""
        return write_through(self.of_nodes(members.select("node"), "_low"), "near-lows")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """The texts of distinct nodes."""
        return self.of_nodes(nodes, f"`{self.text_col}`").toDF("node", "text")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """The full shingle sets of distinct nodes."""
        return write_through(self.texts(nodes).mapInArrow(_sets, "node long, shingles array<long>"), "near-sets")

    def verified(self, pairs: DataFrame, low: DataFrame) -> DataFrame:
        """The pairs (a, b), in any order, that reach the threshold on their full sets and were not compared before.

        Signatures sort out clear misses first. Texts are dealt to the pairs, as their sets are several times larger once
        compressed; they are packed, as a batch of rows has two for each pair. A pair that was refused in one round is not dealt its texts again in the next.
        """
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        for known in self.compared:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        guess = pairs.join(low.toDF("a", "a_low"), "a").join(low.toDF("b", "b_low"), "b").mapInArrow(_alike, "a long, b long")
        guess = write_through(guess, "near-pairs")
        self.compared.append(guess)
        texts = self.texts(guess.select(F.col("a").alias("node")).unionByName(guess.select(F.col("b").alias("node"))))
        texts = texts.mapInArrow(_packed, "node long, text binary")
        full = guess.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")
        return write_through(full.select("a", "b", "a_text", "b_text").mapInArrow(_similar, "a long, b long"), "near-links")

    def rare_pairs(self, nodes: DataFrame) -> DataFrame:
        """An exact way for nodes of large buckets: pairs that share one of their rarest shingles.

        A set of n shingles shares with any larger one at the threshold one of its n - ceil(6/7 n) + 1 first ones in any
        common order, and that is among the larger one's m - ceil(0.75 m) + 1 first; here the order is by rising
        frequency among these nodes. Any order is right, so frequencies need not be exact: shingles are counted by hash
        in a table of fixed size, which is sent to every task. Labels must differ and places and sizes must allow the
        threshold.
        """
        sets = self.sets(nodes.select("node"))
        cells = sets.mapInArrow(_count_shingles, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        # At most CELLS rows.
        counted = cells.toArrow()
        sketch = np.zeros(CELLS, np.int32)
        sketch[np.asarray(counted["cell"])] = np.minimum(np.asarray(counted["n"]), 2**31 - 1)
        shared = self.rows.sparkSession.sparkContext.broadcast(sketch)
        ranked = sets.mapInArrow(_rarest_first(shared), "node long, n int, prefix array<long>").join(nodes, "node")
        ranked = write_through(ranked.select("node", "n", "label", "prefix"), "near-prefixes")
        index = (F.col("n") - F.ceil(F.col("n") * F.lit(2 * PERCENT / (100 + PERCENT) - 1e-9)) + 1).cast("int")

        def side(name: str, prefix: Column) -> DataFrame:
            rows = ranked.select(*[F.col(c).alias(f"{name}_{c}") for c in ("node", "n", "label")], prefix.alias(f"{name}_prefix"))
            return rows.select("*", F.posexplode(f"{name}_prefix").alias(f"{name}_at", "shingle"))

        a, b = side("a", F.slice("prefix", F.lit(1), index)), side("b", F.col("prefix"))
        smaller = (F.col("a_n") < F.col("b_n")) | (F.col("a_n") == F.col("b_n")) & (F.col("a_node") < F.col("b_node"))
        sizes = 100 * F.col("a_n") >= PERCENT * F.col("b_n")
        reach = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
        need = F.lit(PERCENT) * (F.col("a_n") + F.col("b_n")) / F.lit(100 + PERCENT)
        # A pair is taken at the first shingle that its prefixes share, so once.
        once = F.get(F.array_intersect("a_prefix", "b_prefix"), F.lit(0)) == a["shingle"]
        fits = smaller & sizes & (F.col("a_label") != F.col("b_label")) & (reach >= need - F.lit(1e-9)) & once
        joined = a.join(b, (a["shingle"] == b["shingle"]) & fits)
        return joined.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))

    def unsettled(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """Members of the buckets in which the links leave more than one component, with their ``label``."""
        named = members.select("key", "band", "node", "size").join(components(links), "node", "left")
        named = named.withColumn("label", F.coalesce("label", "node"))
        open_keys = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return write_through(named.join(open_keys.select("key"), "key", "left_semi"), "near-rest")

    def links(self) -> DataFrame:
        """Verified links between nodes, enough to connect every pair of similar nodes that meet in a bucket.

        In rounds of a few bands each, nodes are compared with one node of each of their buckets: first the least one,
        then, in buckets left with two or more components, others. So a node meets at most ``ROUND`` others in a round,
        however many buckets a family of variants shares. What is still open in any band is settled: small buckets by
        comparing their nodes of different components, large ones by their rarest shingles. A bucket of thousands of
        copies costs a few comparisons each, and one of thousands of unlike documents that share a passage costs no
        comparison of all pairs.
        """
        members = self.members()
        low = self.lows(members)
        stars = members.where((F.col("band") < ROUND) & (F.col("node") != F.col("pivot")))
        links = self.verified(stars.select(F.col("node").alias("a"), F.col("pivot").alias("b")), low)
        rest = self.unsettled(members, links)
        # Other nodes of a bucket, another in each bucket, find most of what the least node is too unlike to.
        for seed in range(1, self.stars + 1):
            now = rest.where((F.col("band") >= seed * ROUND) & (F.col("band") < (seed + 1) * ROUND))
            chosen = F.min(F.struct(F.xxhash64("node", "key", F.lit(seed)).alias("order"), F.col("node"), F.col("label")))
            pivots = now.groupBy("key").agg(chosen.alias("pivot")).select("key", "pivot.node", "pivot.label").toDF("key", "b", "b_label")
            stars = now.join(pivots, "key").where("label <> b_label").select(F.col("node").alias("a"), "b")
            links = links.unionByName(self.verified(stars, low))
            rest = self.unsettled(rest, links)
        small = rest.where(F.col("size") <= self.small_bucket)
        a, b = small.select("key", "node", "label").toDF("key", "a", "a_label"), small.select("key", "node", "label").toDF("key", "b", "b_label")
        pairs = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (F.col("a_label") != F.col("b_label"))).select("a", "b")
        large = rest.where(F.col("size") > self.small_bucket).select("node", "label").distinct()
        if large.limit(1).count():
            pairs = pairs.unionByName(self.rare_pairs(write_through(large, "near-large")))
        return links.unionByName(self.verified(pairs, low))

    def result(self) -> DataFrame:
        """The input's columns with n_shingles, component_id and kept."""
        labels = components(self.links())
        nodes = self.classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("node").alias("row")))
        firsts = nodes.groupBy("label").agg(first.alias("first"))
        found = nodes.join(firsts, "label").select("_copy", F.col("first.id").alias("component_id"), F.col("first.row").alias("_stays"))
        rows = self.rows.drop("_bands", "_low")
        own = [F.col(f"`{c}`") for c in self.columns]
        with_words = rows.where(F.col("_copy").isNotNull()).join(found, "_copy")
        with_words = with_words.select(*own, "n_shingles", "component_id", (F.col("_row") == F.col("_stays")).alias("kept"))
        wordless = rows.where(F.col("_copy").isNull())
        wordless = wordless.select(*own, "n_shingles", F.col(f"`{self.id_col}`").alias("component_id"), F.lit(True).alias("kept"))
        return with_words.unionByName(wordless)


@any_names
def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` (least id of the documents reachable over links) and ``kept``.

    Linked are documents whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more; a text of fewer words
    is one shingle. Texts with equal words are one node. Forty bands of four coordinates bring a pair at the threshold
    together with a chance of 1 - 4e-7, and more similar pairs more surely; all links are confirmed on full sets.

    NULL, empty and word-less texts are linked with nothing and stay. ``kept`` holds for one row of each component, the
    one with the least id, the first of those if ids repeat; NULL ids come last, so a component of NULL ids has a NULL
    component_id and still keeps one row. Columns named like added ones are replaced. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        return NearDuplicates(docs, text_col, id_col, small_bucket).result()
