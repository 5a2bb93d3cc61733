"""Operator 13: near-duplicate vectors by hashing random projections to points of the E8 lattice."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, write_through
from .minhash import components
from .vectors import matrices, usable

COSINE = 0.95
TABLES = 10
#: Lattice points per cell of a table, and the projected length of a unit vector's coordinate in lattice units.
POINTS, WIDTH = 2, 1.6
#: A bucket of more members is split into blocks of about this size, which meet two by two.
BLOCK = 512
#: Found pairs whose tables are compared at once.
PAIRS = 1 << 16
_KEYS = 1 << POINTS


def _d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where it is odd, the worst rounded place goes the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    place = np.abs(off[odd]).argmax(1)
    near[odd, place] += np.where(off[odd, place] >= 0, 1.0, -1.0)
    return near


def e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is D8 and D8 shifted by a half."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, which lead to the neighbouring points."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            out.append(np.zeros(8))
            out[-1][[i, j]] = signs
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(c < 0 for c in s) % 2 == 0]
    return np.array(out)


def cells(unit: np.ndarray, tables: int = TABLES, width: float = WIDTH, seed: int = 13) -> np.ndarray:
    """Per unit vector and table the key of its own cell, and of those where one or both of its lattice points are
    replaced by the neighbouring point that is next nearest."""
    n, dim = unit.shape
    rng = np.random.default_rng((seed, dim))
    turn = rng.normal(size=(dim, tables * POINTS * 8)) / width
    shift = rng.random(tables * POINTS * 8) * 2
    steps = minimal_vectors()
    keys = np.empty((n, tables, _KEYS), np.uint64)
    for start in range(0, n, 4096):
        x = (unit[start : start + 4096] @ turn + shift).reshape(-1, 8)
        near = e8(x)
        second = near + steps[((x - near) @ steps.T).argmax(1)]
        # Twice the coordinates are integers; a point is hashed with its place in the cell.
        own, other = (np.zeros(len(x), np.uint64) for _ in range(2))
        for c in range(8):
            own = mix(own + (2 * near[:, c]).astype(np.int64).view(np.uint64) + np.uint64(1))
            other = mix(other + (2 * second[:, c]).astype(np.int64).view(np.uint64) + np.uint64(1))
        points = np.stack([own, other]).reshape(2, -1, tables, POINTS)
        for choice in range(_KEYS):
            key = np.full(points.shape[1:3], np.uint64(dim)) + np.arange(tables, dtype=np.uint64) * np.uint64(1 << 32)
            for p in range(POINTS):
                key = mix(key + points[choice >> p & 1, :, :, p])
            keys[start : start + 4096, :, choice] = key
    return keys.view(np.int64)


def units(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length 1; the largest component first becomes 1, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _digests(batches):
    """Adds a digest and the bytes of vectors that can link, NULL for others."""
    for batch in batches:
        column = batch.column("vec")
        copies, raw = [None] * batch.num_rows, [None] * batch.num_rows
        for at, values in matrices(column, np.flatnonzero(usable(column))):
            fits = np.flatnonzero((values != 0).any(1)) if values.shape[1] else []
            for i in fits:
                raw[at[i]] = values[i].tobytes()
                copies[at[i]] = hashlib.md5(raw[at[i]]).digest()
        made = [pa.array(copies, pa.binary()), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *made], names=["id", "copy", "vec"])


def _hashed(batches):
    """Numbers the classes of equal vectors and adds their keys; the vectors are scaled to length 1."""
    task, row = TaskContext.get().partitionId(), 0
    for batch in batches:
        raw = batch.column("vec").to_pylist()
        sizes = np.array([len(v) for v in raw])
        keys, vectors = np.empty((len(raw), TABLES * _KEYS), np.int64), [b""] * len(raw)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            unit = units(np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), -1))
            keys[at] = cells(unit).reshape(len(at), -1)
            for i, v in zip(at, unit):
                vectors[i] = v.tobytes()
        bounds = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * TABLES * _KEYS)
        node = (np.int64(task) << 40) + np.arange(row, row + len(raw))
        row += len(raw)
        made = [pa.array(node), pa.array(vectors, pa.binary()), pa.ListArray.from_arrays(bounds, pa.array(keys.reshape(-1)))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("copy"), batch.column("first"), batch.column("n"), *made], names=["copy", "first", "n", "node", "vec", "keys"])


def first_met(a: np.ndarray, b: np.ndarray, low: np.ndarray, table: int, key: int) -> np.ndarray:
    """Whether pairs that meet in this bucket meet nowhere before; ``a``, ``b``: their keys (pair, table, choice),
    ``low``: whether a is the lower node. Two nodes meet in the own cell of either that the other probes as well; in one
    table the lower node's cell comes first."""
    before = (a[:, :table] == b[:, :table, :1]).any(2) | (b[:, :table] == a[:, :table, :1]).any(2)
    lower, higher = np.where(low, a[:, table, 0], b[:, table, 0]), np.where(low[:, None], b[:, table], a[:, table])
    in_lower = (higher == lower[:, None]).any(1)
    return ~before.any(1) & ((lower == key) | ~in_lower)


def connected(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the least one that the pairs lead to."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_links(key, table, left, right, nodes, n, own, block, unit, keys):
    """Links found first in this bucket between its blocks ``left`` and ``right``: per node the copies it is linked
    with, and edges that connect the linked nodes."""
    homes = np.flatnonzero(own)
    found_a, found_b = [], []
    for start in range(0, len(homes), 256):
        rows = homes[start : start + 256]
        i, j = np.nonzero(unit[rows] @ unit.T >= COSINE)
        i = rows[i]
        # Pairs of own members once, and pairs across the blocks where there are two.
        pick = (i != j) & (~own[j] | (nodes[i] < nodes[j]))
        if left != right:
            pick &= block[i] != block[j]
        i, j = i[pick], j[pick]
        for at in range(0, len(i), PAIRS):
            p, q = i[at : at + PAIRS], j[at : at + PAIRS]
            new = first_met(keys[p], keys[q], nodes[p] < nodes[q], table, key)
            found_a.append(p[new])
            found_b.append(q[new])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))
    links = np.bincount(a, n[b], len(nodes)) + np.bincount(b, n[a], len(nodes))
    label = connected(a, b, len(nodes))
    return links.astype(np.int64), label


def _linked(batches):
    """Links of group after group of a sorted partition."""
    held, now = [], None

    def close():
        group = pa.Table.from_batches(held).combine_chunks()
        col = lambda c: np.asarray(group.column(c).combine_chunks())
        nodes, n, own, block = col("node"), col("n"), col("own").astype(bool), col("block")
        unit = np.frombuffer(b"".join(group.column("vec").to_pylist())).reshape(len(nodes), -1)
        keys = np.asarray(group.column("keys").combine_chunks().flatten()).reshape(len(nodes), TABLES, _KEYS)
        key, table, left, right = now
        links, label = bucket_links(key, table, left, right, nodes, n, own, block, unit, keys)
        some, joined = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(nodes)))
        other = np.concatenate([np.zeros(len(some), np.int64), nodes[label[joined]]])
        mask = np.concatenate([np.ones(len(some), bool), np.zeros(len(joined), bool)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([nodes[some], nodes[joined]])), pa.array(np.concatenate([links[some], np.zeros(len(joined), np.int64)])),
             pa.array(other, mask=mask)], names=["node", "links", "other"])

    out, waiting = [], 0
    for batch in batches:
        marks = [np.asarray(batch.column(c)) for c in ("key", "tab", "a", "b")]
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows - 1, bool)
        for m in marks:
            same &= m[1:] == m[:-1]
        cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            mark = tuple(int(m[start]) for m in marks)
            if held and mark != now:
                out.append(close())
                waiting += out[-1].num_rows
                held = []
            now = mark
            held.append(batch.slice(start, stop - start))
            if waiting >= 20_000:
                yield from out
                out, waiting = [], 0
    if held:
        out.append(close())
    if out:
        yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def near_duplicate_vectors(rows: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """id, n_links, component_id and kept for every row: links are pairs of vectors with a cosine of 0.95 or more.

    Vectors are scaled to length 1. Each of ten tables has two random projections to eight dimensions; each is decoded to
    its nearest point of the lattice E8, and the two points name the vector's cell. A vector also probes the three cells
    where one or both points give way to the neighbouring point that is next nearest. Vectors meet where one's cell is
    the other's own or probed one; every meeting is verified by the cosine in double precision, so no link is false. A
    pair at the threshold meets with a chance of about 0.97 and more similar ones more surely; tests measure it.

    Equal vectors are one node that counts for all its copies. No pairs are written out: a task counts the links of a
    bucket's nodes, each pair in the first bucket where it meets, and hands on edges that connect them, fewer than it
    has nodes. Large buckets are dealt to blocks that meet two by two, in tasks of bounded size.

    NULL, empty and zero vectors, and those with NULL or non-finite components, link with nothing, as do vectors of
    different lengths. ``component_id`` is the least id reachable, NULL ids last; ``kept`` holds where it is the row's
    own id (two NULLs are equal), so all rows that repeat such an id. Other columns are not read. An empty table gives
    no rows.
    """
    named = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
    named = write_through(named.mapInArrow(_digests, "id long, copy binary, vec binary"), "lattice-rows")
    classes = named.where("copy is not null").groupBy("copy").agg(
        F.min("id").alias("first"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    nodes = classes.mapInArrow(_hashed, "copy binary, first long, n long, node long, vec binary, keys array<long>")
    nodes = write_through(nodes, "lattice-nodes")

    members = nodes.select("node", F.posexplode("keys").alias("place", "key"))
    members = members.select("node", "key", F.expr(f"place div {_KEYS}").cast("int").alias("tab"), (F.col("place") % _KEYS == 0).alias("own"))
    buckets = members.groupBy("key", "tab").agg(F.count("*").alias("size"), F.max("own").alias("held")).where("size > 1 and held")
    met = members.join(buckets.select("key", "tab", "size"), ["key", "tab"])
    blocks = F.ceil(F.col("size") / BLOCK)
    met = met.select("node", "key", "tab", "own", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), blocks.cast("int").alias("blocks"))
    each = met.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    each = each.select("node", "key", "tab", "own", "block", F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"))
    full = each.join(nodes.select("node", "n", "vec", "keys"), "node")
    full = full.repartition("key", "tab", "a", "b").sortWithinPartitions("key", "tab", "a", "b")
    found = write_through(full.mapInArrow(_linked, "node long, links long, other long"), "lattice-links")

    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = nodes.select("copy", "first", "n", "node").join(links, "node", "left").join(labels, "node", "left")
    known = known.select("copy", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "node").alias("label"))
    tops = known.groupBy("label").agg(F.min("first").alias("component_id"))
    known = known.join(tops, "label").select("copy", "n_links", "component_id")
    linked = named.where("copy is not null").select("id", "copy").join(known, "copy").select("id", "n_links", "component_id")
    alone = named.where("copy is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
