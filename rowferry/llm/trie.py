"""Operator 11: the trie of conversation prefixes by truncation peeling."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import work_path, write_through

KEY = 16
ROOT = bytes(KEY)
#: A node with more different conversations below it is peeled by Spark, level by level; what hangs below the others is
#: peeled whole, in one task each.
LIGHT = 256
#: Ids are joined for a digest in runs of this width.
RUN_BITS = 12
#: Rows per Arrow batch that a task hands back.
ROWS = 20_000
_SIZES = pa.list_(pa.int64())
NOTHING = hashlib.sha256().hexdigest()

_TREE = "depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the turns of each conversation in order, as (turn, digest of role and text, bytes of text).

    NULL turns come first; equal turn numbers are ordered by the digest. Rows without conv_id are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    one = F.struct("turn", said.alias("said"), F.octet_length(text).cast("long").alias("size"))
    named = conversations.select("conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull())
    return named.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def rebuilt(lists: DataFrame, family: int = 5, shared: int = 9) -> DataFrame:
    """Conversations that share their start with a relative: the first crc32(id) % ``shared`` turns of the first one of
    the family (ids that differ by less than ``family``), then the conversation's own later turns."""
    own = lists.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(family)))
    own = own.withColumn("taken", (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int"))
    heads = lists.select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head"))
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    start = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("taken"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(start, rest).alias("turns"))


def _chains(batches):
    """Per conversation its prefixes' keys, the root's first, each made of the one before and a turn; and text sizes."""
    for batch in batches:
        ends, depths, keys, sizes = [], [], [], []
        for said, size in zip(batch.column("said").to_pylist(), batch.column("size").to_pylist()):
            chain = [ROOT]
            for digest in said:
                chain.append(hashlib.md5(chain[-1] + digest).digest())
            ends.append(chain[-1])
            depths.append(len(said))
            keys.append(b"".join(chain))
            sizes.append([0, *size])
        made = [pa.array(ends, pa.binary()), pa.array(depths, pa.int32()), pa.array(keys, pa.binary()), pa.array(sizes, _SIZES)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *made], names=["conv_id", "end", "depth", "keys", "sizes"])


def _rows(batches):
    for batch in batches:
        yield from zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)])


def _handed(rows, schema: pa.Schema):
    """Rows as Arrow batches of bounded size."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_SEQUENCE = pa.schema([("end", pa.binary()), ("depth", pa.int32()), ("keys", pa.binary()), ("sizes", _SIZES),
                       ("n", pa.int64()), ("first", pa.int64()), ("ends_sha256", pa.string())])


def _merge_copies(batches):
    """Equal conversations as one: rows come sorted by end and run of ids, so a digest needs one run in memory."""

    def merged():
        now, digest = None, None
        for end, _, depth, keys, sizes, n, first, ids in _rows(batches):
            if now is not None and now[0] == end:
                now[4] += n
                digest.update(b"," + ids.encode())
            else:
                if now is not None:
                    yield (*now, digest.hexdigest())
                now, digest = [end, depth, keys, sizes, n, first], hashlib.sha256(ids.encode())
        if now is not None:
            yield (*now, digest.hexdigest())

    return _handed(merged(), _SEQUENCE)


def peel(members):
    """The nodes of one subtree, from conversations (top, depth, keys, sizes, n, first, digest) that share its top.

    From the deepest level up: conversations that end here join the nodes that survive from below, every node is closed
    with what was added up, then its last turn is stripped and it is merged into its parent. Yields
    (depth, conv_id, parent's conv_id, n_convs, n_children, n_leaves, saved, ends digest, is the top).
    """
    ending = defaultdict(list)
    for member in members:
        ending[member[1]].append(member)
    top, bottom = members[0][0], max(ending)
    level: dict[bytes, list] = {}  # key: [conv_id, n, children, leaves, saved below, digest, keys, sizes, child rows]
    for depth in range(bottom, top - 1, -1):
        for _, _, keys, sizes, n, first, digest in ending.pop(depth, ()):
            node = level.setdefault(keys[KEY * depth :], [first, 0, 0, 0, 0, NOTHING, keys, sizes, []])
            node[0], node[1], node[5] = min(node[0], first), node[1] + n, digest
        above: dict[bytes, list] = {}
        for conv_id, n, children, leaves, below, digest, keys, sizes, rows in level.values():
            saved = below + (n - 1) * sizes[depth]
            for row in rows:
                yield (*row[:2], conv_id, *row[2:], False)
            row = (depth, conv_id, n, children, leaves or 1, saved, digest)
            if depth == top:
                yield (depth, conv_id, None, *row[2:], True)
                continue
            key = keys[KEY * (depth - 1) : KEY * depth]
            node = above.get(key)
            if node is None:
                above[key] = [conv_id, n, 1, leaves or 1, saved, NOTHING, keys, sizes, [row]]
            else:
                node[0] = min(node[0], conv_id)
                node[1] += n
                node[2] += 1
                node[3] += leaves or 1
                node[4] += saved
                node[8].append(row)
        level = above


_NODE = pa.schema([("depth", pa.int32()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
                   ("keys", pa.binary()), ("sizes", _SIZES)])


def _peel_light(batches):
    """Peels subtree after subtree of a sorted partition. The top of each carries its keys and sizes on."""

    def close(members):
        top, _, keys, sizes = members[0][:4]
        for *row, is_top in peel(members):
            yield (*row, keys[: KEY * (top + 1)], sizes[: top + 1]) if is_top else (*row, None, None)

    def nodes():
        now, members = None, []
        for group, *member in _rows(batches):
            if members and group != now:
                yield from close(members)
                members = []
            now = group
            members.append(member)
        if members:
            yield from close(members)

    return _handed(nodes(), _NODE)


def key_at(depth: Column) -> Column:
    return F.substring("keys", F.lit(KEY) * depth + 1, F.lit(KEY))


def prefix_trie(lists: DataFrame, light: int = LIGHT) -> DataFrame:
    """One row per distinct conversation prefix (node): depth, conv_id (least member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``lists``: conv_id and turns, an array of (turn, said, size), as ``turn_lists`` makes it. A node is a sequence of
    turns; its members are the conversations that start with it. The root has no turns and all members. Node keys are
    chained 128-bit digests. Equal conversations are merged first. A node with more than ``light`` different
    conversations below it is heavy. Subtrees of the light nodes right below heavy ones are peeled from their deepest
    level up, each by one task in one pass; their tops then meet at the heavy nodes, which are peeled in rounds, one
    combining aggregate for each level. So the rounds follow the depth of heavy nodes, not the longest conversation,
    and no task holds more than ``light`` conversations (24 bytes a turn). A conversation must fit in one row.

    A conversation without turns is a member of the root only. No conversations give no rows.
    """
    chained = lists.select("conv_id", F.col("turns.said").alias("said"), F.col("turns.size").alias("size"))
    chained = chained.mapInArrow(_chains, "conv_id long, end binary, depth int, keys binary, sizes array<long>")
    run = F.shiftright("conv_id", RUN_BITS).alias("run")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    runs = chained.groupBy("end", run).agg(
        F.first("depth").alias("depth"), F.first("keys").alias("keys"), F.first("sizes").alias("sizes"),
        F.count("*").alias("n"), F.min("conv_id").alias("first"), ids.alias("ids"),
    )
    merged = runs.repartition("end").sortWithinPartitions("end", "run").mapInArrow(
        _merge_copies, "end binary, depth int, keys binary, sizes array<long>, n long, first long, ends_sha256 string")
    merged = write_through(merged, "trie-conversations")

    each = merged.select("end", "keys", F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("at"))
    each = each.select("end", "at", key_at(F.col("at")).alias("node"))
    # Written, so that Spark knows its size: broadcast if small, else a join of which it can split hot nodes.
    heavy = each.groupBy("node").agg(F.count("*").alias("below")).where(F.col("below") > light).select("node")
    heavy = write_through(heavy, "trie-heavy-nodes")
    reach = each.join(heavy, "node").groupBy("end").agg((F.max("at") + 1).alias("top"))
    placed = merged.join(reach, "end", "left").withColumn("top", F.coalesce("top", F.lit(0)))
    placed = write_through(placed, "trie-placed")

    below = placed.where("top <= depth").select(
        key_at(F.col("top")).alias("group"), "top", "depth", "keys", "sizes", "n", "first", "ends_sha256")
    below = below.repartition("group").sortWithinPartitions("group")
    nodes = write_through(below.mapInArrow(_peel_light, _TREE + ", keys binary, sizes array<long>"), "trie-light")

    up = F.col("depth") - 1
    tops = nodes.where("keys is not null").withColumn("parent", F.when(F.col("depth") > 0, key_at(up)))
    from_tops = tops.where("depth > 0").select(
        up.alias("depth"), F.substring("keys", F.lit(1), F.lit(KEY) * F.col("depth")).alias("keys"), "sizes",
        "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends_sha256"))
    zero = F.lit(0).cast("long")
    ended = placed.where("top > depth").select(
        "depth", "keys", "sizes", F.col("first").alias("conv_id"), F.col("n").alias("n_convs"), zero.alias("n_children"),
        zero.alias("n_leaves"), zero.alias("saved_tokens"), "ends_sha256")
    parts = write_through(from_tops.unionByName(ended), "trie-parts")
    deepest = parts.agg(F.max("depth")).first()[0]

    path = work_path(lists.sparkSession, "trie-heavy")
    level = None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        rows = parts.where(F.col("depth") == depth).drop("depth")
        if level is not None:
            stripped = F.substring("keys", 1, KEY * (depth + 1)).alias("keys")
            rows = rows.unionByName(level.select(
                stripped, "sizes", "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
                "saved_tokens", F.lit(None).cast("string").alias("ends_sha256")))
        # What survives: the node, the turns above it, and what its conversations have added up to.
        level = rows.groupBy("keys").agg(
            F.first("sizes").alias("sizes"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256"))
        size = F.col("sizes")[depth]
        level = level.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * size)
        level.write.parquet(f"{path}/depth={depth}")
        level = lists.sparkSession.read.schema(level.schema).parquet(f"{path}/depth={depth}")
    columns = [c.split()[0] for c in _TREE.split(", ")]
    if level is None:
        return nodes.select(*columns)
    heavy = lists.sparkSession.read.schema(T.StructType([*level.schema.fields, T.StructField("depth", T.IntegerType())])).parquet(path)
    heavy = heavy.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    heavy = heavy.withColumn("parent", F.when(F.col("depth") > 0, key_at(up)))
    names = heavy.select(key_at(F.col("depth")).alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joint = [c for c in columns if c != "parent_conv_id"]
    open_ = tops.select(*joint, "parent").unionByName(heavy.select(*joint, "parent")).join(names, "parent", "left")
    return nodes.where("keys is null").select(*columns).unionByName(open_.select(*columns))
