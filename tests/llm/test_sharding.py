import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from rowferry.llm.sharding import assign, shard

SF = "/root/testdata/sf0.01"


def check(docs, out, shards):
    texts = defaultdict(set)
    want = defaultdict(list)
    for i, t in docs:
        want[i].append((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    for r in out:
        want[r.doc_id].remove((r["size"], r.text_crc32))
        texts[r["size"], r.text_crc32].add(r.shard)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert not any(want.values()) and all(len(s) == 1 for s in texts.values())
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    loads = [0] * shards
    for r in out:
        loads[r.shard] += r["size"]
    return loads


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    loads = check([tuple(r) for r in docs.collect()], shard(docs).collect(), 16)
    assert max(loads) <= 1.02 * min(loads)


def test_schedule_against_a_loop(spark):
    """Every row's shard follows from giving the items, largest first, to the emptiest shard."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shards, fine = 16, 4
    hashed = docs.select("doc_id", "text", F.pmod(F.xxhash64(F.unhex(F.md5("text"))), F.lit(shards * fine)).alias("bundle")).collect()
    groups = defaultdict(int)
    for r in hashed:
        groups[r.text] += len(r.text.encode()) + 1
    total = sum(groups.values())
    item = {r.text: f"group {hashlib.md5(r.text.encode()).hexdigest().upper()}" if groups[r.text] * shards * fine >= total else f"bundle {r.bundle}" for r in hashed}
    sizes = defaultdict(int)
    for text, size in groups.items():
        sizes[item[text]] += size
    loads, place = [0] * shards, {}
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        place[name] = loads.index(min(loads))
        loads[place[name]] += sizes[name]
    got = {r.doc_id: r.shard for r in shard(docs, shards, fine).collect()}
    assert got == {r.doc_id: place[item[r.text]] for r in hashed} and len(set(place.values())) == shards
    assert any(i.startswith("group") for i in place) and any(i.startswith("bundle") for i in place)


def test_bundles_and_hot_group(spark):
    """A group of a third of all rows, and so few bundles that most groups share one."""
    rng = random.Random(2)
    docs = [(i, "copied text") for i in range(500)] + [(i, "x" * rng.randint(0, 60) + str(i)) for i in range(500, 1500)]
    docs += [(None, None), (None, ""), (7, "again"), (7, "again"), (1, "y" * 2_000_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    loads = check(docs, shard(frame, 4, fine=8).collect(), 4)
    rest = sorted(loads)[:-1]
    assert max(rest) - min(rest) <= 500 * 12 + sum(loads) / 8


def test_longest_first():
    assert dict(assign([("a", 5), ("b", 4), ("c", 3), ("d", 3), ("e", 3)], 2)) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_edges(spark):
    assert shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    out = shard(spark.createDataFrame([(1, "a", 9, 8)], "doc_id long, text string, shard int, size long")).collect()
    assert [(r["size"], r.slot) for r in out] == [(2, 0)]
