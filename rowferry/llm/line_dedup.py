"""Operator 9: reversible line dedup with sharded cuckoo filters over exact reference counts."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import any_names, mix, without, work_path, write_through

SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may stand in one of two buckets. Keys are pairs of 64-bit words.

    Takes insertions, deletions of what was inserted, and look-ups of whole arrays. An insertion that finds no room
    returns False; the caller then builds a larger filter from its exact keys.
    """

    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        size = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / 3.2 + 1))))
        self.table = np.zeros((size, 4), np.uint16) if table is None else table

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(data, np.uint16).reshape(-1, 4).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, low: np.ndarray, high: np.ndarray):
        mask = np.uint64(len(self.table) - 1)
        mark = ((high >> np.uint64(20)) & np.uint64(0xFFFF)) | np.uint64(1)
        first = mix(low) & mask
        return mark.astype(np.uint16), first.astype(np.int64), (first ^ (mix(mark) & mask)).astype(np.int64)

    def contains(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mark, a, b = self._places(low, high)
        return (self.table[a] == mark[:, None]).any(1) | (self.table[b] == mark[:, None]).any(1)

    def _place(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put marks into free slots of their buckets, all at once; True where there was room."""
        order = np.argsort(bucket, kind="stable")
        own = bucket[order]
        turn = np.arange(len(own)) - np.searchsorted(own, own)
        free = self.table[own] == 0
        fits = turn < free.sum(1)
        # The slot of the turn-th free place of the bucket.
        slot = (np.cumsum(free, 1) > turn[:, None]).argmax(1)
        self.table[own[fits], slot[fits]] = mark[order[fits]]
        out = np.zeros(len(mark), bool)
        out[order[fits]] = True
        return out

    def insert(self, low: np.ndarray, high: np.ndarray) -> bool:
        """All keys at once into their first, then their second bucket; the few that are left one by one, with kicks."""
        mask, table = len(self.table) - 1, self.table
        marks, first, second = self._places(low, high)
        left = np.flatnonzero(~self._place(marks, first))
        left = left[~self._place(marks[left], second[left])]
        for mark, a, b in zip(marks[left].tolist(), first[left].tolist(), second[left].tolist()):
            for bucket in (a, b):
                free = np.flatnonzero(table[bucket] == 0)
                if len(free):
                    table[bucket, free[0]] = mark
                    break
            else:
                bucket = b
                for kick in range(500):
                    slot = (kick * 7 + mark) & 3
                    mark, table[bucket, slot] = int(table[bucket, slot]), mark
                    bucket ^= int(mix(np.array([mark], np.uint64))[0]) & mask
                    free = np.flatnonzero(table[bucket] == 0)
                    if len(free):
                        table[bucket, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, low: np.ndarray, high: np.ndarray) -> None:
        for mark, a, b in zip(*(x.tolist() for x in self._places(low, high))):
            for bucket in (a, b):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break


def _words(keys: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The two 64-bit words of 16-byte digests."""
    pairs = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _shard_of(shards: int) -> Column:
    """The shard of a key: its first four bytes modulo the number of shards."""
    return (F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") % shards).cast("int")


def _hits(filters: dict[int, CuckooFilter], keys: list[bytes], shards: int) -> np.ndarray:
    """Which keys the filter of their shard holds."""
    out = np.zeros(len(keys), bool)
    if not keys:
        return out
    low, high = _words(keys)
    where = np.frombuffer(b"".join(keys), ">u4")[::4].astype(np.int64) % shards
    for shard in np.unique(where).tolist():
        if shard in filters:
            rows = np.flatnonzero(where == shard)
            out[rows] = filters[shard].contains(low[rows], high[rows])
    return out


def line_key(line: bytes) -> bytes:
    """The digest of a line's key; empty for a line without one."""
    key = line.strip(SPACE)
    return hashlib.md5(key.translate(_LOWER)).digest() if key else b""


COUNTS = "key binary, docs long, rose boolean, fell boolean"
FILTERS = "shard int, filter binary"
#: Frequent keys of a shard, about, at most; and parts of a shard's lines where lines are dealt to shards.
SHARD_KEYS, SALTS = 1 << 16, 32


class LineIndex:
    """Reference counts of line keys, in versions under ``path``, with a cuckoo filter per shard of the frequent ones.

    Shards are as many as keep the frequent keys of each to about ``shard_keys``; where that number grows, all filters
    are built anew from the counts. A shard's filter is built by one task.

    ``insert`` and ``delete`` change the counts by the documents given and write a new version; earlier versions stay
    readable, and deleting what was inserted restores the state before. A key is known by 128 bits of MD5. It is
    frequent when at least ``min_docs`` documents hold it. Deleting documents that were never inserted is an error of
    the caller; counts then end at zero.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 10, min_chars: int = 1, shard_keys: int = SHARD_KEYS,
                 broadcast_bytes: int = 64 << 20):
        self.spark, self.path, self.version, self.shards = spark, path, 0, 1
        self.min_docs, self.min_chars, self.shard_keys, self.broadcast_bytes = min_docs, min_chars, shard_keys, broadcast_bytes

    def counts(self) -> DataFrame:
        """key, docs, and whether the last change made the key frequent or not frequent any more."""
        if not self.version:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts/v{self.version}")

    def filters(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], FILTERS)
        return self.spark.read.schema(FILTERS).parquet(f"{self.path}/filters/v{self.version}")

    def frequent(self) -> DataFrame:
        return self.counts().where(F.col("docs") >= self.min_docs).select("key")

    def keys_of(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The distinct keys of each document, one row each. Built-in expressions only."""
        stripped = F.transform(
            F.split(F.col(f"`{text_col}`"), "\n", -1), lambda line: F.trim(line, F.lit(SPACE.decode()))
        )
        long_enough = F.filter(stripped, lambda key: F.length(key) >= F.lit(max(1, self.min_chars)))
        upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        digests = F.transform(long_enough, lambda key: F.md5(F.translate(key, upper, lower)))
        return docs.select(F.explode(F.array_distinct(digests)).alias("hex")).select(F.unhex("hex").alias("key"))

    def insert(self, docs: DataFrame, text_col: str = "text") -> None:
        self._change(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> None:
        self._change(docs, text_col, -1)

    def _change(self, docs: DataFrame, text_col: str, sign: int) -> None:
        change = self.keys_of(docs, text_col).groupBy("key").agg(F.count("*").alias("n"))
        change = change.select("key", F.lit(0).cast("long").alias("docs"), (F.col("n") * sign).alias("change"))
        if self.version:
            old = self.counts().select("key", "docs", F.lit(0).cast("long").alias("change"))
            change = old.unionByName(change).groupBy("key").agg(F.sum("docs").alias("docs"), F.sum("change").alias("change"))
        now = F.greatest(F.col("docs") + F.col("change"), F.lit(0))
        least = F.lit(self.min_docs)
        rows = change.select(
            "key",
            now.alias("now"),
            ((F.col("docs") < least) & (now >= least)).alias("rose"),
            ((F.col("docs") >= least) & (now < least)).alias("fell"),
        ).where((F.col("now") > 0) | F.col("fell"))
        old_filters = self.filters()
        rows.withColumnRenamed("now", "docs").write.parquet(f"{self.path}/counts/v{self.version + 1}")
        self.version += 1
        self._write_filters(old_filters)

    def _write_filters(self, old: DataFrame) -> None:
        """Bring each shard's filter up to date with the keys that became frequent or ceased to be.

        A shard whose filter has no room left is built anew, larger, from its frequent keys; all are where there must be
        more shards than before.
        """
        touched = self.counts().where((F.col("docs") >= self.min_docs) | F.col("fell"))
        n, needed = touched.count(), 1
        while needed * self.shard_keys < n:
            needed *= 2
        if needed > self.shards:
            self.shards, old = needed, self.spark.createDataFrame([], FILTERS)
        touched = touched.withColumn("shard", _shard_of(self.shards))
        changed = touched.where(F.col("rose") | F.col("fell")).select("shard", "key", "rose")
        kept = touched.where(~F.col("rose") & ~F.col("fell")).select("shard", "key", F.lit(None).cast("boolean").alias("rose"))

        def update(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            shard = int((keys if len(keys) else filters)["shard"].iloc[0])
            data = list(map(bytes, keys["key"]))
            rose = np.array([r is True or r == True for r in keys["rose"]], bool)  # noqa: E712
            known = np.array([r is None or r != r for r in keys["rose"]], bool)
            up, down = [k for k, r in zip(data, rose) if r], [k for k, r, o in zip(data, rose, known) if not r and not o]
            held = CuckooFilter.load(bytes(filters["filter"].iloc[0])) if len(filters) else None
            roomy = held is not None and len(up) + int(known.sum()) <= 3.4 * len(held.table)
            if roomy:
                if down:
                    held.delete(*_words(down))
                roomy = not up or held.insert(*_words(up))
            if not roomy:
                all_keys, n = sorted(up + [k for k, o in zip(data, known) if o]), len(data)
                held = CuckooFilter(n)
                while all_keys and not held.insert(*_words(all_keys)):
                    n *= 2
                    held = CuckooFilter(n)
            return pd.DataFrame({"shard": [shard], "filter": [held.dump()]})

        new = changed.unionByName(kept).groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(update, FILTERS)
        new.write.parquet(f"{self.path}/filters/v{self.version}")

    @any_names
    def apply(self, docs: DataFrame, inserted: bool = False, text_col: str = "text") -> DataFrame:
        """``docs`` less the lines whose key is frequent, with ``n_lines`` (before) and ``n_dropped``.

        A map over the documents asks the filters. Keys that a filter takes for frequent but the exact counts do not
        are listed first, so the answer is exact: from the counts themselves if every document was ``inserted``, else
        from the documents' keys. Filters and list are broadcast only while both stay within ``broadcast_bytes``;
        beyond that the lines' keys are dealt to the shards, asked there, and those that pass meet the exact counts.

        NULL text is one line without a key and stays NULL; an empty text stays empty. A document may lose all lines
        and then has an empty text. Columns named n_lines or n_dropped are replaced, others are carried along.
        """
        size = self.filters().agg(F.sum(F.octet_length("filter"))).first()[0] or 0
        if size > self.broadcast_bytes:
            return self._apply_by_shards(docs, text_col)
        filters = {r.shard: CuckooFilter.load(bytes(r.filter)) for r in self.filters().collect()}
        shared, shards = self.spark.sparkContext.broadcast(filters), self.shards

        def held(batches):
            for batch in batches:
                keys = batch.column("key").to_pylist()
                yield batch.filter(pa.array(_hits(shared.value, keys, shards)))

        asked = self.counts().where(F.col("docs") < self.min_docs).select("key") if inserted else self.keys_of(docs, text_col).distinct()
        wrong = asked.mapInArrow(held, "key binary").join(self.frequent(), "key", "left_anti")
        wrong = write_through(wrong, "line-exceptions")
        if wrong.count() * 100 > self.broadcast_bytes:
            return self._apply_by_shards(docs, text_col)
        but = self.spark.sparkContext.broadcast({bytes(r.key) for r in wrong.collect()})
        docs = without(docs, "n_lines", "n_dropped")
        names, at, least = docs.columns, docs.columns.index(text_col), self.min_chars

        def drop(batches):
            for batch in batches:
                split = [None if t is None else t.encode().split(b"\n") for t in batch.column(at).to_pylist()]
                keys = [k for lines in split for k in map(line_key, lines or ())]
                full = np.array([bool(k) for k in keys], bool)
                gone = np.zeros(len(keys), bool)
                some = [k for k in keys if k]
                hit = _hits(shared.value, some, shards)
                if but.value:
                    for i in np.flatnonzero(hit):
                        hit[i] = some[i] not in but.value
                gone[full] = hit
                texts, n_lines, n_dropped, i = [], [], [], 0
                for lines in split:
                    if lines is None:
                        texts.append(None), n_lines.append(1), n_dropped.append(0)
                        continue
                    here = gone[i : i + len(lines)]
                    i += len(lines)
                    if least > 1:
                        here = here & [len(x.strip(SPACE).decode()) >= least for x in lines]
                    texts.append(b"\n".join(x for x, g in zip(lines, here) if not g).decode())
                    n_lines.append(len(lines))
                    n_dropped.append(int(here.sum()))
                columns = list(batch.columns)
                columns[at] = pa.array(texts, pa.string())
                columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_lines", "n_dropped"])

        return docs.mapInArrow(drop, _with(docs.schema, "n_lines", "n_dropped"))

    def _passed(self, lines: DataFrame) -> DataFrame:
        """The lines (_row, at, key) whose key the filter of its shard holds.

        Filters and lines meet in sorted partitions, the filter ahead of its lines, so a task holds one filter and one
        batch of lines. A shard's lines come in ``SALTS`` parts, as one line may make up a good share of all; the filter
        goes to each.
        """
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        asked = lines.select("_row", "at", "key", _shard_of(self.shards).alias("shard"), F.pmod(F.xxhash64("_row", "at"), F.lit(SALTS)).cast("int").alias("salt"))
        held = self.filters().select("shard", salts.alias("salt"), "filter")
        both = asked.unionByName(held, allowMissingColumns=True).repartition("shard", "salt")
        both = both.sortWithinPartitions("shard", "salt", F.col("filter").isNull()).select("shard", "filter", "_row", "at", "key")

        def ask(batches):
            shard, cuckoo = None, None
            for batch in batches:
                shards, filters = np.asarray(batch.column("shard")), batch.column("filter")
                keys, out = batch.column("key").to_pylist(), np.zeros(batch.num_rows, bool)
                heads = np.flatnonzero(np.asarray(filters.is_valid())).tolist()
                edges = sorted({0, batch.num_rows, *heads, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist()})
                for a, b in zip(edges, edges[1:]):
                    if filters[a].is_valid:
                        shard, cuckoo = int(shards[a]), CuckooFilter.load(filters[a].as_py())
                        a += 1
                    elif shards[a] != shard:
                        shard, cuckoo = int(shards[a]), None  # a shard without frequent keys
                    if cuckoo is not None and a < b:
                        out[a:b] = cuckoo.contains(*_words(keys[a:b]))
                yield batch.select(["_row", "at", "key"]).filter(pa.array(out))

        return both.mapInArrow(ask, "_row long, at int, key binary")

    def _apply_by_shards(self, docs: DataFrame, text_col: str) -> DataFrame:
        docs = without(docs, "n_lines", "n_dropped", "_row", "_gone")
        rows = write_through(docs.withColumn("_row", F.monotonically_increasing_id()), "line-documents")
        text = F.col(f"`{text_col}`")
        lines = rows.select("_row", F.posexplode(F.split(text, "\n", -1)).alias("at", "line"))
        stripped = F.trim("line", F.lit(SPACE.decode()))
        lower = F.translate(stripped, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        lines = lines.where(F.length(stripped) >= max(1, self.min_chars)).select("_row", "at", F.unhex(F.md5(lower)).alias("key"))
        gone = self._passed(lines).join(self.frequent(), "key", "left_semi").groupBy("_row").agg(F.collect_list("at").alias("_gone"))
        kept = F.transform(
            F.array(F.split(text, "\n", -1)),
            lambda all_lines: F.array_join(
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_gone")),
                    lambda i: F.get(all_lines, i),
                ),
                "\n",
            ),
        )[0]
        return rows.join(gone, "_row", "left").select(
            *[
                F.when(F.col("_gone").isNull(), text).otherwise(kept).alias(text_col)
                if c == text_col else F.col(f"`{c}`")
                for c in docs.columns
            ],
            F.when(text.isNull(), 1).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines"),
            F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        )


def _with(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, T.LongType()) for n in names)])


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text") -> DataFrame:
    """Index ``docs`` in a fresh folder and drop the lines found in ``min_docs`` of them or more from all."""
    spark = docs.sparkSession
    index = LineIndex(spark, work_path(spark, "lines"), min_docs, min_chars)
    index.insert(docs, text_col)
    return index.apply(docs, inserted=True, text_col=text_col)
