"""Operator 3: token ids in files of frequency-ranked, byte-aligned codes; and the tokenizer that operators share."""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, utf8

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 1 << 20


#: Beyond these, lower-casing may depend on neighbours and letters may be composed.
_EXOTIC = re.compile("[^\x00-\u024f]")
#: A mark right after a letter or digit begins a token there; an apostrophe may not.
_MARK = re.compile(r"[^\w\s'](?<=[^\W_].)")


def _byte_characters() -> list[str]:
    """Printable Latin-1 characters stand for themselves, the other bytes for those from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


_BYTES = _byte_characters()


class Encoder:
    """Encodes texts with a tokenizer whose tokens never reach over white space, keeping the ids of words it has seen.

    Such a tokenizer gives a text the ids of its pieces between white space, one after the other, so each distinct
    piece goes to the library once while it is remembered. Only space, tab, newline and return part pieces here; other
    white space stays inside a piece and is the library's business. ``limit`` bounds the memory, not the result.

    A tokenizer that lower-cases gets texts without exotic characters in lower case, with marks set apart from the word
    before where it would part them anyway; that makes distinct pieces fewer. Pieces of letters alone then
    need no further normalisation or splitting and go straight to the library's merges, their bytes written as the
    characters that byte-level tokenizers use for them.
    """

    def __init__(self, name: str = TOKENIZER, limit: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        self.merges = self.whole.model
        kinds = repr(self.whole.normalizer) + repr(self.whole.pre_tokenizer)
        self.folds = "Lowercase" in kinds and "ByteLevel" in kinds and "{L}" in kinds
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        plain = [p for p in pieces if self.folds and p.isalpha() and p == p.lower() and not _EXOTIC.search(p)]
        rest = list(set(pieces).difference(plain))
        merge = self.merges.tokenize
        coded = [[t.id for t in merge(p if p.isascii() else "".join(map(_BYTES.__getitem__, p.encode())))] for p in plain]
        for at in range(0, len(rest), 1000):
            coded += [e.ids for e in self.whole.encode_batch_fast(rest[at : at + 1000], add_special_tokens=False)]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum()))
        self.known.update(zip(chain(plain, rest), range(len(self.known), len(self.known) + len(coded))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])

    def _find(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, those not known yet learnt first."""
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        lacking = np.flatnonzero(at < 0).tolist()
        if not lacking:
            return at
        new = set(map(pieces.__getitem__, lacking))
        if self.known and len(self.known) + len(new) > self.limit:
            self._forget()
            new = set(pieces)
            lacking = range(len(pieces))
        self._learn(list(new))
        at[lacking] = np.fromiter(map(self.known.__getitem__, map(pieces.__getitem__, lacking)), np.int64, len(lacking))
        return at

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the offsets of the texts in them."""
        split = []
        for text in texts:
            if self.folds and "<|" not in text and (text.isascii() or not _EXOTIC.search(text)):
                text = _MARK.sub(r" \g<0>", text.lower())
            split.append(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
        pieces = list(chain.from_iterable(split))
        at = self._find(pieces)
        first = self.starts[at]
        sizes = self.starts[at + 1] - first
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(first - (ends - sizes), sizes) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(s) for s in split])])].astype(np.int64)
        return ids, bounds


_encoders: dict[str, Encoder] = {}


def encoded(batch_text: pa.Array, name: str):
    """Yield (first row, ids, offsets) for runs of rows; an encoder lives as long as its Python worker."""
    encoder = _encoders.get(name) or _encoders.setdefault(name, Encoder(name))
    _, offsets = utf8(batch_text)
    for i, j in chunks(offsets):
        texts = ["" if t is None else t for t in batch_text.slice(i, j - i).to_pylist()]
        yield i, *encoder(texts)


#: For each control byte the bytes of its four codes, two bits each, lowest bits first.
LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """The block's ids by falling frequency (ties by id), the control bytes and the data bytes.

    An id's code is its rank in as few bytes as hold it, lowest first. Unused control bits of the last byte are 0.
    """
    kinds, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((kinds, -counts))
    rank = np.empty(len(kinds), np.uint32)
    rank[order] = np.arange(len(kinds), dtype=np.uint32)
    codes = rank[inverse]
    size = 1 + (codes > 0xFF).astype(np.int64) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    ends = np.cumsum(size)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(4):
        some = np.flatnonzero(size > k)
        data[ends[some] - size[some] + k] = (codes[some] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return kinds[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def unpack_ids(ranks: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    starts = np.cumsum(size) - size
    data = np.frombuffer(data, np.uint8)
    codes = np.zeros(n, np.uint32)
    for k in range(int(size.max()) if n else 0):
        some = np.flatnonzero(size > k)
        codes[some] |= data[starts[some] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.frombuffer(ranks, "<u4")[codes]


BLOCKS = "part int, block int, first long, n_ids long, doc_ids array<long>, doc_sizes array<long>, ranks binary, control binary, data binary"


def _write_blocks(tokenizer: str, end_id: int, block_ids: int):
    def make(batches):
        part, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        n_held = 0

        def close():
            nonlocal block, first, n_held
            ids = np.concatenate(held)
            row = [part, block, first, len(ids), list(doc_ids), list(sizes), *pack_ids(ids)]
            block, first, n_held = block + 1, first + len(ids), 0
            doc_ids.clear(), sizes.clear(), held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 3))],
                names=[field.split()[0] for field in BLOCKS.split(", ")],
            )

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for row, ids, bounds in encoded(batch.column("text"), tokenizer):
                for k in range(len(bounds) - 1):
                    held.append(np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id)))
                    doc_ids.append(names[row + k])
                    sizes.append(len(held[-1]))
                    n_held += sizes[-1]
                    if n_held >= block_ids:
                        yield close()
        if held:
            yield close()

    return make


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all texts to ``path``, documents in ascending order of their (long) id.

    Each text is encoded whole and followed by ``end_id``; NULL counts as empty. Documents are range-partitioned by id
    and written as blocks of at least ``block_ids`` ids of whole documents. A block is self-contained: a table of its
    ids by rank, control bytes apart from data bytes, ids and sizes of its documents. Blocks lie in Parquet files, one
    row each, so any file system of Spark serves and a task that is repeated leaves nothing half written. NULL ids come
    first; rows with equal ids follow one another in the order they were read. An empty table gives no blocks.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    )
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(_write_blocks(tokenizer, end_id, block_ids), BLOCKS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start (ids before it), n_tokens, ids_crc32, and ``ids`` if asked for."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    schema = T.StructType.fromDDL("part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    if with_ids:
        schema.add("ids", T.ArrayType(T.LongType()))

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["ranks"], row["control"], row["data"], row["n_ids"])
                sizes = np.array(row["doc_sizes"], np.int64)
                starts = np.cumsum(sizes) - sizes
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), sizes.tolist())]
                columns = [pa.array(np.full(len(sizes), row["part"], np.int32)), pa.array(row["doc_ids"], pa.int64()),
                           pa.array(row["first"] + starts), pa.array(sizes), pa.array(crc, pa.int64())]
                if with_ids:
                    bounds = np.append(starts, len(ids)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    rows = blocks.mapInArrow(decode, schema).join(parts, "part")
    return rows.withColumn("start", F.col("start") + F.col("before")).drop("part", "before")
