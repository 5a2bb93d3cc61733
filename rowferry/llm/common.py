"""What several operators share: the work folder, Arrow text columns, words as arrays."""

from __future__ import annotations

import contextlib
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are turned into arrays at once; a longer document is a chunk of its own.
CHUNK = 2 << 20
#: Bytes that are hashed at once, so that what is made of them stays in a core's cache.
PIECE = 1 << 16

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: Words of letters, digits and everything beyond ASCII.
WORDS = np.zeros(256, bool)
WORDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 256)]] = True
#: Words between ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Rows that a Parquet reader hands on together and bytes that are sent to Python together. Spark's own bounds are 4,096
#: rows and 10,000, or tens of MB of texts in each buffer.
BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": "256", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, in case it is not on their path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        place = os.path.join(tempfile.mkdtemp(prefix="llm-"), package)
        context.addPyFile(shutil.make_archive(place, "zip", root, package))
        _shipped.add(context.applicationId)


def shipped(query: Callable) -> Callable:
    """A query or stage, of the session and more, that ships the package first."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        return query(spark, *args)

    return run


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``, or that the context was given.

    Where there is none a local folder serves, but only for a local master:
    executors on other machines would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write once to the work folder and read back: later steps survive lost executors and agree on the rows."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> list[str]:
    """Bounds batches by ``BATCHES`` from here on, but for what the session sets itself; the settings that were made."""
    unset = [k for k in BATCHES if spark.conf.get(k, None) is None]
    for k in unset:
        spark.conf.set(k, BATCHES[k])
    return unset


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within hand texts on in bounded batches."""
    made = bound_batches(spark)
    try:
        yield
    finally:
        for k in made:
            spark.conf.unset(k)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns of these names, which an operator is about to add."""
    taken = {n.lower() for n in names}
    if not taken & {c.lower() for c in df.columns}:
        return df
    return df.select([f"`{c.replace('`', '``')}`" for c in df.columns if c.lower() not in taken])


def any_names(operator: Callable) -> Callable:
    """An operator that carries columns whose names hold dots or backticks, which Spark's maps over Arrow batches do not
    take: such columns have other names while it runs."""

    @functools.wraps(operator)
    def run(*args, **kwargs):
        at = next((i for i, a in enumerate(args) if isinstance(a, DataFrame)), None)
        odd = {} if at is None else {c: f"_odd_{i}" for i, c in enumerate(args[at].columns) if "." in c or "`" in c}
        if not odd:
            return operator(*args, **kwargs)
        args = list(args)
        args[at] = args[at].toDF(*[odd.get(c, c) for c in args[at].columns])
        out = operator(*args, **kwargs)
        back = {new: old for old, new in odd.items()}
        return out.toDF(*[back.get(c, c) for c in out.columns])

    return run


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes together, at least one row each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_1
    h = (h ^ (h >> np.uint64(27))) * _MIX_2
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, CHUNK // 2 + 1)
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        made = []
        for base in (_ODD, inverse):
            steps = np.full(n, base)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _powers = made[0], made[1]
    return _powers


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (bytes for which ``kind`` holds) and, per row, the number of words before it.

    ``offsets`` start at 0; words never reach over the end of a row.
    """
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & ~(before & ~edge[:-1]))
    ends = np.flatnonzero(inside & ~(after & ~edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as a-z."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        base, top = starts[i], ends[j - 1]
        power, inverse = _tables(int(top - base) + 1)
        piece = data[base:top]
        values = (ASCII_LOWER[piece] if lower else piece).astype(np.uint64)
        values += np.uint64(1)
        values *= power[: len(values)]
        sums = np.empty(len(values) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values, out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` words, rows disregarded; shorter than ``words`` by k - 1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out *= _ODD
        out += words[j : j + n]
    return mix(out)
