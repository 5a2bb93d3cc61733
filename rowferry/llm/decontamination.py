"""Operator 2: benchmark passages in documents, by winnowed fingerprints whose hits are extended to whole windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_LOWER, WORDS, any_names, chunks, gram_hashes, utf8, without, word_hashes, word_spans, write_through

GRAM = 5
WINDOW = 10
#: Bits of the filter of benchmark fingerprints: 8 MB, however large the benchmark is.
FILTER_BITS = 1 << 26
_BUCKET = 1 << 15


def winnow(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The fingerprint of each run of ``window`` words: the least hash of the runs of ``gram`` words in it.

    Two texts that share a run of ``window`` words share its fingerprint, whatever stands around it.
    """
    grams = gram_hashes(words, gram)
    n = len(grams) - (window - gram)
    if n <= 0:
        return np.zeros(0, np.uint64)
    least = grams[:n].copy()
    for j in range(1, window - gram + 1):
        np.minimum(least, grams[j : j + n], out=least)
    return least


def _inside(first: np.ndarray, n: int) -> np.ndarray:
    """Positions of words from which ``n`` words of the same row follow."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])
    return np.flatnonzero(left >= n)


def _text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, n: int) -> str:
    """The ``n`` words at a position, lower-cased, with single spaces."""
    return b" ".join([data[s:e].tobytes() for s, e in zip(starts[at : at + n], ends[at : at + n])]).decode()


def _item_windows(window: int, gram: int):
    def make(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("item_id")
            rows, prints, sizes, texts = [], [], [], []
            for i in range(len(ids)):
                own = ASCII_LOWER[data[offsets[i] : offsets[i + 1]]]
                starts, ends, _ = word_spans(own, np.array([0, len(own)]), WORDS)
                hashes, n = word_hashes(own, starts, ends, False), min(window, len(starts))
                if not n:
                    continue
                marks = winnow(hashes, window, gram) if n == window else gram_hashes(hashes, n)
                rows += [i] * len(marks)
                prints.append(marks)
                sizes += [n] * len(marks)
                texts += [_text(own, starts, ends, at, n) for at in range(len(marks))]
            prints = np.concatenate(prints).view(np.int64) if prints else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())), pa.array(prints), pa.array(sizes, pa.int32()), pa.array(texts, pa.string())],
                names=["item_id", "print", "n", "window"],
            )

    return make


def _print_filter(items: DataFrame) -> np.ndarray:
    """A bitmap of the fingerprints, put together by Spark; it has FILTER_BITS bits at any number of items."""
    bit = F.pmod("print", F.lit(FILTER_BITS)) + 1
    parts = (
        items.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for part in parts:
        at = (part.bucket - 1) * _BUCKET // 8
        out[at : at + _BUCKET // 8] = np.frombuffer(bytes(part.bits), np.uint8)
    return out


def _passes(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    # fingerprints count as signed numbers in Spark; modulo a power of two both agree
    bit = prints & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


HITS = T.ArrayType(
    T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("window", T.StringType())])
)
_HIT = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("window", pa.string())])


def _document_hits(bitmap, short: list[int], window: int, gram: int, text_at: int, kept: list[int], names: list[str]):
    """Adds to each document a row number, its words and the windows whose fingerprint passes the filter."""

    def make(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = utf8(batch.column(text_at))
            n_words = np.zeros(batch.num_rows, np.int64)
            counts = np.zeros(batch.num_rows + 1, np.int32)
            at_all, n_all, texts = [], [], []
            for i, j in chunks(offsets):
                piece = ASCII_LOWER[data[offsets[i] : offsets[j]]]
                starts, ends, first = word_spans(piece, offsets[i : j + 1] - offsets[i], WORDS)
                n_words[i:j] = np.diff(first)
                hashes = word_hashes(piece, starts, ends, False)
                found_at, found_n = [], []
                for n in [*short, window]:
                    marks = winnow(hashes, window, gram) if n == window else gram_hashes(hashes, n)
                    whole = _inside(first, n)
                    # a fingerprint stays the same over several windows: ask the filter once for each run
                    marks = marks[whole]
                    new = np.ones(len(marks), bool)
                    new[1:] = (marks[1:] != marks[:-1]) | (np.diff(whole) != 1)
                    runs = np.flatnonzero(new)
                    good = np.repeat(_passes(bitmap.value, marks[runs]), np.diff(np.append(runs, len(marks))))
                    at = whole[good]
                    found_at.append(at)
                    found_n.append(np.full(len(at), n))
                at, size = np.concatenate(found_at), np.concatenate(found_n)
                doc = np.searchsorted(first, at, "right") - 1
                order = np.argsort(doc, kind="stable")
                at, size, doc = at[order], size[order], doc[order]
                counts[i + 1 : j + 1] = np.bincount(doc, minlength=j - i)
                texts += [_text(piece, starts, ends, a, n) for a, n in zip(at.tolist(), size.tolist())]
                at_all.append(at - first[doc])
                n_all.append(size)
            at = np.concatenate(at_all).astype(np.int32) if at_all else np.zeros(0, np.int32)
            size = np.concatenate(n_all).astype(np.int32) if n_all else np.zeros(0, np.int32)
            hits = pa.ListArray.from_arrays(
                pa.array(np.cumsum(counts, dtype=np.int32)),
                pa.StructArray.from_arrays([pa.array(at), pa.array(size), pa.array(texts, pa.string())], fields=list(_HIT)),
            )
            rows = (np.int64(task) << 40) + np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(n_words), pa.array(rows), hits], names=names
            )

    return make


def _covered(spans: Column) -> Column:
    """Words in any of the spans, which are sorted (start, length) pairs."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("to"))

    def add(state: Column, span: Column) -> Column:
        end = span["at"] + span["n"]
        return F.struct(
            (state["sum"] + F.greatest(F.lit(0), end - F.greatest(span["at"], state["to"]))).alias("sum"),
            F.greatest(state["to"], end).alias("to"),
        )

    return F.aggregate(spans, start, add, lambda state: state["sum"])


@any_names
def find_overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, carry: bool = True,
                  text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (ids as strings, sorted) and ``contaminated``.

    A document word is hit when it lies in a run of ``window`` words that also stands in an item (``item_id``,
    ``text``). An item of fewer words counts as one run of its own; for each such length, of which there are fewer than
    ``window``, the documents' runs of that length are fingerprints themselves.

    One map over the documents winnows them, asks a bitmap of the items' fingerprints, whose size is fixed, and keeps
    the windows that pass, with their words. These meet the items' distinct windows in an equi-join on all the words,
    which removes what only the hash or the bitmap let through. Only documents with such windows are shuffled. With
    more items the bitmap lets more through and the join does more; the result is the same.

    Empty, NULL and word-less texts have no words and no hits. Every row is judged by itself, so NULL and repeated ids
    do no harm. Items without words match nothing; an item that occurs twice counts once per id; a NULL item id
    is left out of ``items``, but its words are hit. With ``carry`` all columns come along (those named like added ones
    are replaced), without it all but the text. Empty tables give no rows, or rows without hits.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    spark = docs.sparkSession
    sides = write_through(
        items.select("item_id", "text").mapInArrow(
            _item_windows(window, gram),
            T.StructType([items.schema["item_id"], *T.StructType.fromDDL("print long, n int, window string").fields]),
        ),
        "item-windows",
    )
    short = sorted(r.n for r in sides.where(F.col("n") < window).select("n").distinct().collect())
    bitmap = spark.sparkContext.broadcast(_print_filter(sides))
    docs = without(docs, "n_words", "n_hit", "items", "contaminated", "_row", "_hits")
    text_at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if carry or i != text_at]
    added = T.StructType.fromDDL("n_words long, _row long").add(T.StructField("_hits", HITS))
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), *added.fields])
    rows = docs.mapInArrow(_document_hits(bitmap, short, window, gram, text_at, kept, schema.names), schema)
    rows = write_through(rows, "document-hits")
    known = sides.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    asked = rows.where(F.size("_hits") > 0).select("_row", F.inline("_hits"))
    found = (
        asked.join(known, "window")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("spans"), F.collect_set("ids").alias("ids"))
        .select("_row", _covered(F.col("spans")).cast("long").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten("ids"))).alias("items"))
    )
    clean = rows.where(F.size("_hits") == 0).drop("_hits", "_row")
    clean = clean.withColumns({"n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>")})
    hit = rows.where(F.size("_hits") > 0).drop("_hits").join(found, "_row", "left").drop("_row")
    hit = hit.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", F.array().cast("array<string>"))})
    return clean.unionByName(hit).withColumn("contaminated", F.col("n_hit") > 0)
