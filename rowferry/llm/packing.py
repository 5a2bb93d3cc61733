"""Operator 4: documents into sequences of fixed length by hierarchical residual best-fit packing."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_through
from .tokens import TOKENIZER, encoded

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 20_000
FAN_IN = 8


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest first, each into the fullest bin with room: the bin and offset of each item, and the bins' fill."""
    n = len(lengths)
    bins, offsets, fills = np.empty(n, np.int64), np.empty(n, np.int64), []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a bin has room for exactly r
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = some >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                some ^= 1 << left
        else:
            b, left = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = b, capacity - left
        left -= size
        fills[b] = capacity - left
        if left:
            room[left].append(b)
            some |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def underfull(fills: np.ndarray, capacity: int, nearly: float, carry: int) -> np.ndarray:
    """Bins to pack further: not nearly full, and either at most half full or among the ``carry`` emptiest.

    Two bins that are more than half full never fit together, and best fit leaves one of at most half a bin's fill per
    group. The emptiest bins are therefore more than all those half-full ones can use, and all others are final.
    """
    open_bins = np.flatnonzero(fills < nearly * capacity)
    emptiest = open_bins[np.argsort(fills[open_bins], kind="stable")]
    return np.union1d(emptiest[:carry], open_bins[2 * fills[open_bins] <= capacity])


def _pieces(text_at: int, id_at: int, tokenizer: str, end_id: int, capacity: int):
    def make(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for first, ids, bounds in encoded(batch.column(text_at), tokenizer):
                for k in range(len(bounds) - 1):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id)).astype("<u4")
                    raw = memoryview(own.tobytes())
                    for number, at in enumerate(range(0, len(own), capacity)):
                        n = min(capacity, len(own) - at)
                        doc.append(first + k), piece.append(number), start.append(at), length.append(n)
                        crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
            rows = (np.int64(task) << 40) + np.arange(row, row + len(doc))
            row += len(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), batch.column(id_at).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["_row", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return make


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document's ids with ``end_id`` after them: ``_row``, doc_id, piece, start, length, crc."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "_row long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(_pieces(1, 0, tokenizer, end_id, capacity), schema)


def place(pieces: DataFrame, capacity: int = CAPACITY, nearly: float = 0.995, group_pieces: int = GROUP_PIECES,
          carry: int = 256) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``_row``, ``length``), which must be a written table.

    Pieces are dealt at random, by a hash of their row, into groups of about ``group_pieces``, so that every group has
    the same mix of lengths; each is packed by best fit. Nearly full bins are final. Underfull ones go up a tree as
    items: eight groups' bins are packed again by best fit, and so on to the root. A bin that is put into another takes
    its pieces along. What goes up from a group is bounded (see ``underfull``), so no task of the tree grows with the input.
    """
    groups = max(1, -(-pieces.count() // group_pieces))

    def local(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["grp"].iloc[0])
        frame = frame.sort_values("_row")
        bins, offsets, fills = best_fit(frame["length"].to_numpy(), capacity)
        is_open = np.zeros(len(fills), bool)
        is_open[underfull(fills, capacity, nearly, carry)] = True
        return pd.DataFrame({"_row": frame["_row"].to_numpy(), "bin": (group << 24) + bins, "offset": offsets, "fill": fills[bins], "more": is_open[bins], "grp": group})

    dealt = pieces.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("grp"))
    placed = write_through(
        dealt.groupBy("grp").applyInPandas(local, "_row long, bin long, offset long, fill long, more boolean, grp long"), "pack-local"
    )

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bin")
        own = frame["bin"].to_numpy()
        bins, offsets, fills = best_fit(frame["fill"].to_numpy(), capacity)
        head = np.empty(len(fills), np.int64)
        head[bins[offsets == 0]] = own[offsets == 0]
        is_open = np.zeros(len(fills), bool)
        is_open[underfull(fills, capacity, nearly, carry)] = True
        return pd.DataFrame({"bin": own, "into": head[bins], "shift": offsets, "fill": fills[bins], "more": is_open[bins], "grp": int(frame["grp"].iloc[0])})

    open_bins = placed.where(F.col("more") & (F.col("offset") == 0)).select("bin", "fill", "grp")
    moves = None
    while groups > 1:
        groups = -(-groups // FAN_IN)
        up = open_bins.withColumn("grp", F.floor(F.col("grp") / FAN_IN))
        level = write_through(
            up.groupBy("grp").applyInPandas(merge, "bin long, into long, shift long, fill long, more boolean, grp long"), "pack-merge"
        )
        step = level.where("bin <> into").select("bin", "into", "shift")
        if moves is None:
            moves = step
        else:
            after = step.select(F.col("bin").alias("into"), F.col("into").alias("to"), F.col("shift").alias("further"))
            joined = moves.join(after, "into", "left")
            moved = joined.select(
                "bin", F.coalesce("to", "into").alias("into"), (F.col("shift") + F.coalesce("further", F.lit(0))).alias("shift")
            )
            moves = moved.unionByName(step)
        open_bins = level.where(F.col("more") & (F.col("bin") == F.col("into"))).select("bin", "fill", "grp")
    where = placed.select("_row", "bin", "offset")
    if moves is not None:
        where = where.join(moves, "bin", "left").select(
            "_row", F.coalesce("into", "bin").alias("bin"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")
        )
    return pieces.join(where.withColumnRenamed("bin", "sequence_id"), "_row")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A NULL or empty text is the end id alone. Ids may be NULL or repeat: every row is a document of its own. Other
    columns are not read. An empty table gives no rows. Texts are encoded once; the pieces, without ids, are written.
    """
    pieces = write_through(cut_pieces(docs, capacity, tokenizer, end_id, id_col, text_col), "pack-pieces")
    return place(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
