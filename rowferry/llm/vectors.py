"""What the operators on vectors share: list columns as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def usable(column: pa.Array) -> np.ndarray:
    """True for lists that are not NULL and hold no NULL and no non-finite component."""
    flat = column.values.slice(column.offsets[0].as_py(), column.offsets[-1].as_py() - column.offsets[0].as_py()) if len(column) else None
    good = np.asarray(column.is_valid()).copy()
    if flat is None:
        return good
    offsets = np.asarray(column.offsets).astype(np.int64)
    offsets -= offsets[0]
    bad = ~np.isfinite(np.asarray(flat.cast(pa.float64()).fill_null(np.nan)))
    upto = np.concatenate([[0], np.cumsum(bad)])
    return good & (upto[offsets[1:]] == upto[offsets[:-1]])


def matrices(column: pa.Array, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length among these rows: their positions, and their lists as a matrix of doubles."""
    if not len(rows):
        return
    offsets = np.asarray(column.offsets).astype(np.int64)
    flat = np.asarray(column.values.cast(pa.float64()).fill_null(0.0))
    sizes = offsets[rows + 1] - offsets[rows]
    for size in np.unique(sizes):
        at = rows[sizes == size]
        yield at, flat[offsets[at][:, None] + np.arange(size)]
