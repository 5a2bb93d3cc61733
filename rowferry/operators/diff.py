"""Reconciliation: what a destination lacks, has too much, or holds with other values.

Rows of both sides are summed up per leaf bucket of their key by order-free
digests, which combine per task: a few numbers per leaf and side are shuffled, and
no row. Leaves roll up into a tree, from which a report can be read at any level.
Only rows of leaves that differ are then compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import as_keys, bucket, column, normal_forms
from rowferry.sources.workdir import write_through

MISSING, EXTRA, CHANGED = "missing", "extra", "changed"
#: Each node of the tree has this many children; leaves are FANOUT ** LEVELS.
FANOUT, LEVELS = 16, 4


def row_digests(rows: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit digests of a row, NULLs told from values by their places."""
    fields = [column(c) for c in columns]
    text = F.to_json(F.struct(*[f.isNull().cast("int").alias(str(i)) for i, f in enumerate(fields)]))
    values = [F.to_json(F.struct(f.alias("v"))) if rows.schema[c].dataType.typeName() in ("map", "variant") else f for f, c in zip(fields, columns)]
    return F.xxhash64(*values, text), F.xxhash64(F.lit(17), *reversed(values), text)


def _placed(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], collation: str | None, side: str) -> DataFrame:
    forms = normal_forms(rows, keys, collation)
    a, b = row_digests(rows, columns)
    names = [f"_k{i}" for i in range(len(keys))]
    return rows.select(
        *[column(k).alias(k) for k in keys], *[f.alias(n) for n, f in zip(names, forms)],
        bucket(forms, FANOUT**LEVELS).alias("leaf"), a.alias("d0"), b.alias("d1"), F.lit(side).alias("side"),
    )


def _sums() -> list[Column]:
    """Rows and digests of each side. Sums of 64-bit numbers are kept exactly, so that copies do not cancel out."""
    out = []
    for s in ("source", "dest"):
        here = F.col("side") == s
        out.append(F.count_if(here).alias(f"{s}_n"))
        out += [F.coalesce(F.sum(F.when(here, F.col(c).cast("decimal(20,0)"))), F.lit(0)).alias(f"{s}_{c}") for c in ("d0", "d1")]
    return out


def _differs() -> Column:
    return (F.col("source_n") != F.col("dest_n")) | (F.col("source_d0") != F.col("dest_d0")) | (F.col("source_d1") != F.col("dest_d1"))


def _sides(source: DataFrame, dest: DataFrame, keys: Sequence[str], columns: Sequence[str] | None, collation: str | None) -> tuple[DataFrame, DataFrame]:
    columns = [c for c in source.columns if c in dest.columns] if columns is None else list(columns)
    # Values are compared as the destination's types.
    casts = [column(c).try_cast(dest.schema[c].dataType).alias(c) for c in dict.fromkeys([*keys, *columns])]
    typed = source.select(*casts)
    return _placed(typed, keys, columns, collation, "source"), _placed(dest, keys, columns, collation, "dest")


def diff_tree(
    source: DataFrame, dest: DataFrame, keys: str | Sequence[str], columns: Sequence[str] | None = None,
    collation: str | None = None, level: int = LEVELS,
) -> DataFrame:
    """node, source_n, dest_n, differs for the nodes of one level of the tree (0: the whole tables)."""
    keys = as_keys(keys)
    a, b = _sides(source, dest, keys, columns, collation)
    node = F.expr(f"leaf div {FANOUT ** (LEVELS - level)}").cast("int").alias("node")
    both = a.select(node, "d0", "d1", "side").unionByName(b.select(node, "d0", "d1", "side"))
    return both.groupBy("node").agg(*_sums()).select("node", "source_n", "dest_n", _differs().alias("differs"))


def table_diff(
    source: DataFrame, dest: DataFrame, keys: str | Sequence[str], columns: Sequence[str] | None = None, collation: str | None = None
) -> DataFrame:
    """The keys on which the sides differ, with ``change``, ``source_n`` and ``dest_n``.

    ``missing`` keys are in the source only, ``extra`` ones in the destination
    only; ``changed`` ones have rows with other values, or another number of
    rows. ``columns`` default to those of both sides; source values are taken as
    the destination's types. NULL keys are keys like any other. The list of
    leaves that differ has 65,536 numbers at most and goes to every task.
    """
    keys = as_keys(keys)
    a, b = _sides(source, dest, keys, columns, collation)
    names = [f"_k{i}" for i in range(len(keys))]
    both = a.select("leaf", "d0", "d1", "side").unionByName(b.select("leaf", "d0", "d1", "side"))
    leaves = write_through(both.groupBy("leaf").agg(*_sums()).where(_differs()).select("leaf"), "diff-leaves")
    rows = a.unionByName(b).join(F.broadcast(leaves), "leaf", "left_semi")
    shown = [F.min(F.struct(column(k).alias("k")))["k"].alias(k) for k in keys]
    found = rows.groupBy(*names).agg(*shown, *_sums())
    change = F.when(F.col("dest_n") == 0, MISSING).when(F.col("source_n") == 0, EXTRA).otherwise(CHANGED)
    return found.where(_differs()).select(*map(column, keys), change.alias("change"), "source_n", "dest_n")

