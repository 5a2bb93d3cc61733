"""Rejects for all that a database would refuse: several unique keys, checks and foreign keys.

With one unique key the first row of each key wins. With several, a row wins only
if it has no key in common with an *accepted* earlier row: a row that lost by one
key leaves its other keys free for later rows. Taken in order that is a loop over
all rows; here every task runs it over a block of rows that follow each other, and
what depends on open rows of earlier blocks waits for the next round. What a row is
refused for is worked out at the end.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import DELETED, DUPLICATE_KEY, any_null, column, key_json, normal_forms
from rowferry.operators.classify import SOURCE_VALUE, conform
from rowferry.operators.paging import number_rows
from rowferry.sources.workdir import empty, write_through
from rowferry.spec import DestSpec

CHECK, FOREIGN_KEY = "check:%s", "foreign_key:%s"
#: Unique keys of open rows that one task settles in turn.
IN_TURN = 1 << 20


def has_constraints(spec: DestSpec) -> bool:
    return bool(spec.unique or spec.checks or spec.foreign_keys)


def unique_keys(spec: DestSpec) -> list[tuple[str, tuple[str, ...]]]:
    """The unique keys with the reasons for breaking them, the primary key first."""
    return [(DUPLICATE_KEY, spec.primary_key), *((f"{DUPLICATE_KEY}:{n}", tuple(c)) for n, c in spec.unique.items())]


def key_columns(spec: DestSpec) -> list[str]:
    return list(dict.fromkeys(c for _, columns in unique_keys(spec) for c in columns))


def key_entries(rows: DataFrame, spec: DestSpec) -> Column:
    """The row's unique keys as (which, key); one with a NULL part binds nothing."""
    entries = []
    for i, (_, columns) in enumerate(unique_keys(spec)):
        key = key_json(rows, columns, spec.key_collation)
        entries.append(F.when(~any_null(columns), F.struct(F.lit(i).alias("which"), key.alias("key"))))
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def broken_rules(rows: DataFrame, spec: DestSpec) -> DataFrame:
    """``rows`` of ``conform`` with failed checks and foreign keys as their reason, where they have none yet. A check
    that is NULL holds, and so does a foreign key with a NULL part."""
    reason = F.col("_reason")
    for name, condition in spec.checks.items():
        reason = F.when(reason.isNull() & ~F.coalesce(F.expr(condition), F.lit(True)), F.lit(CHECK % name)).otherwise(reason)
    columns = rows.columns
    rows = rows.withColumn("_reason", reason)
    for i, (name, (own, parent, parts)) in enumerate(spec.foreign_keys.items()):
        names = [f"_f{i}_{j}" for j in range(len(own))]
        known = rows.sparkSession.table(parent).select(*[column(p).alias(n) for p, n in zip(parts, names)]).na.drop().distinct()
        same = [column(c) == F.col(n) for c, n in zip(own, names)]
        met = rows.join(known, same, "left")
        missing = F.col("_reason").isNull() & ~any_null(own) & F.col(names[0]).isNull()
        rows = met.withColumn("_reason", F.when(missing, F.lit(FOREIGN_KEY % name)).otherwise(F.col("_reason"))).select(*[column(c) for c in columns])
    return rows


def _settling():
    """What a task does with a block. Nested, so that it is sent to the workers whole and they need not have this package."""

    def settle(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        """A block's open rows taken in order; those that are refused are left out. ``marks`` names the keys that earlier
        rounds took and those that open rows of earlier blocks have, behind which nothing can be said yet."""
        rows = rows.sort_values("row_no", kind="stable")
        taken_before = marks["taken"].to_numpy(bool)
        taken, unsure = set(marks["held"][taken_before].tolist()), set(marks["held"][~taken_before].tolist())
        numbers, keys = rows["row_no"].to_numpy(), rows["key"].tolist()
        starts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist()]
        won, open_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for at, end in zip(starts, [*starts[1:], len(keys)]):
            own = keys[at:end]
            if not taken.isdisjoint(own):
                continue
            if unsure.isdisjoint(own):
                taken.update(own)
                won[at:end] = True
            else:
                unsure.update(own)
                open_[at:end] = True
        first = np.zeros(len(keys), bool)
        first[starts] = True
        return pd.DataFrame({"row_no": numbers, "key": rows["key"].to_numpy(), "won": won, "first": first})[won | open_]

    return settle


def _blocks(edges: DataFrame, in_turn: int) -> DataFrame | None:
    """The open rows in blocks, each of about ``in_turn`` keys and of rows that follow each other; None if there are none."""
    width = max(1, in_turn // 8)
    parts = edges.withColumn("part", F.expr(f"row_no div {width}"))
    # One small row for each stretch of the order.
    sizes = sorted(tuple(r) for r in parts.groupBy("part").count().collect())
    if not sizes:
        return None
    block, full, placed = 0, 0, []
    for part, n in sizes:
        if full and full + n > in_turn:
            block, full = block + 1, 0
        placed.append((part, block))
        full += n
    of_part = edges.sparkSession.createDataFrame(pd.DataFrame(placed, columns=["part", "block"]), "part long, block int")
    return parts.join(F.broadcast(of_part), "part").select("block", "row_no", "key")


def accepted_rows(edges: DataFrame, in_turn: int = IN_TURN) -> DataFrame:
    """``row_no`` of the rows that a loop in the order of ``row_no`` would accept.

    ``edges`` has one row for each unique key of a row: row_no and key. The open rows are cut into blocks along their
    order. In a round each task takes the rows of a block in turn: it accepts and refuses them as the loop would, but for
    rows that share a key with an open one of an earlier block, or with one left open before them, which wait for the
    next round. The first block waits for nothing, so there are no more rounds than blocks, however long the chains of
    rows that each wait for the one before.
    """
    ids = edges.select("key").distinct().withColumn("id", F.monotonically_increasing_id())
    ids = write_through(ids, "unique-ids")
    open_ = write_through(edges.join(ids, "key").select("row_no", F.col("id").alias("key")), "unique-numbered")
    wins: list[DataFrame] = []
    while (rows := _blocks(open_, in_turn)) is not None:
        seen = rows.select("key", "block", F.lit(False).alias("taken"))
        if wins:
            # What earlier rounds took is settled in the open rows already.
            seen = seen.unionByName(wins[-1].select("key", F.lit(None).cast("int").alias("block"), F.lit(True).alias("taken")))
        marks = seen.groupBy("key").agg(F.collect_set("block").alias("blocks"), F.max("taken").alias("taken"))
        behind = F.filter("blocks", lambda b: F.col("taken") | (b > F.array_min("blocks")))
        marks = marks.select(F.explode(behind).alias("at"), F.col("key").alias("held"), "taken")
        done = rows.groupBy("block").cogroup(marks.groupBy("at")).applyInPandas(_settling(), "row_no long, key long, won boolean, first boolean")
        done = write_through(done, "round")
        wins.append(done.where("won"))
        open_ = done.where(~F.col("won")).select("row_no", "key")
    out = empty(edges.sparkSession, "row_no long")
    for won in wins:
        out = out.unionByName(won.where("first").select("row_no"))
    return out


def classify_constrained(
    source: DataFrame, spec: DestSpec, existing: DataFrame | None = None, deleted: DataFrame | None = None, in_turn: int = IN_TURN
) -> DataFrame:
    """Every source row with the columns of the destination, ``_reason`` (NULL when accepted) and ``_row``.

    As ``classify``, for a destination with unique keys beside the primary one, checks and foreign keys. ``existing``
    has the destination's visible rows, or just the columns of all unique keys; ``deleted`` primary keys that must not
    come back. Rows are taken in the order of the primary key, then of the other columns. The first of these that holds
    is the reason: a failed conversion or NULL, a check, a foreign key, a deleted key, then the first unique key in
    common with an accepted earlier row or one of the destination. Rows refused for other reasons occupy no key.
    """
    names = spec.schema.names
    rows = broken_rules(conform(source, spec), spec)
    if deleted is not None:
        held = deleted.select(*[column(k).cast(spec.schema[k].dataType).alias(k) for k in spec.primary_key])
        forms = [f"_k{i}" for i in range(len(spec.primary_key))]
        columns = rows.columns
        held = held.select(*[f.alias(n) for n, f in zip(forms, normal_forms(held, spec.primary_key, spec.key_collation))]).distinct()
        rows = rows.withColumns(dict(zip(forms, normal_forms(rows, spec.primary_key, spec.key_collation))))
        rows = rows.join(held.withColumn("_gone", F.lit(DELETED)), forms, "left")
        rows = rows.withColumn("_reason", F.coalesce("_reason", "_gone")).select(*[column(c) for c in columns])
    # Numbers are written out with the rows: every round below reads the same ones.
    numbered = number_rows(rows, spec.primary_key)
    entries = numbered.where(F.col("_reason").isNull()).select("row_no", key_entries(numbered, spec).alias("keys"))
    edges = entries.select("row_no", F.inline("keys"))
    edges = edges.select("row_no", "which", F.concat_ws(":", "which", "key").alias("key"))
    edges = write_through(edges, "unique-keys")
    open_, occupied = edges, None
    if existing is not None:
        existing = existing.select(*map(column, key_columns(spec)))
        occupied = existing.select(F.explode(key_entries(existing, spec)).alias("e")).select(F.concat_ws(":", "e.which", "e.key").alias("key")).distinct()
        refused = edges.join(occupied, "key", "left_semi").select("row_no").distinct()
        open_ = write_through(edges.join(refused, "row_no", "left_anti"), "unique-open")
    won = accepted_rows(open_.select("row_no", "key"), in_turn)
    taken = edges.join(won, "row_no", "left_semi").select("key", F.col("row_no").alias("holder"))
    if occupied is not None:
        taken = taken.unionByName(occupied.select("key", F.lit(0).cast("long").alias("holder")))
    lost = edges.join(taken, "key").where(F.col("holder") < F.col("row_no")).groupBy("row_no").agg(F.min("which").alias("which"))
    reasons = F.array(*[F.lit(reason) for reason, _ in unique_keys(spec)])
    lost = lost.select("row_no", F.get(reasons, F.col("which")).alias("_lost"))
    result = numbered.join(lost, "row_no", "left").withColumn("_reason", F.coalesce("_reason", "_lost"))
    shown = [column(SOURCE_VALUE + n).alias(n) if SOURCE_VALUE + n in numbered.columns else column(n) for n in names]
    text = F.when(F.col("_reason").isNotNull(), F.coalesce(F.col("_row"), F.to_json(F.struct(*shown))))
    return result.withColumn("_row", text).select(*[column(n) for n in names], "_reason", "_row")

