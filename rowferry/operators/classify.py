"""Splitting source rows into accepted and rejected ones.

The destination holds one row per key. A row is rejected when its key is NULL,
a NOT NULL column is NULL, a value does not fit the column's type or length,
an earlier row of the load has the key, or the destination already has it. Only
rows that pass the row checks compete for a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.keys import DUPLICATE_KEY, NULL_KEY, any_null, as_keys, column, normal_forms, quoted, total_order
from rowferry.spec import DestSpec

SOURCE, DEST = 1, 0
#: Rows of one key, from one task, that are ranked together: a million.
RUN_BITS = 20


SOURCE_VALUE = "_source_"


def converted(source: DataFrame, field: T.StructField) -> Column:
    """A source column as the field's type, NULL where a value does not fit. Lengths are not checked here."""
    raw = column(field.name)
    kind = T.StringType() if isinstance(field.dataType, (T.VarcharType, T.CharType)) else field.dataType
    try:
        value = raw.try_cast(kind)
        source.select(value)
    except AnalysisException:
        return F.lit(None).cast(kind)
    return value


def conform(source: DataFrame, spec: DestSpec) -> DataFrame:
    """Source rows as destination rows, with the first failing check.

    Columns are matched by name; columns only the destination has get their
    default or NULL. Adds ``_reason``, for failing rows the row as JSON, and
    under ``SOURCE_VALUE`` names what converted columns were in the source.
    A conversion that Spark does not know fails for every value; a source
    without a key column has NULL keys.
    """
    values, raws, nulls, casts, lengths = {}, [], [], [], []
    for f in spec.schema.fields:
        if f.name not in source.columns:
            value = F.lit(spec.defaults.get(f.name)).cast(f.dataType)
            if not f.nullable and f.name not in spec.defaults:
                nulls.append((F.lit(True), f"not_null:{f.name}"))
            values[f.name] = value.alias(f.name)
            continue
        raw = column(f.name)
        same = source.schema[f.name].dataType == f.dataType
        value = raw if same else converted(source, f)
        if not same:
            raws.append(raw.alias(SOURCE_VALUE + f.name))
        # An alias on an unchanged column would keep Spark from reusing the shuffle.
        values[f.name] = raw if same else value.alias(f.name)
        if not f.nullable and f.name not in spec.primary_key:
            nulls.append((raw.isNull(), f"not_null:{f.name}"))
        if not same:
            casts.append((raw.isNotNull() & value.isNull(), f"bad_cast:{f.name}"))
        longest = spec.max_length.get(f.name, getattr(f.dataType, "length", None))
        if longest is not None:
            too_long = F.char_length(value.cast("string")) > longest
            lengths.append((too_long, f"too_long:{f.name}"))
    reason = F.lit(None).cast("string")
    lacking = any(k not in source.columns and k not in spec.defaults for k in spec.primary_key)
    given = [k for k in spec.primary_key if k in source.columns]
    no_key = F.lit(True) if lacking else any_null(given) if given else F.lit(False)
    checks = [(no_key, NULL_KEY), *nulls, *casts, *lengths]
    for failed, name in reversed(checks):
        reason = F.when(failed, F.lit(name)).otherwise(reason)
    checked = source.withColumn("_reason", reason)
    text = F.when(F.col("_reason").isNotNull(), F.to_json(F.struct(*[column(c) for c in source.columns])))
    return checked.select(*values.values(), *raws, "_reason", text.alias("_row"))


def accepted(
    source: DataFrame,
    keys: str | Sequence[str],
    existing: DataFrame | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The first row of every non-null key that the destination lacks.

    Use this where the rejects are not wanted. Spark prunes to one row per key
    and task ahead of the shuffle, so a hot key costs nothing; the anti join
    then reuses the partitioning by key.
    """
    keys = as_keys(keys)
    order = order or total_order(source, keys)
    first = (
        source.where(~any_null(keys))
        .withColumn("_rn", F.row_number().over(W.partitionBy(*map(column, keys)).orderBy(*order)))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )
    return first if existing is None else first.join(existing.select(*map(column, keys)), list(keys), "left_anti")


def classify_conformed(
    rows: DataFrame,
    spec: DestSpec,
    existing: DataFrame | None = None,
    order: Sequence[Column] | None = None,
    split: bool = True,
) -> DataFrame:
    """Every row of ``conform`` with its final ``_reason``, NULL when accepted.

    ``existing`` holds taken keys; rows that lose to one are duplicates, or get
    the reason in its column ``_why`` where it has one.

    The rows of a key are spread by the task that made them and their place in
    it, ``2 ** RUN_BITS`` rows at a time, and ranked there. Only the best of each run then
    meets the destination's keys, which sort ahead of the rows that compete for
    them. So no key's rows need to fit in one task, also where the query ends in
    a shuffle by that key, and the source is read once. Rows already rejected
    are spread the same way. ``split=False`` ranks all rows of a key at once,
    for sources known to hold few rows per key; the outcome is the same.
    """
    # The id counts the rows of a task from a start of its own.
    run = F.shiftright(F.monotonically_increasing_id(), RUN_BITS)
    keys = spec.primary_key
    # Keys that are equal under a collation may still differ, so they order too.
    same = keys if spec.key_collation is None else ()
    names = spec.schema.names
    order = list(order or total_order(rows.select(*[column(n) for n in names]), same))
    forms, by_forms = list(keys), [quoted(k) for k in keys]
    if spec.key_collation is not None:
        forms = by_forms = [f"_k{i}" for i in range(len(keys))]
        rows = rows.withColumns(dict(zip(forms, normal_forms(rows, keys, spec.key_collation))))
    meet = rows.withColumns(
        {
            "_origin": F.lit(SOURCE),
            "_bad": F.col("_reason").isNotNull(),
            "_salt": run if split else F.when(F.col("_reason").isNotNull(), run).otherwise(-1),
        }
    )
    why = ["_why"] if existing is not None and "_why" in existing.columns else []
    if existing is not None:
        held = existing.select(*[column(k).cast(spec.schema[k].dataType).alias(k) for k in keys], *why)
        held = held.select(
            *[f.alias(n) for n, f in zip(forms, normal_forms(held, keys, spec.key_collation))],
            F.lit(DEST).alias("_origin"),
            F.lit(False).alias("_bad"),
            F.lit(-1).cast("long").alias("_salt"),
            *why,
        )

    def met(df):
        return df if existing is None else df.unionByName(held, allowMissingColumns=True)

    def ranked(df, *by):
        window = W.partitionBy(*by).orderBy("_origin", *(F.col(c).asc_nulls_last() for c in why if c in df.columns), *order)
        return df.withColumns({"_rn": F.row_number().over(window), **{c: F.first(c).over(window) for c in why if c in df.columns}})

    def settled(df):
        lost = ~F.col("_bad") & (F.col("_rn") > 1)
        reason = F.when(lost, F.coalesce(*(c for c in why if c in df.columns), F.lit(DUPLICATE_KEY))).otherwise(F.col("_reason"))
        return df.where(F.col("_origin") == SOURCE).withColumn("_reason", reason)

    if not split:
        result = settled(ranked(met(meet), *by_forms, "_salt", "_bad"))
    else:
        # A difference, since a limit on _rn itself would move into one branch and part their shuffles.
        # Asked for, since a query that ends in a shuffle by key would be taken as it is, its hot key in one task.
        first = ranked(meet.repartition(*by_forms, "_salt", "_bad"), *by_forms, "_salt", "_bad")
        behind = F.col("_rn") - F.when(~F.col("_bad"), F.lit(1)).otherwise(F.lit(0))
        again = settled(ranked(met(first.where(behind == 0).drop("_rn")), *by_forms))
        rest = first.where(behind != 0)
        if why:
            # What a held key's rows are refused for holds for all of them, whichever round they lost in.
            held_why = held.groupBy(*by_forms).agg(F.min("_why").alias("_why"))
            rest = rest.join(held_why, list(forms), "left")
        result = again.unionByName(settled(rest).select(*map(column, again.columns)))
    # Dead letters show what the source held, not what it was converted to.
    shown = [column(SOURCE_VALUE + n).alias(n) if SOURCE_VALUE + n in rows.columns else column(n) for n in names]
    text = F.when(F.col("_reason").isNotNull(), F.coalesce(F.col("_row"), F.to_json(F.struct(*shown))))
    return result.withColumn("_row", text).select(*map(column, names), "_reason", "_row")


def classify(
    source: DataFrame,
    spec: DestSpec,
    existing: DataFrame | None = None,
    order: Sequence[Column] | None = None,
    split: bool = True,
) -> DataFrame:
    return classify_conformed(conform(source, spec), spec, existing, order, split)


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("_reason").isNotNull())


def reject_table(classified: DataFrame, run_id: str) -> DataFrame:
    """Dead letters: the row as JSON with the reason it was refused."""
    return rejected(classified).select(
        F.lit(run_id).alias("run_id"), F.col("_reason").alias("reason"), F.col("_row").alias("row")
    )
