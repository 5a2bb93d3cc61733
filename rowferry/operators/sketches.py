"""Mergeable sketches of a key: rows, distinct values, quantiles, overlap.

Each run leaves one row; rows are merged without looking at the data again. They
serve for range cuts and load estimates; ``profile.key_profile`` stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.keys import column

SKETCH = "pk string, pk_type string, n_rows long, n_null long, theta binary, quantiles binary"
#: Accuracy: ranks are right to about one per cent, distinct counts to about two.
K, LG = 400, 13

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)
_REAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _number(col: Column, dtype: T.DataType) -> tuple[Column, str] | None:
    """The key as a number of the same order, and the kind of sketch; None for text and the like."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("long"), "bigint"
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col), "bigint"
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(col.cast("timestamp"), F.current_timezone())), "bigint"
    if isinstance(dtype, _WHOLE):
        return col.cast("long"), "bigint"
    return (col.cast("double"), "double") if isinstance(dtype, _REAL) else None


def quantile_kind(dtype: T.DataType) -> str | None:
    """The kind of a key's quantile sketch."""
    made = _number(F.lit(None), dtype)
    return made and made[1]


def _type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"k {name}")["k"].dataType


def key_sketch(rows: DataFrame, key: str) -> DataFrame:
    """One row of ``SKETCH`` for a key column. Keys without numbers of their order have no quantiles."""
    dtype = rows.schema[key].dataType
    col = column(key)
    number = _number(col, dtype)
    texts = col if isinstance(dtype, (T.IntegerType, T.LongType, T.StringType, T.BinaryType, T.DoubleType, T.FloatType)) else col.cast("string")
    quantiles = F.lit(None).cast("binary") if number is None else F.when(F.count(col) > 0, F.call_function(f"kll_sketch_agg_{number[1]}", number[0], F.lit(K)))
    return rows.agg(
        F.lit(key).alias("pk"), F.lit(dtype.simpleString()).alias("pk_type"), F.count("*").alias("n_rows"),
        F.count_if(col.isNull()).alias("n_null"), F.call_function("theta_sketch_agg", texts, F.lit(LG)).alias("theta"), quantiles.alias("quantiles"),
    )


def merge_sketches(sketches: DataFrame, kind: str | None, *by: str) -> DataFrame:
    """Sketches of the same key as one for each value of ``by``. ``kind``: of their quantiles, "bigint", "double" or None."""
    quantiles = F.lit(None).cast("binary") if kind is None else F.when(F.count("quantiles") > 0, F.call_function(f"kll_merge_agg_{kind}", "quantiles"))
    return sketches.groupBy(*by).agg(
        F.first("pk").alias("pk"), F.first("pk_type").alias("pk_type"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"), F.call_function("theta_union_agg", F.col("theta")).alias("theta"), quantiles.alias("quantiles"),
    )


def sketch_profile(sketches: DataFrame, kind: str | None, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """n_rows, n_null, n_distinct (estimated) and, as numbers, the keys at these ranks."""
    at = F.array(*[F.lit(float(r)) for r in ranks])
    values = F.lit(None).cast("array<long>") if kind is None else F.call_function(f"kll_sketch_get_quantile_{kind}", "quantiles", at)
    rest = [c for c in sketches.columns if c not in ("pk_type", "n_rows", "n_null", "theta", "quantiles")]
    return sketches.select(
        *rest, "n_rows", "n_null", F.call_function("theta_sketch_estimate", F.col("theta")).cast("long").alias("n_distinct"), values.alias("at_ranks"))


def overlap(one: DataFrame, other: DataFrame) -> DataFrame:
    """n_common: about how many distinct keys two sketches of one row each share."""
    both = one.select("theta").unionByName(other.select("theta"))
    return both.agg(F.call_function("theta_sketch_estimate", F.call_function("theta_intersection_agg", F.col("theta"))).cast("long").alias("n_common"))


def sketch_cuts(sketch: Row, ranges: int) -> list:
    """At most ``ranges - 1`` key values that cut the rows into like shares, without reading them; [] if there are no
    quantiles. As ``paging.key_cuts``, cuts only decide which range a row is loaded with."""
    if ranges < 2 or sketch is None or sketch["quantiles"] is None:
        return []
    dtype = _type(sketch["pk_type"])
    kind = _number(F.lit(None), dtype)[1]
    at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    value = F.explode(F.call_function(f"kll_sketch_get_quantile_{kind}", F.lit(bytes(sketch["quantiles"])), at))
    found = SparkSession.active().range(1).select(value.alias("v")).distinct()
    if isinstance(dtype, T.DateType):
        found = found.select(F.date_from_unix_date(F.col("v").cast("int")).alias("v"))
    elif isinstance(dtype, T.TimestampType):
        found = found.select(F.timestamp_micros("v").alias("v"))
    elif isinstance(dtype, T.TimestampNTZType):
        found = found.select(F.from_utc_timestamp(F.timestamp_micros("v"), F.current_timezone()).cast("timestamp_ntz").alias("v"))
    else:
        found = found.select(F.col("v").cast(dtype).alias("v"))
    return sorted(r["v"] for r in found.collect())
