"""Key expressions: keyset comparison, typed watermarks, normal forms, order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DUPLICATE_KEY = "duplicate_key"
NULL_KEY = "null_key"
DELETED = "deleted"

# The collations a string key may be compared under.
KEY_COLLATIONS = ("UTF8_LCASE", "UTF8_BINARY_RTRIM", "UTF8_LCASE_RTRIM")


def quoted(name: str) -> str:
    """A column's name as Spark reads names, so that dots are part of it."""
    return f"`{name.replace('`', '``')}`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def as_keys(keys: str | Iterable[str]) -> tuple[str, ...]:
    return (keys,) if isinstance(keys, str) else tuple(keys)


def after(keys: str | Sequence[str], values: Sequence) -> Column:
    """Rows whose key sorts strictly after ``values``.

    Written as ``a > x OR (a = x AND b > y)``: unlike a struct comparison this
    form is pushed into the Parquet scan.
    """
    keys = as_keys(keys)
    if len(keys) != len(values):
        raise ValueError(f"{len(keys)} key columns but {len(values)} values")
    lits = [v if isinstance(v, Column) else F.lit(v) for v in values]
    arms = []
    for i, (k, v) in enumerate(zip(keys, lits)):
        same = [column(p) == q for p, q in zip(keys[:i], lits[:i])]
        arms.append(reduce(lambda a, b: a & b, [*same, column(k) > v]))
    return reduce(lambda a, b: a | b, arms)


def typed_value(value: str, type_name: str) -> Column:
    """A stored watermark, cast back to the key's type.

    Compared as text, '10' would sort before '9'. An instant is kept as
    microseconds since 1970, since its local text depends on the session's zone.
    """
    if type_name == "timestamp" and value is not None and value.lstrip("-").isdigit():
        return F.timestamp_micros(F.lit(int(value)))
    if type_name == "binary":
        return F.unbase64(F.lit(value))
    return F.lit(value).cast(type_name)


def typed_key(df: DataFrame, key: str, dtype: T.DataType | None) -> Column:
    """A source's key as the destination's type, in which watermarks are kept and compared.

    Text that is no such value becomes NULL, as it does when it is loaded. A
    source that lacks the column has NULL keys.
    """
    if key not in df.columns:
        return F.lit(None).cast(dtype)
    col = column(key)
    return col if dtype is None or df.schema[key].dataType == dtype else col.try_cast(dtype)


def after_watermark(key: str | Column, value: str | None, type_name: str | None, collation: str | None = None) -> Column:
    """The incremental predicate; without a watermark every row qualifies.

    Under a collation text is compared in the collation's order, in which equal
    keys lie on one side of any watermark.
    """
    if value is None:
        return F.lit(True)
    col, mark = column(key) if isinstance(key, str) else key, typed_value(value, type_name)
    return col > mark if type_name != "string" else folded(col, collation) > folded(mark, collation)


def key_text(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """A key value as the text kept in the state tables; see ``typed_value``."""
    col = column(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampType):
        col = F.unix_micros(col)
    elif isinstance(dtype, T.BinaryType):
        col = F.base64(col)
    return col.cast("string")


def normal_form(name: str, dtype: T.DataType, collation: str | None) -> Column:
    """The key as it is compared.

    Window partitioning does not honour collations, so a collated key is
    brought into a plain string that is equal exactly when the keys are.
    """
    return folded(column(name), collation if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)) else None)


def folded(col: Column, collation: str | None) -> Column:
    """Text as a plain string with the equality and order of a collation."""
    if collation is None:
        return col
    if collation not in KEY_COLLATIONS:
        raise ValueError(f"unsupported key collation {collation}")
    if collation.endswith("_RTRIM"):
        col = F.rtrim(col)
    return F.lower(col) if "LCASE" in collation else col


def normal_forms(df: DataFrame, keys: Sequence[str], collation: str | None) -> list[Column]:
    return [normal_form(k, df.schema[k].dataType, collation) for k in keys]


def key_json(df: DataFrame, keys: Sequence[str], collation: str | None) -> Column:
    """Keys as one text that is equal exactly when they are."""
    texts = []
    for form, k in zip(normal_forms(df, keys, collation), keys):
        dtype = df.schema[k].dataType
        if isinstance(dtype, (T.ArrayType, T.StructType)):
            texts.append(F.to_json(form, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}))
            continue
        # Zero has two forms.
        texts.append(key_text(form + F.lit(0.0) if dtype.typeName() in ("float", "double") else form, dtype))
    return F.to_json(F.array(*texts))


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [column(k).isNull() for k in keys])


def _sortable(field: T.StructField) -> Column:
    if _orderable(field.dataType):
        return column(field.name)
    return F.to_json(F.struct(column(field.name)))


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def total_order(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """An order over all columns, so that ties are whole-row copies only."""
    return [_sortable(f).asc_nulls_first() for f in df.schema.fields if f.name not in skip]


def bucket(forms: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*forms), F.lit(buckets)).cast("int")
