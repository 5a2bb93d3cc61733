"""Column type names: wire codes, compatibility groups, names of Spark types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column type codes of the MariaDB wire protocol.
TYPE_CODES = {
    0: "decimal",
    1: "tinyint",
    2: "smallint",
    3: "int",
    4: "float",
    5: "double",
    6: "null",
    7: "timestamp",
    8: "bigint",
    9: "mediumint",
    10: "date",
    11: "time",
    12: "datetime",
    13: "year",
    14: "date",
    15: "varchar",
    16: "bit",
    245: "json",
    246: "decimal",
    247: "enum",
    248: "set",
    249: "tinyblob",
    250: "mediumblob",
    251: "longblob",
    252: "blob",
    253: "varchar",
    254: "char",
    255: "geometry",
}

# Groups of mutually compatible types. A type belongs to a group
# when its name contains one of these tokens; the longer names of each family
# (bigint, longtext, varbinary ...) contain a listed token already.
TYPE_GROUPS = {
    "integer": ("int",),
    "string": ("char", "text"),
    "number": ("decimal", "numeric", "float", "double", "real"),
    "datetime": ("datetime", "timestamp"),
    "date": ("date",),
    "time": ("time",),
    "binary": ("blob", "binary"),
}


def type_name(code: Column | str) -> Column:
    """The name of a wire type code, ``unknown`` for any other code."""
    code = F.col(code) if isinstance(code, str) else code
    names = F.create_map(*[F.lit(x) for pair in TYPE_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code.cast("int")), F.lit("unknown"))


def _in_group(name: Column, tokens: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(name, F.lit(t)) for t in tokens])


def types_compatible(source: Column | str, dest: Column | str) -> Column:
    """Equal names, or names that share a group; case does not matter.

    Membership is by substring, hence ``date`` and ``datetime`` agree, and so
    do ``point`` and ``int``.
    """
    a = F.lower(F.col(source) if isinstance(source, str) else source)
    b = F.lower(F.col(dest) if isinstance(dest, str) else dest)
    shared = [_in_group(a, tokens) & _in_group(b, tokens) for tokens in TYPE_GROUPS.values()]
    return reduce(lambda x, y: x | y, shared, a == b)


def spark_type_name(dtype: T.DataType) -> str:
    """The database name of a Spark type, as used by the compatibility report."""
    names = [
        (T.ByteType, "tinyint"),
        (T.ShortType, "smallint"),
        (T.IntegerType, "int"),
        (T.LongType, "bigint"),
        (T.FloatType, "float"),
        (T.DoubleType, "double"),
        (T.DecimalType, "decimal"),
        (T.DateType, "date"),
        (T.TimestampNTZType, "datetime"),
        (T.TimestampType, "timestamp"),
        (T.BooleanType, "bit"),
        (T.BinaryType, "blob"),
        (T.CharType, "char"),
        (T.VarcharType, "varchar"),
        (T.StringType, "varchar"),
        (T.NullType, "null"),
    ]
    return next((n for cls, n in names if isinstance(dtype, cls)), dtype.simpleString())
