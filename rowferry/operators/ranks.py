"""A rank index: fence posts that tell how many rows lie before each range of a key.

It is made once, by one pass that counts; a page at any position then reads, sorts
and numbers the one or two ranges that hold it, through predicates that Parquet
can filter by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.keys import after, as_keys, column
from rowferry.operators.paging import key_cuts, number_rows
from rowferry.sources.workdir import rows_of


class RankIndex:
    """Fences of a table in the order of ``keys``, then of its other columns; NULLs first.

    Ranges are cut by the first key column, so rows of equal first keys are in
    one range. The index is of the rows that were there when it was made: rows
    that are only ever appended behind the last key keep it right.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(cls, df: DataFrame, keys: str | Sequence[str], path: str, ranges: int = 64, cuts: list | None = None) -> RankIndex:
        """Count the rows of each range; ``cuts`` may come from a sketch. One row per range is written."""
        key = as_keys(keys)[0]
        cuts = key_cuts(df, key, ranges) if cuts is None else sorted(cuts)
        col = column(key)
        number = F.lit(0) if not cuts else F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < col))
        counts = df.groupBy(F.coalesce(number, F.lit(0)).alias("range_no")).agg(F.count("*").alias("n")).collect()
        sizes = {r["range_no"]: r["n"] for r in counts}
        rows, before = [], 0
        for i, (low, high) in enumerate(zip([None, *cuts], [*cuts, None])):
            rows.append((i, low, high, before, sizes.get(i, 0)))
            before += sizes.get(i, 0)
        kind = df.schema[key].dataType
        layout = T.StructType().add("range_no", "integer").add("low", kind).add("high", kind).add("before", "long").add("n", "long")
        rows_of(df.sparkSession, rows, layout).write.mode("overwrite").parquet(path)
        return cls(df.sparkSession, path)

    def fences(self) -> DataFrame:
        """range_no, low (excluded), high (included), rows before, rows."""
        return self.spark.read.parquet(self.path)

    def _range(self, df: DataFrame, key: str, first: int, last: int) -> tuple[DataFrame, int]:
        """The rows of the ranges that hold these positions, from 1, and how many rows lie before them."""
        held = self.fences().where((F.col("before") < last) & (F.col("before") + F.col("n") >= first) & (F.col("n") > 0))
        posts = held.orderBy("range_no").collect()
        if not posts:
            return df.where(F.lit(False)), 0
        return df.where(self._within(key, posts[0]["low"], posts[-1]["high"])), posts[0]["before"]

    @staticmethod
    def _within(key: str, low, high) -> Column:
        col = column(key)
        # The first range has the NULLs.
        above = F.lit(True) if low is None else col > F.lit(low)
        below = F.lit(True) if high is None else (col <= F.lit(high)) | (col.isNull() if low is None else F.lit(False))
        return above & below

    def page(self, df: DataFrame, keys: str | Sequence[str], offset: int, size: int) -> DataFrame:
        """Rows ``offset + 1`` to ``offset + size`` with their ``row_no``."""
        keys = as_keys(keys)
        rows, before = self._range(df, keys[0], offset + 1, offset + size)
        numbered = number_rows(rows, keys).withColumn("row_no", F.col("row_no") + F.lit(before))
        return numbered.where(F.col("row_no").between(offset + 1, offset + size))

    def rank(self, df: DataFrame, keys: str | Sequence[str], last: Sequence) -> int:
        """How many rows come no later than the key values ``last``: counts within one range."""
        keys = as_keys(keys)
        low, high = F.col("low"), F.col("high")
        value = F.lit(last[0])
        post = self.fences().where((low.isNull() | (low < value)) & (high.isNull() | (high >= value))).first()
        rows = df.where(self._within(keys[0], post["low"], post["high"]))
        return post["before"] + rows.where(~F.coalesce(after(keys, last), F.lit(False))).count()

    def resume(self, df: DataFrame, keys: str | Sequence[str], last: Sequence, size: int) -> DataFrame:
        """The next ``size`` rows after a checkpoint's key, with ``row_no`` in the whole table."""
        return self.page(df, keys, self.rank(df, keys, last), size)
