"""Keyset polling as a streaming data source: what lies after a typed watermark, read by key ranges.

``spark.readStream.format("keyset")`` follows a folder of Parquet files in the order
of a key column. The offset is the highest key handed out, kept in the stream's
checkpoint with its type. Each micro-batch is planned from the files' statistics:
executors read their own range of the key, as Arrow batches, from the files
whose bounds meet it. Keys at or below the watermark that arrive later are not
seen, as with any polling by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

EPOCH = datetime(1970, 1, 1)


def as_text(value) -> str | None:
    """A key in an offset; instants as microseconds, so that no zone takes part."""
    if value is None:
        return None
    if isinstance(value, datetime):
        value = value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        return str((value - EPOCH) // timedelta(microseconds=1))
    return value.isoformat() if isinstance(value, date) else str(value)


def as_value(text: str | None, kind: pa.DataType) -> pa.Scalar | None:
    if text is None:
        return None
    if pa.types.is_timestamp(kind):
        return pa.scalar(int(text), pa.timestamp("us", tz=kind.tz)).cast(kind, safe=False)
    if pa.types.is_date(kind):
        return pa.scalar(date.fromisoformat(text), kind)
    return pa.scalar(text).cast(kind) if not pa.types.is_string(kind) else pa.scalar(text, kind)


#: Spark's older instants are read as microseconds.
FORMAT = ds.ParquetFileFormat(coerce_int96_timestamp_unit="us")


def table(paths: str | list[str]) -> ds.Dataset:
    return ds.dataset(paths, format=FORMAT)


class KeyRange(InputPartition):
    def __init__(self, files: list[str], low: str | None, high: str):
        self.files, self.low, self.high = files, low, high


class KeysetReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.key = options["path"], options["key"]
        self.ranges = int(options.get("ranges", "8"))
        self.columns = schema.names
        self.instants = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)]
        self.known: dict[str, list] = {}

    def _bounds(self) -> list[tuple[str, pa.Scalar, pa.Scalar]]:
        """Least and greatest key of each row group, from the footers; of each file once, as files do not change.

        Where the writer left no statistics, as Spark does for instants in its older format, the key column is read.
        """
        rows = table(self.path)
        kind, out = rows.schema.field(self.key).type, []
        for fragment in rows.get_fragments():
            if fragment.path not in self.known:
                self.known[fragment.path] = list(self._groups(fragment, kind))
            out += [(fragment.path, low, high) for low, high in self.known[fragment.path]]
        return out

    def _groups(self, fragment, kind: pa.DataType):
        meta = fragment.metadata
        at = meta.schema.names.index(self.key)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            if stats is not None and stats.has_min_max:
                yield pa.scalar(stats.min, kind), pa.scalar(stats.max, kind)
                continue
            ends = pc.min_max(fragment.subset(row_group_ids=[g]).to_table(columns=[self.key])[self.key])
            if ends["max"].is_valid:
                yield ends["min"], ends["max"]

    def initialOffset(self) -> dict:
        return {"after": None}

    def latestOffset(self) -> dict:
        keys = [high.as_py() for _, _, high in self._bounds()]
        return {"after": as_text(max(keys)) if keys else None}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Ranges of the key between the offsets, cut at the bounds of row groups, with the files that meet them."""
        if end["after"] is None or start["after"] == end["after"]:
            return []
        bounds = self._bounds()
        kind = bounds[0][1].type
        low, high = as_value(start["after"], kind), as_value(end["after"], kind)
        inside = sorted({b.as_py() for _, _, b in bounds if (low is None or b.as_py() > low.as_py()) and b.as_py() < high.as_py()})
        step = max(1, -(-len(inside) // max(1, self.ranges - 1)))
        cuts = [None if low is None else low.as_py(), *inside[step - 1 :: step], high.as_py()]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            files = sorted({f for f, lo, hi in bounds if lo.as_py() <= b and (a is None or hi.as_py() > a)})
            if files:
                out.append(KeyRange(files, as_text(a), as_text(b)))
        return out

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        rows = table(partition.files)
        kind = rows.schema.field(self.key).type
        wanted = pc.field(self.key) <= as_value(partition.high, kind)
        if partition.low is not None:
            wanted = wanted & (pc.field(self.key) > as_value(partition.low, kind))
        for batch in rows.to_batches(columns=self.columns, filter=wanted):
            for name in self.instants:
                if batch.schema.field(name).type.tz is None:
                    i = batch.schema.names.index(name)
                    batch = batch.set_column(i, name, batch.column(i).cast(pa.timestamp("us", "UTC")))
            yield batch

    def commit(self, end: dict) -> None:
        pass


class KeysetSource(DataSource):
    """Options: path, key, and ranges (how many a micro-batch is read in, 8)."""

    @classmethod
    def name(cls) -> str:
        return "keyset"

    def schema(self) -> T.StructType:
        rows = table(self.options["path"])
        made = from_arrow_schema(rows.schema)
        first = next(iter(rows.get_fragments()))
        old = {first.metadata.schema.column(i).name for i in range(first.metadata.num_columns) if first.metadata.schema.column(i).physical_type == "INT96"}
        return T.StructType([T.StructField(f.name, T.TimestampType() if f.name in old else f.dataType, f.nullable) for f in made.fields])

    def streamReader(self, schema: T.StructType) -> KeysetReader:
        return KeysetReader(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KeysetSource)
