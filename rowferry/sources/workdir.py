"""Small local relations and a shared place for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct_type(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows; planned away entirely, unlike an empty RDD."""
    schema = struct_type(schema)
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).where(F.lit(False)).select(*columns)


def rows_of(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A few driver-side rows, such as one state entry, as literals."""
    schema = struct_type(schema)
    if not rows:
        return empty(spark, schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names, or that
    the context was given.

    A machine-local folder is only made where there is none and the master is
    local; executors on other machines would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="rowferry-")
    return f"{root.rstrip('/')}/rowferry/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame once and read it back.

    Cuts the lineage and pins values that depend on how Spark partitioned the
    rows; a lost executor cannot change what later stages read.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def fold_files(df: DataFrame, path: str) -> None:
    """Write ``df``, which reads ``path``, back to it and delete what it read.

    For tables whose readers do not mind a row that is there twice, which is
    the case between the two steps. One writer at a time is assumed.
    """
    old = df.inputFiles()
    df.write.mode("append").parquet(path)
    for file in old:
        fs, where = file_system(df.sparkSession, file)
        fs.delete(where, False)
