"""Batch, incremental and soft-delete table synchronisation on Spark DataFrames."""

from rowferry.spec import DestSpec, JobSpec

__all__ = ["DestSpec", "JobSpec"]
