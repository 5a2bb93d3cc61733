"""What a job copies and what its destination demands."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from rowferry.functions.keys import as_keys


@dataclass(frozen=True)
class DestSpec:
    """The constraints of a destination table.

    Spark file tables accept NULL into NOT NULL columns and know no primary
    key, so both are declared here and enforced by ``operators.classify``.
    """

    schema: T.StructType
    primary_key: tuple[str, ...]
    identity: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    max_length: dict = field(default_factory=dict)
    key_collation: str | None = None
    #: Unique keys beside the primary one, by name; conditions that every row must meet; and, by name, columns that must
    #: be found in columns of another table.
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    foreign_keys: dict[str, tuple[tuple[str, ...], str, tuple[str, ...]]] = field(default_factory=dict)
    buckets: int = 16
    #: Parts of a file's key filter, each of two bitmaps of 32,768 bits; about 8,000 keys a part are told apart well.
    filter_chunks: int = 1

    def __post_init__(self):
        object.__setattr__(self, "primary_key", as_keys(self.primary_key))
        missing = [k for k in self.primary_key if k not in self.schema.names]
        if missing:
            raise ValueError(f"primary key columns not in the schema: {missing}")
        object.__setattr__(self, "unique", {n: as_keys(c) for n, c in self.unique.items()})
        own = {**self.unique, **{n: columns for n, (columns, _, _) in self.foreign_keys.items()}}
        lacking = {n: c for n, columns in own.items() for c in columns if c not in self.schema.names}
        if lacking:
            raise ValueError(f"columns of constraints not in the schema: {lacking}")
        if self.buckets < 1:
            raise ValueError("buckets must be at least 1")
        if self.filter_chunks < 1:
            raise ValueError("filter_chunks must be at least 1")

    @property
    def required(self) -> list[str]:
        """NOT NULL columns outside the key that have no default."""
        return [
            f.name
            for f in self.schema.fields
            if not f.nullable and f.name not in self.primary_key and f.name not in self.defaults
        ]


@dataclass(frozen=True)
class JobSpec:
    """One copy job. An empty or zero setting means its default.

    ``split_hot_keys=False`` ranks the rows of a key in one task instead of two
    rounds; it suits queries that return each key a few times at most, and never
    changes a result.
    """

    name: str
    source_table: str
    dest_table: str
    primary_key: tuple[str, ...] = ("id",)
    query: str = "SELECT * FROM {{table}}"
    deleted_flag: str = "is_deleted"
    batch_size: int = 1000
    source_keys: tuple[str, ...] = ()
    force_full_refresh: bool = False
    truncate: bool = False
    seed_watermark: bool = False
    deletes: str = "all"
    combined: bool = False
    batch_history: bool = False
    #: Keep a sketch of each run's keys, by which later loads are cut into ranges without reading the source for it.
    key_sketches: bool = False
    split_hot_keys: bool = True

    def __post_init__(self):
        object.__setattr__(self, "primary_key", as_keys(self.primary_key or "id"))
        object.__setattr__(self, "source_keys", as_keys(self.source_keys or ()))
        object.__setattr__(self, "query", self.query or "SELECT * FROM {{table}}")
        object.__setattr__(self, "deleted_flag", self.deleted_flag or "is_deleted")
        object.__setattr__(self, "batch_size", self.batch_size or 1000)
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        if self.deletes not in ("all", "pending"):
            raise ValueError("deletes must be 'all' or 'pending'")
