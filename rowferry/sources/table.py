"""A destination table of plain Parquet files with one commit per run.

Files lie under ``rows/seq=<folder>/bucket=<hash bucket of the key>``, written
once and never changed. A commit is a snapshot in the log (``sources.log``) that
names the folders which are visible; a run that dies leaves files that no
snapshot names. Rejected rows of a run are written by the same job into bucket -1.

``files/seq=<folder>`` lists the files of a folder with the bounds of their keys
and a small Bloom filter, by which a reader of few keys leaves files unopened.

A delete writes bitmaps: for each file, and each 32,768 rows of it, the positions
of the rows that go. Readers test a row's position against them, without any
comparison of keys and without moving a row. ``compact`` folds them in.

Any number of writers may work at once; see ``insert`` and ``delete``.
"""

from __future__ import annotations

import random
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.keys import DUPLICATE_KEY, any_null, bucket, column, normal_forms
from rowferry.sources.log import Snapshot, SnapshotLog
from rowferry.sources.workdir import empty, file_system, write_through
from rowferry.spec import DestSpec

REJECT_BUCKET = -1
REJECTS = "run_id string, reason string, row string"
#: Rows, or bits of a filter, that one bitmap covers.
BITS = 32768
#: Bitmaps of 4 KB that may be sent to every executor: 64 MB.
BROADCAST_MARKS = 16384
#: Attempts to commit while other writers keep committing first.
ATTEMPTS = 20

_PLACE = ("_seq", "_bucket", "_file")


class ConflictError(RuntimeError):
    """Another writer's commit took away what a run was based on; the run must start again."""


def next_seq(last: int = 0) -> int:
    """A sequence number after ``last``; a dead run's number is never met again."""
    return max(last + 1, time.time_ns() // 1000)


def new_folder() -> int:
    """A number for a folder, rising with time; its low bits keep writers of the same microsecond apart."""
    return time.time_ns() // 1000 << 11 | random.getrandbits(11)


def bit(bits: Column, position: Column) -> Column:
    """Whether a bitmap has the position."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), position.bitwiseAND(7))) != 0


class DestTable:
    def __init__(self, spark: SparkSession, path: str, spec: DestSpec):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.log = SnapshotLog(spark, self.path)

    # -- reading ---------------------------------------------------------

    def snapshot(self) -> Snapshot:
        return self.log.latest()

    def commits(self) -> DataFrame:
        return self.log.history()

    def has_run(self, run_id: str) -> bool:
        return self.log.run(run_id) is not None

    def read(self) -> DataFrame:
        """The visible rows."""
        return self._visible(self.snapshot(), *self.spec.schema.names)

    def keys(self, after: Column | None = None, matching: DataFrame | None = None) -> DataFrame:
        """The visible keys.

        ``after`` is a condition on the first key's upper bound in a file, named
        ``high`` and folded by the collation; files for which it does not hold are left out. ``matching``
        holds keys: only files that can have one of them are opened. Either may
        leave keys in that were not asked for, but never the other way round.
        """
        now = self.snapshot()
        wanted = None
        if after is not None:
            wanted = self.manifest(now).where(after).select(*_PLACE)
        if matching is not None:
            held = self.candidates(matching, now)
            wanted = held if wanted is None else wanted.join(held, list(_PLACE), "left_semi")
        return self._visible(now, *self.spec.primary_key, files=wanted)

    def is_empty(self) -> bool:
        return not self.snapshot().rows

    def rejects(self) -> DataFrame:
        """The dead letters of all committed runs: row JSON, reason, run."""
        if not self.snapshot().version or not self._exists("rows"):
            return empty(self.spark, REJECTS)
        runs = self.commits().select("run_id", F.explode("folders").alias("seq"))
        files = self.spark.read.schema(self._layout()).parquet(f"{self.path}/rows")
        files = files.where(F.col("bucket") == REJECT_BUCKET)
        return files.join(runs, "seq").select("run_id", F.col("_reason").alias("reason"), F.col("_row").alias("row"))

    def run_rows(self, done: Snapshot, *columns: str) -> DataFrame:
        """Keys and outcome of everything one run processed."""
        wanted = dict.fromkeys([*self.spec.primary_key, *columns, "_reason"])
        if not done.folders:
            return self._no_rows(*self.spec.schema.names).withColumn("_reason", F.lit(None).cast("string")).select(*map(column, wanted))
        rows = self._scan(done.folders)
        if len(done.folders) > 1:
            # Rows that lost to another writer's are masked, and shown by their rejects.
            rows = self._unmarked(rows, (done.folders[1],), done.masks)
        return rows.select(*map(column, wanted))

    def manifest(self, now: Snapshot) -> DataFrame:
        """The visible files, each in up to ``spec.filter_chunks`` parts of its keys: place, rows, bounds, filters."""
        key = normal_forms(self._no_rows(*self.spec.primary_key), self.spec.primary_key, self.spec.key_collation)[0]
        kind = self._no_rows(*self.spec.primary_key).select(key.alias("k")).schema["k"].dataType
        layout = T.StructType.fromDDL("bucket int, _file string, chunk int, n long, b0 binary, b1 binary, seq long")
        layout = layout.add("low", kind).add("high", kind)
        if not now.live:
            return empty(self.spark, layout).withColumnsRenamed({"seq": "_seq", "bucket": "_bucket"})
        paths = [f"{self.path}/files/seq={s}" for s in now.live]
        found = self.spark.read.schema(layout).option("basePath", f"{self.path}/files").parquet(*paths)
        found = found.where((F.col("bucket") >= 0) & self._alive(now))
        return found.withColumnsRenamed({"seq": "_seq", "bucket": "_bucket"})

    def candidates(self, keys: DataFrame, now: Snapshot | None = None) -> DataFrame:
        """The files that can hold one of these keys, by their bounds and filters."""
        typed = keys.select(*[column(k).try_cast(self.spec.schema[k].dataType).alias(k) for k in self.spec.primary_key])
        typed = typed.where(~any_null(self.spec.primary_key))
        asked = self._with_probe(self._with_forms(typed, self.spec.primary_key)).withColumn("_bucket", self.bucket_of(typed))
        asked = asked.select("_bucket", "_k0", "chunk", "p0", "p1").distinct()
        files = self.manifest(now or self.snapshot())
        within = (F.col("_k0") >= F.col("low")) & (F.col("_k0") <= F.col("high"))
        met = asked.join(files, ["_bucket", "chunk"]).where(within & bit(F.col("b0"), F.col("p0")) & bit(F.col("b1"), F.col("p1")))
        return met.select(*_PLACE).distinct()

    def _layout(self) -> T.StructType:
        own = T.StructType(self.spec.schema.fields[:])
        return own.add("_reason", "string").add("_row", "string").add("seq", "long").add("bucket", "integer")

    def _no_rows(self, *columns: str) -> DataFrame:
        return empty(self.spark, T.StructType([self.spec.schema[c] for c in columns]))

    def _exists(self, name: str) -> bool:
        fs, where = file_system(self.spark, f"{self.path}/{name}")
        return fs.exists(where)

    def _scan(self, folders: Sequence[int], files: DataFrame | None = None) -> DataFrame | None:
        """Rows of folders, or of some files, with their places."""
        if files is None:
            paths = [f"{self.path}/rows/seq={s}" for s in folders]
        else:
            # What a scan opens is planned on the driver: one path for each file that is needed.
            paths = [f"{self.path}/rows/seq={r[0]}/bucket={r[1]}/{r[2]}" for r in files.distinct().collect()]
        if not paths:
            return None
        rows = self.spark.read.schema(self._layout()).option("basePath", f"{self.path}/rows").parquet(*paths)
        place = {"_file": F.col("_metadata.file_name"), "_at": F.col("_metadata.row_index")}
        return rows.withColumns(place).withColumnsRenamed({"seq": "_seq", "bucket": "_bucket"})

    def _alive(self, now: Snapshot, seq: str = "seq", bucket_: str = "bucket") -> Column:
        """A predicate on directories only, so replaced ones are never opened."""
        live = F.lit(True)
        for folder, buckets in now.dead.items():
            live = live & ~((F.col(seq) == folder) & F.col(bucket_).isin(list(buckets)))
        return live

    def _visible(self, now: Snapshot, *columns: str, files: DataFrame | None = None) -> DataFrame:
        return self._placed(now, *columns, files=files).select(*map(column, columns))

    def _placed(self, now: Snapshot, *columns: str, files: DataFrame | None = None) -> DataFrame:
        """Visible rows with their places."""
        rows = self._scan(now.live, files)
        if rows is None:
            places = {"_seq": "long", "_bucket": "int", "_file": "string", "_at": "long"}
            return self._no_rows(*columns).withColumns({n: F.lit(None).cast(t) for n, t in places.items()})
        rows = rows.where((F.col("_bucket") >= 0) & self._alive(now, "_seq", "_bucket"))
        return self._unmarked(rows, now.marks, now.n_marks).select(*map(column, columns), *_PLACE, "_at")

    def _marks(self, folders: Sequence[int]) -> DataFrame:
        """Bitmaps by file and part of it."""
        layout = "_file string, _chunk int, bits binary, bucket int, _mseq long, seq long"
        paths = [f"{self.path}/deletes/seq={s}" for s in folders]
        return self.spark.read.schema(layout).option("basePath", f"{self.path}/deletes").parquet(*paths)

    def _unmarked(self, rows: DataFrame, folders: Sequence[int], n: int) -> DataFrame:
        """Rows whose position no bitmap has. Bitmaps within the limit go to the rows; beyond it rows and bitmaps
        meet by file."""
        if not folders:
            return rows
        marks = self._marks(folders).select("_mseq", "bucket", "_file", "_chunk", "bits")
        if len(folders) > 1:
            marks = marks.groupBy("_mseq", "bucket", "_file", "_chunk").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        marks = marks.toDF("m_seq", "m_bucket", "m_file", "m_chunk", "m_bits").hint("broadcast" if n <= BROADCAST_MARKS else "merge")
        same = (F.col("_seq") == F.col("m_seq")) & (F.col("_bucket") == F.col("m_bucket")) & (F.col("_file") == F.col("m_file"))
        met = rows.join(marks, same & (F.expr(f"_at div {BITS}") == F.col("m_chunk")), "left")
        gone = bit(F.col("m_bits"), (F.col("_at") % BITS).cast("int"))
        return met.where(F.col("m_bits").isNull() | ~gone).select(*map(column, rows.columns))

    # -- writing ---------------------------------------------------------

    def bucket_of(self, df: DataFrame) -> Column:
        keys = self.spec.primary_key
        return bucket(normal_forms(df, keys, self.spec.key_collation), self.spec.buckets)

    def write(self, classified: DataFrame) -> int:
        """Write the outcome of ``classify`` without making it visible yet.

        The rebalance groups rows by bucket, so that a run leaves few files,
        and lets Spark split a bucket that is much larger than the others.
        """
        seq = new_folder()
        target = F.when(F.col("_reason").isNull(), self.bucket_of(classified)).otherwise(REJECT_BUCKET)
        (
            classified.select(*[column(c) for c in self.spec.schema.names], "_reason", "_row", target.alias("bucket"))
            .hint("rebalance", "bucket")
            .write.partitionBy("bucket")
            .parquet(f"{self.path}/rows/seq={seq}")
        )
        self._describe(seq)
        return seq

    def _describe(self, seq: int) -> None:
        """List a folder's files with the bounds and filters of their keys, from what was written."""
        fs, where = file_system(self.spark, f"{self.path}/rows/seq={seq}")
        if not any(s.isDirectory() for s in fs.listStatus(where)):
            return
        keys = self._with_probe(self._with_forms(self._scan([seq]).select(*map(column, self.spec.primary_key), "_bucket", "_file"), self.spec.primary_key))
        keys.groupBy(F.col("_bucket").alias("bucket"), "_file", "chunk").agg(
            F.count("*").alias("n"), F.min("_k0").alias("low"), F.max("_k0").alias("high"),
            F.expr("bitmap_construct_agg(p0)").alias("b0"), F.expr("bitmap_construct_agg(p1)").alias("b1"),
).write.parquet(f"{self.path}/files/seq={seq}")

    def _with_probe(self, keys: DataFrame) -> DataFrame:
        """Adds where the filters keep a key: the part of its file, and a bit in each of two bitmaps."""
        code = F.xxhash64(F.lit(7), *self._key_forms())
        return keys.withColumns({
            "chunk": F.pmod(F.shiftright(code, 32), F.lit(self.spec.filter_chunks)).cast("int"),
            "p0": code.bitwiseAND(BITS - 1).cast("int"),
            "p1": F.shiftright(code, 15).bitwiseAND(BITS - 1).cast("int"),
        })

    def _counts(self, seq: int) -> tuple[int, int]:
        if not self._exists(f"files/seq={seq}"):
            return 0, 0
        # A few rows per file, so one task will do.
        files = self.spark.read.schema("bucket int, n long").parquet(f"{self.path}/files/seq={seq}").coalesce(1)
        row = files.agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) for c in (F.col("bucket") >= 0, F.col("bucket") < 0)]).first()
        return row[0], row[1]

    def commit(self, seq: int, run_id: str, base: Snapshot | None = None) -> Snapshot:
        """Make a written folder visible after ``base``, on which its rows were classified.

        Where other writers have committed since, rows whose key one of them
        has inserted are masked and become ``duplicate_key`` rejects: the run
        counts as coming after theirs. Only files whose bounds and filters may
        hold a key of the other side are compared. A run that refused rows for
        keys which have been deleted meanwhile would be wrong in either order,
        as would any run after a truncation; it ends in a ``ConflictError`` and
        may be repeated.
        """
        base = self.snapshot() if base is None else base
        accepted, rejected = self._counts(seq)
        folders, n_marks, lost, seen = (seq,), 0, 0, base
        for _ in range(ATTEMPTS):
            now = self.snapshot()
            others = [self.log.read(v) for v in range(seen.version + 1, now.version + 1)]
            if any(o is None for o in others):
                raise ConflictError("commits since the run began have been folded")
            if any(o.kind == "truncate" for o in others):
                raise ConflictError("the table has been emptied")
            deleted = [s for o in others if o.kind == "delete" for s in o.folders]
            if deleted and rejected and self._refused_deleted(seq, deleted):
                raise ConflictError("keys that rows were refused for have been deleted")
            new = [s for o in others if o.kind == "insert" and o.accepted for s in o.folders[:1]]
            if new and accepted and self.spec.unique:
                raise ConflictError("another unique key may be taken by rows inserted meanwhile")
            if new and accepted:
                masked, n = self._mask(seq, now, new, folders[1] if len(folders) > 1 else None)
                if masked is not None:
                    folders, n_marks, lost = (seq, masked), n, self._counts_marks(masked)
            seen, visible = now, accepted - lost
            made = now.followed_by(
                seq=seq, run_id=run_id, kind="insert", folders=folders, accepted=visible, rejected=rejected + lost, masks=n_marks,
                live=now.live + ((seq,) if visible else ()), marks=now.marks + (folders[1:] if visible else ()),
                n_marks=now.n_marks + (n_marks if visible else 0), rows=now.rows + visible,
            )
            if self.log.claim(made):
                return made
        raise ConflictError(f"other writers came first {ATTEMPTS} times")

    def _refused_deleted(self, seq: int, deleted: Sequence[int]) -> bool:
        """Whether a bucket of a duplicate reject is one of those touched by deletes."""
        refused = self._scan([seq]).where((F.col("_bucket") == REJECT_BUCKET) & (F.col("_reason") == DUPLICATE_KEY))
        refused = refused.select(self.bucket_of(refused).alias("bucket")).distinct()
        return not self._marks(deleted).select("bucket").distinct().join(refused, "bucket").isEmpty()

    def _mask(self, seq: int, now: Snapshot, new: Sequence[int], before: int | None) -> tuple[int | None, int]:
        """Bitmaps and rejects for the folder's rows whose keys other folders hold; with those found before."""
        forms = self._key_forms()
        mine = self._scan([seq]).where(F.col("_bucket") >= 0)
        own = Snapshot(live=(seq,))
        theirs = Snapshot(live=tuple(s for s in new if s in now.live), dead=now.dead, marks=now.marks, n_marks=now.n_marks)
        held = self.manifest(theirs).select("_bucket", "low", "high", *_PLACE[::2])
        near = self.manifest(own).select("_bucket", F.col("low").alias("a"), F.col("high").alias("b"))
        near = held.join(near, "_bucket").where((F.col("low") <= F.col("b")) & (F.col("high") >= F.col("a")))
        keys = self._placed(theirs, *self.spec.primary_key, files=near.select(*_PLACE))
        keys = self._with_forms(keys, self.spec.primary_key).select("_bucket", *forms).distinct()
        hits = self._with_forms(mine, self.spec.primary_key).join(keys, ["_bucket", *forms], "left_semi").drop(*forms)
        if before is not None:
            hits = hits.unionByName(self._with_forms(mine, self.spec.primary_key).drop(*forms).join(
                self._rows_of_marks(before), [*_PLACE, "_at"], "left_semi")).distinct()
        hits = write_through(hits, "conflicts")
        if hits.isEmpty():
            return None, 0
        folder = new_folder()
        n = self._write_marks(hits, folder)
        names = self.spec.schema.names
        refused = hits.select(*[column(c) for c in names], F.lit(DUPLICATE_KEY).alias("_reason"),
                              F.to_json(F.struct(*[column(c) for c in names])).alias("_row"), F.lit(REJECT_BUCKET).alias("bucket"))
        refused.write.partitionBy("bucket").parquet(f"{self.path}/rows/seq={folder}")
        return folder, n

    def _rows_of_marks(self, folder: int) -> DataFrame:
        """The places that bitmaps name."""
        positions = F.explode(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda p: bit(F.col("bits"), p)))
        marks = self._marks([folder]).select("_mseq", "bucket", "_file", "_chunk", positions.alias("p"))
        return marks.select(F.col("_mseq").alias("_seq"), F.col("bucket").alias("_bucket"), "_file", (F.col("_chunk") * F.lit(BITS).cast("long") + F.col("p")).alias("_at"))

    def _write_marks(self, hits: DataFrame, folder: int) -> int:
        """Write bitmaps of these rows' places; returns how many there are."""
        bits = F.expr(f"bitmap_construct_agg(cast(_at % {BITS} as int))").alias("bits")
        marks = hits.groupBy(F.col("_seq").alias("_mseq"), F.col("_bucket").alias("bucket"), "_file", F.expr(f"_at div {BITS}").cast("int").alias("_chunk"))
        marks.agg(bits).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/deletes/seq={folder}")
        return self._marks([folder]).count()

    def _counts_marks(self, folder: int) -> int:
        return self._marks([folder]).agg(F.coalesce(F.sum(F.expr("bitmap_count(bits)")), F.lit(0))).first()[0]

    def insert(self, classified: DataFrame, run_id: str, base: Snapshot | None = None) -> Snapshot:
        """Write and commit the outcome of ``classify``. ``base`` is the snapshot whose keys it has met."""
        base = self.snapshot() if base is None else base
        return self.commit(self.write(classified), run_id, base)

    def load(self, rows: DataFrame, run_id: str = "load") -> Snapshot:
        """Insert rows known to be valid, such as a first snapshot."""
        none = F.lit(None).cast("string")
        return self.insert(rows.withColumns({"_reason": none, "_row": none}), run_id)

    def delete(self, keys: DataFrame, run_id: str) -> int:
        """Remove the rows that match ``keys`` on all of its columns.

        Writes bitmaps of these rows' positions, so neither the cost in bytes
        nor that of later reads follows the keys. Where another writer commits
        first, the rows are looked for again. Returns the number of rows removed.
        """
        on = keys.columns
        # A key that is no value of the column's type is in no row.
        typed = keys.select(*[column(k).try_cast(self.spec.schema[k].dataType).alias(k) for k in on])
        typed = typed.where(~any_null(on))
        names = [f"_k{i}" for i in range(len(on))]
        gone = self._with_forms(typed, on).select(*names).distinct()
        for _ in range(ATTEMPTS):
            now = self.snapshot()
            files = self.candidates(typed, now) if set(on) == set(self.spec.primary_key) else None
            held = self._placed(now, *dict.fromkeys([*self.spec.primary_key, *on]), files=files)
            hits = self._with_forms(held, on).join(gone, names, "left_semi")
            folder = new_folder()
            n = self._write_marks(hits, folder)
            if not n:
                return 0
            removed = self._counts_marks(folder)
            if self.log.claim(now.followed_by(
                seq=folder, run_id=run_id, kind="delete", folders=(folder,), removed=removed,
                marks=now.marks + (folder,), n_marks=now.n_marks + n, rows=now.rows - removed,
            )):
                return removed
        raise ConflictError(f"other writers came first {ATTEMPTS} times")

    def truncate(self, run_id: str) -> None:
        for _ in range(ATTEMPTS):
            now = self.snapshot()
            if self.log.claim(now.followed_by(
                seq=new_folder(), run_id=run_id, kind="truncate", removed=now.rows, live=(), dead={}, marks=(), n_marks=0, rows=0,
            )):
                return
        raise ConflictError(f"other writers came first {ATTEMPTS} times")

    def compact(self, run_id: str, min_deleted: float | None = None) -> None:
        """Merge the files of all runs into one set per bucket, fold deletes in, and fold the log.

        With ``min_deleted`` only buckets are rewritten of whose rows at least
        this share has been deleted. Rows that others insert meanwhile stay as
        they are; after a delete by others the work is done again.
        """
        for _ in range(ATTEMPTS):
            now = self.snapshot()
            if not now.live:
                break
            buckets = range(self.spec.buckets) if min_deleted is None else self._worn(now, min_deleted)
            if not buckets:
                break
            if self._rewrite(now, buckets, run_id, len(buckets) == self.spec.buckets):
                break
        else:
            raise ConflictError(f"other writers came first {ATTEMPTS} times")
        self.log.fold()

    def _worn(self, now: Snapshot, share: float) -> list[int]:
        """At most one row per bucket."""
        if not now.marks:
            return []
        held = self.manifest(now).groupBy("_bucket").agg(F.sum("n").alias("n"))
        gone = self._marks(now.marks).groupBy(F.col("bucket").alias("_bucket")).agg(F.sum(F.expr("bitmap_count(bits)")).alias("gone"))
        return sorted(r[0] for r in held.join(gone, "_bucket").where(F.col("gone") >= share * F.col("n")).select("_bucket").collect())

    def _rewrite(self, now: Snapshot, buckets: Sequence[int], run_id: str, whole: bool) -> bool:
        rows = self._placed(now, *self.spec.schema.names)
        rows = rows if whole else rows.where(F.col("_bucket").isin(list(buckets)))
        none = F.lit(None).cast("string")
        seq = self.write(rows.withColumns({"_reason": none, "_row": none}))
        for _ in range(ATTEMPTS):
            last = self.snapshot()
            others = [self.log.read(v) for v in range(now.version + 1, last.version + 1)]
            if any(o is None or o.kind != "insert" or o.masks for o in others):
                return False
            since = tuple(s for s in last.live if s not in now.live)
            if whole:
                live, dead, marks, n_marks = (seq, *since), {}, (), 0
            else:
                dead = {s: tuple(sorted({*last.dead.get(s, ()), *buckets})) for s in now.live}
                live = (*[s for s in now.live if len(dead[s]) < self.spec.buckets], seq, *since)
                dead = {s: b for s, b in dead.items() if s in live}
                marks, n_marks = last.marks, last.n_marks
            if self.log.claim(last.followed_by(
                seq=seq, run_id=run_id, kind="compact", folders=(seq,), live=live, dead=dead, marks=marks, n_marks=n_marks,
            )):
                return True
        return False

    def vacuum(self) -> int:
        """Delete directories that no reader of the current state can see.

        Rejects stay. Run it when neither a load nor an older reader is active.
        Returns the number of directories of rows and deletes deleted.
        """
        if not self._exists("rows"):
            return 0
        now = self.snapshot()
        fs, root = file_system(self.spark, f"{self.path}/rows")

        def children(path, prefix):
            found = [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(path)]
            return [(p, int(n.removeprefix(prefix))) for p, n in found if n.startswith(prefix)]

        # One small row per commit.
        known = {r[0] for r in self.commits().select(F.explode("folders")).collect()}
        dead, lists = [], []
        for run, seq in children(root, "seq="):
            if seq not in known:
                dead.append(run)
                continue
            replaced = now.dead.get(seq, ()) if seq in now.live else range(self.spec.buckets)
            dead += [p for p, b in children(run, "bucket=") if b >= 0 and b in replaced]
        for name, kept, out in (("deletes", now.marks, dead), ("files", now.live, lists)):
            where = file_system(self.spark, f"{self.path}/{name}")[1]
            if fs.exists(where):
                out += [p for p, seq in children(where, "seq=") if seq not in kept]
        for path in dead + lists:
            fs.delete(path, True)
        return len(dead)

    def _key_forms(self) -> list[str]:
        return [f"_k{i}" for i in range(len(self.spec.primary_key))]

    def _with_forms(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Adds the keys as they are compared."""
        forms = normal_forms(df, keys, self.spec.key_collation)
        return df.withColumns({f"_k{i}": f for i, f in enumerate(forms)})
