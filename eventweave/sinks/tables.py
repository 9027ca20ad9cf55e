"""Path-backed target tables: replayable batches, snapshot reads, levelled compaction.

Structured Streaming may run a micro-batch again after a failure, Spark retries tasks after
an executor is lost, and several streams may write to one table. So a batch is known by
``(stream_id, batch_id)`` (the stream id lives in the stream's checkpoint): its rows are one part
of the table (see ``sinks/snapshots.py``), and writing it again commits a new part in its place.
Readers hold one snapshot, so neither replays nor compaction take files away under them.

* :class:`AppendTable` (K4, K5): the batch's rows.
* :class:`KeyedTable` (K3): versions of keys; the last version of a key wins on reading.
* :class:`InsertOnceTable` (K2, D2): the same read the other way: the first version of a key
  wins, and the later ones can be listed (:meth:`InsertOnceTable.rejected`).

Versions are ordered by numbers taken from the table (no clock): a batch takes the next one, and
keeps it when it is replayed.

Compaction is size-tiered: ``FANOUT`` parts of one level become one part of the next, so a row is
rewritten once a level and a reader meets at most ``FANOUT`` parts a level. Merged parts are cut
into files by ranges of the key (or of the time), with bounds and key filters for every file, so a
read of one key opens about one file a part. Parts up to ``INLINE_BYTES`` are merged while
batches are written; larger ones by :meth:`SnapshotTable.compact`. The last batch of every
stream is never merged: it may be replayed.

Table formats with row-level MERGE do the same work in place; see :func:`merge_upsert`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from hashlib import sha256
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType

from eventweave.operators.latest import first_per_key, latest_per_key
from eventweave.operators.layout import bucket_of
from eventweave.session import checkpoint_root
from eventweave.sinks.snapshots import (SNAPSHOTS, Between, Part, Snapshot, SnapshotLog, add_ranges, create_if_absent, folder_exists,
                                        has_bounds, merged_schema, read_text, remove_folder, versions_of, without)

RUN_COL, VERSION_COL = "run_id", "_version"
#: Parts of one level that become one of the next; bytes that are merged while batches are written;
#: bytes of one file of a merged part; bytes from which a merged part gets an index of its files.
FANOUT, INLINE_BYTES, FILE_BYTES, INDEX_BYTES = 8, 1 << 30, 256 << 20, 64 << 20
#: Rows of one file of a merged part, about: one task sorts them, and compressed bytes say little of its memory.
FILE_ROWS = 1 << 19


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table's rows: a snapshot table's, or a plain Parquet folder's. With a ``schema`` a table
    that nobody has written yet is empty, and nothing is inferred."""
    if folder_exists(spark, f"{path}/{SNAPSHOTS}"):
        return AppendTable(path, schema).read(spark)
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], schema)


def ensure_path_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """K6 for path tables: an empty table with the fixed schema if there is none; of several
    writers one makes it."""
    SnapshotLog(spark, path).ensure(schema)


def ensure_catalog_table(spark: SparkSession, name: str, schema: StructType, *, source: str = "parquet",
                         path: str | None = None, by_run: bool = False) -> DataFrame:
    """K6 for catalog tables: ``CREATE TABLE IF NOT EXISTS`` with the fixed schema; ``by_run`` adds a
    partition column ``run_id``, so that a load can be replaced (see :func:`load_run_to_table`)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    run = f", `{RUN_COL}` string" if by_run else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}{run}) USING {source}"
              + (f" PARTITIONED BY ({RUN_COL})" if by_run else "") + (f" LOCATION '{path}'" if path else ""))
    return spark.table(name)


class SnapshotTable:
    """What the tables share: batches as parts, snapshots, pruning, compaction."""

    key: str | None = None

    def __init__(self, path: str, schema: StructType | None = None, partition_by: Sequence[str] = (), *, bounds: Sequence[str] | None = None,
                 fanout: int = FANOUT, inline_bytes: int = INLINE_BYTES, file_bytes: int = FILE_BYTES, index_bytes: int = INDEX_BYTES):
        self.path, self.schema, self.partition_by = path.rstrip("/"), schema, tuple(partition_by)
        self.bounds, self.fanout, self.inline_bytes, self.file_bytes, self.index_bytes = bounds, fanout, inline_bytes, file_bytes, index_bytes

    def log(self, spark: SparkSession) -> SnapshotLog:
        return SnapshotLog(spark, self.path)

    def snapshot(self, spark: SparkSession, as_of: int | None = None) -> Snapshot:
        """The latest snapshot, or the one of a commit number."""
        head = self.log(spark).head() if as_of is None else self.log(spark).at(as_of)
        return head or Snapshot(schema=self.schema)

    def bound_columns(self, schema: StructType) -> list[str]:
        """Columns whose bounds every part carries: the key and those of days and times, or as given."""
        if self.bounds is not None:
            return [c for c in self.bounds if c in schema.names and has_bounds(schema[c].dataType)]
        return [f.name for f in schema if has_bounds(f.dataType) and (f.name == self.key or isinstance(f.dataType, (DateType, TimestampNTZType)))]

    # -- writing ------------------------------------------------------------------------
    def _commit_batch(self, df: DataFrame, batch_id: int, stream_id: str, version: int | None = None, unique: bool = False) -> Part:
        log = self.log(df.sparkSession)
        head = log.head()
        if head is not None:
            self._refuse_merged(head, batch_id, stream_id)
            merged_schema(head.schema, df.schema)           # fails before anything is written
        part = log.write_part(df, self.bound_columns(df.schema), self.partition_by, stream=stream_id, batch=int(batch_id), version=version, unique=unique)

        def change(now: Snapshot) -> Snapshot:
            self._refuse_merged(now, batch_id, stream_id)
            others = tuple(p for p in now.parts if (p.stream, p.batch) != (stream_id, int(batch_id)))
            return replace(now, parts=others + ((part,) if part.rows else ()), schema=merged_schema(now.schema or self.schema, df.schema))

        now = log.commit(change)
        if len(now.parts) >= self.fanout:
            self._tidy(log, now)
        return part

    @staticmethod
    def _refuse_merged(head: Snapshot, batch_id: int, stream_id: str) -> None:
        if batch_id <= head.merged.get(stream_id, -1):
            raise ValueError(f"batch {batch_id} of stream {stream_id} was merged with others; only later batches can be written")

    def _version(self, spark: SparkSession, batch_id: int, stream_id: str) -> int:
        """A batch's version: the next number, or its own if it is replayed."""
        log = self.log(spark)
        had = (log.head() or Snapshot()).of_batch(stream_id, int(batch_id))
        return had[0].version if had and had[0].version is not None else log.next_version()

    # -- compaction -----------------------------------------------------------------------
    def _mergeable(self, head: Snapshot) -> list[Part]:
        last = {}
        for p in head.parts:
            if p.stream is not None:
                last[p.stream] = max(p.batch, last.get(p.stream, -1))
        return [p for p in head.parts if p.stream is None or p.batch < last[p.stream]]

    def _tidy(self, log: SnapshotLog, head: Snapshot) -> None:
        """Merge full levels from the lowest on, as far as their size allows."""
        level = 0
        while True:
            own = [p for p in self._mergeable(head) if p.level == level]
            done = False
            for kind in ("rows", "rejected"):
                some = [p for p in own if p.kind == kind]
                if len(some) >= self.fanout and sum(p.size for p in some) <= self.inline_bytes:
                    head, done = self._merge(log, head, some, level + 1), True
            if not done and level >= max((p.level for p in head.parts), default=0):
                return
            level += 1

    def _pieces(self, rows: DataFrame, kind: str) -> list[tuple[DataFrame, str, bool]]:
        """What merged rows become: (rows, kind, one row a key)."""
        return [(rows, kind, False)]

    def _laid_out(self, rows: DataFrame, schema: StructType, size: int, count: int) -> DataFrame:
        """Files of about ``file_bytes`` or ``FILE_ROWS`` rows, whichever are smaller, each a range of
        the key or of the first bound column."""
        files = max(1, -(-size // self.file_bytes), -(-count // FILE_ROWS))
        if self.partition_by:
            return rows.hint("rebalance", *self.partition_by)
        by = [c for c in ([self.key] if self.key else self.bound_columns(schema)[:1]) if c in schema.names]
        if files == 1:
            return rows.coalesce(1).sortWithinPartitions(*by) if by else rows.coalesce(1)
        if not by:
            return rows.repartition(files)
        return rows.repartitionByRange(files, *by, F.xxhash64(*rows.columns)).sortWithinPartitions(*by)      # one common value is not one file

    def _merge(self, log: SnapshotLog, head: Snapshot, parts: Sequence[Part], level: int) -> Snapshot:
        size, count, kind = sum(p.size for p in parts), sum(p.rows for p in parts), parts[0].kind
        bounds, new = self.bound_columns(head.schema), []
        for rows, own_kind, unique in self._pieces(log.read_parts(parts, head.schema), kind):
            part = log.write_part(self._laid_out(rows, head.schema, size, count), bounds, self.partition_by, level=level, kind=own_kind, unique=unique,
                                  versions=add_ranges(*map(versions_of, parts)))
            if part.rows:
                new.append(log.index(part, head.schema, bounds, self.key) if part.size >= self.index_bytes else part)
        gone = {p.id for p in parts}

        def change(now: Snapshot) -> Snapshot | None:
            if not gone <= {p.id for p in now.parts}:
                return None             # replayed or merged by someone else meanwhile
            merged = dict(now.merged)
            for p in parts:
                if p.stream is not None:
                    merged[p.stream] = max(p.batch, merged.get(p.stream, -1))
            return replace(now, parts=tuple(p for p in now.parts if p.id not in gone) + tuple(new), merged=merged)

        now = log.commit(change)
        if new and new[0].id not in {p.id for p in now.parts}:
            for p in new:
                remove_folder(log.spark, log.folder(p))
        return now

    def compact(self, spark: SparkSession) -> int:
        """Merge everything that is safe to merge into one part (a kind); returns the merged rows.
        Old parts stay for readers until :meth:`SnapshotLog.expire`."""
        log = self.log(spark)
        head = log.head()
        if head is None:
            return 0
        for kind in ("rejected", "rows"):
            own = [p for p in self._mergeable(head) if p.kind == kind]
            if len(own) > 1 or any(p.level == 0 for p in own):
                head = self._merge(log, head, own, 1 + max(p.level for p in own))
        return sum(p.rows for p in head.parts if p.level and p.kind == "rows")

    # -- reading ----------------------------------------------------------------------------
    def _read(self, spark: SparkSession, head: Snapshot, kind: str, where: Sequence[Between], keys: Sequence[Any] | None) -> DataFrame:
        return self.log(spark).read_parts([p for p in head.parts if p.kind == kind], head.schema, where, self.key, keys)


class AppendTable(SnapshotTable):
    """K4/K5: append a batch; replaying the same batch of the same stream replaces it. With a
    ``schema`` the table can be read before anything is written (K6).

    ``versioned`` rows carry their batch's version, so that a reader can ask for those that came
    after a state it knows (:meth:`read_new`), merged or not. A batch keeps its version when it is
    replayed, as its rows are the same then."""

    def __init__(self, path: str, schema: StructType | None = None, partition_by: Sequence[str] = (), *, versioned: bool = False, **options):
        super().__init__(path, schema, partition_by, **options)
        self.versioned = versioned

    def write(self, df: DataFrame, batch_id: int, stream_id: str = "default") -> int:
        version = None
        if self.versioned:
            version = self._version(df.sparkSession, batch_id, stream_id)
            df = df.withColumn(VERSION_COL, F.lit(version).cast("bigint"))
        # Rows are grouped by the partition columns first (one file set per subfolder); AQE still
        # splits a subfolder that is too big for one task.
        return self._commit_batch(df.hint("rebalance", *self.partition_by) if self.partition_by else df, batch_id, stream_id, version).rows

    def bound_columns(self, schema: StructType) -> list[str]:
        return [*super().bound_columns(schema), *([VERSION_COL] if VERSION_COL in schema.names else [])]

    def read(self, spark: SparkSession, where: Sequence[Between] = (), as_of: int | None = None) -> DataFrame:
        """The rows of the latest (or a given) snapshot; ``where`` also leaves out parts and files."""
        head = self.snapshot(spark, as_of)
        if head.schema is None:
            raise ValueError(f"no table at {self.path}")
        return self._read(spark, head, "rows", where, None).drop(VERSION_COL)

    def read_new(self, spark: SparkSession, known: Sequence[Sequence[int]]) -> tuple[DataFrame, list[list[int]]]:
        """(rows of batches whose versions are not among ``known`` ranges, all versions now). Parts
        that hold known batches only are not opened."""
        head = self.snapshot(spark)
        if head.schema is None:
            raise ValueError(f"no table at {self.path}")
        if head.parts and VERSION_COL not in head.schema.names:
            raise ValueError(f"the rows of {self.path} carry no versions (versioned=True when they are written)")
        every = add_ranges(known, *map(versions_of, head.parts))
        new = without(every, known)
        parts = [p for p in head.parts if p.kind == "rows" and without(versions_of(p), known)]
        if not parts:
            return spark.createDataFrame([], head.schema).drop(VERSION_COL), every
        own = F.lit(False)
        for first, last in new:
            own = own | F.col(VERSION_COL).between(first, last)
        return self.log(spark).read_parts(parts, head.schema).where(own).drop(VERSION_COL), every


class VersionLog(SnapshotTable):
    """Versions of keyed rows. Every row carries the version of its batch (a number taken from
    the table, kept when the batch is replayed) and its order columns."""

    newest = True

    def __init__(self, path: str, schema: StructType | None = None, key: str = "event_id", order_cols: Sequence[str] = (), **options):
        if not order_cols:
            raise ValueError("name the columns that order the versions of a key inside a batch")
        super().__init__(path, schema, **options)
        self.key, self.order_cols = key, tuple(order_cols)

    @property
    def order(self) -> tuple[str, ...]:
        return (VERSION_COL, *self.order_cols)

    def _pick(self, rows: DataFrame) -> DataFrame:
        return (latest_per_key if self.newest else first_per_key)(rows, self.key, self.order).select(*rows.columns)

    def append(self, rows: DataFrame, batch_id: int, stream_id: str, unique: bool) -> int:
        version = self._version(rows.sparkSession, batch_id, stream_id)
        return self._commit_batch(rows.withColumn(VERSION_COL, F.lit(version).cast("bigint")), batch_id, stream_id, version, unique).rows

    def _winners(self, spark: SparkSession, head: Snapshot, keys: Sequence[Any] | None) -> DataFrame:
        """One version a key. A large merged part holds every key once: only its rows whose keys
        also stand in the few later rows are compared, the others are read as they are."""
        log, parts = self.log(spark), [p for p in head.parts if p.kind == "rows"]
        base = max((p for p in parts if p.unique), key=lambda p: p.rows, default=None)
        if base is not None and len(parts) == 1:
            return log.read_parts(parts, head.schema, (), self.key, keys)
        rest = [p for p in parts if p is not base]
        if base is None or keys is not None or sum(p.rows for p in rest) * 8 > base.rows:
            return self._pick(log.read_parts(parts, head.schema, (), self.key, keys))
        recent, old = log.read_parts(rest, head.schema), log.read_parts([base], head.schema)
        touched = recent.select(self.key).distinct()
        return old.join(touched, self.key, "left_anti").select(*old.columns).unionByName(
            self._pick(recent.unionByName(old.join(touched, self.key, "left_semi").select(*old.columns))))


class InsertOnceTable(VersionLog):
    """K2 with D2: plain insert semantics on ``key`` without aborting on duplicates.

    The first version of a key (earliest batch, then smallest ``order_cols``) is the row; the
    others, inside the batch or in later batches, are rejected. A batch is logged as it comes,
    without reading the table, so its cost does not grow with the table; merging moves rejected
    versions to parts of their own. Rows with a null key cannot be addressed and never reach the
    table (the fan-out quarantines them).
    """

    newest = False

    def __init__(self, path: str, order_cols: Sequence[str] = (), key: str = "event_id", **options):
        super().__init__(path, None, key, order_cols, **options)

    def write(self, df: DataFrame, batch_id: int, stream_id: str = "default") -> dict[str, int]:
        return {"logged": self.append(df.where(F.col(self.key).isNotNull()), batch_id, stream_id, False)}

    def _losers(self, rows: DataFrame) -> DataFrame:
        first = rows.groupBy(self.key).agg(F.min(F.struct(*self.order)).alias("_first"))
        return rows.join(first, self.key).where(F.struct(*self.order) != F.col("_first")).select(*rows.columns)

    def _pieces(self, rows: DataFrame, kind: str) -> list[tuple[DataFrame, str, bool]]:
        if kind == "rejected":
            return [(rows, kind, False)]
        return [(self._pick(rows), "rows", True), (self._losers(rows), "rejected", False)]

    def read(self, spark: SparkSession, schema: StructType | None = None, *, keys: Sequence[Any] | None = None, as_of: int | None = None) -> DataFrame:
        """The table; with a ``schema`` it is empty before the first write."""
        head = self.snapshot(spark, as_of)
        if head.schema is None:
            if schema is None:
                raise ValueError(f"no table at {self.path}")
            return spark.createDataFrame([], schema)
        return self._winners(spark, head, keys).drop(*[c for c in self.order if c != self.key])

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Every version that lost against an earlier one, with a reason."""
        head = self.snapshot(spark)
        lost = self._losers(self._read(spark, head, "rows", (), None)).unionByName(self._read(spark, head, "rejected", (), None))
        return lost.select(F.lit(f"duplicate_{self.key}").alias("reason"), *[c for c in lost.columns if c not in self.order or c == self.key])


class KeyedTable(VersionLog):
    """K3: upsert on ``key``; the version of the latest batch, then with the greatest
    ``order_cols``, wins.

    Every non-key column is overwritten by the winning version (nulls included). Rows with
    a null key cannot be addressed and never reach the table (the fan-out quarantines them).
    """

    def __init__(self, path: str, schema: StructType, key: str = "event_id", order_cols: Sequence[str] = (), **options):
        super().__init__(path, schema, key, order_cols, **options)

    def write(self, df: DataFrame, batch_id: int, stream_id: str = "default") -> dict[str, int]:
        cols = self.schema.fieldNames()
        keyed = df.where(F.col(self.key).isNotNull())
        latest = latest_per_key(keyed.select(*cols, *[c for c in self.order_cols if c not in cols]), self.key, self.order_cols)
        return {"upserted": self.append(latest, batch_id, stream_id, True)}

    def _pieces(self, rows: DataFrame, kind: str) -> list[tuple[DataFrame, str, bool]]:
        return [(self._pick(rows), "rows", True)]

    def read(self, spark: SparkSession, *, keys: Sequence[Any] | None = None, as_of: int | None = None) -> DataFrame:
        """The last version of every key, or of some keys (their files alone are opened)."""
        head = self.snapshot(spark, as_of)
        if not any(p.kind == "rows" for p in head.parts):
            return spark.createDataFrame([], self.schema)
        return self._winners(spark, head, keys).select(*self.schema.fieldNames())


def merge_upsert(spark: SparkSession, table: str, batch: DataFrame, key: str = "event_id", *,
                 order_cols: Sequence[str]) -> None:
    """K3 back end B: ``MERGE INTO`` for catalogs whose tables support row-level changes."""
    cols = [c for c in spark.table(table).columns]
    latest = latest_per_key(batch, key, order_cols).select(*cols)
    view = f"_eventweave_upsert_{uuid.uuid4().hex[:8]}"
    latest.createOrReplaceTempView(view)
    try:
        spark.sql(merge_text(table, view, cols, key))
    finally:
        spark.catalog.dropTempView(view)


def merge_text(table: str, view: str, cols: Sequence[str], key: str) -> str:
    """The MERGE statement of :func:`merge_upsert`, names quoted."""
    def q(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"
    sets = ", ".join(f"t.{q(c)} = s.{q(c)}" for c in cols if c != key)
    update = f"WHEN MATCHED THEN UPDATE SET {sets} " if sets else ""
    return f"MERGE INTO {table} t USING {q(view)} s ON t.{q(key)} = s.{q(key)} {update}WHEN NOT MATCHED THEN INSERT *"


def _count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    # Unique names: several target writes of one micro-batch may run at the same time.
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _rows(obs: Observation, name: str = "rows") -> int:
    return int(obs.get.get(name, 0) or 0)


def append_to_table(df: DataFrame, table: str) -> int:
    """K4/K5/K8 for catalog tables (session or v2 catalogs): one append commit; returns
    the row count. Columns are matched by name, then passed in the table's order."""
    target_cols = df.sparkSession.table(table).columns
    counted, obs = _count(df.select(*target_cols), "table_append")
    counted.write.insertInto(table)
    return _rows(obs)


def load_run_to_table(df: DataFrame, table: str, run_id: str, *, ledger: str | None = None) -> int:
    """K7/K8 into a catalog table, once a run: loading the same run again leaves one copy.

    A table with the partition column ``run_id`` has the run's partition replaced. Any other table
    is appended to, and a ledger (a folder, in the shared work folder by default) remembers the
    runs: a run that ended is not loaded again. A run that broke off between its append and its
    entry cannot be told from one that appended nothing, so it is refused, never doubled.
    """
    spark = df.sparkSession
    columns = spark.catalog.listColumns(table)
    names = [c.name for c in columns if c.name != RUN_COL]
    if any(c.name == RUN_COL and c.isPartition for c in columns):
        counted, obs = _count(df.select(*names), "run_load")
        view = f"_eventweave_run_{uuid.uuid4().hex[:8]}"
        counted.createOrReplaceTempView(view)
        try:
            quoted = run_id.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({RUN_COL} = '{quoted}') SELECT * FROM {view}")
        finally:
            spark.catalog.dropTempView(view)
        return _rows(obs)
    folder = ledger or f"{checkpoint_root(spark)}/eventweave/ledger/{table}"
    entry = f"{folder}/{sha256(run_id.encode()).hexdigest()}"
    if folder_exists(spark, f"{entry}.done"):
        return int(read_text(spark, f"{entry}.done"))
    if not create_if_absent(spark, f"{entry}.begun", run_id):
        raise RuntimeError(f"run {run_id!r} into {table} broke off before: see whether its rows are there, then remove {entry}.begun")
    rows = append_to_table(df, table)
    create_if_absent(spark, f"{entry}.done", str(rows))
    return rows


def write_bucketed(df: DataFrame, table: str, key: str = "event_id", buckets: int = 16,
                   sort_by: Sequence[str] = (), mode: str = "overwrite", path: str | None = None) -> None:
    """Hash-distributed (and optionally sorted) table; joins and aggregations on
    ``key`` against another table with the same bucketing need no shuffle."""
    writer = df.write.mode(mode).bucketBy(buckets, key)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if path:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(table)


def write_sharded(df: DataFrame, path: str, shard_key: str = "shard_key", shards: int = 16,
                  mode: str = "append") -> None:
    """K9: rows placed by ``pmod(xxhash64(shard_key), shards)`` into ``shard=<n>`` folders."""
    # REBALANCE groups rows by shard (one file set per shard, not one per task and shard)
    # and lets AQE split a shard too big for one task, so a hot shard key is not one task.
    placed = df.withColumn("shard", bucket_of(F.col(shard_key), shards))
    placed.hint("rebalance", "shard").write.mode(mode).partitionBy("shard").parquet(path)
