"""Snapshots of a table in a folder: immutable parts, a manifest a commit, one pointer.

``data/ew_part=<id>/`` holds the files of one part; parts are never changed. A commit writes
``_snapshots/<number>.json``, the list of all live parts with rows, bytes, column bounds and the
batch each came from; the highest number is the table. The file is made only if no one else has
made that number (create-if-absent), so of two writers one wins and the other starts again from the
new head. Readers take their parts from one snapshot and go on reading them whatever is
committed later; parts that left the table stay until :meth:`SnapshotLog.expire`.

``_sequence/<n>`` numbers are taken the same way: they order versions of a key without a clock.

A part written by compaction has an index: a row a file with rows and column bounds, and a Bloom
filter of the key for every file. :func:`files_of` asks bounds and index before any file is
listed or opened.

Create-if-absent needs a store with it: a hard link on local and network file systems, a rename
that fails on an existing name on HDFS. Object stores without either need a table format's
catalog (see ``tables.merge_upsert``).
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from typing import Any
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, StringType,
                               StructField, StructType, TimestampNTZType)

PART_COL = "ew_part"
SNAPSHOTS, SEQUENCE, DATA, INDEX = "_snapshots", "_sequence", "data", "_index"
#: Bits of a key filter for every row of a file, and bits of one stored bitmap.
BITS_PER_ROW, BITMAP = 16, 32_768


# ---------------------------------------------------------------- the store

def store_of(spark: SparkSession, folder: str):
    """(Hadoop path, file system) of a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path, store = store_of(spark, folder)
    return store.exists(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever store it lies."""
    path, store = store_of(spark, folder)
    store.delete(path, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder (none if there is no folder)."""
    path, store = store_of(spark, folder)
    if not store.exists(path):
        return []
    return [s.getPath().getName() for s in store.listStatus(path)]


def bytes_in(spark: SparkSession, folder: str) -> int:
    path, store = store_of(spark, folder)
    return int(store.getContentSummary(path).getLength()) if store.exists(path) else 0


def read_text(spark: SparkSession, file: str) -> str:
    path, store = store_of(spark, file)
    stream = store.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, file: str, text: str) -> bool:
    """``file`` with ``text``, whole or not at all; False if the name is taken."""
    path, store = store_of(spark, file)
    if store.exists(path):
        return False
    store.mkdirs(path.getParent())
    draft = f"{path.getParent().toString()}/.{uuid.uuid4().hex}"
    draft_path = spark._jvm.org.apache.hadoop.fs.Path(draft)
    out = store.create(draft_path, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if store.getUri().getScheme() == "file":
            # a rename would replace an existing file here; a link does not
            target, source = (urlparse(store.makeQualified(p).toString()).path for p in (path, draft_path))
            try:
                os.link(unquote(source), unquote(target))
                return True
            except FileExistsError:
                return False
        return bool(store.rename(draft_path, path))
    finally:
        store.delete(draft_path, False)


# ---------------------------------------------------------------- parts and bounds

@dataclass(frozen=True)
class Part:
    """One immutable folder of rows."""
    id: str
    rows: int
    size: int = 0                       # bytes
    level: int = 0                      # 0: a batch as written; n + 1: merged from parts of level n
    stream: str | None = None           # the batch it came from; merged parts have none
    batch: int | None = None
    version: int | None = None
    versions: Sequence[Sequence[int]] = ()      # of a merged part: first and last of each range of versions
    kind: str = "rows"                  # or "rejected"
    unique: bool = False                # one row a key
    indexed: bool = False
    bounds: Mapping[str, Sequence[str | None]] = field(default_factory=dict)    # column -> least, greatest as text; none: only nulls


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    parts: tuple[Part, ...] = ()
    schema: StructType | None = None
    merged: Mapping[str, int] = field(default_factory=dict)     # stream -> last batch that was merged

    def to_text(self) -> str:
        return json.dumps({"number": self.number, "parts": [asdict(p) for p in self.parts],
                           "schema": self.schema.jsonValue() if self.schema else None, "merged": dict(self.merged)})

    @classmethod
    def of_text(cls, text: str) -> Snapshot:
        d = json.loads(text)
        return cls(d["number"], tuple(Part(**p) for p in d["parts"]),
                   StructType.fromJson(d["schema"]) if d["schema"] else None, d["merged"])

    def of_batch(self, stream: str, batch: int) -> list[Part]:
        return [p for p in self.parts if p.stream == stream and p.batch == batch]


@dataclass(frozen=True)
class Between:
    """Rows whose ``column`` lies between two values, both included; None leaves a side open."""
    column: str
    low: Any = None
    high: Any = None

    def condition(self, dtype: DataType):
        c = F.col(self.column)
        own = [F.lit(v).cast(dtype) if not isinstance(v, str) or isinstance(dtype, StringType) else F.lit(str(_value(v, dtype))).cast(dtype)
               for v in (self.low, self.high) if v is not None]
        sides = [v is not None for v in (self.low, self.high)]
        out = c.isNotNull()
        if sides[0]:
            out = out & (c >= own[0])
        if sides[1]:
            out = out & (c <= own[-1])
        return out


def _value(text, dtype: DataType):
    """A bound as a Python value that compares as the column's values do."""
    if isinstance(dtype, StringType):
        return str(text).encode()
    if isinstance(dtype, IntegralType):
        return int(text)
    if isinstance(dtype, (DoubleType, FloatType)):
        return float(text)
    if isinstance(dtype, DecimalType):
        return decimal.Decimal(str(text))
    if isinstance(dtype, DateType):
        return dt.date.fromisoformat(str(text))
    if isinstance(dtype, TimestampNTZType):
        at = text if isinstance(text, dt.datetime) else dt.datetime.fromisoformat(str(text).replace("Z", "+00:00"))
        return at.astimezone(dt.timezone.utc).replace(tzinfo=None) if at.tzinfo else at
    raise TypeError(f"no bounds for {dtype.simpleString()}")


def ranges(numbers: Sequence[int]) -> list[list[int]]:
    """Sorted [first, last] of every run of neighbouring numbers."""
    out: list[list[int]] = []
    for n in sorted(set(numbers)):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def add_ranges(*some: Sequence[Sequence[int]]) -> list[list[int]]:
    """The union of ranges."""
    out: list[list[int]] = []
    for first, last in sorted(map(tuple, (r for x in some for r in x))):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def without(some: Sequence[Sequence[int]], gone: Sequence[Sequence[int]]) -> list[list[int]]:
    """The numbers of ``some`` that are not in ``gone``."""
    out = []
    for first, last in add_ranges(some):
        for a, b in add_ranges(gone):
            if b < first or a > last:
                continue
            if a > first:
                out.append([first, a - 1])
            first = b + 1
        if first <= last:
            out.append([first, last])
    return out


def versions_of(part: Part) -> list[list[int]]:
    return [[part.version, part.version]] if part.version is not None else [list(r) for r in part.versions]


def has_bounds(dtype: DataType) -> bool:
    return isinstance(dtype, (StringType, IntegralType, DoubleType, FloatType, DecimalType, DateType, TimestampNTZType))


def may_hold(part: Part, where: Sequence[Between], schema: StructType) -> bool:
    """Whether a part's bounds leave room for rows of all conditions."""
    if not part.rows:
        return False
    for w in where:
        if w.column not in part.bounds:
            continue
        low, high = part.bounds[w.column]
        if low is None:
            return False            # only nulls
        dtype = schema[w.column].dataType
        try:
            if isinstance(dtype, (DoubleType, FloatType)) and "NaN" in (low, high):
                continue
            if w.low is not None and _value(high, dtype) < _value(w.low, dtype):
                return False
            if w.high is not None and _value(low, dtype) > _value(w.high, dtype):
                return False
        except ValueError:          # a value Python cannot hold: not pruned
            continue
    return True


def observed_bounds(columns: Sequence[str]) -> list:
    """Metrics of the rows that a write passes on: their number and every column's bounds."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        out += [F.min(c).cast("string").alias(f"low{i}"), F.max(c).cast("string").alias(f"high{i}")]
    return out


# ---------------------------------------------------------------- the log

class SnapshotLog:
    """The commits of the table in ``path``."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 100):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in names_in(self.spark, f"{self.path}/{SNAPSHOTS}") if n.endswith(".json"))

    def _file(self, number: int) -> str:
        return f"{self.path}/{SNAPSHOTS}/{number:020d}.json"

    def at(self, number: int) -> Snapshot:
        """The table as of one commit."""
        return Snapshot.of_text(read_text(self.spark, self._file(number)))

    def head(self) -> Snapshot | None:
        """The latest snapshot, None if nothing was ever committed."""
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else None

    def commit(self, change: Callable[[Snapshot], Snapshot | None]) -> Snapshot:
        """Commit what ``change`` makes of the head; tried again from the new head if another
        writer was first. ``change`` returns None to leave the table as it is."""
        while True:
            head = self.head() or Snapshot()
            new = change(head)
            if new is None:
                return head
            new = replace(new, number=head.number + 1)
            if create_if_absent(self.spark, self._file(new.number), new.to_text()):
                if new.number % self.keep == 0:
                    self.expire(self.keep)
                return new

    def ensure(self, schema: StructType) -> Snapshot:
        """K6: the table with ``schema``, made if it is not there."""
        return self.commit(lambda head: None if head.number else replace(head, schema=schema))

    def next_version(self) -> int:
        """The next number of the table's sequence. A number is only taken beside its
        predecessor, so a writer that slept between looking and taking gets no old one."""
        folder = f"{self.path}/{SEQUENCE}"
        while True:
            taken = sorted(int(n) for n in names_in(self.spark, folder) if n.isdigit())
            n = taken[-1] + 1 if taken else 1
            if not create_if_absent(self.spark, f"{folder}/{n:020d}", ""):
                continue
            if n > 1 and not folder_exists(self.spark, f"{folder}/{n - 1:020d}"):
                remove_folder(self.spark, f"{folder}/{n:020d}")
                continue
            for old in taken[:-16]:
                remove_folder(self.spark, f"{folder}/{old:020d}")
            return n

    def folder(self, part: Part | str) -> str:
        return f"{self.path}/{DATA}/{PART_COL}={part if isinstance(part, str) else part.id}"

    def expire(self, keep: int) -> list[str]:
        """Forget all but the last ``keep`` snapshots and delete the parts that none of these
        holds; readers of older ones lose them. Returns the deleted parts' ids."""
        numbers = self.numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        live = {p.id for n in kept for p in self.at(n).parts}
        gone = {p.id for n in old for p in self.at(n).parts} - live
        for n in old:                   # first, so that nobody starts from a snapshot without its files
            remove_folder(self.spark, self._file(n))
        for i in sorted(gone):
            remove_folder(self.spark, self.folder(i))
            remove_folder(self.spark, f"{self.path}/{INDEX}/{i}")
        return sorted(gone)

    # -- writing and reading parts ----------------------------------------------------

    def write_part(self, df: DataFrame, bounds: Sequence[str], partition_by: Sequence[str] = (), **own) -> Part:
        """Rows written as a new part; not in the table before it is committed."""
        part = f"p{uuid.uuid4().hex[:16]}"
        obs = Observation(f"part-{part}")           # a name of its own: several writes may run at a time
        counted = df.observe(obs, *observed_bounds(bounds))
        writer = counted.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.folder(part))
        got = obs.get
        rows = int(got.get("rows") or 0)
        if not rows:
            remove_folder(self.spark, self.folder(part))
        return Part(part, rows, bytes_in(self.spark, self.folder(part)) if rows else 0,
                    bounds={c: [got.get(f"low{i}"), got.get(f"high{i}")] for i, c in enumerate(bounds)} if rows else {}, **own)

    def index(self, part: Part, schema: StructType, bounds: Sequence[str], key: str | None) -> Part:
        """Bounds of every file of a part and, of the key, a Bloom filter of two hashes."""
        file = F.substring_index(F.col("_metadata.file_path"), f"{PART_COL}={part.id}/", -1).alias("file")
        rows = self.read_paths([self.folder(part)], schema, file)
        own = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in bounds for n, f in (("low", F.min), ("high", F.max))])
        own.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{INDEX}/{part.id}/files")
        if key is not None:
            most = self.spark.read.parquet(f"{self.path}/{INDEX}/{part.id}/files").agg(F.max("rows")).first()[0]
            bits = -(-most * BITS_PER_ROW // BITMAP) * BITMAP
            hashed = rows.where(F.col(key).isNotNull()).select("file", F.explode(F.array(*key_bits(F.col(key), bits))).alias("bit"))
            (hashed.groupBy("file", F.col("bit.which").alias("which"), F.expr(f"bit.at div {BITMAP}").alias("slot"))
             .agg(F.bitmap_construct_agg(F.expr(f"bit.at % {BITMAP}")).alias("bits")).withColumn("of", F.lit(bits))
             .write.mode("overwrite").parquet(f"{self.path}/{INDEX}/{part.id}/keys"))
        return replace(part, indexed=True)

    def read_paths(self, paths: Sequence[str], schema: StructType, *extra) -> DataFrame:
        """Rows of folders or files of this table, with the table's schema."""
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{DATA}")
        return reader.parquet(*paths).select(*[F.col(f"`{c}`") for c in schema.fieldNames()], *extra)

    def read_parts(self, parts: Sequence[Part], schema: StructType, where: Sequence[Between] = (),
                   key: str | None = None, keys: Sequence[Any] | None = None) -> DataFrame:
        """Rows of some parts, those alone that meet ``where`` and hold one of ``keys``."""
        paths = files_of(self, parts, schema, where, key, keys)
        df = self.read_paths(paths, schema) if paths else self.spark.createDataFrame([], schema)
        for w in where:
            df = df.where(w.condition(schema[w.column].dataType))
        return df.where(F.col(key).isin(list(keys))) if keys is not None else df


def key_bits(key, bits: int) -> list:
    """The two bits of a key in a filter of ``bits`` bits."""
    return [F.struct(F.lit(i).alias("which"), F.pmod(F.xxhash64(key.cast("string"), F.lit(i)), F.lit(bits).cast("bigint")).alias("at")) for i in (0, 1)]


def files_of(log: SnapshotLog, parts: Sequence[Part], schema: StructType, where: Sequence[Between] = (),
             key: str | None = None, keys: Sequence[Any] | None = None) -> list[str]:
    """Folders and files that may hold rows of all conditions: whole parts by their bounds, files
    of indexed parts by the index. Nothing of the data is listed or opened."""
    spark, out = log.spark, []
    for w in where:
        if w.column not in schema.names:
            raise ValueError(f"no column {w.column!r} in {schema.names}")
    asked = [*where, *([Between(key, min(keys), max(keys))] if keys else [])]
    if keys is not None and not keys:
        return []
    for part in parts:
        if not may_hold(part, asked, schema):
            continue
        if not part.indexed or not asked:
            out.append(log.folder(part))
            continue
        files = spark.read.parquet(f"{log.path}/{INDEX}/{part.id}/files")
        for w in asked:
            low, high = F.col(f"low_{w.column}"), F.col(f"high_{w.column}")
            if f"low_{w.column}" not in files.columns:
                continue
            dtype = schema[w.column].dataType
            if w.low is not None:
                files = files.where(high >= _literal(w.low, dtype))
            if w.high is not None:
                files = files.where(low <= _literal(w.high, dtype))
        if keys and folder_exists(spark, f"{log.path}/{INDEX}/{part.id}/keys"):
            stored = spark.read.parquet(f"{log.path}/{INDEX}/{part.id}/keys")
            probes = spark.createDataFrame([(str(k),) for k in set(keys)], "k string")
            bits = stored.select("of").first()
            if bits is None:
                continue
            wanted = probes.select("k", F.explode(F.array(*key_bits(F.col("k"), bits[0]))).alias("bit")).select(
                "k", F.col("bit.which").alias("which"), F.expr(f"bit.at div {BITMAP}").alias("slot"), F.expr(f"bit.at % {BITMAP}").alias("pos"))
            held = F.expr("shiftright(cast(conv(hex(substring(bits, cast(pos div 8 as int) + 1, 1)), 16, 10) as int), cast(pos % 8 as int)) & 1")
            hits = (stored.join(F.broadcast(wanted), ["which", "slot"]).where(held == 1).groupBy("file", "k")
                    .agg(F.count_distinct("which").alias("n")).where("n = 2").select("file").distinct())
            files = files.join(hits, "file", "left_semi")
        out += [f"{log.folder(part)}/{unquote(r['file'])}" for r in files.select("file").collect()]      # one row a file that is read
    return out


def _literal(value, dtype: DataType):
    if isinstance(value, str) and isinstance(dtype, TimestampNTZType):
        value = _value(value, dtype)
    return F.lit(value.isoformat(" ")).cast(dtype) if isinstance(value, dt.datetime) else F.lit(value).cast(dtype)


def merged_schema(have: StructType | None, new: StructType) -> StructType:
    """The table's columns, new ones after them; a column keeps its type."""
    if have is None:
        return StructType([StructField(f.name, f.dataType, True) for f in new])
    by = {f.name: f for f in have}
    for f in new:
        if f.name in by and _plain(by[f.name].dataType) != _plain(f.dataType):
            raise ValueError(f"column {f.name!r} is {by[f.name].dataType.simpleString()} in the table, {f.dataType.simpleString()} in the batch")
    return StructType([*have.fields, *(StructField(f.name, f.dataType, True) for f in new if f.name not in by)])


def _plain(dtype: DataType) -> str:
    return dtype.simpleString()
