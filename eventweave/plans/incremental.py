"""A1, A2, T8 with a high-water mark: per-type counts and exact distinct ids, kept as state.

The state is mergeable, so a run reads only rows of batches it has not seen:

* ``ids``: every event_id with a number of its own (given once, in the run that met it first);
* ``bitmaps``: per event type and block of 32,768 numbers a bitmap of the numbers seen, one row a
  run and block; a type's distinct count is the bits of its bitmaps put together by OR;
* ``counts``: rows per type and run.

Numbers are dense inside a task and follow the type, so bitmaps are full rather than scattered; a
type of any size is spread over its blocks. The mark is the set of batch versions that are
in the state (``AppendTable.read_new``), committed after the three tables: a run that broke off
is done again and replaces its own rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType

from eventweave.schemas import schema_of
from eventweave.session import work_dir
from eventweave.sinks.snapshots import create_if_absent, names_in, read_text, remove_folder
from eventweave.sinks.tables import AppendTable

IDS = schema_of(("event_id", StringType()), ("id", LongType()))
BITMAPS = schema_of(("event_type", StringType()), ("block", LongType()), ("bits", BinaryType()))
COUNTS = schema_of(("event_type", StringType()), ("n", LongType()))
#: A new id's number: run, task and row of the task, in so many bits.
RUN_BITS, TASK_BITS, ROW_BITS = 18, 17, 28
RUN = "run"


class IncrementalSummary:
    """The state under ``path`` of one lake table."""

    def __init__(self, path: str, *, type_col: str = "event_type", id_col: str = "event_id"):
        self.path, self.type_col, self.id_col = path.rstrip("/"), type_col, id_col
        self.ids = AppendTable(f"{self.path}/ids", IDS)
        self.bitmaps = AppendTable(f"{self.path}/bitmaps", BITMAPS)
        self.counts = AppendTable(f"{self.path}/counts", COUNTS)

    def _runs(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in names_in(spark, f"{self.path}/runs") if n.endswith(".json"))

    def mark(self, spark: SparkSession) -> tuple[int, list[list[int]]]:
        """(number of the next run, versions in the state)."""
        runs = self._runs(spark)
        if not runs:
            return 0, []
        return runs[-1] + 1, json.loads(read_text(spark, f"{self.path}/runs/{runs[-1]:020d}.json"))["versions"]

    def _before(self, spark: SparkSession, table: AppendTable, run: int) -> DataFrame:
        """A state table without rows of runs that did not end."""
        head = table.snapshot(spark)
        return table.log(spark).read_parts([p for p in head.parts if p.batch is None or p.batch < run], head.schema or table.schema)

    def update(self, spark: SparkSession, lake: AppendTable) -> DataFrame:
        """Take in the lake's new batches; returns ``event_type, event_count, unique_events``."""
        run, known = self.mark(spark)
        rows, versions = lake.read_new(spark, known)
        if versions != known:
            self._take_in(spark, rows, run)
            if not create_if_absent(spark, f"{self.path}/runs/{run:020d}.json", json.dumps({"versions": versions})):
                raise RuntimeError(f"another driver updates {self.path}; its run {run} stands")
            for old in self._runs(spark)[:-20]:
                remove_folder(spark, f"{self.path}/runs/{old:020d}.json")
        return self.read(spark)

    def _take_in(self, spark: SparkSession, rows: DataFrame, run: int) -> None:
        if run >= 1 << RUN_BITS:
            raise RuntimeError("too many runs: start a new state")
        own = rows.select(F.col(self.type_col).alias("event_type"), F.col(self.id_col).cast("string").alias("event_id"))
        pairs = own.groupBy("event_type", "event_id").agg(F.count(F.lit(1)).alias("n"))       # a hot id collapses before the shuffle
        folder = work_dir(spark, "increment")
        pairs.write.parquet(folder)
        pairs = spark.read.schema("event_type string, event_id string, n bigint").parquet(folder)
        self.counts.write(pairs.groupBy("event_type").agg(F.sum("n").alias("n")), run, RUN)
        named = pairs.where(F.col("event_id").isNotNull())
        known = self._before(spark, self.ids, run)
        new = (named.groupBy("event_id").agg(F.min("event_type").alias("t")).join(known, "event_id", "left_anti")
               .sortWithinPartitions("t"))              # numbers of one type lie together
        place = F.monotonically_increasing_id()
        task, row = F.shiftright(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
        fits = (task < (1 << TASK_BITS)) & (row < (1 << ROW_BITS))
        number = F.lit(run << (TASK_BITS + ROW_BITS)) + task * (1 << ROW_BITS) + row + 1
        self.ids.write(new.select("event_id", F.when(fits, number).otherwise(F.raise_error(F.lit("an increment too large: more shuffle partitions"))).cast("bigint").alias("id")), run, RUN)
        every = self._before(spark, self.ids, run + 1)
        bits = (named.join(every, "event_id").groupBy("event_type", F.bitmap_bucket_number("id").alias("block"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))
        self.bitmaps.write(bits, run, RUN)
        remove_folder(spark, folder)

    def read(self, spark: SparkSession) -> DataFrame:
        """The summary of what is in the state."""
        run, _ = self.mark(spark)
        blocks = self._before(spark, self.bitmaps, run).groupBy("event_type", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        unique = blocks.groupBy("event_type").agg(F.sum(F.bitmap_count("bits")).alias("unique_events"))
        counts = self._before(spark, self.counts, run).groupBy("event_type").agg(F.sum("n").alias("event_count"))
        return (counts.alias("c").join(unique.alias("u"), F.col("c.event_type").eqNullSafe(F.col("u.event_type")), "left")
                .select("c.event_type", "event_count", F.coalesce("unique_events", F.lit(0)).cast("bigint").alias("unique_events")))
