"""One object that wires the session, the target tables and the workload routes.

Run the stream, run the incremental sync, publish events, query by workload, federate. Each method is a thin
composition of the operators, sources and sinks of this package; tables live under
``root`` (a shared folder or bucket prefix) unless mapped to catalog tables.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.operators.canonical import OK, STATUS
from eventweave.operators.federate import SkewGuard, SourceRef, federate
from eventweave.plans.incremental import IncrementalSummary
from eventweave.plans.sync import run_incremental
from eventweave.schemas import EVENT_METRICS, EVENTS, LAKE_BY_DAY, ORDERS, QUARANTINE
from eventweave.session import prepare
from eventweave.sinks.export import event_records, publish, publish_records
from eventweave.sinks.snapshots import Between
from eventweave.sinks.tables import AppendTable, InsertOnceTable, KeyedTable, read_table
from eventweave.sources.catalogs import Router, Workload, store_table
from eventweave.sources.files import read_event_files
from eventweave.sources.topics import read_topic
from eventweave.streaming.fanout import FanOut, Transform, default_transform, run_bounded, run_fanout

ORDER = ("partition", "offset")


def since_bounds(since: str) -> list[Between]:
    """The bound of a sync as a condition on parts and files; none if it is no plain ISO time."""
    try:
        dt.datetime.fromisoformat(since)
    except ValueError:
        return []
    return [Between("occurred_at", since)]


@dataclass
class Engine:
    spark: SparkSession
    root: str
    routes: Mapping[Workload | str, tuple[str | None, str | None]] = field(default_factory=dict)
    topic_format: str = "json"                 # "kafka" with the Kafka connector on the classpath
    topic_options: Mapping[str, str] = field(default_factory=dict)
    tables: dict[str, DataFrame | str] = field(default_factory=dict)   # qualified name -> df or path

    def __post_init__(self) -> None:
        prepare(self.spark)
        self.root = self.root.rstrip("/")
        self.router = Router(self.routes)
        self.orders = InsertOnceTable(f"{self.root}/orders", order_cols=ORDER)
        self.events = KeyedTable(f"{self.root}/events", EVENTS, order_cols=ORDER)
        self.metrics = AppendTable(f"{self.root}/event_metrics", EVENT_METRICS)
        self.lake = AppendTable(f"{self.root}/lake_events", LAKE_BY_DAY, partition_by=("event_date",), versioned=True)
        self.quarantine = AppendTable(f"{self.root}/quarantine", QUARANTINE)

    def _topic(self, topic: str) -> str:
        return topic if self.topic_format == "kafka" else f"{self.root}/topics/{topic}"

    # -- publish (K1) -------------------------------------------------------------
    def publish(self, topic: str, events: DataFrame) -> None:
        """Keyed JSON records of ``events`` (one row per event) to ``topic``."""
        publish(events, topic, fmt=self.topic_format, path=self._topic(topic),
                options=dict(self.topic_options) or None)

    def publish_file(self, topic: str, path: str, *, whole_files: bool = True, bad: str = "fail") -> None:
        """S1 -> K1: every event of the JSON file(s) at ``path``, keyed by its event_id. Text that is no
        event makes the publish fail, or goes to the quarantine (``bad="quarantine"``)."""
        events = read_event_files(self.spark, path, whole_files=whole_files)
        if bad == "quarantine":
            broken = events.where(F.col(STATUS) != OK).select(F.col(STATUS).alias("reason"), F.col("value").alias("raw"))
            self.quarantine.write(broken, 0, f"file-{path}")         # the same files again replace their own
            events = events.where(F.col(STATUS) == OK)
        elif bad != "fail":
            raise ValueError(f"bad={bad!r}: 'fail' or 'quarantine'")
        self._publish(topic, event_records(events))

    def publish_event(self, topic: str, event: Mapping[str, Any]) -> None:
        """One event given as a mapping (nested values are kept as JSON)."""
        key = event.get("event_id")
        self._publish(topic, self.spark.createDataFrame([(None if key in (None, "") else str(key), json.dumps(dict(event)))], "key string, value string"))

    def _publish(self, topic: str, records: DataFrame) -> None:
        publish_records(records, topic, fmt=self.topic_format, path=self._topic(topic), options=self.topic_options)

    # -- stream (T1-T7) -----------------------------------------------------------
    def stream(self, topic: str, *, max_per_trigger: int | None = None,
               transform: Transform = default_transform, targets: Sequence[str] | None = None,
               lifecycle_prefix: str | None = None, limit: int | None = None) -> int:
        """Drain ``topic`` into the targets (all by default), or take its next ``limit`` records;
        returns records processed. A topic is either drained or read in bounded runs."""
        chosen = targets or ("orders", "events", "metrics", "lake", "quarantine")
        fan = FanOut({name: getattr(self, name) for name in chosen}, transform=transform,
                     lifecycle_prefix=lifecycle_prefix)
        checkpoint = f"{self.root}/_checkpoints/stream-{topic}"
        if limit is not None:
            return run_bounded(self.spark, self._topic(topic), fan, checkpoint, limit, fmt=self.topic_format, options=self.topic_options)
        source = read_topic(self.spark, self._topic(topic), fmt=self.topic_format,
                            max_per_trigger=max_per_trigger, options=dict(self.topic_options))
        return run_fanout(source, fan, checkpoint)

    # -- sync (T8) ----------------------------------------------------------------
    def sync(self, since: str, *, warehouse: bool = True) -> dict[str, int]:
        """Lake rows since ``since`` -> per-type summary table (+ warehouse copy)."""
        return run_incremental(self.spark, self.lake.read(self.spark, since_bounds(since)), since, summary_path=f"{self.root}/type_summary",
                               warehouse_path=f"{self.root}/warehouse_events" if warehouse else None, date_col="event_date")

    def summary(self) -> DataFrame:
        """Count and exact distinct ids per type of the whole lake, kept up to date: only lake rows
        that came since the last call are read (T8 with a high-water mark)."""
        return IncrementalSummary(f"{self.root}/_summary_state").update(self.spark, self.lake)

    # -- query (U1) and federation (J1-J7) ----------------------------------------
    def mounted(self, workload: Workload, sql: str | None = None) -> dict[str, DataFrame]:
        """The root's tables by the names that SQL of a workload knows them by; with ``sql`` those
        whose names occur in it (a table is listed when it is read)."""
        spark = self.spark
        own = {"orders": lambda: self.orders.read(spark, ORDERS), "serving_events": lambda: self.events.read(spark),
               "event_metrics": lambda: self.metrics.read(spark), "lake_events": lambda: self.lake.read(spark),
               "events": lambda: self.events.read(spark) if workload in (Workload.OLTP, Workload.HTAP) else self.lake.read(spark)}
        for qualified, table in self.tables.items():
            own.setdefault(qualified.rpartition(".")[2], lambda t=table: read_table(spark, t) if isinstance(t, str) else t)
        return {name: read() for name, read in own.items() if sql is None or re.search(rf"\b{re.escape(name)}\b", sql, re.IGNORECASE)}

    def query(self, sql: str, workload: Workload | str | None = None,
              args: Sequence[Any] | Mapping[str, Any] | None = None, *,
              sources: Sequence[SourceRef] | None = None, **join: Any) -> DataFrame:
        """SQL text in the catalog of its workload, or, if no route is set for the workload, over
        the tables under the root (their names come before a caller's temporary views). Blank text for ``federated`` joins ``sources`` (J6)."""
        label = Workload(workload) if workload is not None else self.router.default
        if label is Workload.FEDERATED and not sql.strip():
            return self.federate(sources, **join)
        if label in self.router.routes:
            return self.router.query(self.spark, sql, label, args)
        names = self.mounted(label, sql)
        # Analysed here, so the names are only needed for a moment; a caller's views come back.
        before = {t.name: self.spark.table(t.name) for t in self.spark.catalog.listTables() if t.isTemporary and t.name in names}
        for n, df in names.items():
            df.createOrReplaceTempView(n)
        try:
            return self.router.query(self.spark, sql, label, args)
        finally:
            for n in names:
                if n in before:
                    before[n].createOrReplaceTempView(n)
                else:
                    self.spark.catalog.dropTempView(n)

    def register(self, qualified: str, table: DataFrame | str) -> None:
        """Expose a DataFrame or a Parquet folder under ``catalog.schema.table``."""
        self.tables[qualified] = table

    def register_store(self, qualified: str, url: str, table: str, *, partition_column: str | None = None, partitions: int = 16,
                       driver: str | None = None, options: Mapping[str, str] | None = None) -> None:
        """Expose a store's table under ``catalog.schema.table``, read in parallel by even ranges of
        ``partition_column`` wherever SQL or a federation names it."""
        self.register(qualified, store_table(self.spark, url, table, driver=driver, partition_column=partition_column, partitions=partitions, options=options))

    def resolve(self, source: SourceRef) -> DataFrame:
        target = self.tables.get(source.qualified)
        if target is not None:
            return read_table(self.spark, target) if isinstance(target, str) else target
        own = {"lake.analytics.events": self.lake.read, "olap.analytics.event_metrics": self.metrics.read,
               "oltp.analytics.orders": lambda s: self.orders.read(s, ORDERS), "htap.analytics.events": self.events.read}
        return own[source.qualified](self.spark) if source.qualified in own else self.spark.table(source.qualified)

    def federate(self, sources: Sequence[SourceRef] | None = None, *, sql: str | None = None,
                 join_key: str = "event_id", join_type: str = "LEFT", limit: int | None = None,
                 skew_guard: SkewGuard | None = SkewGuard()) -> DataFrame:
        return federate(self.spark, sources, sql=sql, join_key=join_key, join_type=join_type,
                        limit=limit, resolve=self.resolve, skew_guard=skew_guard)
