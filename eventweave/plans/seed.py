"""Serving tables from an event file, and the publish-then-stream seed flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventweave.operators import canonical as C
from eventweave.operators import projections as P
from eventweave.sinks.export import event_records, publish_records
from eventweave.sources.files import read_event_files
from eventweave.sources.topics import read_topic
from eventweave.streaming.fanout import FanOut, run_fanout


def canonical_from_files(spark: SparkSession, path: str, *, whole_files: bool = False) -> DataFrame:
    events = read_event_files(spark, path, whole_files=whole_files)
    return C.canonicalise(event_records(events))


def seed_tables(spark: SparkSession, path: str, *, whole_files: bool = True,
                segments: DataFrame | None = None, lifecycle_prefix: str = "order.") -> dict[str, DataFrame]:
    """The serving tables an event file implies (orders hold order-lifecycle events
    only, as the seed data does); segments come from outside the events."""
    canon = canonical_from_files(spark, path, whole_files=whole_files)
    tables = {"orders": P.orders_rows(canon, lifecycle_prefix=lifecycle_prefix),
              "events": P.serving_rows(canon),
              "event_metrics": P.metric_rows(canon)}
    if segments is not None:
        tables["event_segments"] = segments
    return tables


def seed_flow(spark: SparkSession, path: str, topic: str, fanout: FanOut, checkpoint: str, *,
              whole_files: bool = True, max_per_trigger: int | None = None) -> int:
    """Publish an event file to a (file) topic keyed by event_id, then drain it."""
    events = read_event_files(spark, path, whole_files=whole_files)
    publish_records(event_records(events), "events.raw", path=topic)
    return run_fanout(read_topic(spark, topic, max_per_trigger=max_per_trigger), fanout, checkpoint)


__all__ = ["canonical_from_files", "seed_flow", "seed_tables"]
