"""Publishing and exporting: keyed JSON records (K1), result export as JSON (K11, F12),
bulk load of staged Parquet (K7) and the summary load (K8)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DateType, DecimalType, StructType, TimestampNTZType,
                               TimestampType)

from eventweave.operators.canonical import OK, STATUS
from eventweave.sources.files import read_staged
from eventweave.sinks.snapshots import SnapshotLog
from eventweave.sinks.tables import AppendTable, append_to_table, load_run_to_table, read_table

_TO_JSON_KEEP_NULLS = {"ignoreNullFields": "false"}
_TEXT_TYPES = (DateType, TimestampType, TimestampNTZType, DecimalType, BinaryType)


def keyed_records(df: DataFrame, *, key_col: str | None = "event_id", topic: str | None = None,
                  value_cols: list[str] | None = None) -> DataFrame:
    """K1: ``key`` = the key column ('' or null -> null key), ``value`` = JSON of the whole row.

    Nulls are written as JSON nulls (``to_json`` would drop them by default).
    """
    cols = value_cols or [c for c in df.columns if c not in ("topic", "partition", "offset", "_key")]
    key = F.nullif(F.col(key_col).cast("string"), F.lit("")) if key_col else F.lit(None).cast("string")
    out = [key.alias("key"), F.to_json(F.struct(*cols), _TO_JSON_KEEP_NULLS).alias("value")]
    if topic is not None:
        out.insert(0, F.lit(topic).alias("topic"))
    return df.select(*[c for c in ("partition", "offset") if c in df.columns], *out)


#: Offsets of one publish into a file topic.
OFFSETS = 1 << 40


def with_offsets(records: DataFrame, topic_path: str) -> DataFrame:
    """``records`` with a partition and an offset, for a topic that is a folder: offsets follow
    the row order and those of earlier publishes (every publish takes the topic's next number, no
    clock). ``records`` should be cached: it is counted by partition first."""
    counts = {r[0]: r[1] for r in records.groupBy(F.spark_partition_id()).count().collect()}     # one row a partition
    base, starts = SnapshotLog(records.sparkSession, topic_path).next_version() * OFFSETS, []
    for pid in sorted(counts):
        starts.append((pid, base))
        base += counts[pid]
    first = records.sparkSession.createDataFrame(starts, "_pid int, _first bigint")
    return (records.withColumn("_pid", F.spark_partition_id())
            .withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
            .join(F.broadcast(first), "_pid")
            .withColumns({"partition": F.lit(0), "offset": F.col("_first") + F.col("_i")}).drop("_pid", "_i", "_first"))


def publish_records(records: DataFrame, topic: str, *, fmt: str = "json", path: str | None = None,
                    options: Mapping[str, str] | None = None) -> None:
    """Records (``key``, ``value``) to a topic: the one way all publishing goes.

    ``fmt="kafka"`` uses the Kafka sink (``kafka.acks=all`` unless overridden); the default
    ``fmt="json"`` appends to a *file topic*: a folder of JSON lines with the topic-record
    columns, which the topic source reads back; partition and offset are kept when given,
    else assigned in order.
    """
    if fmt == "kafka":
        opts = {"kafka.acks": "all", "topic": topic, **(options or {})}
        records.select("key", "value").write.format("kafka").options(**opts).save()
        return
    if path is None:
        raise ValueError("a file topic needs a path")
    if {"partition", "offset"} <= set(records.columns):
        _write_topic(records, topic, path, options)
        return
    cached = records.select("key", "value").persist()
    try:
        _write_topic(with_offsets(cached, path), topic, path, options)
    finally:
        cached.unpersist()


def _write_topic(records: DataFrame, topic: str, path: str, options: Mapping[str, str] | None) -> None:
    cols = [F.lit(topic).alias("topic"), "partition", "offset", "key", "value"]
    records.select(*cols).write.mode("append").options(**(options or {})).json(path)


def publish(df: DataFrame, topic: str, *, fmt: str = "json", path: str | None = None,
            options: Mapping[str, str] | None = None, key_col: str | None = "event_id") -> None:
    """K1: write every row as a keyed JSON record to a topic."""
    publish_records(keyed_records(df, key_col=key_col), topic, fmt=fmt, path=path, options=options)


def event_records(events: DataFrame) -> DataFrame:
    """Records of event files (S1): the text of every event, keyed by its event_id. A file or
    line that holds no event makes the job fail: nothing is left out of a publish unseen."""
    text = F.when(F.col(STATUS) == OK, F.col("value")).otherwise(F.raise_error(F.concat(
        F.lit("not an event ("), F.col(STATUS), F.lit("): "), F.coalesce(F.substring("value", 1, 200), F.lit("unreadable")))))
    key = F.nullif(F.try_variant_get(F.col("_v"), "$.event_id", "string"), F.lit(""))
    return events.select(key.alias("key"), text.cast("string").alias("value"))


def as_json_safe(df: DataFrame) -> DataFrame:
    """values JSON cannot hold natively (dates, timestamps, decimals, bytes) as text."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, _TEXT_TYPES)
                       else F.col(f.name) for f in df.schema.fields])


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a result as JSON lines (distributed; nothing passes through the driver)."""
    as_json_safe(df).write.mode(mode).option("ignoreNullFields", "false").json(path)


def load_run(df: DataFrame, path: str, run_id: str | None) -> int:
    """The rows of one run in a path table; the same run loaded again replaces them."""
    return AppendTable(path).write(df, 0, f"run-{run_id or 'default'}")


def bulk_load(spark: SparkSession, staging: str, schema: StructType, *, table: str | None = None,
              path: str | None = None, run_id: str | None = None) -> int:
    """K7 + S9: read staged Parquet with the target schema and load it into the target: a path
    table or a catalog table. A run that is loaded again leaves one copy of its rows (without a
    ``run_id`` a catalog table is appended to). Columns not in the schema are left out."""
    staged = read_staged(spark, staging, schema).select(*schema.fieldNames())
    if table is not None:
        return append_to_table(staged, table) if run_id is None else load_run_to_table(staged, table, run_id)
    if path is None:
        raise ValueError("give a table or a path")
    return load_run(staged, path, run_id)


def load_summary(summary: DataFrame, *, table: str | None = None, path: str | None = None,
                 run_id: str | None = None) -> int:
    """K8: put the per-type summary into its own table (D6); a run that is loaded again leaves
    one copy of its rows."""
    if table is not None:
        return append_to_table(summary, table) if run_id is None else load_run_to_table(summary, table, run_id)
    if path is None:
        raise ValueError("give a table or a path")
    return load_run(summary, path, run_id)


__all__ = ["as_json_safe", "bulk_load", "export_json", "keyed_records", "load_summary", "publish",
           "publish_records", "read_table"]
