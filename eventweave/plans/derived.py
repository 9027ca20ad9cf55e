"""Inputs of the registered queries, derived by Spark from the driver tables.

The driver's ``events`` table has no missing or null keys, so the raw JSON records are
written from it by a fixed rule (the DuckDB oracle restates the same rule):

* ``event_id % 10 = 0``: the id is under key ``id`` instead of ``event_id``;
* ``event_id % 7 = 0``: no ``event_type`` key; else ``% 11 = 0``: ``"event_type": null``;
* ``event_id % 5 = 0``: no ``amount`` key;
* ``event_id % 3 = 0``: no ``payload`` key (otherwise ``props`` as a nested object).

Every event yields exactly one record; the rule only chooses the record's shape.
The serving tables of the three-way join come from ``events`` as well:

* metrics: one row per event except ``error`` events; ``purchase`` events carry a
  second metric row (a count of 1), so keys repeat on that side;
* segments: ``high_value`` when ``value >= 100``, else ``engagement`` for click/view,
  else ``standard``; ``signup`` events are not scored (no segment row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions import fields as J
from eventweave.operators import canonical as C
from eventweave.operators.spread import spread
from eventweave.schemas import AMOUNT

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _frag(key: str, json_value) -> F.Column:
    return F.concat(F.lit(f'"{key}":'), json_value)


def _quoted(c) -> F.Column:
    # The quoted values (ids, type words, ISO times) hold no character JSON must escape.
    return F.concat(F.lit('"'), c, F.lit('"'))


def raw_events(events: DataFrame) -> DataFrame:
    """One JSON text record per event: columns ``seq`` (the event id) and ``value``."""
    eid = F.col("event_id")
    id_frag = F.when(eid % 10 == 0, _frag("id", _quoted(eid.cast("string")))) \
        .otherwise(_frag("event_id", _quoted(eid.cast("string"))))
    type_frag = F.when(eid % 7 == 0, F.lit(None)) \
        .when(eid % 11 == 0, F.lit('"event_type":null')) \
        .otherwise(_frag("event_type", _quoted(F.col("event_type"))))
    customer_frag = _frag("customer_id", F.col("user_id").cast("string"))
    amount_frag = F.when(eid % 5 == 0, F.lit(None)) \
        .otherwise(_frag("amount", F.col("value").cast(AMOUNT).cast("string")))
    payload_frag = F.when(eid % 3 == 0, F.lit(None)).otherwise(_frag("payload", F.col("props")))
    occurred_frag = _frag("occurred_at", _quoted(J.iso_text(F.col("ts"))))
    value = F.concat(F.lit("{"), F.concat_ws(",", id_frag, type_frag, customer_frag, amount_frag,
                                              payload_frag, occurred_frag), F.lit("}"))
    return spread(events).select(eid.alias("seq"), value.alias("value"))


def lake_events(events: DataFrame) -> DataFrame:
    """Lake rows: P5 over the raw records; records without an ``event_id`` key are rejected."""
    tagged = C.classify(raw_events(events))
    v = F.col("_v")
    good = tagged.where(C.ok_predicate(v) & J.has_key(v, "event_id"))
    return good.select(*C.lake_columns(v))


def event_metrics(events: DataFrame) -> DataFrame:
    """OLAP metrics: one row per non-error event, a second (count 1) row per purchase."""
    rows = events.where(F.col("event_type") != "error")
    base = rows.select(F.col("event_id").cast("string").alias("event_id"), "event_type",
                       F.col("value").cast(AMOUNT).cast("bigint").alias("metric_value"),
                       F.to_date("ts").alias("event_date"))
    extra = rows.where(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type",
        F.lit(1).cast("bigint").alias("metric_value"), F.to_date("ts").alias("event_date"))
    return base.unionByName(extra)


def event_segments(events: DataFrame) -> DataFrame:
    """Warehouse segments by value and type; signups are not scored (no row)."""
    segment = F.when(F.col("value") >= 100, "high_value") \
        .when(F.col("event_type").isin("click", "view"), "engagement").otherwise("standard")
    return events.where(F.col("event_type") != "signup").select(
        F.col("event_id").cast("string").alias("event_id"), segment.alias("segment"),
        (F.col("value") / 500.0).alias("score"))
