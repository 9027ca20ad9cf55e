"""Registered queries: one per operator family, each over the driver tables (or data
Spark derives from them), each with its DuckDB oracle in ``ORACLES``.

A query is ``fn(spark, sf_dir) -> DataFrame``. Queries that exercise a sink write into
a new folder under the shared checkpoint root and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions import fields as J
from eventweave.operators import canonical as C
from eventweave.operators import projections as P
from eventweave.operators.federate import DEFAULT_SOURCES, SkewGuard, SourceRef, federate
from eventweave.operators.summary import run_stats, type_summary
from eventweave.plans import derived as D
from eventweave.plans import oracle as O
from eventweave.plans import table_queries
from eventweave.session import prepare, work_dir
from eventweave.sources.catalogs import Router, Workload

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fixed parameters of the registered queries.
SINCE = "2024-01-15T00:00:00Z"
SINCE_SQL = "TIMESTAMP '2024-01-15 00:00:00'"
LIFECYCLE_PREFIX = "purchase"


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "events")


def _lake_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver events table seen as the lake (occurred_at <- ts)."""
    return _events(spark, sf_dir).select("event_id", "event_type", F.col("ts").alias("occurred_at"))


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.canonicalise(D.raw_events(_events(spark, sf_dir)), keep=("seq",))


def _payload_parts(df: DataFrame) -> list:
    """Comparable view of canonical payload text: its ``k`` and 'is the whole record'."""
    p = J.parse(F.col("payload"))
    return [J.field(p, "k", "bigint").alias("payload_k"),
            J.has_key(p, "occurred_at").alias("payload_is_record")]


def _views(spark: SparkSession, sf_dir: str, names=("events",)) -> None:
    for name in names:
        D.table(spark, sf_dir, name).createOrReplaceTempView(name)


def _serving_resolver(spark: SparkSession, sf_dir: str):
    events = _events(spark, sf_dir)
    tables = {
        DEFAULT_SOURCES[0].qualified: D.lake_events(events),
        DEFAULT_SOURCES[1].qualified: D.event_metrics(events),
        DEFAULT_SOURCES[2].qualified: D.event_segments(events),
    }
    return lambda s: tables[s.qualified]


# ---------------------------------------------------------------- summary

@register("incremental_summary", f"""
SELECT event_type, COUNT(*) AS event_count, COUNT(DISTINCT event_id) AS unique_events
FROM events WHERE ts >= {SINCE_SQL} GROUP BY event_type""")
def incremental_summary(spark, sf_dir):
    """Rows since the bound, per type: count and exact distinct ids."""
    return type_summary(_lake_view(spark, sf_dir), SINCE)


@register("sync_stats", f"""
SELECT CAST(COALESCE(SUM(event_count), 0) AS BIGINT) AS iceberg_rows, COUNT(*) AS aggregate_groups FROM (
  SELECT event_type, COUNT(*) AS event_count FROM events WHERE ts >= {SINCE_SQL} GROUP BY event_type) t""")
def sync_stats(spark, sf_dir):
    """Run statistics derived from the summary (no second scan)."""
    return run_stats(type_summary(_lake_view(spark, sf_dir), SINCE))


@register("lake_scan_filter", f"SELECT * FROM events WHERE ts >= {SINCE_SQL}")
def lake_scan_filter(spark, sf_dir):
    """S3: lake scan with a predicate string, pushed into the Parquet scan."""
    from eventweave.sources.files import lake_scan
    return lake_scan(spark, D.table(spark, sf_dir, "events"), "ts >= TIMESTAMP_NTZ'2024-01-15 00:00:00'")


# ---------------------------------------------------------------- SQL text

@register("count_all", "SELECT COUNT(*) AS n FROM events")
def count_all(spark, sf_dir):
    _views(spark, sf_dir)
    return Router().query(spark, "SELECT COUNT(*) AS n FROM events", Workload.LAKEHOUSE)


@register("group_by_ordinal", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def group_by_ordinal(spark, sf_dir):
    _views(spark, sf_dir)
    return Router().query(spark, "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")


@register("sql_on_catalog", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(user_id) AS BIGINT) AS users FROM events WHERE value >= 100.0 GROUP BY event_type""")
def sql_on_catalog(spark, sf_dir):
    """Positional ``?`` parameters, routed by workload label."""
    _views(spark, sf_dir)
    return Router().query(
        spark, "SELECT event_type, COUNT(*) AS n, SUM(user_id) AS users FROM events "
               "WHERE value >= ? GROUP BY event_type", Workload.HTAP, args=[100.0])


@register("sql_named_params", """
SELECT user_id, COUNT(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND event_type = 'purchase' GROUP BY user_id""")
def sql_named_params(spark, sf_dir):
    """Named ``:name`` parameters."""
    _views(spark, sf_dir)
    return Router().query(
        spark, "SELECT user_id, COUNT(*) AS n FROM events "
               "WHERE ts >= CAST(:since AS TIMESTAMP_NTZ) AND event_type = :etype GROUP BY user_id",
        Workload.OLAP_WAREHOUSE, args={"since": "2024-01-15 00:00:00", "etype": "purchase"})


# ---------------------------------------------------------------- canonical shapes

@register("canonical_events", O.with_ctes(O.CANONICAL_CTE) + """
SELECT event_id, event_type, customer_id, amount, payload_k, payload_is_record, occurred_at FROM canon""")
def canonical_events(spark, sf_dir):
    canon = _canonical(spark, sf_dir)
    return canon.select("event_id", "event_type", "customer_id", "amount", *_payload_parts(canon), "occurred_at")


@register("orders_projection", O.with_ctes(O.CANONICAL_CTE) + """
SELECT event_id, customer_id, amount, ts AS created_at FROM canon""")
def orders_projection(spark, sf_dir):
    return P.orders_rows(_canonical(spark, sf_dir))


@register("orders_lifecycle_only", O.with_ctes(O.CANONICAL_CTE) + f"""
SELECT event_id, customer_id, amount, ts AS created_at FROM canon WHERE event_type LIKE '{LIFECYCLE_PREFIX}%'""")
def orders_lifecycle_only(spark, sf_dir):
    return P.orders_rows(_canonical(spark, sf_dir), lifecycle_prefix=LIFECYCLE_PREFIX)


@register("serving_events", O.with_ctes(O.CANONICAL_CTE) + """
SELECT event_id, event_type, payload_k, payload_is_record, ts AS occurred_at FROM canon""")
def serving_events(spark, sf_dir):
    rows = P.serving_rows(_canonical(spark, sf_dir))
    return rows.select("event_id", "event_type", *_payload_parts(rows), "occurred_at")


@register("metrics_projection", O.with_ctes(O.CANONICAL_CTE) + """
SELECT event_id, event_type, CAST(TRUNC(amount) AS BIGINT) AS metric_value, CAST(ts AS DATE) AS event_date FROM canon""")
def metrics_projection(spark, sf_dir):
    return P.metric_rows(_canonical(spark, sf_dir))


@register("lake_projection", O.with_ctes(O.LAKE_CTE) + "SELECT event_id, event_type, occurred_at, payload FROM lake")
def lake_projection(spark, sf_dir):
    """P5 over raw records; records without an event_id key are rejected (see malformed_split)."""
    return D.lake_events(_events(spark, sf_dir))


# ---------------------------------------------------------------- federation

@register("federated_single", O.with_ctes(O.LAKE_CTE) + "SELECT event_id AS i_event_id, event_type AS i_event_type FROM lake")
def federated_single(spark, sf_dir):
    return federate(spark, [DEFAULT_SOURCES[0]], limit=None, resolve=_serving_resolver(spark, sf_dir))


@register("federated_left_join", O.with_ctes(O.LAKE_CTE, O.METRICS_CTE) + """
SELECT i.event_id AS i_event_id, s.event_id AS s_event_id, s.metric_value AS s_metric_value
FROM lake i LEFT JOIN metrics s ON i.event_id = s.event_id""")
def federated_left_join(spark, sf_dir):
    sources = [SourceRef("lake", "analytics", "events", "i", ("event_id",)), DEFAULT_SOURCES[1]]
    return federate(spark, sources, join_key="event_id", limit=None, resolve=_serving_resolver(spark, sf_dir))


def _three_way(join_type: str) -> Query:
    def q(spark, sf_dir):
        return federate(spark, None, join_type=join_type, limit=None, resolve=_serving_resolver(spark, sf_dir),
                        skew_guard=SkewGuard())
    q.__doc__ = f"Default three sources, {join_type} star join on the base key."
    return q


register("federated_three_way", O.three_way("LEFT"))(_three_way("LEFT"))
register("federated_inner_join", O.three_way("INNER"))(_three_way("INNER"))
register("federated_right_join", O.three_way("RIGHT"))(_three_way("RIGHT"))
register("federated_full_join", O.three_way("FULL"))(_three_way("FULL"))


@register("federated_star_projection", O.with_ctes(O.LAKE_CTE, O.SEGMENTS_CTE) + """
SELECT i.event_id AS i_event_id, i.event_type AS i_event_type, i.occurred_at AS i_occurred_at,
       i.payload AS i_payload, r.segment AS r_segment, r.score AS r_score
FROM lake i LEFT JOIN segments r ON i.event_id = r.event_id""")
def federated_star_projection(spark, sf_dir):
    sources = [SourceRef("lake", "analytics", "events", "i"),
               SourceRef("warehouse", "public", "event_segments", "r", ("segment", "score"))]
    return federate(spark, sources, limit=None, resolve=_serving_resolver(spark, sf_dir))


@register("federated_custom_key", """
SELECT o.o_orderkey AS o_orderkey, o.o_custkey AS o_custkey, o.o_totalprice AS o_totalprice,
       l.l_orderkey AS l_orderkey, l.l_linenumber AS l_linenumber, l.l_quantity AS l_quantity
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def federated_custom_key(spark, sf_dir):
    """Join key ``orderkey``; the sources expose it under one shared name."""
    tables = {
        "tpch.orders": D.table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"),
            F.col("o_totalprice").alias("totalprice")),
        "tpch.lineitem": D.table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"),
            F.col("l_quantity").alias("quantity")),
    }
    sources = [SourceRef(None, "tpch", "orders", "o", ("orderkey", "custkey", "totalprice")),
               SourceRef(None, "tpch", "lineitem", "l", ("orderkey", "linenumber", "quantity"))]
    return federate(spark, sources, join_key="orderkey", limit=None, resolve=lambda s: tables[s.qualified])


@register("federated_limit", f"SELECT COUNT(*) AS limited_rows FROM ({O.three_way('LEFT')} LIMIT 1000) t")
def federated_limit(spark, sf_dir):
    """L1: LIMIT without order; only the number of rows is defined."""
    out = federate(spark, None, limit=1000, resolve=_serving_resolver(spark, sf_dir))
    return out.agg(F.count(F.lit(1)).alias("limited_rows"))


# ---------------------------------------------------------------- sources (S1, S2) and publish (K1)

TOPIC = "events.raw"
TOPIC_PARTITIONS = 4


def _topic_records(events: DataFrame) -> DataFrame:
    """Raw records as topic records: partition by id, offset = id, key = event_id (K1)."""
    raw = D.raw_events(events)
    v = J.parse(F.col("value"))
    return raw.select(F.pmod(F.col("seq"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
                      F.col("seq").alias("offset"),
                      F.nullif(J.field(v, "event_id", "string"), F.lit("")).alias("key"),
                      F.col("value"))


def _publish_topic(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = work_dir(spark, name)
    recs = _topic_records(_events(spark, sf_dir)).select(
        F.lit(TOPIC).alias("topic"), "partition", "offset", "key", "value")
    # One file set per topic partition, like a log per partition.
    recs.repartition(TOPIC_PARTITIONS * 2, "partition").write.mode("overwrite").json(path)
    return path


@register("json_event_scan", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, (event_id % 7 <> 0) AS has_event_type,
       3 + CAST(event_id % 7 <> 0 AS INT) + CAST(event_id % 5 <> 0 AS INT) + CAST(event_id % 3 <> 0 AS INT) AS n_keys
FROM events""")
def json_event_scan(spark, sf_dir):
    """JSON event files (one object per line; arrays are exploded) -> one row per event."""
    from eventweave.sources.files import read_event_files
    path = work_dir(spark, "event_files")
    D.raw_events(_events(spark, sf_dir)).select("value").write.mode("overwrite").text(path)
    scanned = read_event_files(spark, path)
    v = F.col("_v")
    event_id = F.when(J.has_key(v, "event_id"), J.field(v, "event_id", "string")).otherwise(J.field(v, "id", "string"))
    return scanned.where(F.col(C.STATUS) == C.OK).select(
        event_id.alias("event_id"), J.has_key(v, "event_type").alias("has_event_type"),
        F.size(F.json_object_keys(F.col("value"))).alias("n_keys"))


@register("topic_records", f"""
SELECT '{TOPIC}' AS topic, CAST(event_id % {TOPIC_PARTITIONS} AS INT) AS partition, event_id AS "offset",
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS key,
       CAST(event_id AS VARCHAR) AS event_id, user_id AS customer_id
FROM events""")
def topic_records(spark, sf_dir):
    """Drain a topic with a stream (availableNow) into an exactly-once file sink."""
    from eventweave.sources.topics import read_topic
    topic = _publish_topic(spark, sf_dir, "topic")
    out, ckpt = work_dir(spark, "topic_out"), work_dir(spark, "topic_ckpt")
    stream = read_topic(spark, topic, max_per_trigger=3)
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    from eventweave.schemas import RAW_RECORD
    back = spark.read.schema(RAW_RECORD).parquet(out)
    canon = C.canonicalise(back, keep=("topic", "partition", "offset", "key"))
    return canon.select("topic", "partition", "offset", "key", "event_id", "customer_id")


@register("keyed_json_records", O.with_ctes(O.CANONICAL_CTE) + """
SELECT event_id AS key, event_id, event_type, customer_id, amount, occurred_at FROM canon""")
def keyed_json_records(spark, sf_dir):
    """K1: canonical events published as keyed JSON (nulls kept), read back from the topic."""
    from eventweave.schemas import RAW_RECORD
    from eventweave.sinks.export import publish
    path = work_dir(spark, "keyed_topic")
    canon = _canonical(spark, sf_dir).drop("seq")
    publish(canon, "events.canonical", path=path)
    back = spark.read.schema(RAW_RECORD).json(path)
    v = J.parse(F.col("value"))
    return back.select("key", J.field(v, "event_id", "string").alias("event_id"),
                       J.field(v, "event_type", "string").alias("event_type"),
                       J.field(v, "customer_id", "bigint").alias("customer_id"),
                       J.field(v, "amount", "decimal(18,2)").alias("amount"),
                       J.field(v, "occurred_at", "string").alias("occurred_at"))


# ---------------------------------------------------------------- sinks

def _split_by_since(df: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    bound = J.iso_to_ts(F.lit(SINCE))
    return df.where(F.col(ts) < bound), df.where(~(F.col(ts) < bound) | F.col(ts).isNull())


@register("append_metrics", ORACLES["metrics_projection"])
def append_metrics(spark, sf_dir):
    """K4: metric rows appended in two batches (before / from the bound), read back."""
    from eventweave.sinks.tables import AppendTable
    rows = P.metric_rows(_canonical(spark, sf_dir).withColumn("_ts", J.iso_to_ts(F.col("occurred_at"))),
                         keep=("_ts",)).persist()      # derived once, cut into two batches
    try:
        table = AppendTable(work_dir(spark, "metrics"))
        for batch_id, part in enumerate(_split_by_since(rows, "_ts")):
            table.write(part.drop("_ts"), batch_id)
    finally:
        rows.unpersist()
    return table.read(spark)


@register("lake_append", ORACLES["lake_projection"])
def lake_append(spark, sf_dir):
    """K5: lake rows appended in two commits, laid out by event date, read back."""
    from eventweave.sinks.tables import AppendTable
    rows = D.lake_events(_events(spark, sf_dir)).withColumn("event_date", F.to_date("occurred_at")).persist()
    try:
        table = AppendTable(work_dir(spark, "lake"), partition_by=("event_date",))
        for batch_id, part in enumerate(_split_by_since(rows, "occurred_at")):
            table.write(part, batch_id)
    finally:
        rows.unpersist()
    return table.read(spark).drop("event_date")


@register("bulk_load_parquet", O.with_ctes(O.LAKE_CTE) + f"""
SELECT event_id, event_type, occurred_at, payload FROM lake WHERE occurred_at >= {SINCE_SQL}""")
def bulk_load_parquet(spark, sf_dir):
    """T8 + D7 + K7: the sync stages qualifying lake rows, the bulk load copies them."""
    from eventweave.plans.sync import run_incremental
    from eventweave.sinks.tables import read_table
    target = work_dir(spark, "warehouse_events")
    stats = run_incremental(spark, D.lake_events(_events(spark, sf_dir)), SINCE,
                            summary_path=work_dir(spark, "type_summary"), warehouse_path=target)
    if stats.get("redshift_copy") != 1:
        raise RuntimeError(f"bulk load did not run: {stats}")
    return read_table(spark, target)


def _upsert_versions(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches of versions keyed by event_id; ordering columns (b, seq)."""
    base = events.select(F.col("event_id").cast("string").alias("event_id"), "event_type",
                         F.col("props").alias("payload"), F.col("ts").alias("occurred_at"),
                         F.col("event_id").alias("seq"))
    bound = J.iso_to_ts(F.lit(SINCE))
    first = base.withColumn("b", F.lit(1))
    late = base.where(F.col("occurred_at") >= bound)
    drafts = late.withColumn("event_type", F.concat("event_type", F.lit(".draft"))).withColumn("b", F.lit(2))
    finals = late.where(F.col("event_type").isin("purchase", "signup")) \
        .withColumn("event_type", F.concat("event_type", F.lit(".final"))).withColumn("b", F.lit(3))
    return first, drafts.unionByName(finals)


@register("upsert_latest", f"""
WITH v AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props AS payload, ts AS occurred_at, 1 AS b, event_id AS seq FROM events
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), event_type || '.draft', props, ts, 2, event_id FROM events WHERE ts >= {SINCE_SQL}
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), event_type || '.final', props, ts, 3, event_id FROM events
  WHERE ts >= {SINCE_SQL} AND event_type IN ('purchase', 'signup'))
SELECT event_id, event_type, payload, occurred_at FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY b DESC, seq DESC) AS rn FROM v) t WHERE rn = 1""")
def upsert_latest(spark, sf_dir):
    """K3: two upsert batches into a bucketed keyed table; last version per key wins."""
    from eventweave.schemas import EVENTS
    from eventweave.sinks.tables import KeyedTable
    table = KeyedTable(work_dir(spark, "serving_events"), EVENTS, key="event_id", order_cols=("b", "seq"))
    for batch_id, batch in enumerate(_upsert_versions(_events(spark, sf_dir))):
        table.write(batch, batch_id)
    return table.read(spark)


@register("shard_layout", O.with_ctes(O.CANONICAL_CTE) + """
SELECT event_id, customer_id, amount, ts AS created_at, CAST(customer_id AS VARCHAR) AS shard_key FROM canon""")
def shard_layout(spark, sf_dir):
    """K9: orders rows with a shard key column, placed by hash of the key; read back."""
    from eventweave.operators.layout import with_shard_key
    from eventweave.sinks.tables import write_sharded
    path = work_dir(spark, "sharded_orders")
    write_sharded(with_shard_key(P.orders_rows(_canonical(spark, sf_dir)), "customer_id"), path)
    return spark.read.parquet(path).drop("shard")


@register("result_json", O.three_way("LEFT"))
def result_json(spark, sf_dir):
    """The three-way result exported as JSON lines and read back with its schema."""
    from eventweave.sinks.export import export_json
    result = federate(spark, None, limit=None, resolve=_serving_resolver(spark, sf_dir))
    path = work_dir(spark, "result_json")
    export_json(result, path)
    return spark.read.schema(result.schema).json(path)


# ---------------------------------------------------------------- stream and hooks

STREAM_COLUMNS = """target, event_id, event_type, customer_id, amount, ts, event_date, payload, reason"""
_NULLS = {"event_type": "string", "customer_id": "bigint", "amount": "decimal(18,2)", "ts": "timestamp_ntz", "event_date": "date",
          "payload": "string", "reason": "string", "event_id": "string"}


def _as_target(df: DataFrame, target: str, **cols) -> DataFrame:
    """Rows of one target in the common shape; columns it does not have are null."""
    own = {c: cols.get(c, F.col(c) if c in df.columns else F.lit(None)) for c in _NULLS}
    return df.select(F.lit(target).alias("target"), *[v.cast(_NULLS[c]).alias(c) for c, v in own.items()])


def _targets_of(targets: dict, spark: SparkSession) -> DataFrame:
    """Every row of every target; payloads by their ``k`` (the whole record has none)."""
    def k(df):
        return J.field(J.parse(F.col("payload")), "k", "string")
    o, e, m, lk = (targets[n].read(spark) for n in ("orders", "events", "metrics", "lake"))
    q = targets["quarantine"].read(spark)
    rejected_id = J.field(J.parse(F.col("raw")), "id", "string")
    return (_as_target(o, "orders", ts=F.col("created_at"))
            .unionByName(_as_target(e, "events", ts=F.col("occurred_at"), payload=k(e)))
            .unionByName(_as_target(m, "metrics", amount=F.col("metric_value")))
            .unionByName(_as_target(lk, "lake", ts=F.col("occurred_at")))
            .unionByName(_as_target(q, "quarantine", event_id=rejected_id)))


def _new_targets(spark: SparkSession) -> dict:
    from eventweave.schemas import EVENTS, QUARANTINE
    from eventweave.sinks.tables import AppendTable, InsertOnceTable, KeyedTable
    return {
        "orders": InsertOnceTable(work_dir(spark, "orders"), order_cols=("partition", "offset")),
        "events": KeyedTable(work_dir(spark, "events"), EVENTS, order_cols=("partition", "offset")),
        "metrics": AppendTable(work_dir(spark, "metrics")),
        "lake": AppendTable(work_dir(spark, "lake"), partition_by=("event_date",)),
        "quarantine": AppendTable(work_dir(spark, "quarantine"), QUARANTINE),
    }


def _target_sql(target: str, source: str = "canon", **cols: str) -> str:
    types = {"event_type": "VARCHAR", "customer_id": "BIGINT", "amount": "DECIMAL(18,2)", "ts": "TIMESTAMP", "event_date": "DATE", "payload": "VARCHAR", "reason": "VARCHAR"}
    own = ", ".join(f"CAST({cols.get(c, 'NULL')} AS {t}) AS {c}" for c, t in types.items())
    return f"SELECT '{target}' AS target, event_id, {own} FROM {source}"


@register("stream_fanout", O.with_ctes(O.CANONICAL_CTE, O.LAKE_CTE) + f"""
SELECT {STREAM_COLUMNS} FROM (
{_target_sql("orders", customer_id="customer_id", amount="amount", ts="ts")}
UNION ALL {_target_sql("events", event_type="event_type", ts="ts", payload="payload_k")}
UNION ALL {_target_sql("metrics", event_type="event_type", amount="TRUNC(amount)", event_date="ts")}
UNION ALL {_target_sql("lake", "lake", event_type="event_type", ts="occurred_at", payload="payload", event_date="occurred_at")}
UNION ALL {_target_sql("quarantine", "(SELECT * FROM canon WHERE seq % 10 = 0)", reason="'missing_event_id'")}) t""")
def stream_fanout(spark, sf_dir):
    """File topic -> one availableNow stream -> orders / events / metrics / lake (P5) / quarantine."""
    from eventweave.sources.topics import read_topic
    from eventweave.streaming import FanOut, run_fanout
    topic, targets = _publish_topic(spark, sf_dir, "fanout_topic"), _new_targets(spark)
    run_fanout(read_topic(spark, topic, max_per_trigger=3), FanOut(targets), work_dir(spark, "fanout_ckpt"))
    return _targets_of(targets, spark)


@register("stream_two_topics", O.with_ctes(O.CANONICAL_CTE, O.LAKE_CTE) + """
SELECT 'metrics' AS target, event_id, CASE WHEN seq % 2 = 0 THEN 2 ELSE 1 END AS n FROM canon
UNION ALL SELECT 'lake', event_id, CASE WHEN CAST(event_id AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END FROM lake
UNION ALL SELECT 'orders', event_id, 1 FROM canon
UNION ALL SELECT 'events', event_id, 1 FROM canon
UNION ALL SELECT 'rejected', event_id, 1 FROM canon WHERE seq % 2 = 0""")
def stream_two_topics(spark, sf_dir):
    """T5: two topics into the same targets, the first again under a new checkpoint, and a
    restart under the old one, which adds nothing. Rows per target and event."""
    from eventweave.sources.topics import read_topic
    from eventweave.streaming import FanOut, run_fanout
    recs = _topic_records(_events(spark, sf_dir)).withColumn("topic", F.lit(TOPIC))
    topics = []
    for part in (0, 1):
        topics.append(work_dir(spark, f"topic{part}"))
        recs.where(F.col("offset") % 2 == part).select("topic", "partition", "offset", "key", "value").write.json(topics[part])
    targets, checkpoints = _new_targets(spark), [work_dir(spark, "ckpt") for _ in range(3)]
    for topic, checkpoint in ((topics[0], checkpoints[0]), (topics[1], checkpoints[1]), (topics[0], checkpoints[2]), (topics[0], checkpoints[0])):
        run_fanout(read_topic(spark, topic), FanOut(targets), checkpoint)
    frames = {n: targets[n].read(spark) for n in ("orders", "events", "metrics", "lake")} | {"rejected": targets["orders"].rejected(spark)}
    out = None
    for name, df in frames.items():
        rows = df.groupBy("event_id").agg(F.count(F.lit(1)).cast("int").alias("n")).select(F.lit(name).alias("target"), "event_id", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("quarantine_reasons", """
SELECT reason, COUNT(*) AS records FROM (
  SELECT CASE WHEN event_id % 17 = 0 THEN 'malformed_json' WHEN event_id % 19 = 0 THEN 'not_object'
              WHEN event_id % 23 = 0 THEN 'bad_customer_id' WHEN event_id % 29 = 0 THEN 'bad_amount'
              WHEN event_id % 31 = 0 THEN 'bad_occurred_at' WHEN event_id % 10 = 0 THEN 'missing_event_id' END AS reason
  FROM events) t WHERE reason IS NOT NULL GROUP BY reason""")
def quarantine_reasons(spark, sf_dir):
    """What the stream's quarantine holds of damaged records and of values that
    do not fit (they repeat a key: the last value counts)."""
    from eventweave.sources.topics import read_topic
    from eventweave.streaming import FanOut, run_fanout
    raw, seq = _damaged_records(_events(spark, sf_dir)), F.col("seq")
    worse = F.when(seq % 23 == 0, F.lit(',"customer_id":"?"}')).when(seq % 29 == 0, F.lit(',"amount":"abc"}')).when(seq % 31 == 0, F.lit(',"occurred_at":"soon"}'))
    whole = (seq % 17 != 0) & (seq % 19 != 0) & worse.isNotNull()
    value = F.when(whole, F.concat(F.expr("substring(value, 1, length(value) - 1)"), worse)).otherwise(F.col("value"))
    topic, targets = work_dir(spark, "damaged"), _new_targets(spark)
    raw.select(F.lit(TOPIC).alias("topic"), F.lit(0).alias("partition"), seq.alias("offset"), F.lit(None).cast("string").alias("key"), value.alias("value")).write.json(topic)
    run_fanout(read_topic(spark, topic), FanOut(targets), work_dir(spark, "ckpt"))
    return targets["quarantine"].read(spark).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


@register("publish_stream_upsert", "SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 4 = 0 THEN event_type || '.1' ELSE event_type || '.2' END AS event_type FROM events")
def publish_stream_upsert(spark, sf_dir):
    """Versions published in three runs; the last published of a key wins."""
    from eventweave.schemas import EVENTS
    from eventweave.sinks.export import publish
    from eventweave.sinks.tables import KeyedTable
    from eventweave.sources.topics import read_topic
    from eventweave.streaming import FanOut, run_fanout
    topic, table = work_dir(spark, "versions"), KeyedTable(work_dir(spark, "serving"), EVENTS, order_cols=("partition", "offset"))
    events = _events(spark, sf_dir)
    for run, some in enumerate((events, events, events.where("event_id % 4 <> 0"))):
        publish(some.select(F.col("event_id").cast("string").alias("event_id"), F.concat("event_type", F.lit(f".{run}")).alias("event_type")), TOPIC, path=topic)
    run_fanout(read_topic(spark, topic, max_per_trigger=2), FanOut({"events": table}), work_dir(spark, "ckpt"))
    return table.read(spark).select("event_id", "event_type")


# ---------------------------------------------------------------- engine (U1, J6, T8, K8) and layouts

def _loaded_engine(spark: SparkSession, sf_dir: str):
    """An engine whose lake and metrics are loaded and whose segments are registered."""
    from eventweave.engine import Engine
    eng, events = Engine(spark, work_dir(spark, "engine")), _events(spark, sf_dir)
    eng.lake.write(D.lake_events(events).withColumn("event_date", F.to_date("occurred_at")), 0, "s-load")
    eng.metrics.write(D.event_metrics(events), 0, "s-load")
    eng.register("warehouse.public.event_segments", D.event_segments(events))
    return eng


@register("routed_query", O.with_ctes(O.LAKE_CTE, O.SEGMENTS_CTE) + """
SELECT segment, COUNT(*) AS n, COUNT(DISTINCT event_type) AS types FROM lake JOIN segments USING (event_id)
WHERE segment <> 'standard' GROUP BY segment""")
def routed_query(spark, sf_dir):
    """SQL with named binds over the engine's tables, by workload."""
    return _loaded_engine(spark, sf_dir).query(
        "SELECT segment, COUNT(*) AS n, COUNT(DISTINCT event_type) AS types FROM events JOIN event_segments USING (event_id) "
        "WHERE segment <> :s GROUP BY segment", "lakehouse", {"s": "standard"})


@register("routed_federation", O.three_way("LEFT"))
def routed_federation(spark, sf_dir):
    """J6 through the engine: blank SQL for the federated workload is the default join."""
    return _loaded_engine(spark, sf_dir).query("", "federated")


@register("sync_targets", O.with_ctes(O.LAKE_CTE) + f"""
, q AS (SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT event_id) AS ids FROM lake WHERE occurred_at >= {SINCE_SQL} GROUP BY event_type)
SELECT 'summary' AS target, event_type, n, ids FROM q UNION ALL SELECT 'warehouse', event_type, n, ids FROM q""")
def sync_targets(spark, sf_dir):
    """The loaded summary and warehouse after the same sync ran twice."""
    from eventweave.sinks.tables import read_table
    eng = _loaded_engine(spark, sf_dir)
    for _ in range(2):
        eng.sync(SINCE)
    summary, copy = (read_table(spark, f"{eng.root}/{t}") for t in ("type_summary", "warehouse_events"))
    return (summary.select(F.lit("summary").alias("target"), "event_type", F.col("event_count").alias("n"), F.col("unique_events").alias("ids"))
            .unionByName(copy.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"))
                         .select(F.lit("warehouse").alias("target"), "event_type", "n", "ids")))


_HOT = "CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 13 = 0 THEN NULL ELSE event_id END"


_HOT_BASE = "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_type = 'click' AND value >= 100 THEN 7 WHEN event_type = 'view' THEN -1 ELSE event_id END"


@register("federated_hot_key", f"""
WITH b AS (SELECT {_HOT_BASE} AS k, event_id AS v FROM events),
     r AS (SELECT {_HOT} AS k, event_id AS w FROM events),
     lk AS (SELECT k, COUNT(*) AS n, SUM(v) AS s FROM b WHERE k IS NOT NULL GROUP BY k), rk AS (SELECT k, COUNT(*) AS n, SUM(w) AS s FROM r WHERE k IS NOT NULL GROUP BY k),
     m AS (SELECT SUM(lk.n * rk.n) AS n, SUM(lk.s * rk.n + rk.s * lk.n) AS total FROM lk JOIN rk USING (k)),
     ul AS (SELECT COUNT(*) AS n, SUM(v) AS total FROM b WHERE k IS NULL OR k NOT IN (SELECT k FROM rk)),
     ur AS (SELECT COUNT(*) AS n, SUM(w) AS total FROM r WHERE k IS NULL OR k NOT IN (SELECT k FROM lk))
SELECT j.join_type, CAST(m.n + l * ul.n + r * ur.n AS BIGINT) AS n, CAST(m.n + l * ul.n AS BIGINT) AS base, CAST(m.n + r * ur.n AS BIGINT) AS other,
       CAST(m.total + l * ul.total + r * ur.total AS BIGINT) AS total
FROM m, ul, ur, (VALUES ('LEFT', 1, 0), ('INNER', 0, 0), ('RIGHT', 0, 1), ('FULL', 1, 1)) j(join_type, l, r)""")
def federated_hot_key(spark, sf_dir):
    """J2 over whole tables: one key hot on both sides, one on the base side alone, rows without a
    key, thresholds that trigger the split."""
    events = _events(spark, sf_dir)
    tables = {"t.b": events.selectExpr(f"{_HOT_BASE} AS k", "event_id AS v"), "t.r": events.selectExpr(f"{_HOT} AS k", "event_id AS w")}
    sources = [SourceRef(None, "t", "b", "b", ("v",)), SourceRef(None, "t", "r", "r", ("w",))]
    guard, out = SkewGuard(hot_fraction=0.05, min_rows=10, min_bytes=0, cell_pairs=1_000_000), None
    for how in ("LEFT", "INNER", "RIGHT", "FULL"):
        sums = federate(spark, sources, join_key="k", join_type=how, resolve=lambda s: tables[s.qualified], skew_guard=guard, each_part=_joined_sums)
        row = sums.agg(*[F.sum(c).alias(c) for c in sums.columns]).select(F.lit(how).alias("join_type"), "n", "base", "other", "total")
        out = row if out is None else out.unionByName(row)
    return out


def _joined_sums(joined: DataFrame) -> DataFrame:
    """Counts and sum over the joined rows of one part of the join."""
    return joined.agg(F.count(F.lit(1)).alias("n"), F.count("b_v").alias("base"), F.count("r_w").alias("other"),
                      F.sum(F.coalesce("b_v", F.lit(0)) + F.coalesce("r_w", F.lit(0))).alias("total"))


@register("bucketed_layout", "SELECT user_id, COUNT(*) AS n, MAX(event_id) AS last FROM events GROUP BY user_id")
def bucketed_layout(spark, sf_dir):
    """A bucketed, sorted table; grouping by its key needs no shuffle."""
    import uuid

    from eventweave.sinks.tables import write_bucketed
    name = f"ew_events_{uuid.uuid4().hex[:10]}"
    write_bucketed(_events(spark, sf_dir).select("user_id", "event_id"), name, key="user_id", sort_by=("event_id",), path=work_dir(spark, name))
    return spark.table(name).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


@register("json_safe_values", "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def json_safe_values(spark, sf_dir):
    """Decimals and dates are exported as text and read back as written."""
    from eventweave.sinks.export import export_json
    path = work_dir(spark, "json_safe")
    export_json(D.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_totalprice as decimal(18,2)) AS price", "cast(o_orderdate as date) AS day"), path)
    return spark.read.schema("o_orderkey bigint, price string, day string").json(path)


def upper_type_transform(raw: dict) -> dict:
    """A user transform (T6): upper-case type, no amount (so metrics default to 1)."""
    return {"event_id": raw.get("event_id", raw.get("id")),
            "event_type": str(raw.get("event_type") or "unknown").upper(),
            "customer_id": 2**53 + 1 + raw["customer_id"] if raw["customer_id"] % 2 else None,
            "payload": raw.get("payload", {}),
            "occurred_at": raw["occurred_at"]}


@register("custom_transform", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'UNKNOWN' ELSE upper(event_type) END AS event_type,
       CAST(1 AS BIGINT) AS metric_value, CAST(ts AS DATE) AS event_date,
       CASE WHEN user_id % 2 = 1 THEN 9007199254740993 + user_id END AS customer_id
FROM events""")
def custom_transform(spark, sf_dir):
    """A Python dict->dict transform (Arrow batches), then the metrics projection."""
    from pyspark.sql.types import StructType
    from eventweave.schemas import CANONICAL
    from eventweave.streaming import python_transform
    schema = StructType([f for f in CANONICAL.fields if f.name != "amount"])
    recs = _topic_records(_events(spark, sf_dir))
    canon = python_transform(upper_type_transform, schema)(recs)
    return P.metric_rows(canon.where(F.col(C.STATUS) == C.OK), keep=("customer_id",))


def _damaged_records(events: DataFrame) -> DataFrame:
    """Raw records with damage by rule: id % 17 = 0 truncated text, else % 19 = 0 an array."""
    raw = D.raw_events(events)
    seq = F.col("seq")
    value = (F.when(seq % 17 == 0, F.expr("substring(value, 1, length(value) - 1)"))
             .when(seq % 19 == 0, F.concat(F.lit("["), F.col("value"), F.lit("]")))
             .otherwise(F.col("value")))
    return raw.select("seq", value.alias("value"))


@register("malformed_split", """
SELECT reason, COUNT(*) AS records FROM (
  SELECT CASE WHEN event_id % 17 = 0 THEN 'malformed_json' WHEN event_id % 19 = 0 THEN 'not_object'
              WHEN event_id % 10 = 0 THEN 'missing_event_id' ELSE 'ok' END AS reason FROM events) t
GROUP BY reason""")
def malformed_split(spark, sf_dir):
    """Every record lands in exactly one class; bad ones are quarantined, not raised."""
    tagged = C.lake_normalise(_damaged_records(_events(spark, sf_dir)))
    return tagged.groupBy(F.col(C.STATUS).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


table_queries.register_all(register)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
