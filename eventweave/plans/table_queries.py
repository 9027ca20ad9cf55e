"""Registered queries over the target tables and streams: snapshots, pruning, compaction, bounded
runs, incremental state, loads, seeds, hooks and guards. Registered beside those of
``plans/registry.py``, each with its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.functions import fields as J
from eventweave.operators import canonical as C
from eventweave.plans import derived as D
from eventweave.plans import oracle as O
from eventweave.schemas import EVENTS, LAKE_BY_DAY, LAKE_EVENTS, ORDERS, TYPE_SUMMARY
from eventweave.session import work_dir
from eventweave.sinks.snapshots import Between
from eventweave.sinks.tables import AppendTable, InsertOnceTable, KeyedTable

SINCE_TS = "2024-01-15 00:00:00"
#: Days at which the driver's month of events is cut into batches.
CUTS = ("2024-01-08", "2024-01-15", "2024-01-22")


def _versions(events: DataFrame, name: str) -> DataFrame:
    """Serving rows of events, their type marked with a version's name."""
    return events.select(F.col("event_id").cast("string").alias("event_id"), F.concat("event_type", F.lit(f".{name}")).alias("event_type"),
                         F.col("props").alias("payload"), F.col("ts").alias("occurred_at"), F.col("event_id").alias("seq"))


def _weeks(events: DataFrame, ts: str = "ts") -> list[DataFrame]:
    """All events, cut at ``CUTS``."""
    bounds = [None, *[F.lit(c).cast("date").cast("timestamp_ntz") for c in CUTS], None]
    return [events.where(((F.col(ts) >= a) if a is not None else F.lit(True)) & ((F.col(ts) < b) if b is not None else F.lit(True)))
            for a, b in zip(bounds, bounds[1:])]


def _lake_rows(events: DataFrame) -> DataFrame:
    return D.lake_events(events).withColumn("event_date", F.to_date("occurred_at"))


def _eighth(table, spark: SparkSession) -> int:
    """File size that cuts a table of any scale into about eight files."""
    return sum(p.size for p in table.snapshot(spark).parts) // 8 + 1


def register_all(register: Callable) -> None:
    """Register every query of this module with the registry's decorator."""
    for name, (oracle, fn) in QUERIES.items():
        register(name, oracle)(fn)


QUERIES: dict[str, tuple[str, Callable[[SparkSession, str], DataFrame]]] = {}


def query(name: str, oracle: str):
    def deco(fn):
        QUERIES[name] = (oracle, fn)
        return fn
    return deco


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---------------------------------------------------------------- snapshots (S3, K3, K5)

@query("snapshot_reads", f"""
WITH late AS (SELECT *, ts >= TIMESTAMP '{SINCE_TS}' AS is_late FROM events)
SELECT 'before' AS seen, CAST(event_id AS VARCHAR) AS event_id, event_type || CASE WHEN is_late THEN '.1' ELSE '.0' END AS event_type FROM late
UNION ALL SELECT 'after', CAST(event_id AS VARCHAR), event_type || CASE WHEN event_type = 'purchase' THEN '.3' WHEN is_late THEN '.2' ELSE '.0' END FROM late
UNION ALL SELECT 'as of', CAST(event_id AS VARCHAR), event_type || CASE WHEN is_late THEN '.1' ELSE '.0' END FROM late""")
def snapshot_reads(spark, sf_dir):
    """S3, K3: a read taken before a batch was replayed with other rows, another batch came and all
    was merged, beside one taken after and one of the old snapshot by its number."""
    events = D.table(spark, sf_dir, "events")
    late = events.where(F.col("ts") >= F.lit(SINCE_TS).cast("timestamp_ntz"))
    table = KeyedTable(work_dir(spark, "snapshots"), EVENTS, order_cols=("seq",))
    table.write(_versions(events, "0"), 0)
    table.write(_versions(late, "1"), 1)
    before, number = table.read(spark), table.snapshot(spark).number
    table.write(_versions(late, "2"), 1)
    table.write(_versions(events.where("event_type = 'purchase'"), "3"), 2)
    table.compact(spark)
    frames = {"before": before, "after": table.read(spark), "as of": table.read(spark, as_of=number)}
    return _all([df.select(F.lit(name).alias("seen"), "event_id", "event_type") for name, df in frames.items()])


@query("pruned_scan", O.with_ctes(O.LAKE_CTE) + f"""
SELECT 'merged' AS layout, event_id, event_type, occurred_at FROM lake WHERE occurred_at >= TIMESTAMP '{SINCE_TS}'
UNION ALL SELECT 'batches', event_id, event_type, occurred_at FROM lake WHERE occurred_at >= TIMESTAMP '{SINCE_TS}'""")
def pruned_scan(spark, sf_dir):
    """A time range of a lake of weekly batches, then of the merged lake: parts and files
    outside the range are not even listed."""
    table = AppendTable(work_dir(spark, "lake"), fanout=100, index_bytes=0)
    weeks = _weeks(D.lake_events(D.table(spark, sf_dir, "events")), "occurred_at")
    for batch_id, rows in enumerate(weeks):
        table.write(rows, batch_id)
    table.file_bytes = _eighth(table, spark)
    where, frames = [Between("occurred_at", SINCE_TS)], {}
    for layout in ("batches", "merged"):
        every, some = table.read(spark), table.read(spark, where)
        if len(some.inputFiles()) >= len(every.inputFiles()):
            raise RuntimeError(f"{layout}: no file was left out")
        frames[layout] = some
        table.compact(spark)
    return _all([df.select(F.lit(name).alias("layout"), "event_id", "event_type", "occurred_at") for name, df in frames.items()])


@query("key_reads", """
WITH k AS (SELECT event_type, CAST(max(event_id) AS VARCHAR) AS event_id FROM events GROUP BY event_type)
SELECT event_id, event_type || '.1' AS event_type FROM k""")
def key_reads(spark, sf_dir):
    """K3: some keys of a merged table; bounds and key filters leave their files alone to be read."""
    events = D.table(spark, sf_dir, "events")
    table = KeyedTable(work_dir(spark, "keys"), EVENTS, order_cols=("seq",), fanout=100, index_bytes=0)
    for batch_id, name in enumerate("01"):
        table.write(_versions(events, name), batch_id)
    table.file_bytes = _eighth(table, spark)
    table.compact(spark)
    keys = [str(r[0]) for r in events.groupBy("event_type").agg(F.max("event_id")).select("max(event_id)").collect()]     # one key a type
    return table.read(spark, keys=keys).select("event_id", "event_type")


@query("levelled_tables", """
WITH t AS (SELECT event_type, rank() OVER (ORDER BY event_type) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT event_type FROM events) d)
SELECT 'keyed' AS target, CAST(event_id AS VARCHAR) AS event_id, event_type || '.2' AS value FROM events
UNION ALL SELECT 'first', CAST(event_id AS VARCHAR), event_type || '.0' FROM events
UNION ALL SELECT 'rejected', CAST(event_id AS VARCHAR), event_type || v FROM events, (VALUES ('.1'), ('.2')) x(v)
UNION ALL SELECT 'appended', CAST(event_id AS VARCHAR), event_type || v FROM events, (VALUES ('.0'), ('.1'), ('.2')) x(v)""")
def levelled_tables(spark, sf_dir):
    """K2-K5: many batches with three versions of every event, merged level by level as they come
    into the keyed, the insert-once and the append table."""
    events = D.table(spark, sf_dir, "events")
    types = sorted(r[0] for r in events.select("event_type").distinct().collect())          # a handful
    keyed = KeyedTable(work_dir(spark, "keyed"), EVENTS, order_cols=("seq",), fanout=3)
    first = InsertOnceTable(work_dir(spark, "first"), order_cols=("seq",), fanout=3)
    appended = AppendTable(work_dir(spark, "appended"), fanout=3)
    batches = [_versions(events.where(F.col("event_type") == t), str(v)) for v in range(3) for t in types]
    for batch_id, rows in enumerate(batches):
        for table in (keyed, first, appended):
            table.write(rows, batch_id)
    for table in (keyed, first, appended):
        if max(p.level for p in table.snapshot(spark).parts) < 1:
            raise RuntimeError(f"{table.path}: nothing was merged")
    frames = {"keyed": keyed.read(spark), "first": first.read(spark), "rejected": first.rejected(spark), "appended": appended.read(spark)}
    return _all([df.select(F.lit(name).alias("target"), "event_id", F.col("event_type").alias("value")) for name, df in frames.items()])


@query("create_if_missing", """
SELECT 'path' AS kind, 5 AS columns, COUNT(*) AS n FROM events WHERE event_id % 10 <> 0
UNION ALL SELECT 'catalog', 3, COUNT(DISTINCT event_type) FROM events
UNION ALL SELECT 'empty', 4, 0""")
def create_if_missing(spark, sf_dir):
    """K6: path and catalog tables made twice, then written; an empty one reads with its schema."""
    import uuid

    from eventweave.operators.summary import type_summary
    from eventweave.sinks.tables import append_to_table, ensure_catalog_table, ensure_path_table, read_table
    events, path, empty = D.table(spark, sf_dir, "events"), work_dir(spark, "lake"), work_dir(spark, "empty")
    name = f"ew_types_{uuid.uuid4().hex[:10]}"
    for _ in range(2):
        ensure_path_table(spark, path, LAKE_BY_DAY)
        ensure_path_table(spark, empty, ORDERS)
        ensure_catalog_table(spark, name, TYPE_SUMMARY, path=work_dir(spark, name))
    AppendTable(path, partition_by=("event_date",)).write(_lake_rows(events), 0)
    append_to_table(type_summary(events.select("event_id", "event_type")), name)
    frames = {"path": read_table(spark, path), "catalog": spark.table(name), "empty": read_table(spark, empty)}
    return _all([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), F.lit(len(df.columns)).alias("columns"), "n") for k, df in frames.items()])


# ---------------------------------------------------------------- syncs and loads

@query("sync_empty", "SELECT CAST(0 AS BIGINT) AS iceberg_rows, CAST(0 AS BIGINT) AS lake_rows, COUNT(*) AS orders, COUNT(*) AS quarantined FROM events")
def sync_empty(spark, sf_dir):
    """Every event lacks the ``event_id`` key (it has ``id``), so the lake refuses all: it is
    empty, can be read, and the sync ends early."""
    from eventweave.engine import Engine
    eng = Engine(spark, work_dir(spark, "engine"))
    raw = D.raw_events(D.table(spark, sf_dir, "events"))
    value = F.regexp_replace("value", '"event_id":', '"id":')
    raw.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("seq").alias("offset"), F.lit(None).cast("string").alias("key"),
               value.alias("value")).write.json(f"{eng.root}/topics/t")
    eng.stream("t")
    stats = eng.sync(SINCE_TS)
    if set(stats) != {"iceberg_rows"}:
        raise RuntimeError(f"no early end: {stats}")
    counts = [t.agg(F.count(F.lit(1)).alias(n)) for n, t in (("lake_rows", eng.lake.read(spark)), ("orders", eng.orders.read(spark)), ("quarantined", eng.quarantine.read(spark)))]
    named = counts[0].select(F.lit(stats["iceberg_rows"]).cast("bigint").alias("iceberg_rows"), "lake_rows")
    for c in counts[1:]:
        named = named.join(c, how="cross")          # one row each
    return named


@query("incremental_distinct", O.with_ctes(O.LAKE_CTE) + """
SELECT 'state' AS how, event_type, 2 * COUNT(*) AS event_count, COUNT(DISTINCT event_id) AS unique_events FROM lake GROUP BY event_type
UNION ALL SELECT 'whole', event_type, 2 * COUNT(*), COUNT(DISTINCT event_id) FROM lake GROUP BY event_type""")
def incremental_distinct(spark, sf_dir):
    """Counts and exact distinct ids kept as state over weekly batches, each event twice;
    every update reads the new batches only. Beside it one pass over everything."""
    from eventweave.operators.summary import type_summary
    from eventweave.plans.incremental import IncrementalSummary
    events = D.table(spark, sf_dir, "events")
    lake = AppendTable(work_dir(spark, "lake"), LAKE_EVENTS, fanout=3, versioned=True)
    state, batch_id = IncrementalSummary(work_dir(spark, "state")), 0
    for rows in _weeks(D.lake_events(events), "occurred_at"):
        for _ in range(2):
            lake.write(rows, batch_id)
            batch_id += 1
        state.update(spark, lake)
    frames = {"state": state.read(spark), "whole": type_summary(lake.read(spark))}
    return _all([df.select(F.lit(k).alias("how"), "event_type", "event_count", "unique_events") for k, df in frames.items()])


@query("catalog_loads", O.with_ctes(O.LAKE_CTE) + f"""
, q AS (SELECT event_type, COUNT(*) AS n FROM lake WHERE occurred_at >= TIMESTAMP '{SINCE_TS}' GROUP BY event_type)
SELECT kind || ' ' || target AS target, event_type, n FROM q, (VALUES ('by run'), ('ledger')) k(kind), (VALUES ('summary'), ('warehouse')) t(target)""")
def catalog_loads(spark, sf_dir):
    """K7, K8: the same sync into catalog tables twice leaves one copy, in tables with a run partition
    and in tables whose runs a ledger remembers."""
    import uuid

    from eventweave.plans.sync import run_incremental
    from eventweave.sinks.tables import ensure_catalog_table
    lake, frames = D.lake_events(D.table(spark, sf_dir, "events")), []
    for kind, by_run in (("by run", True), ("ledger", False)):
        names = {t: f"ew_{t}_{uuid.uuid4().hex[:10]}" for t in ("summary", "warehouse")}
        for t, schema in (("summary", TYPE_SUMMARY), ("warehouse", LAKE_EVENTS)):
            ensure_catalog_table(spark, names[t], schema, path=work_dir(spark, names[t]), by_run=by_run)
        for _ in range(2):
            run_incremental(spark, lake, SINCE_TS, summary_table=names["summary"], warehouse_table=names["warehouse"])
        summary, copy = (spark.table(names[t]) for t in ("summary", "warehouse"))
        frames.append(summary.select(F.lit(f"{kind} summary").alias("target"), "event_type", F.col("event_count").alias("n")))
        frames.append(copy.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{kind} warehouse").alias("target"), "event_type", "n"))
    return _all(frames)


# ---------------------------------------------------------------- streams

def _topic(spark: SparkSession, sf_dir: str) -> str:
    """The raw records as a file topic in offset order."""
    path = work_dir(spark, "topic")
    raw = D.raw_events(D.table(spark, sf_dir, "events"))
    (raw.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("seq").alias("offset"), F.lit(None).cast("string").alias("key"), "value")
     .repartitionByRange(8, "offset").write.json(path))
    return path


@query("bounded_run", """
WITH n AS (SELECT COUNT(*) AS n, (COUNT(*) + 3) // 4 AS cap, MIN(event_id) AS low FROM events),
     r AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // cap AS run FROM events, n)
SELECT CAST(run AS INTEGER) AS run, COUNT(*) AS records, MIN(event_id) AS first, MAX(event_id) AS last, COUNT(*) AS written FROM r GROUP BY run""")
def bounded_run(spark, sf_dir):
    """Four runs of a quarter of the records each; the next one goes on where the last
    one ended, and a fifth finds nothing."""
    from eventweave.streaming import FanOut, run_bounded
    topic, ckpt, table = _topic(spark, sf_dir), work_dir(spark, "ckpt"), AppendTable(work_dir(spark, "metrics"), fanout=100)
    cap = -(-D.table(spark, sf_dir, "events").count() // 4)
    counts = [run_bounded(spark, topic, FanOut({"metrics": table}), ckpt, cap) for _ in range(5)]
    if counts[4]:
        raise RuntimeError(f"a fifth run found records: {counts}")
    head, log = table.snapshot(spark), table.log(spark)
    frames = []
    for part in sorted(head.parts, key=lambda p: p.batch):
        own = log.read_parts([part], head.schema).select(F.col("event_id").cast("bigint").alias("e"))
        frames.append(own.agg(F.min("e").alias("first"), F.max("e").alias("last"), F.count(F.lit(1)).alias("written"))
                      .select(F.lit(part.batch).alias("run"), F.lit(counts[part.batch]).cast("bigint").alias("records"), "first", "last", "written"))
    return _all(frames)


@query("processed_counts", """
SELECT 'stream' AS run, COUNT(*) AS processed FROM events UNION ALL SELECT 'restart', CAST(0 AS BIGINT)
UNION ALL SELECT 'replay', COUNT(*) FROM events UNION ALL SELECT 'ledger', COUNT(*) FROM events""")
def processed_counts(spark, sf_dir):
    """Records of a run, of a restart with nothing new, of a batch given twice, and of the
    checkpoint's ledger."""
    from eventweave.sources.topics import read_topic
    from eventweave.streaming import FanOut, run_fanout
    from eventweave.streaming.ledger import LEDGER, BatchLedger
    topic, ckpt = _topic(spark, sf_dir), work_dir(spark, "ckpt")
    table = AppendTable(work_dir(spark, "metrics"))
    counts = {name: run_fanout(read_topic(spark, topic, max_per_trigger=3), FanOut({"metrics": table}), ckpt) for name in ("stream", "restart")}
    fan, batch = FanOut({"metrics": AppendTable(work_dir(spark, "metrics"))}), read_topic(spark, topic, streaming=False)
    for _ in range(2):
        fan.process(batch, 0)
    counts |= {"replay": fan.processed, "ledger": BatchLedger(spark, f"{ckpt}/{LEDGER}").total()}
    return spark.createDataFrame(list(counts.items()), "run string, processed bigint")


@query("chosen_targets", O.with_ctes(O.CANONICAL_CTE, O.LAKE_CTE) + """
SELECT 'metrics' AS target, COUNT(*) AS n, COUNT(DISTINCT event_id) AS ids FROM canon UNION ALL SELECT 'lake', COUNT(*), COUNT(DISTINCT event_id) FROM lake""")
def chosen_targets(spark, sf_dir):
    """A fan-out with two of its five targets; each is written once a micro-batch."""
    from eventweave.sources.topics import read_topic
    from eventweave.streaming import FanOut, run_fanout
    targets = {"metrics": AppendTable(work_dir(spark, "metrics"), fanout=100), "lake": AppendTable(work_dir(spark, "lake"), partition_by=("event_date",), fanout=100)}
    fan = FanOut(targets)
    run_fanout(read_topic(spark, _topic(spark, sf_dir), max_per_trigger=3), fan, work_dir(spark, "ckpt"))
    if any(len(t.snapshot(spark).parts) != len(fan.batches) for t in targets.values()):
        raise RuntimeError("not one part a batch")
    return _all([t.read(spark).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids")).select(F.lit(name).alias("target"), "n", "ids")
                 for name, t in targets.items()])


@query("record_hook", "SELECT COUNT(*) AS records, CAST(SUM(event_id) AS BIGINT) AS offsets FROM events")
def record_hook(spark, sf_dir):
    """A handler called on the executors for every raw record of the written batches."""
    from eventweave.sources.topics import read_topic
    from eventweave.streaming import FanOut, run_fanout
    records, offsets = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def handler(record):
        records.add(1)
        offsets.add(record.offset)

    run_fanout(read_topic(spark, _topic(spark, sf_dir)), FanOut({"metrics": AppendTable(work_dir(spark, "m"))}, on_record=handler), work_dir(spark, "ckpt"))
    return spark.createDataFrame([(records.value, offsets.value)], "records bigint, offsets bigint")


def _event_arrays(spark: SparkSession, sf_dir: str) -> str:
    """The raw records as files that hold one JSON array each."""
    path = work_dir(spark, "documents")

    def array(batches):
        first = True
        for batch in batches:
            lines = []
            for v in batch.column(0).to_pylist():
                lines.append(("[" if first else ",") + v)
                first = False
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"], pa.string())], names=["value"])

    D.raw_events(D.table(spark, sf_dir, "events")).select("value").mapInArrow(array, "value string").write.text(path)
    return path


@query("json_documents", """
SELECT CAST(event_id AS VARCHAR) AS event_id, (event_id % 7 <> 0) AS has_event_type,
       3 + CAST(event_id % 7 <> 0 AS INT) + CAST(event_id % 5 <> 0 AS INT) + CAST(event_id % 3 <> 0 AS INT) AS n_keys FROM events""")
def json_documents(spark, sf_dir):
    """Files that are one JSON array each, cut into their events by many tasks."""
    from eventweave.sources.files import read_event_files
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    path, out = _event_arrays(spark, sf_dir), work_dir(spark, "elements")
    try:
        spark.conf.set(key, "256k")             # several splits a file at this scale
        read_event_files(spark, path, whole_files=True).where(F.col(C.STATUS) == C.OK).select("value").write.text(out)
    finally:
        spark.conf.set(key, old)
    back = spark.read.text(out).select("value", F.explode(F.array(J.parse(F.col("value")))).alias("_v"))
    v = F.col("_v")
    event_id = F.when(J.has_key(v, "event_id"), J.field(v, "event_id", "string")).otherwise(J.field(v, "id", "string"))
    return back.select(event_id.alias("event_id"), J.has_key(v, "event_type").alias("has_event_type"), F.size(F.json_object_keys("value")).alias("n_keys"))


@query("seed_load", O.with_ctes(O.CANONICAL_CTE) + """
SELECT 'orders' AS target, event_id, CAST(amount AS VARCHAR) AS value FROM canon WHERE event_type LIKE 'purchase%'
UNION ALL SELECT 'events', event_id, event_type FROM canon
UNION ALL SELECT 'event_metrics', event_id, CAST(CAST(TRUNC(amount) AS BIGINT) AS VARCHAR) FROM canon
UNION ALL SELECT 'event_segments', CAST(event_id AS VARCHAR), CASE WHEN value >= 100 THEN 'high_value' WHEN event_type IN ('click', 'view') THEN 'engagement' ELSE 'standard' END
FROM events WHERE event_type <> 'signup'""")
def seed_load(spark, sf_dir):
    """The four serving tables that event files imply; segments come from outside the events."""
    from eventweave.plans.seed import seed_tables
    tables = seed_tables(spark, _event_arrays(spark, sf_dir), segments=D.event_segments(D.table(spark, sf_dir, "events")), lifecycle_prefix="purchase")
    value = {"orders": "amount", "events": "event_type", "event_metrics": "metric_value", "event_segments": "segment"}
    return _all([df.select(F.lit(n).alias("target"), "event_id", F.col(value[n]).cast("string").alias("value")) for n, df in tables.items()])


@query("seed_flow", O.with_ctes(O.CANONICAL_CTE) + """
SELECT event_id, event_type, CAST(TRUNC(amount) AS BIGINT) AS metric_value, (SELECT COUNT(*) FROM events) AS processed FROM canon""")
def seed_flow_run(spark, sf_dir):
    """Event files published to a topic, then drained into the metrics table."""
    from eventweave.plans.seed import seed_flow
    from eventweave.streaming import FanOut
    table = AppendTable(work_dir(spark, "metrics"))
    n = seed_flow(spark, _event_arrays(spark, sf_dir), work_dir(spark, "topic"), FanOut({"metrics": table}), work_dir(spark, "ckpt"))
    return table.read(spark).select("event_id", "event_type", "metric_value", F.lit(n).cast("bigint").alias("processed"))


# ---------------------------------------------------------------- functions and guards

@query("ingest_time", "SELECT event_id AS seq, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS occurred_at FROM events")
def ingest_time(spark, sf_dir):
    """events without ``occurred_at`` get the time they came in, as ISO text in UTC."""
    raw = D.raw_events(D.table(spark, sf_dir, "events"))
    written = F.regexp_extract("value", '"occurred_at":"([^"]*)"', 1)
    bare = raw.withColumn("came", F.to_timestamp(written)).withColumn("value", F.regexp_replace("value", ',"occurred_at":"[^"]*"', ""))
    return C.canonicalise(bare, keep=("seq",), ingest_ts=F.col("came")).select("seq", "occurred_at")


@query("federation_guards", """
SELECT g.guard, TRUE AS refused, (SELECT COUNT(*) FROM events) AS events
FROM (VALUES ('no source'), ('missing key'), ('unknown join type')) g(guard)""")
def federation_guards(spark, sf_dir):
    """A federation without sources, over a table without the key, or with a join type that
    is none, is refused before anything is read."""
    from eventweave.operators.federate import DEFAULT_SOURCES, SourceRef, federate
    events = D.table(spark, sf_dir, "events")
    two = [DEFAULT_SOURCES[0], SourceRef(None, None, "other", "o", ("ts",))]

    def resolve(source):
        return events.select("event_type", "ts") if source.alias == "o" else events.select("event_id", "event_type")

    def refused(**how) -> bool:
        try:
            federate(spark, resolve=resolve, **how)
        except ValueError:
            return True
        return False

    found = {"no source": refused(sources=[]), "missing key": refused(sources=two), "unknown join type": refused(sources=two[:1] * 2, join_type="CROSS")}
    return events.agg(F.count(F.lit(1)).alias("events")).select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("guard"), F.lit(v).alias("refused")) for k, v in found.items()])).alias("g"), "events").select("g.guard", "g.refused", "events")
