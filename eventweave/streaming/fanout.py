"""The real-time fan-out (T1-T7, T9) as one Structured Streaming query.

One source read, one checkpoint, one ``foreachBatch``: each micro-batch is canonicalised
once, persisted, and written to every configured target (orders, serving events, metrics,
lake), then unpersisted. Targets are optional (T3). Offsets are committed to the
checkpoint only after all targets of a batch are written, and every target write replaces
the folder of its (stream, batch) (see ``sinks/tables.py``), so a restart after a failure
neither loses nor doubles rows, and streams that share a target do not touch each other (T5, stronger than auto-commit).

``run_fanout`` drains what is there and stops (``trigger(availableNow=True)``); the cap
per micro-batch is ``max_per_trigger`` (files or offsets). ``run_bounded`` processes at most so many
records and stops; the next run goes on behind them (T1, L2). Both return the number of records
processed (A6): a ledger in the checkpoint holds it for every batch, so a batch that is replayed
after a failure counts once.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import uuid
from collections import deque
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (DecimalType, IntegerType, LongType, StringType, StructType,
                               TimestampNTZType, TimestampType)

from eventweave.functions import fields as J
from eventweave.operators import canonical as C
from eventweave.operators import projections as P
from eventweave.schemas import CANONICAL
from eventweave.sinks.snapshots import folder_exists
from eventweave.sources.topics import read_slice
from eventweave.streaming.ledger import LEDGER, PLANS, BatchLedger, RunPlans

ORDER_COLS = ("partition", "offset")

Transform = Callable[[DataFrame], DataFrame]


def default_transform(records: DataFrame) -> DataFrame:
    """P1 over topic records, keeping (partition, offset) and the bookkeeping status."""
    return C.canonicalise(records, "value", keep=ORDER_COLS, with_status=True, lake_fields=True)


def _cast(value, dtype):
    """A JSON value as the Python value of a Spark type; raises if it does not fit."""
    if value is None:
        return None
    if isinstance(dtype, StringType):
        return value if isinstance(value, str) else json.dumps(value)
    if isinstance(dtype, DecimalType):
        return decimal.Decimal(str(value)).quantize(decimal.Decimal(1).scaleb(-dtype.scale))
    if isinstance(dtype, (LongType, IntegerType)):
        if isinstance(value, float) and not value.is_integer():
            raise ValueError(f"{value!r} is not a whole number")
        return int(value)
    if isinstance(dtype, (TimestampType, TimestampNTZType)) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value


def python_transform(fn: Callable[[dict], dict], schema: StructType = CANONICAL) -> Transform:
    """T6 for row callables: ``fn(raw dict) -> canonical dict`` run in Arrow batches.

    Each task parses its records with ``json.loads`` and applies ``fn``; output columns are
    the fields of ``schema`` (a column ``fn`` never returns may be left out of ``schema``;
    projections then apply their defaults) and are built with the schema's types, so large
    integers and missing values stay exact. Malformed records get a ``_status``, and so do
    values that do not fit their column (``bad_<column>``); an error inside ``fn`` is the
    caller's and fails the task.
    """
    fields = list(schema.fields)
    out_schema = StructType(fields + list(StructType.fromDDL("partition INT, offset BIGINT, _status STRING, _raw STRING").fields))

    def parse(text) -> tuple[object, str]:
        try:
            raw = json.loads(text)
        except (TypeError, ValueError):
            return None, C.MALFORMED
        return (raw, C.OK) if isinstance(raw, dict) else (None, C.NOT_OBJECT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_schema)
        for batch in batches:
            texts = batch.column("value").to_pylist()
            columns: dict[str, list] = {f.name: [] for f in fields}
            statuses = []
            for text in texts:
                raw, status = parse(text)
                out = fn(raw) if status == C.OK else {}
                for f in fields:
                    try:
                        value = _cast(out.get(f.name), f.dataType)
                    except (TypeError, ValueError, ArithmeticError):
                        value, status = None, f"bad_{f.name}"
                    columns[f.name].append(value)
                statuses.append(status)
            own = {**columns, "partition": batch.column("partition"), "offset": batch.column("offset"), "_status": statuses, "_raw": texts}
            yield pa.RecordBatch.from_arrays([c if isinstance(c := own[f.name], pa.Array) else pa.array(c, type=f.type) for f in arrow], schema=arrow)

    def transform(records: DataFrame) -> DataFrame:
        src = records
        for c, typ in (("partition", "int"), ("offset", "bigint")):
            if c not in src.columns:
                src = src.withColumn(c, F.lit(None).cast(typ))
        return src.select("partition", "offset", "value").mapInArrow(run, out_schema)

    return transform


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns ``checkpoint``: made once and kept in it, so a restart
    is the same stream and a new checkpoint is another one."""
    path = f"{checkpoint}/eventweave_stream"
    if folder_exists(spark, f"{path}/_SUCCESS"):
        return spark.read.text(path).first()[0]
    name = f"s-{uuid.uuid4().hex[:16]}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return name


@dataclass
class FanOut:
    """Targets by role: ``orders`` (InsertOnceTable), ``events`` (KeyedTable),
    ``metrics`` and ``lake`` (AppendTable), ``quarantine`` (AppendTable); all optional.

    The quarantine receives every record some target refused: text that is not a JSON
    object, values that do not fit their column, for the keyed targets a null ``event_id``, for
    the lake a missing ``event_id`` key (P10), and for orders (D3), if it would take the event,
    a null ``customer_id``; such rows still reach the targets that accept them.
    """

    targets: Mapping[str, object]
    transform: Transform = default_transform
    lifecycle_prefix: str | None = None
    require_customer: bool = True      # D3: orders rows without customer_id go to quarantine
    on_batch: Callable[[DataFrame, int], None] | None = None
    on_record: Callable[[object], None] | None = None   # T7: called per raw record, on executors
    parallel_writes: bool = True       # submit the independent target writes side by side
    stream_id: str | None = None       # set from the checkpoint when the stream starts
    ledger: BatchLedger | None = None  # set from the checkpoint when the stream starts
    batches: deque = field(default_factory=lambda: deque(maxlen=1000))     # the latest statistics
    _before: int = 0                   # records of earlier batches
    _last: tuple[int, int] = (-1, 0)   # the latest batch and its records

    @property
    def processed(self) -> int:
        """Records of all batches; a batch that came twice counts once."""
        return self._before + self._last[1]

    def shapes(self, canonical: DataFrame) -> dict[str, DataFrame]:
        # The lake takes the P5 shape: an event_id key of its own, the payload or {}.
        payload = next((c for c in (C.LAKE_PAYLOAD, "payload") if c in canonical.columns), None)
        named = F.col(C.HAS_EVENT_ID) if C.HAS_EVENT_ID in canonical.columns else F.lit(True)
        out = {
            "orders": P.orders_rows(canonical, lifecycle_prefix=self.lifecycle_prefix, keep=ORDER_COLS),
            "events": P.serving_rows(canonical, keep=ORDER_COLS),
            "metrics": P.metric_rows(canonical),
            # Lake rows carry their UTC day: partition the lake target by ``event_date`` and
            # the incremental sync prunes whole days.
            "lake": canonical.where(named).select(
                "event_id", "event_type", J.iso_to_ts(F.col(C.LAKE_TIME) if C.LAKE_TIME in canonical.columns else F.col("occurred_at")).alias("occurred_at"),
                (F.col(payload) if payload else F.lit("{}")).alias("payload")).withColumn("event_date", F.to_date("occurred_at")),
        }
        return out

    def _write_all(self, writes: dict, batch_id: int) -> dict[str, object]:
        """Write every target; independent jobs over the cached batch, submitted from
        parallel driver threads so small jobs overlap. Any failure fails the batch, which
        is then replayed; every write is a partition replacement, so that is safe."""
        stream = self.stream_id or "default"
        if not self.parallel_writes or len(writes) < 2:
            return {role: t.write(df, batch_id, stream) for role, (t, df) in writes.items()}
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(writes)) as pool:
            futures = {role: pool.submit(t.write, df, batch_id, stream) for role, (t, df) in writes.items()}
            return {role: f.result() for role, f in futures.items()}

    def process(self, batch: DataFrame, batch_id: int) -> None:
        raw = batch.persist() if self.on_record is not None else batch       # the source is read once
        tagged = self.transform(raw).persist()
        try:
            keyed_targets = any(r in self.targets for r in ("orders", "events"))
            check_customer = (self.require_customer and "orders" in self.targets
                              and "customer_id" in tagged.columns)
            no_customer = F.col("customer_id").isNull() if check_customer else F.lit(False)
            if check_customer and self.lifecycle_prefix:
                no_customer = no_customer & F.coalesce(F.startswith(F.col("event_type"), F.lit(self.lifecycle_prefix)), F.lit(False))
            no_key = F.col("event_id").isNull() if keyed_targets else F.lit(False)
            no_name = ~F.col(C.HAS_EVENT_ID) if "lake" in self.targets and C.HAS_EVENT_ID in tagged.columns else F.lit(False)
            # One pass over the cached batch: record count per class (a handful of groups),
            # which also tells whether anything needs quarantining.
            refused = no_key | no_name | no_customer
            classes = {(r[0], r[1]): r[2] for r in tagged.groupBy(F.col(C.STATUS), refused.alias("_refused")).count().collect()}
            n = sum(classes.values())
            rejects = sum(v for (st, no), v in classes.items() if st != C.OK or no)
            good = tagged.where(F.col(C.STATUS) == C.OK).drop(C.STATUS, "_raw")
            shapes = self.shapes(good)
            # D3 and keyed targets: rows the store would refuse are quarantined instead.
            shapes["orders"] = shapes["orders"].where(~no_key & ~no_customer)
            shapes["events"] = shapes["events"].where(~no_key)
            stats: dict[str, object] = {"batch_id": batch_id, "records": n, "rejects": rejects}
            writes = {role: (self.targets[role], shapes[role])
                      for role in ("orders", "events", "metrics", "lake") if self.targets.get(role) is not None}
            quarantine = self.targets.get("quarantine")
            if quarantine is not None and rejects:
                reason = (F.when(F.col(C.STATUS) != C.OK, F.col(C.STATUS))
                          .when(no_name, F.lit(C.MISSING_EVENT_ID)).when(no_key, F.lit("null_event_id"))
                          .otherwise(F.lit("missing_customer_id")))
                bad = tagged.where((F.col(C.STATUS) != C.OK) | refused).select(
                    reason.alias("reason"), F.col("_raw").alias("raw"))
                writes["quarantine"] = (quarantine, bad)
            stats.update(self._write_all(writes, batch_id))
            if self.on_record is not None:
                raw.foreach(self.on_record)     # Row(topic, partition, offset, key, value) of a batch whose targets are written
            if self.on_batch is not None:
                self.on_batch(good, batch_id)
            if self.ledger is not None:
                self.ledger.record(batch_id, n)
            if batch_id != self._last[0]:
                self._before += self._last[1]
            self._last = (batch_id, n)
            self.batches.append(stats)
        finally:
            tagged.unpersist()
            if raw is not batch or self.on_record is not None:
                raw.unpersist()


def start_fanout(source: DataFrame, fanout: FanOut, checkpoint: str, *,
                 available_now: bool = False, processing_time: str | None = None,
                 query_name: str | None = None):
    """Start the fan-out and return the ``StreamingQuery`` (continuous runs: a
    processing-time trigger, or Spark's default of one micro-batch after another)."""
    spark = source.sparkSession
    if folder_exists(spark, f"{checkpoint}/{PLANS}"):
        raise ValueError(f"{checkpoint} belongs to bounded runs; a stream needs a checkpoint of its own")
    fanout.stream_id = fanout.stream_id or stream_identity(spark, checkpoint)
    fanout.ledger = fanout.ledger or BatchLedger(spark, f"{checkpoint}/{LEDGER}")
    writer = source.writeStream.foreachBatch(fanout.process).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_fanout(source: DataFrame, fanout: FanOut, checkpoint: str, *,
               query_name: str | None = None) -> int:
    """Drain what the source holds (``availableNow``), stop, return the record count."""
    ledger = BatchLedger(source.sparkSession, f"{checkpoint}/{LEDGER}")
    before = ledger.total()
    query = start_fanout(source, fanout, checkpoint, available_now=True, query_name=query_name)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return ledger.total() - before


def run_bounded(spark: SparkSession, topic: str, fanout: FanOut, checkpoint: str, limit: int, *,
                fmt: str = "json", options: Mapping[str, str] | None = None) -> int:
    """Process the next ``limit`` records of a topic (fewer if there are fewer), stop,
    return their number; the next run goes on behind them.

    A run is planned before it starts: the ``limit`` smallest offsets beyond those of the last run
    give an end offset for every partition, which the checkpoint keeps. A run that failed is done
    again with the same ends and the same batch number, so targets stay exact.
    """
    if limit < 1:
        raise ValueError("a run takes at least one record")
    if folder_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{checkpoint} belongs to a stream; bounded runs need a checkpoint of their own")
    plans = RunPlans(spark, f"{checkpoint}/{PLANS}")
    plan = plans.open()
    if plan is None:
        after = plans.ends()
        ahead = read_slice(spark, topic, fmt=fmt, after=after, options=options)
        chosen = ahead.select("topic", "partition", "offset").orderBy("offset", "partition", "topic").limit(limit)
        ends = chosen.groupBy("topic", "partition").agg(F.max("offset").alias("end")).collect()         # a row a partition
        if not ends:
            return 0
        plan = plans.add(after, {**after, **{(r["topic"], r["partition"]): r["end"] for r in ends}})
    fanout.stream_id = fanout.stream_id or stream_identity(spark, checkpoint)
    fanout.ledger = fanout.ledger or BatchLedger(spark, f"{checkpoint}/{LEDGER}")
    fanout.process(read_slice(spark, topic, fmt=fmt, after=plan.after, until=plan.until, options=options), plan.number)
    plans.close(plan)
    return fanout.ledger.records(plan.number)
