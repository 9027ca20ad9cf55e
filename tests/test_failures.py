"""Failures: a retried task and a replayed micro-batch leave every target exact."""

import pytest

from eventweave.operators import projections as P
from eventweave.schemas import EVENTS
from eventweave.sinks.tables import AppendTable, InsertOnceTable, KeyedTable
from eventweave.sources.topics import read_topic
from eventweave.streaming import FanOut, run_fanout
from tests.test_stream import _publish_sample


def _fail_first_attempt(batches):
    from pyspark import TaskContext
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("simulated executor loss")
    yield from batches


def test_upsert_survives_task_retry(spark, tmp_dir):
    rows = [(f"k{i % 50}", f"t{i}", None, None, 0, i) for i in range(400)]
    schema = "event_id string, event_type string, payload string, occurred_at timestamp_ntz, partition int, offset bigint"
    batch = spark.createDataFrame(rows, schema).repartition(4).mapInPandas(_fail_first_attempt, schema)
    tbl = KeyedTable(tmp_dir("retry"), EVENTS, order_cols=("partition", "offset"))
    tbl.write(batch, 0)
    got = sorted((r.event_id, r.event_type) for r in tbl.read(spark).collect())
    want = sorted({f"k{k}": (f"k{k}", f"t{max(i for i in range(400) if i % 50 == k)}") for k in range(50)}.values())
    assert got == want


class _FailOnce:
    """A target that dies the first time it is written (after earlier targets succeeded)."""

    def __init__(self, inner):
        self.inner, self.failed = inner, False

    def write(self, df, batch_id, stream_id="default"):
        if not self.failed:
            self.failed = True
            raise RuntimeError("simulated crash in the middle of a batch")
        return self.inner.write(df, batch_id, stream_id)

    def read(self, spark):
        return self.inner.read(spark)


def test_replayed_batch_leaves_targets_exact(spark, tmp_dir, sample_canonical):
    topic, ckpt = tmp_dir("topic"), tmp_dir("ckpt")
    _publish_sample(spark, topic, 2)
    orders = InsertOnceTable(tmp_dir("o"), order_cols=("partition", "offset"))
    events = KeyedTable(tmp_dir("e"), EVENTS, order_cols=("partition", "offset"))
    metrics = AppendTable(tmp_dir("m"))
    flaky = _FailOnce(metrics)
    with pytest.raises(Exception):
        run_fanout(read_topic(spark, topic), FanOut({"orders": orders, "events": events, "metrics": flaky}), ckpt)
    # orders and events of the failed batch are already written; the restart replays it
    run_fanout(read_topic(spark, topic), FanOut({"orders": orders, "events": events, "metrics": flaky}), ckpt)
    key = lambda df, cols: sorted(tuple(r) for r in df.select(*cols).collect())
    assert key(orders.read(spark), ["event_id", "amount"]) == key(P.orders_rows(sample_canonical), ["event_id", "amount"])
    assert key(events.read(spark), ["event_id", "event_type"]) == key(P.serving_rows(sample_canonical), ["event_id", "event_type"])
    assert key(metrics.read(spark), ["event_id", "metric_value"]) == \
        key(P.metric_rows(sample_canonical), ["event_id", "metric_value"])
