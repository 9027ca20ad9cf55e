"""The fan-out stream equals the batch result, survives restart, skips targets."""

import pytest
from pyspark.sql import functions as F

from eventweave.operators import projections as P
from eventweave.schemas import EVENTS, QUARANTINE
from eventweave.sinks import export as X
from eventweave.sinks.tables import AppendTable, InsertOnceTable, KeyedTable
from eventweave.sources.topics import read_topic
from eventweave.streaming import FanOut, python_transform, run_fanout
from tests.fixtures import sample_lines


def _publish_sample(spark, path, files, extra=()):
    """S1 -> K1 (T9): the demo events published to a file topic in ``files`` files."""
    lines = sample_lines() + list(extra)
    rows = [(i % files, i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "partition int, offset bigint, value string")
    recs = df.select(F.lit("events.raw").alias("topic"), "partition", "offset",
                     F.get_json_object("value", "$.event_id").alias("key"), "value")
    recs.repartition(files, "partition").write.mode("overwrite").json(path)


def _targets(tmp_dir):
    return {"orders": InsertOnceTable(tmp_dir("o"), order_cols=("partition", "offset")),
            "events": KeyedTable(tmp_dir("e"), EVENTS, order_cols=("partition", "offset")),
            "metrics": AppendTable(tmp_dir("m")), "lake": AppendTable(tmp_dir("l"), partition_by=("event_date",)),
            "quarantine": AppendTable(tmp_dir("q"))}


@pytest.mark.parametrize("files,per_trigger", [(1, 1), (4, 2), (5, 1)])
def test_fanout_equals_batch(spark, tmp_dir, sample_canonical, files, per_trigger):
    topic = tmp_dir("topic")
    _publish_sample(spark, topic, files, extra=["{bad"])
    targets = _targets(tmp_dir)
    fan = FanOut(targets)
    n = run_fanout(read_topic(spark, topic, max_per_trigger=per_trigger), fan, tmp_dir("ckpt"))
    assert n == 26                                     # every record counted, the bad one too
    assert len(fan.batches) >= -(-files // per_trigger)
    key = lambda df, cols: sorted(tuple(r) for r in df.select(*cols).collect())
    assert key(targets["metrics"].read(spark), ["event_id", "metric_value", "event_date"]) == \
        key(P.metric_rows(sample_canonical), ["event_id", "metric_value", "event_date"])
    assert key(targets["orders"].read(spark), ["event_id", "amount", "created_at"]) == \
        key(P.orders_rows(sample_canonical), ["event_id", "amount", "created_at"])
    assert key(targets["events"].read(spark), ["event_id", "event_type", "occurred_at"]) == \
        key(P.serving_rows(sample_canonical), ["event_id", "event_type", "occurred_at"])
    assert targets["lake"].read(spark).count() == 25
    assert [r.reason for r in targets["quarantine"].read(spark).collect()] == ["malformed_json"]


def test_restart_adds_nothing(spark, tmp_dir):
    topic, ckpt = tmp_dir("topic"), tmp_dir("ckpt")
    _publish_sample(spark, topic, 3)
    targets = _targets(tmp_dir)
    assert run_fanout(read_topic(spark, topic, max_per_trigger=1), FanOut(targets), ckpt) == 25
    again = FanOut(targets)
    assert run_fanout(read_topic(spark, topic, max_per_trigger=1), again, ckpt) == 0
    assert not again.batches
    assert targets["metrics"].read(spark).count() == 25
    assert targets["orders"].read(spark).count() == 25


def test_optional_targets_and_hook(spark, tmp_dir):
    topic = tmp_dir("topic")
    _publish_sample(spark, topic, 2)
    seen = []
    metrics = AppendTable(tmp_dir("m"))
    fan = FanOut({"metrics": metrics}, on_batch=lambda df, bid: seen.append((bid, df.count())),
                 lifecycle_prefix="order.")
    assert run_fanout(read_topic(spark, topic), fan, tmp_dir("ckpt")) == 25
    assert sum(n for _b, n in seen) == 25
    assert metrics.read(spark).agg(F.sum("metric_value")).first()[0] == 7157


def test_lifecycle_orders_in_stream(spark, tmp_dir):
    topic = tmp_dir("topic")
    _publish_sample(spark, topic, 2)
    orders = InsertOnceTable(tmp_dir("o"), order_cols=("partition", "offset"))
    run_fanout(read_topic(spark, topic), FanOut({"orders": orders}, lifecycle_prefix="order."), tmp_dir("ckpt"))
    assert orders.read(spark).count() == 17


def test_python_transform_hook(spark, tmp_dir):
    topic = tmp_dir("topic")
    _publish_sample(spark, topic, 2, extra=["[1]"])

    def transform(raw):
        return {"event_id": raw.get("event_id"), "event_type": raw.get("event_type", "?").upper(),
                "occurred_at": raw["occurred_at"]}

    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("event_id string, event_type string, occurred_at string")
    metrics, q = AppendTable(tmp_dir("m")), AppendTable(tmp_dir("q"))
    fan = FanOut({"metrics": metrics, "quarantine": q}, transform=python_transform(transform, schema))
    assert run_fanout(read_topic(spark, topic), fan, tmp_dir("ckpt")) == 26
    m = metrics.read(spark)
    assert m.agg(F.sum("metric_value")).first()[0] == 25        # no amount -> 1 per event (D4)
    assert m.where("event_type = 'ORDER.PLACED'").count() == 10
    assert q.read(spark).first().reason == "not_object"


def test_publish_then_topic_batch_read(spark, tmp_dir, sample_canonical):
    path = tmp_dir("canon_topic")
    X.publish(sample_canonical.drop("partition", "offset"), "events.canonical", path=path)
    back = read_topic(spark, path, streaming=False)
    assert back.count() == 25 and back.where("key IS NULL").count() == 0


def test_orders_without_customer_go_to_quarantine(spark, tmp_dir):
    topic = tmp_dir("topic")
    _publish_sample(spark, topic, 1, extra=['{"event_id":"nc","event_type":"order.placed"}',
                                            '{"event_id":null,"customer_id":5}'])
    orders, events, q = (InsertOnceTable(tmp_dir("o"), order_cols=("partition", "offset")),
                         KeyedTable(tmp_dir("e"), EVENTS, order_cols=("partition", "offset")), AppendTable(tmp_dir("q")))
    metrics = AppendTable(tmp_dir("m"))
    fan = FanOut({"orders": orders, "events": events, "metrics": metrics, "quarantine": q})
    assert run_fanout(read_topic(spark, topic), fan, tmp_dir("ckpt")) == 27
    assert orders.read(spark).count() == 25 and events.read(spark).count() == 26
    assert metrics.read(spark).count() == 27                      # metrics need no key
    assert sorted(r.reason for r in q.read(spark).collect()) == ["missing_customer_id", "null_event_id"]
    assert sum(b["rejects"] for b in fan.batches) == 2


def test_seed_flow_and_seed_tables(spark, tmp_dir):
    from eventweave.plans.seed import seed_flow, seed_tables
    files = tmp_dir("file")
    doc = "[\n" + ",\n".join(sample_lines()) + "\n]"
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(files)
    tables = seed_tables(spark, files)
    assert tables["orders"].count() == 17 and tables["events"].count() == 25
    assert tables["event_metrics"].agg(F.sum("metric_value")).first()[0] == 7157
    metrics = AppendTable(tmp_dir("m"))
    assert seed_flow(spark, files, tmp_dir("topic"), FanOut({"metrics": metrics}), tmp_dir("ckpt")) == 25
    assert metrics.read(spark).count() == 25


def test_continuous_fanout_picks_up_new_files(spark, tmp_dir):
    from eventweave.streaming import start_fanout
    topic = tmp_dir("topic")
    _publish_sample(spark, topic, 1)
    metrics = AppendTable(tmp_dir("m"))
    fan = FanOut({"metrics": metrics})
    query = start_fanout(read_topic(spark, topic), fan, tmp_dir("ckpt"), processing_time="1 second")
    try:
        query.processAllAvailable()
        assert fan.processed == 25
    finally:
        query.stop()


def test_keyed_targets_together_equal_separate_runs(spark, tmp_dir):
    """Duplicate keys, a first version that is not an order, a missing customer."""
    lines = ['{"event_id":"a","event_type":"click","customer_id":1,"amount":1}',
             '{"event_id":"a","event_type":"order.placed","customer_id":1,"amount":2}',
             '{"event_id":"a","event_type":"order.shipped","customer_id":1,"amount":3}',
             '{"event_id":"b","event_type":"order.placed","amount":4}',
             '{"event_id":"b","event_type":"order.placed","customer_id":2,"amount":5}',
             '{"event_id":"c","event_type":"view","customer_id":3}',
             '{"event_id":"c","event_type":"view","customer_id":3,"amount":6}']
    rows = [(0, i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "partition int, offset bigint, value string")
    topic = tmp_dir("topic")
    df.select(F.lit("t").alias("topic"), "partition", "offset", F.lit(None).cast("string").alias("key"),
              "value").coalesce(1).write.json(topic)

    def run(targets):
        run_fanout(read_topic(spark, topic), FanOut(targets, lifecycle_prefix="order."), tmp_dir("ckpt"))

    together = {"orders": InsertOnceTable(tmp_dir("o"), order_cols=("partition", "offset")),
             "events": KeyedTable(tmp_dir("e"), EVENTS, order_cols=("partition", "offset"))}
    run(together)
    alone_o = InsertOnceTable(tmp_dir("o2"), order_cols=("partition", "offset"))
    alone_e = KeyedTable(tmp_dir("e2"), EVENTS, order_cols=("partition", "offset"))
    run({"orders": alone_o})
    run({"events": alone_e})
    rows_of = lambda t, cols: sorted(tuple(r) for r in t.read(spark).select(*cols).collect())
    assert rows_of(together["orders"], ["event_id", "customer_id", "amount"]) == \
        rows_of(alone_o, ["event_id", "customer_id", "amount"]) == [("a", 1, 2), ("b", 2, 5)]
    assert rows_of(together["events"], ["event_id", "event_type"]) == rows_of(alone_e, ["event_id", "event_type"]) == \
        [("a", "order.shipped"), ("b", "order.placed"), ("c", "view")]


def test_per_record_handler(spark, tmp_dir):
    topic = tmp_dir("topic")
    _publish_sample(spark, topic, 2)
    seen = spark.sparkContext.accumulator(0)

    def handler(record):
        if record.value.startswith("{"):
            seen.add(1)

    fan = FanOut({"metrics": AppendTable(tmp_dir("m"))}, on_record=handler)
    assert run_fanout(read_topic(spark, topic), fan, tmp_dir("ckpt")) == 25
    assert seen.value == 25


def test_two_topics_into_the_same_targets(spark, tmp_dir):
    """Each checkpoint is a stream of its own; a topic drained again under a new one adds metrics and lake rows, not keys."""
    targets, one, two = _targets(tmp_dir), tmp_dir("t1"), tmp_dir("t2")
    _publish_sample(spark, one, 2)
    _publish_sample(spark, two, 1, extra=['{"event_id":"new","customer_id":1,"occurred_at":"2026-05-25T00:00:00Z"}'])
    run_fanout(read_topic(spark, one), FanOut(targets), tmp_dir("c1"))
    run_fanout(read_topic(spark, two), FanOut(targets), tmp_dir("c2"))
    assert targets["metrics"].read(spark).count() == 51 and targets["lake"].read(spark).count() == 51
    assert targets["orders"].read(spark).count() == 26 and targets["events"].read(spark).count() == 26
    assert targets["orders"].rejected(spark).count() == 25


def test_values_that_do_not_fit_and_lake_shape(spark, tmp_dir):
    topic, targets = tmp_dir("topic"), _targets(tmp_dir)
    extra = ['{"event_id":"x1","customer_id":1,"amount":"abc"}', '{"event_id":"x2","customer_id":1,"occurred_at":"garbage"}',
             '{"event_id":"x3","customer_id":"?"}', '{"id":"x4","customer_id":1,"occurred_at":"2026-05-25T00:00:00Z"}',
             '{"event_id":"x5","event_id":"x6","customer_id":1,"amount":null,"occurred_at":"2026-05-25T00:00:00Z"}']
    _publish_sample(spark, topic, 1, extra=extra)
    run_fanout(read_topic(spark, topic), FanOut(targets), tmp_dir("ckpt"))
    assert sorted(r.reason for r in targets["quarantine"].read(spark).collect()) == \
        ["bad_amount", "bad_customer_id", "bad_occurred_at", "missing_event_id"]
    assert {r.event_id for r in targets["orders"].read(spark).collect()} >= {"x4", "x6"}
    lake = {r.event_id: r.payload for r in targets["lake"].read(spark).collect()}
    assert "x4" not in lake and lake["x6"] == "{}" and len(lake) == 26


def test_lifecycle_orders_quarantine_only_what_orders_want(spark, tmp_dir):
    topic, q = tmp_dir("topic"), AppendTable(tmp_dir("q"), QUARANTINE)
    _publish_sample(spark, topic, 1, extra=['{"event_id":"v","event_type":"view"}', '{"event_id":"w","event_type":"order.x"}'])
    orders = InsertOnceTable(tmp_dir("o"), order_cols=("partition", "offset"))
    run_fanout(read_topic(spark, topic), FanOut({"orders": orders, "quarantine": q}, lifecycle_prefix="order."), tmp_dir("ckpt"))
    assert [(r.reason, "order.x" in r.raw) for r in q.read(spark).collect()] == [("missing_customer_id", True)]


def test_python_transform_keeps_large_integers_and_raises_user_errors(spark):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("event_id string, customer_id bigint, amount decimal(18,2)")
    rows = [(0, 0, '{"event_id":"a","customer_id":9007199254740993,"amount":1.5}'), (0, 1, '{"event_id":"b"}'), (0, 2, '{"event_id":"c","customer_id":"no"}')]
    df = spark.createDataFrame(rows, "partition int, offset bigint, value string")
    got = {r.event_id: (r.customer_id, None if r.amount is None else float(r.amount), r._status) for r in python_transform(lambda r: r, schema)(df).collect()}
    assert got == {"a": (9007199254740993, 1.5, "ok"), "b": (None, None, "ok"), "c": (None, None, "bad_customer_id")}

    def broken(raw):
        raise ValueError("my own error")
    with pytest.raises(Exception, match="my own error"):
        python_transform(broken, schema)(df).collect()
