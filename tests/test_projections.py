"""P2-P4, P8 and the golden values of the 25 demo events."""

from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from eventweave.operators import projections as P


def test_type_counts(sample_canonical):
    counts = Counter(r.event_type for r in sample_canonical.collect())
    assert counts == {"order.placed": 10, "order.shipped": 4, "order.delivered": 3, "click": 4, "page.view": 4}
    assert sample_canonical.select("customer_id").distinct().count() == 10


def test_metrics_truncate_and_written_day(sample_canonical):
    m = P.metric_rows(sample_canonical)
    assert m.agg(F.sum("metric_value")).first()[0] == 7157
    rows = {r.event_id: r for r in m.collect()}
    assert rows["evt-001"].metric_value == 249          # 249.99 truncates
    assert rows["evt-003"].metric_value == 89           # 89.50 truncates
    assert str(rows["evt-018"].event_date) == "2026-05-27"


def test_orders_lifecycle_only(sample_canonical):
    all_orders = P.orders_rows(sample_canonical)
    assert all_orders.count() == 25                      # the code writes every event (D1)
    lifecycle = P.orders_rows(sample_canonical, lifecycle_prefix="order.")
    assert lifecycle.count() == 17
    assert lifecycle.agg(F.sum("amount")).first()[0] == Decimal("7156.19")
    assert str(lifecycle.where("event_id = 'evt-001'").first().created_at) == "2026-05-25 10:00:00"


def test_serving_payload_is_whole_record_when_absent(sample_canonical):
    import json
    row = P.serving_rows(sample_canonical).where("event_id = 'evt-004'").first()
    assert json.loads(row.payload)["event_type"] == "click"


def test_custom_transform_defaults(spark):
    canon = spark.createDataFrame([("a", "x", "2026-05-25T23:30:00-05:00")], "event_id string, event_type string, occurred_at string")
    assert P.orders_rows(canon).first().amount == Decimal("0.00")      # no amount column -> 0
    m = P.metric_rows(canon).first()
    assert m.metric_value == 1                                          # no amount column -> 1 (D4)
    assert str(m.event_date) == "2026-05-25"                            # written day, not UTC day
    assert P.serving_rows(canon).first().payload == "{}"
