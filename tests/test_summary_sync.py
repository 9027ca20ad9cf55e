"""Since filter, per-type summary, run statistics, golden bounds."""

import pytest
from pyspark.sql import functions as F

from eventweave.operators import canonical as C
from eventweave.operators.summary import run_stats, type_summary
from eventweave.plans.sync import run_incremental
from eventweave.sinks.tables import read_table
from tests.conftest import plan_text

GOLDEN = [
    ("2026-05-25T00:00:00Z", 25, {"order.placed": 10, "order.shipped": 4, "order.delivered": 3, "click": 4, "page.view": 4}),
    ("2026-05-25T12:00:00Z", 15, {"order.placed": 5, "order.shipped": 3, "order.delivered": 3, "click": 2, "page.view": 2}),
    ("2026-05-26T00:00:00Z", 5, {"order.shipped": 2, "order.delivered": 3}),
]


@pytest.fixture
def lake(sample_raw):
    tagged = C.lake_normalise(sample_raw)
    return tagged.where(F.col(C.STATUS) == C.OK).select(*C.LAKE_COLUMNS)


@pytest.mark.parametrize("since,rows,types", GOLDEN)
def test_golden_bounds(lake, since, rows, types):
    summary = {r.event_type: (r.event_count, r.unique_events) for r in type_summary(lake, since).collect()}
    assert {k: v[0] for k, v in summary.items()} == types
    assert all(c == u for c, u in summary.values())
    st = run_stats(type_summary(lake, since)).first()
    assert (st.iceberg_rows, st.aggregate_groups) == (rows, len(types))


def test_bound_is_inclusive(lake):
    # evt-014 sits exactly on 12:00 and is counted
    s = {r.event_type: r.event_count for r in type_summary(lake, "2026-05-25T12:00:00Z").collect()}
    assert s["click"] == 2


def test_distinct_ignores_nulls_and_duplicates(spark):
    df = spark.createDataFrame([("a", "t", "2026-01-01 00:00:00"), ("a", "t", "2026-01-01 00:00:00"),
                                (None, "t", "2026-01-01 00:00:00")],
                               "event_id string, event_type string, occurred_at string") \
        .withColumn("occurred_at", F.col("occurred_at").cast("timestamp_ntz"))
    r = type_summary(df, "2025-12-31T00:00:00Z").first()
    assert (r.event_count, r.unique_events) == (3, 1)


def test_filter_is_pushed_into_parquet_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnRenamed("ts", "occurred_at")
    plan = plan_text(type_summary(df, "2024-01-15T00:00:00Z"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-15T00:00)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_run_incremental_loads_and_early_exit(spark, lake, tmp_dir):
    summary_path, wh = tmp_dir("summary"), tmp_dir("wh")
    stats = run_incremental(spark, lake, "2026-05-25T12:00:00Z", summary_path=summary_path,
                            warehouse_path=wh, run_id="r1")
    assert stats == {"iceberg_rows": 15, "aggregate_groups": 5, "starrocks_loaded": 5, "redshift_copy": 1}
    assert read_table(spark, wh).count() == 15
    run_incremental(spark, lake, "2026-05-25T12:00:00Z", summary_path=summary_path, warehouse_path=wh, run_id="r1")
    assert read_table(spark, wh).count() == 15             # the run replaces its own rows
    # a re-run with the same run id replaces its summary rows
    run_incremental(spark, lake, "2026-05-25T12:00:00Z", summary_path=summary_path, run_id="r1")
    assert read_table(spark, summary_path).count() == 5
    assert run_incremental(spark, lake, "2026-06-01T00:00:00Z", summary_path=summary_path) == {"iceberg_rows": 0}


def test_date_layout_prunes_partitions(spark, lake, tmp_dir):
    from eventweave.sinks.tables import AppendTable
    table = AppendTable(tmp_dir("lake_by_day"), partition_by=("event_date",))
    table.write(lake.withColumn("event_date", F.to_date("occurred_at")), 0)
    df = table.read(spark)
    plan = plan_text(type_summary(df, "2026-05-26T00:00:00Z", date_col="event_date"))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "(event_date#" in plan
    got = {r.event_type: r.event_count for r in type_summary(df, "2026-05-26T00:00:00Z", date_col="event_date").collect()}
    assert got == GOLDEN[2][2]


def test_written_day_does_not_hide_rows(spark):
    """event_date of metrics is the day as written, not the UTC day: it is no bound."""
    df = spark.sql("SELECT 'a' AS event_id, 't' AS event_type, timestamp_ntz '2026-05-26 04:30:00' AS occurred_at, date '2026-05-25' AS event_date")
    assert type_summary(df, "2026-05-26T00:00:00Z").first().event_count == 1


def test_sync_into_catalog_tables_twice_equals_once(spark, lake, tmp_dir):
    from eventweave.schemas import LAKE_EVENTS, TYPE_SUMMARY
    from eventweave.sinks.tables import ensure_catalog_table
    names = ("ew_sync_summary", "ew_sync_wh")
    for by_run in (True, False):
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
        ensure_catalog_table(spark, names[0], TYPE_SUMMARY, path=tmp_dir("s"), by_run=by_run)
        ensure_catalog_table(spark, names[1], LAKE_EVENTS, path=tmp_dir("w"), by_run=by_run)
        run = f"it's run {by_run}"
        for _ in range(2):
            stats = run_incremental(spark, lake, "2026-05-25T12:00:00Z", summary_table=names[0], warehouse_table=names[1], run_id=run)
            assert stats == {"iceberg_rows": 15, "aggregate_groups": 5, "starrocks_loaded": 5, "redshift_copy": 1}
            assert (spark.table(names[0]).count(), spark.table(names[1]).count()) == (5, 15)
        run_incremental(spark, lake, "2026-05-26T00:00:00Z", summary_table=names[0], warehouse_table=names[1], run_id=run + " b")
        assert (spark.table(names[0]).count(), spark.table(names[1]).count()) == (7, 20)
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_a_load_that_broke_off_is_refused(spark, lake, tmp_dir):
    from eventweave.schemas import LAKE_EVENTS
    from eventweave.sinks.tables import ensure_catalog_table, load_run_to_table
    name, ledger = "ew_broken_load", tmp_dir("ledger")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_catalog_table(spark, name, LAKE_EVENTS, path=tmp_dir("t"))
    with pytest.raises(Exception):
        load_run_to_table(lake.withColumn("payload", F.raise_error(F.lit("lost")).cast("string")), name, "r", ledger=ledger)
    with pytest.raises(RuntimeError, match="broke off"):
        load_run_to_table(lake, name, "r", ledger=ledger)
    assert load_run_to_table(lake, name, "r2", ledger=ledger) == load_run_to_table(lake, name, "r2", ledger=ledger) == 25
    assert spark.table(name).count() == 25
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_lake_with_refused_rows_only(spark, tmp_dir):
    """One event without an event_id key: the lake stays readable, the sync finds nothing."""
    from eventweave.engine import Engine
    eng = Engine(spark, tmp_dir("e"))
    eng.publish_event("t", {"id": "x", "customer_id": 1, "occurred_at": "2026-05-25T00:00:00Z"})
    assert eng.stream("t") == 1
    assert eng.lake.read(spark).count() == 0 and eng.orders.read(spark).count() == 1 and eng.quarantine.read(spark).count() == 1
    assert eng.sync("2026-05-25T00:00:00Z") == {"iceberg_rows": 0}
    assert eng.query("SELECT count(*) AS n FROM events", "lakehouse").first().n == 0
