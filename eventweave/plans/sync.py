"""Incremental lake -> OLAP/warehouse sync (T8): since-filter, per-type summary, loads.

One plan per run: the lake scan carries the pushed-down bound; when a warehouse load
is asked for, the qualifying rows are staged once as Parquet (D7) and both the summary
and the bulk load read that staging, so the lake is scanned once. Only the statistics
row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from eventweave.operators.summary import run_stats, since_filter, type_summary
from eventweave.schemas import LAKE_EVENTS
from eventweave.sinks.export import bulk_load, load_summary
from eventweave.session import work_dir
from eventweave.sinks.snapshots import remove_folder


def run_incremental(spark: SparkSession, lake: DataFrame | str, since: str, *,
                    summary_table: str | None = None, summary_path: str | None = None,
                    warehouse_table: str | None = None, warehouse_path: str | None = None,
                    warehouse_schema: StructType = LAKE_EVENTS, staging: str | None = None,
                    ts_col: str = "occurred_at", date_col: str | None = None,
                    run_id: str | None = None) -> dict[str, int]:
    """A5 statistics: ``iceberg_rows``, ``aggregate_groups``, ``starrocks_loaded``,
    ``redshift_copy``; only ``iceberg_rows: 0`` when nothing qualifies (early exit).

    Path targets hold one folder a run; ``run_id`` defaults to the bound, so that the same
    sync, run again, replaces what it loaded. ``date_col`` names a column that holds the UTC
    day of ``ts_col``, if the lake has one. A staging folder of the run's own is removed."""
    source = spark.table(lake) if isinstance(lake, str) else lake
    rows = since_filter(source, since, ts_col, date_col)
    run_id = run_id or since
    want_copy = warehouse_table is not None or warehouse_path is not None
    own_staging = want_copy and staging is None
    if want_copy:
        staging = staging or work_dir(spark, "staging")
        rows.write.mode("overwrite").parquet(staging)
        rows = spark.read.parquet(staging)
    summary = type_summary(rows, ts_col=ts_col).persist()   # one row per event type
    try:
        st = run_stats(summary).first()
        stats = {"iceberg_rows": int(st["iceberg_rows"])}
        if stats["iceberg_rows"] == 0:
            return stats
        stats["aggregate_groups"] = int(st["aggregate_groups"])
        if summary_table or summary_path:
            stats["starrocks_loaded"] = load_summary(summary, table=summary_table, path=summary_path,
                                                     run_id=run_id)
        if want_copy:
            bulk_load(spark, staging, warehouse_schema, table=warehouse_table, path=warehouse_path, run_id=run_id)
            stats["redshift_copy"] = 1
        return stats
    finally:
        summary.unpersist()
        if own_staging:
            remove_folder(spark, staging)
