"""Incremental per-type summary (P7, A1, A2) and run statistics (A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.functions import fields as J


def since_filter(lake: DataFrame, since: str, ts_col: str = "occurred_at",
                 date_col: str | None = None) -> DataFrame:
    """``ts_col >= since`` (inclusive). ``since`` is ISO-8601 text, a ``Z`` suffix is allowed.

    The bound folds to a literal, so the comparison is pushed into the Parquet scan
    (row-group pruning). If the caller names a ``date_col`` that is known to hold the UTC day
    of ``ts_col`` (a lake's partition column), the implied ``date_col >= day(since)`` is added
    so whole date partitions are pruned before any file is opened.
    """
    bound = J.iso_to_ts(F.lit(since))
    if dict(lake.dtypes).get(ts_col) == "timestamp":
        bound = F.try_to_timestamp(F.lit(since))
    cond = F.col(ts_col) >= bound
    if date_col:
        cond = cond & (F.col(date_col) >= F.to_date(J.iso_to_ts(F.lit(since))))
    return lake.where(cond)


def type_summary(lake: DataFrame, since: str | None = None, *, ts_col: str = "occurred_at",
                 type_col: str = "event_type", id_col: str = "event_id", date_col: str | None = None) -> DataFrame:
    """A1 + A2: per event type, row count and exact distinct count of ids (nulls ignored).

    Plan: partial count on (type, id) -> shuffle on (type, id) -> partial per type ->
    shuffle of one row per type and task. A hot type is spread by id in the first
    shuffle; a hot id collapses map-side, so no task sees a whole group.
    """
    rows = since_filter(lake, since, ts_col, date_col) if since is not None else lake
    return rows.groupBy(F.col(type_col).alias("event_type")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct(F.col(id_col)).alias("unique_events"),
    )


def run_stats(summary: DataFrame) -> DataFrame:
    """A5 from the summary alone (no second scan): qualifying rows and groups."""
    return summary.agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("iceberg_rows"),
        F.count(F.lit(1)).alias("aggregate_groups"),
    )
