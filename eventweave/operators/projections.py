"""Canonical events -> target shapes (P2 orders, P3 serving events, P4 metrics, P8 filter).

A custom transform may leave a column out; the reference's per-target defaults then
apply (amount 0 for orders, 1 for metrics, ``{}`` for payload).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.functions import fields as J
from eventweave.schemas import AMOUNT


def _col_or(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def orders_rows(canonical: DataFrame, *, lifecycle_prefix: str | None = None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """event_id, customer_id, amount (0 if absent), created_at <- occurred_at.

    ``lifecycle_prefix`` (e.g. ``"order."``) keeps only order-lifecycle events (P8, D1);
    the default keeps every event, as the reference code does.
    """
    df = lifecycle_only(canonical, lifecycle_prefix) if lifecycle_prefix else canonical
    return df.select(
        *[F.col(c) for c in keep],
        F.col("event_id"),
        _col_or(df, "customer_id", F.lit(None)).cast("bigint").alias("customer_id"),
        _col_or(df, "amount", F.lit(0)).cast(AMOUNT).alias("amount"),
        J.iso_to_ts(F.col("occurred_at")).alias("created_at"),
    )


def serving_rows(canonical: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """event_id, event_type, payload JSON text, occurred_at as timestamp."""
    return canonical.select(
        *[F.col(c) for c in keep],
        F.col("event_id"),
        F.col("event_type"),
        _col_or(canonical, "payload", F.lit("{}")).alias("payload"),
        J.iso_to_ts(F.col("occurred_at")).alias("occurred_at"),
    )


def metric_rows(canonical: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """metric_value <- truncated amount (1 if absent), event_date <- written day."""
    return canonical.select(
        *[F.col(c) for c in keep],
        F.col("event_id"),
        F.col("event_type"),
        J.truncate_to_bigint(_col_or(canonical, "amount", F.lit(1))).alias("metric_value"),
        J.date_prefix(F.col("occurred_at")).alias("event_date"),
    )


def lifecycle_only(df: DataFrame, prefix: str = "order.") -> DataFrame:
    """Events whose type starts with ``prefix``."""
    return df.where(F.startswith(F.col("event_type"), F.lit(prefix)))
