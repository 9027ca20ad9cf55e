"""Latest (or first) version per key inside one batch (core of K3 and D2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: str, order_cols: Sequence[str], newest: bool) -> DataFrame:
    if not order_cols:
        raise ValueError("name the columns that order the versions of a key")
    values = [c for c in df.columns if c != key]
    if not values:
        return df.select(key).distinct()
    order = F.struct(*[F.col(c) for c in order_cols])
    row = F.struct(*[F.col(c) for c in values])
    pick = F.max_by(row, order) if newest else F.min_by(row, order)
    # max_by/min_by aggregate partially before the shuffle: a key with many versions
    # is reduced map-side and never gathered into one task.
    return df.groupBy(key).agg(pick.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in values])


def latest_per_key(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """Last arrival wins: the row with the greatest ``order_cols`` per ``key``."""
    return _pick(df, key, order_cols, newest=True)


def first_per_key(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """First arrival wins (duplicate inserts are rejected)."""
    return _pick(df, key, order_cols, newest=False)
