"""Parallelism guard for CPU-heavy per-row work (JSON building and parsing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one task, about: what follows (records built, cached, published) grows with them.
TASK_ROWS = 1 << 18


def spread(df: DataFrame, min_partitions: int | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores, and over so many tasks that each has about
    ``task_rows`` rows, when its scan gives fewer tasks rows or some task more.

    A Parquet row group is read by one task whatever its size, and splits that hold none stay
    empty, so the number of splits says little: their rows are counted (of a plain scan, from the
    file footers alone). An input that is already cut finely is left as it is, without a shuffle.
    Round-robin placement cannot skew.
    """
    if df.isStreaming:
        return df
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no Spark context (Spark Connect): leave placement to Spark
        return df
    counts = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]       # one row a task that has rows
    if len(counts) >= target and max(counts) <= task_rows:
        return df
    return df.repartition(max(target, -(-sum(counts) // task_rows)))
