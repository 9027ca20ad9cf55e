"""Shard/bucket placement by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_of(key: Column, buckets: int) -> Column:
    """Stable bucket number of a key: ``pmod(xxhash64(key), buckets)``."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def with_shard_key(df: DataFrame, shard_key: Column | str, name: str = "shard_key") -> DataFrame:
    """K9: add the routing column the store shards by."""
    col = F.col(shard_key) if isinstance(shard_key, str) else shard_key
    return df.withColumn(name, col.cast("string"))
