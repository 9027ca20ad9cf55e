"""Small DataFrame helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from eventweave.llm.textops import BLOCK, blocks, drop_worker_tables
from eventweave.session import prepare, work_dir


def session(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches (texts may be long)."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared work folder (with the writer's ``options``) and read back:
    cuts the lineage, so a lost executor costs no more than the tasks that read the files."""
    return stored_at(df, work_dir(df.sparkSession, name), **options)


def stored_at(df: DataFrame, path: str, **options: str) -> DataFrame:
    """The same in a given folder, for a table that is removed after its last reader."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_blocks(df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None],
              schema: str | StructType, limit: int = BLOCK) -> DataFrame:
    """``fn`` over the rows of ``df`` in Arrow, at most ``limit`` bytes of ``column`` at a time.

    ``fn`` gets a record batch and returns the columns of ``schema`` (or None for no rows)."""
    target = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = arrow_schema(target)
        drop_worker_tables()
        for batch in batches:
            for block in blocks(batch, column, limit):
                got = fn(block)
                if got is not None:
                    yield record_batch(got, out_schema)

    return df.mapInArrow(run, target)


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else
         (c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type))
         for c, f in ((columns[f.name], f) for f in schema)], schema=schema)


def longs(h: np.ndarray) -> np.ndarray:
    """uint64 values as Spark longs (same bits)."""
    return np.ascontiguousarray(h).view(np.int64)


def need(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; have {df.columns}")


def no_text_as_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)


def all_labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label 0/1), one row a document; conflicting labels count as 0."""
    need(labels, "doc_id", column)
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
            .dropna().groupBy("doc_id").agg(F.min("label").alias("label")))


def labelled(labels: DataFrame, column: str, most: int) -> DataFrame:
    """The same of about ``most`` documents at most, chosen by a hash."""
    own = all_labelled(labels, column)
    n = own.count()
    if n > most:
        own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))
    return own


#: Bins of one pass over the values (rows to the driver).
BINS = 1 << 14


def percentile(df: DataFrame, column: str, share: float) -> float | None:
    """The exact percentile of a column of doubles, between two values by their distance as Spark's own
    ``percentile``, which gathers all distinct values in one task. Here the values are counted in
    bins, and the bin that holds the place is cut into bins again until it holds one value."""
    n, low, high = df.agg(F.count(column), F.min(column), F.max(column)).first()
    if not n:
        return None

    def at(rank: int, low: float, high: float) -> float:
        while low < high:
            own = df.where(F.col(column).between(low, high))
            place = F.floor((F.col(column) - F.lit(low)) / F.lit(high - low) * BINS)
            bins = (own.groupBy(F.least(place, F.lit(BINS - 1)).alias("bin"))
                    .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy("bin").collect())
            for b in bins:
                if rank < b["n"]:
                    low, high = b["low"], b["high"]
                    break
                rank -= b["n"]
        return low

    place = share * (n - 1)
    below = int(place)
    first = at(below, low, high)
    next_ = first if place == below else at(below + 1, low, high)
    return first if next_ == first else (below + 1 - place) * first + (place - below) * next_
