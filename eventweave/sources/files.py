"""File-backed sources: event files (S1), lake scan with a predicate (S3), staged Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lake_scan(spark: SparkSession, table: DataFrame | str, predicate: str | None = None) -> DataFrame:
    """S3: all columns of the current table state, rows matching ``predicate`` (SQL text).

    The predicate is compiled by Catalyst, so comparisons on columns reach the Parquet
    scan as ``PushedFilters`` and partition filters prune directories.
    """
    df = spark.table(table) if isinstance(table, str) else table
    return df.where(F.expr(predicate)) if predicate else df


def read_event_files(spark: SparkSession, path: str, *, whole_files: bool = False,
                     strict: bool = False) -> DataFrame:
    """JSON event files -> one row per event (``value`` text, ``_v`` variant, ``_status``).

    A file (or line) may hold one object or an array of objects; an array is taken apart, an
    object is kept as one event. ``whole_files=True`` takes each file as one document, pretty-printed
    or not: many tasks cut a large one into its elements (``json_files.json_elements``), so it is
    never one value, and a broken element is one row with a status. The default reads JSON
    lines. Each line or element is parsed once; array elements of a line are turned back into
    text only for the ``value`` column.
    """
    from eventweave.functions import fields as J
    from eventweave.operators.canonical import MALFORMED, NOT_OBJECT, OK, STATUS
    from eventweave.sources.json_files import json_elements

    text = json_elements(spark, path) if whole_files else spark.read.text(path)
    doc = J.parse(F.col("value"), strict=strict)
    if whole_files:         # a generator: a filter on the status does not parse a second time
        events = text.select("value", F.explode(F.array(doc)).alias("_v"))
    else:
        parsed = text.select(F.col("value").alias("_text"), doc.alias("_doc"))
        items = F.try_variant_get(F.col("_doc"), "$", "array<variant>")
        exploded = parsed.select(
            "_text", items.isNotNull().alias("_is_array"),
            F.explode(F.when(items.isNotNull(), items).otherwise(F.array(F.col("_doc")))).alias("_v"))
        value = F.when(F.col("_is_array"), F.to_json(F.col("_v"))).otherwise(F.col("_text"))
        events = exploded.select(value.alias("value"), "_v")
    status = (F.when(F.col("_v").isNull(), F.lit(MALFORMED))
              .when(~J.is_object(F.col("_v")), F.lit(NOT_OBJECT))
              .otherwise(F.lit(OK)))
    if strict:
        status = F.when(status == OK, status).otherwise(F.raise_error(F.lit("event is not a JSON object")))
    return events.withColumn(STATUS, status)


def read_staged(spark: SparkSession, prefix: str, schema) -> DataFrame:
    """Staged Parquet under a prefix, read with a fixed schema (never inferred)."""
    return spark.read.schema(schema).parquet(prefix)
