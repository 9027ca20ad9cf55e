"""Merged parts are cut by rows as well as by bytes: one task sorts one file."""

import pytest
from pyspark.sql import functions as F

from eventweave.sinks import tables as T

SCHEMA = "event_id string, event_type string, seq bigint"


def _batch(spark, first, rows, name):
    return spark.range(first, first + rows).select(F.col("id").cast("string").alias("event_id"), F.lit(name).alias("event_type"), F.col("id").alias("seq"))


def _files(spark, table):
    """Rows of every file of the table's merged part."""
    part = next(p for p in table.snapshot(spark).parts if p.level and p.kind == "rows")
    got = spark.read.parquet(table.log(spark).folder(part)).groupBy(F.input_file_name()).count().collect()
    return [r[1] for r in got]


@pytest.mark.parametrize("kind", ["keyed", "first", "appended"])
def test_a_merge_of_many_rows_is_many_files(spark, tmp_dir, monkeypatch, kind):
    monkeypatch.setattr(T, "FILE_ROWS", 100)
    schema = spark.createDataFrame([], SCHEMA).schema
    table = {"keyed": lambda p: T.KeyedTable(p, schema, order_cols=("seq",)), "first": lambda p: T.InsertOnceTable(p, order_cols=("seq",)),
             "appended": lambda p: T.AppendTable(p, schema)}[kind](tmp_dir(kind))
    for batch, (first, rows) in enumerate(((0, 400), (200, 400), (900, 1))):
        table.write(_batch(spark, first, rows, f"v{batch}"), batch)
    table.compact(spark)
    files = _files(spark, table)
    assert len(files) >= 5 and max(files) <= 250         # ranges are sampled: about 100 rows each
    rows = sorted((int(r.event_id), r.event_type) for r in table.read(spark).collect())
    old = [(i, "v0") for i in range(400)]
    new = [(i, "v1") for i in range(200, 600)]
    want = {"keyed": old[:200] + new, "first": old + new[200:], "appended": sorted(old + new)}[kind]
    assert rows == want + [(900, "v2")]


def test_a_merge_of_few_rows_is_one_file(spark, tmp_dir):
    table = T.KeyedTable(tmp_dir("few"), spark.createDataFrame([], SCHEMA).schema, order_cols=("seq",))
    for batch in range(3):
        table.write(_batch(spark, batch * 10, 10, "v"), batch)
    table.compact(spark)
    assert _files(spark, table) == [20]
