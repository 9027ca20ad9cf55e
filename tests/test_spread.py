"""Rows of one task of the JSON work."""

from pyspark.sql import functions as F

from eventweave.operators.spread import spread


def _largest(df):
    return max(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_few_row_groups_are_dealt_out_by_rows(spark):
    one = spark.range(0, 1000, 1, 1)
    sides = one.unionByName(spark.range(0, 0, 1, 7))             # eight splits, seven of them empty
    out = spread(sides, min_partitions=4, task_rows=100)
    assert _largest(out) <= 110
    assert sorted(r[0] for r in out.collect()) == list(range(1000))


def test_a_finely_cut_input_is_not_shuffled(spark):
    df = spark.range(0, 1000, 1, 20)
    assert spread(df, min_partitions=4, task_rows=100) is df


def test_an_empty_input_stays_empty(spark):
    assert spread(spark.range(0), min_partitions=4).count() == 0
