"""Sides of the star join that look small by their compressed files alone."""

from eventweave.operators.federate import SourceRef, federate

SOURCES = [SourceRef(None, "t", "a", "a", ("k",)), SourceRef(None, "t", "b", "b", ("v",))]


def _plan(spark, rows, how):
    # 16 bytes a row by estimate, as few as a column of compressed files has
    tables = {"t.a": spark.range(rows).selectExpr("id AS k"), "t.b": spark.range(rows).selectExpr("id AS k", "id + 1 AS v")}
    out = federate(spark, SOURCES, join_key="k", join_type=how, resolve=lambda s: tables[s.qualified])
    return out, out._jdf.queryExecution().executedPlan().toString()


def test_sides_of_many_rows_are_not_broadcast(spark):
    for how in ("LEFT", "INNER", "RIGHT"):
        out, plan = _plan(spark, 200_000, how)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert out.count() == 200_000


def test_small_sides_still_are(spark):
    for how in ("LEFT", "INNER", "RIGHT"):
        assert "BroadcastHashJoin" in _plan(spark, 1000, how)[1]
