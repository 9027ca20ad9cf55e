"""Per-type counts and exact distinct ids as mergeable state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventweave.operators.summary import type_summary
from eventweave.plans.incremental import IncrementalSummary
from eventweave.sinks import snapshots as S
from eventweave.sinks.tables import AppendTable

LAKE = "event_id string, event_type string, occurred_at timestamp_ntz, payload string"


def rows(rng, n, types=("click", "view", "buy", None)):
    return [(rng.choice([None, *(f"e{rng.randint(0, 200)}" for _ in range(9))]), rng.choice(types), dt.datetime(2026, 1, 1), "{}") for _ in range(n)]


def whole(lake, spark):
    return sorted(map(tuple, type_summary(lake.read(spark)).collect()), key=str)


def state(summary, spark):
    return sorted(map(tuple, summary.read(spark).select("event_type", "event_count", "unique_events").collect()), key=str)


@pytest.mark.parametrize("fanout", [100, 2])
def test_increments_equal_one_run(spark, tmp_dir, fanout):
    rng = random.Random(1)
    lake = AppendTable(tmp_dir("lake"), fanout=fanout, versioned=True)
    summary = IncrementalSummary(tmp_dir("state"))
    for step in range(3):
        for b in range(2):
            lake.write(spark.createDataFrame(rows(rng, 150), LAKE), 2 * step + b)
        got = sorted(map(tuple, summary.update(spark, lake).collect()), key=str)
        assert got == whole(lake, spark) == state(summary, spark)
    before = summary.mark(spark)
    assert state(summary, spark) == sorted(map(tuple, summary.update(spark, lake).collect()), key=str)
    assert summary.mark(spark) == before                             # nothing new: no run


def test_only_new_parts_are_read(spark, tmp_dir):
    lake, summary = AppendTable(tmp_dir("lake"), fanout=100, versioned=True), IncrementalSummary(tmp_dir("state"))
    rng = random.Random(2)
    for b in range(4):
        lake.write(spark.createDataFrame(rows(rng, 20), LAKE).coalesce(1), b)
    summary.update(spark, lake)
    lake.write(spark.createDataFrame(rows(rng, 20), LAKE).coalesce(1), 4)
    new, _ = lake.read_new(spark, summary.mark(spark)[1])
    assert len(new.inputFiles()) == 1 and new.count() == 20
    lake.compact(spark)                                               # known batches merged: still known
    assert lake.read_new(spark, summary.mark(spark)[1])[0].count() == 20
    lake.write(spark.createDataFrame(rows(rng, 5), LAKE).coalesce(1), 5)
    lake.compact(spark)                                               # a new batch merged with known ones
    assert lake.read_new(spark, summary.mark(spark)[1])[0].count() == 25
    summary.update(spark, lake)
    assert state(summary, spark) == whole(lake, spark)


def test_a_run_that_broke_off_is_done_again(spark, tmp_dir, monkeypatch):
    lake, summary = AppendTable(tmp_dir("lake"), versioned=True), IncrementalSummary(tmp_dir("state"))
    rng = random.Random(3)
    lake.write(spark.createDataFrame(rows(rng, 100), LAKE), 0)
    summary.update(spark, lake)
    lake.write(spark.createDataFrame(rows(rng, 100), LAKE), 1)
    from eventweave.plans import incremental as I
    monkeypatch.setattr(I, "create_if_absent", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        summary.update(spark, lake)                                   # its three tables are written, its mark is not
    monkeypatch.undo()
    before = state(summary, spark)
    lake.write(spark.createDataFrame(rows(rng, 100), LAKE), 2)
    summary.update(spark, lake)
    assert state(summary, spark) == whole(lake, spark) != before


def test_two_drivers(spark, tmp_dir):
    lake, summary = AppendTable(tmp_dir("lake"), versioned=True), IncrementalSummary(tmp_dir("state"))
    lake.write(spark.createDataFrame(rows(random.Random(3), 10), LAKE), 0)
    mark = summary.mark(spark)
    summary.update(spark, lake)
    other = IncrementalSummary(summary.path)
    other.mark = lambda spark: mark                                   # looked before the first one ended
    with pytest.raises(RuntimeError, match="another driver"):
        other.update(spark, lake)


def test_hot_type_and_many_ids(spark, tmp_dir):
    """One type with most rows lies in many blocks; its ids are counted exactly."""
    lake, summary = AppendTable(tmp_dir("lake"), versioned=True), IncrementalSummary(tmp_dir("state"))
    for b in range(2):
        lake.write(spark.range(b * 60_000, b * 60_000 + 90_000).select(
            F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.when(F.col("id") % 50 == 0, F.lit("rare")).otherwise(F.lit("hot")).alias("event_type")), b)
    got = {r.event_type: (r.event_count, r.unique_events) for r in summary.update(spark, lake).collect()}
    assert got == {"hot": (176_400, 147_000), "rare": (3_600, 3_000)}
    blocks = {r.event_type: r["count"] for r in summary.bitmaps.read(spark).groupBy("event_type").count().collect()}
    assert blocks["hot"] >= 4 and blocks["rare"] <= blocks["hot"]


def test_empty_lake(spark, tmp_dir):
    from eventweave.schemas import LAKE_BY_DAY
    lake, summary = AppendTable(tmp_dir("lake"), LAKE_BY_DAY, versioned=True), IncrementalSummary(tmp_dir("state"))
    assert summary.update(spark, lake).count() == 0 and summary.mark(spark) == (0, [])
    lake.write(spark.createDataFrame([], LAKE_BY_DAY), 0)
    assert summary.update(spark, lake).count() == 0


def test_rows_without_versions_are_refused(spark, tmp_dir):
    lake = AppendTable(tmp_dir("lake"))
    lake.write(spark.createDataFrame(rows(random.Random(1), 5), LAKE), 0)
    with pytest.raises(ValueError, match="no versions"):
        IncrementalSummary(tmp_dir("state")).update(spark, lake)


def test_version_ranges():
    assert S.ranges([3, 1, 2, 7]) == [[1, 3], [7, 7]]
    assert S.add_ranges([[1, 3]], [[4, 4], [9, 9]], [[2, 6]]) == [[1, 6], [9, 9]]
    rng = random.Random(5)
    for _ in range(300):
        a, b = ({rng.randint(0, 20) for _ in range(rng.randint(0, 12))} for _ in range(2))
        assert S.without(S.ranges(a), S.ranges(b)) == S.ranges(a - b)
        assert S.add_ranges(S.ranges(a), S.ranges(b)) == S.ranges(a | b)


def test_engine_summary(spark, tmp_dir):
    from eventweave.engine import Engine
    eng = Engine(spark, tmp_dir("e"))
    assert eng.summary().count() == 0
    for i in range(2):
        eng.publish("t", spark.createDataFrame([(f"{i}-{j}", "click") for j in range(5)], "event_id string, event_type string"))
        eng.stream("t", targets=["lake"])
        assert [tuple(r) for r in eng.summary().collect()] == [("click", 5 * (i + 1), 5 * (i + 1))]
