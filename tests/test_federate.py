"""Star join over qualified sources."""

import pytest
from pyspark.sql import functions as F

from eventweave.operators.federate import DEFAULT_SOURCES, SourceRef, federate
from tests.fixtures import SAMPLE_SEGMENTS


def _resolver(tables):
    return lambda s: tables[s.qualified]


@pytest.fixture
def star(spark):
    mk = lambda keys: spark.createDataFrame([(k,) for k in keys], "k int")
    return {"x.a": mk([1, 2]), "x.b": mk([2, 3]), "x.c": mk([3, 1])}


SRC = [SourceRef(None, "x", "a", "a", ("k",)), SourceRef(None, "x", "b", "b", ("k",)),
       SourceRef(None, "x", "c", "c", ("k",))]


@pytest.mark.parametrize("how,rows", [("LEFT", 2), ("INNER", 0), ("RIGHT", 2), ("FULL", 4)])
def test_star_condition_refers_to_base_key(spark, star, how, rows):
    out = federate(spark, SRC, join_key="k", join_type=how, limit=None, resolve=_resolver(star))
    assert out.count() == rows
    assert out.columns == ["a_k", "b_k", "c_k"]


def test_single_source_has_no_join(spark, star):
    out = federate(spark, SRC[:1], join_key="k", limit=100, resolve=_resolver(star))
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 2


def test_default_sources_three_way_on_seeds(spark, sample_canonical):
    from eventweave.operators.projections import metric_rows
    lake = sample_canonical.select("event_id", "event_type")
    tables = {DEFAULT_SOURCES[0].qualified: lake,
              DEFAULT_SOURCES[1].qualified: metric_rows(sample_canonical),
              DEFAULT_SOURCES[2].qualified: spark.createDataFrame(SAMPLE_SEGMENTS, "event_id string, segment string, score double")}
    assert len(DEFAULT_SOURCES) == 3
    out = federate(spark, resolve=_resolver(tables))
    assert out.count() == 25
    assert out.where("s_event_id IS NULL OR r_event_id IS NULL").count() == 0
    sums = {r.r_segment: r.s for r in out.groupBy("r_segment").agg(F.sum("s_metric_value").alias("s")).collect()}
    assert sums == {"high_value": 6648, "standard": 501, "engagement": 8}
    seg_counts = {r.r_segment: r["count"] for r in out.groupBy("r_segment").count().collect()}
    assert seg_counts == {"high_value": 11, "standard": 6, "engagement": 8}


def test_left_join_keeps_every_base_row_and_nulls_never_match(spark):
    base = spark.createDataFrame([("a",), (None,), ("b",)], "event_id string")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "event_id string, v int")
    src = [SourceRef("c", "s", "base", "i", ("event_id",)), SourceRef("c", "s", "right", "r", ("v",))]
    out = federate(spark, src, limit=None, resolve=_resolver({"c.s.base": base, "c.s.right": right}))
    rows = sorted((r.i_event_id or "", r.r_v or 0) for r in out.collect())
    assert rows == [("", 0), ("a", 1), ("a", 2), ("b", 0)]     # duplicates multiply, null keys unmatched


def test_star_projection_and_limit(spark, star):
    src = [SourceRef(None, "x", "a", "a"), SourceRef(None, "x", "b", "b", ("k",))]
    out = federate(spark, src, join_key="k", limit=1, resolve=_resolver(star))
    assert out.columns == ["a_k", "b_k"] and out.count() == 1


def test_guards(spark, star):
    with pytest.raises(ValueError):
        federate(spark, [], resolve=_resolver(star))
    with pytest.raises(ValueError):
        federate(spark, SRC, join_key="k", join_type="CROSS", resolve=_resolver(star))
    with pytest.raises(ValueError):
        federate(spark, SRC, join_key="missing", resolve=_resolver(star))


def test_sql_wins_when_given(spark):
    assert federate(spark, sql="SELECT 1 AS one").first().one == 1


@pytest.mark.parametrize("how", ["LEFT", "INNER", "RIGHT", "FULL"])
def test_hot_key_split_equals_plain_join(spark, how):
    from eventweave.operators.federate import SkewGuard
    from tests.conftest import plan_text
    base = spark.createDataFrame([(k,) for k in ["hot", "a", "b", None, "lonely"]], "event_id string")
    # one key holds a third of the right side's rows
    right_rows = [("hot", i) for i in range(300)] + [(f"k{i % 40}", i) for i in range(600)] + \
                 [("a", 1), ("b", 2), (None, 3)]
    right = spark.createDataFrame(right_rows, "event_id string, v int")
    src = [SourceRef("c", "s", "base", "i", ("event_id",)), SourceRef("c", "s", "right", "r", ("event_id", "v"))]
    tables = {"c.s.base": base, "c.s.right": right}
    plain = federate(spark, src, join_type=how, limit=None, resolve=_resolver(tables))
    guarded = federate(spark, src, join_type=how, limit=None, resolve=_resolver(tables),
                       skew_guard=SkewGuard(hot_fraction=0.2, min_rows=100, min_bytes=0, cell_pairs=50))
    norm = lambda df: sorted(tuple("" if x is None else str(x) for x in r) for r in df.collect())
    assert norm(guarded) == norm(plain)
    assert "__right_row" in plan_text(guarded) and "Union" in plan_text(guarded)


def test_star_join_shuffles_each_source_once(spark):
    """At scale (no broadcast), three sources cost three shuffles: later joins reuse the
    base side's hash partitioning because every condition refers to the base key."""
    from tests.conftest import plan_text
    mk = lambda n: spark.range(n).selectExpr("cast(id % 1000 as string) AS event_id", "id AS v")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        src = [SourceRef(None, "x", n, n, ("event_id", "v")) for n in ("a", "b", "c")]
        out = federate(spark, src, limit=None, resolve=_resolver({f"x.{n}": mk(5000) for n in "abc"}))
        plan = plan_text(out, "simple")
        assert plan.count("Exchange hashpartitioning") == 3
        assert plan.count("SortMergeJoin") == 2
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_skew_guard_leaves_even_keys_alone(spark):
    from eventweave.operators.federate import SkewGuard
    from tests.conftest import plan_text
    base = spark.createDataFrame([(f"k{i}",) for i in range(50)], "event_id string")
    right = spark.createDataFrame([(f"k{i % 50}", i) for i in range(1000)], "event_id string, v int")
    src = [SourceRef("c", "s", "base", "i", ("event_id",)), SourceRef("c", "s", "right", "r", ("v",))]
    out = federate(spark, src, limit=None, resolve=_resolver({"c.s.base": base, "c.s.right": right}),
                   skew_guard=SkewGuard(hot_fraction=0.2, min_rows=10, min_bytes=0))
    assert "Union" not in plan_text(out) and out.count() == 1000
