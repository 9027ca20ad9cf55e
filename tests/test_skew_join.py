"""The two-sided hot-key split: equal to the plain join, no task holds a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from eventweave.operators import federate as J
from eventweave.operators.federate import SkewGuard, SourceRef, federate

GUARD = SkewGuard(hot_fraction=0.02, min_rows=20, min_bytes=0, cell_bytes=2000, cell_pairs=500)


def sources(*names):
    return [SourceRef(None, "t", n, n, ("k", "v")) for n in names]


def frame(spark, rows, name):
    return spark.createDataFrame(rows, "k string, v bigint").repartition(3).withColumn("v", F.col("v")), name


def norm(df):
    return sorted(tuple("" if x is None else str(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("how", ["LEFT", "INNER", "RIGHT", "FULL"])
def test_hot_on_both_sides_and_on_one(spark, how):
    rng = random.Random(1)

    def rows(hot, n):
        out = [(k, rng.randint(0, 3)) for k, m in hot.items() for _ in range(m)]        # many equal rows
        return out + [(f"k{rng.randint(0, 300)}", rng.randint(0, 9)) for _ in range(n)] + [(None, i) for i in range(25)]

    tables = {"t.a": spark.createDataFrame(rows({"both": 120, "left": 90, "few": 2}, 150), "k string, v bigint").repartition(3),
              "t.b": spark.createDataFrame(rows({"both": 80, "right": 100, "few": 60}, 150), "k string, v bigint").repartition(3)}
    plain = federate(spark, sources("a", "b"), join_key="k", join_type=how, resolve=lambda s: tables[s.qualified], skew_guard=None)
    split = federate(spark, sources("a", "b"), join_key="k", join_type=how, resolve=lambda s: tables[s.qualified], skew_guard=GUARD)
    assert norm(split) == norm(plain)
    assert split.columns == plain.columns and dict(split.dtypes) == dict(plain.dtypes)


@pytest.mark.parametrize("how", ["LEFT", "INNER", "RIGHT", "FULL"])
def test_three_sides(spark, how):
    """A key that is hot on the later sides only grows with every join."""
    rng = random.Random(2)
    data = {n: [("hot", i) for i in range(m)] + [(f"k{rng.randint(0, 60)}", i) for i in range(80)] + [(None, 1)] for n, m in (("a", 1), ("b", 25), ("c", 30))}
    tables = {f"t.{n}": spark.createDataFrame(d, "k string, v bigint").repartition(3) for n, d in data.items()}
    guard = SkewGuard(hot_fraction=0.1, min_rows=20, min_bytes=0, cell_bytes=500, cell_pairs=100)
    plain, split = (federate(spark, sources("a", "b", "c"), join_key="k", join_type=how, resolve=lambda s: tables[s.qualified], skew_guard=g) for g in (None, guard))
    assert norm(split) == norm(plain)


def test_no_task_holds_a_hot_key(spark):
    """A third of both sides under one key: the pairs are spread over all cells, equal rows too."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        side = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-7)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
        tables = {"t.a": side.repartition(48), "t.b": side.repartition(48)}
        guard = SkewGuard(hot_fraction=0.05, min_rows=100, min_bytes=0, cell_pairs=2_000)
        most = {}
        for name, g in (("plain", None), ("split", guard)):
            out = federate(spark, sources("a", "b"), join_key="k", join_type="FULL", resolve=lambda s: tables[s.qualified], skew_guard=g)
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            most[name], total = max(sizes), sum(sizes)
            assert total == 1000 * 1000 + 2000
        assert most["plain"] > total * 0.9 and most["split"] < total * 0.1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_small_bounds_do_not_give_up_the_split(spark):
    """Many base rows of the hot key: still split (there is no row bound beyond which it is not)."""
    side = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    few = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    tables = {"t.a": side, "t.b": few}
    out = federate(spark, sources("a", "b"), join_key="k", join_type="INNER", resolve=lambda s: tables[s.qualified],
                   skew_guard=SkewGuard(hot_fraction=0.1, min_rows=100, min_bytes=0, cell_bytes=10_000))
    assert "__right_row" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 10_000 * 200 + 200


def test_grid_shapes():
    guard = SkewGuard(cell_bytes=1000, cell_pairs=100, most_cells=64)
    assert J._grid(5, 5, 10, 10, guard) == (1, 1)
    for left, right in ((1000, 10), (10, 1000), (400, 400), (1, 10**6), (10**6, 10**6)):
        a, b = J._grid(left, right, 10, 10, guard)
        assert 1 <= a <= min(64, left) and 1 <= b <= min(64, right)
        if a < 64 and b < 64 and a < left and b < right:
            assert -(-left // a) * -(-right // b) <= 4 * guard.cell_pairs
            assert -(-left // a) * 10 <= 1000 + 10 and -(-right // b) * 10 <= 1000 + 10


def test_small_sides_are_not_counted(spark, monkeypatch):
    def fail(*args):
        raise AssertionError("counted")
    monkeypatch.setattr(J, "_counts", fail)
    monkeypatch.setattr(J, "_candidates", fail)
    tables = {n: spark.range(10).selectExpr("id AS k", "id AS v") for n in ("t.a", "t.b")}
    assert federate(spark, sources("a", "b"), join_key="k", resolve=lambda s: tables[s.qualified]).count() == 10


def test_keys_of_two_types_take_the_plain_join(spark):
    tables = {"t.a": spark.range(50).selectExpr("1 AS k", "id AS v"), "t.b": spark.range(50).selectExpr("CAST(1 AS BIGINT) AS k", "id AS v")}
    out = federate(spark, sources("a", "b"), join_key="k", resolve=lambda s: tables[s.qualified], skew_guard=GUARD)
    assert out.count() == 2500


def test_grid_sends_few_rows_and_bounds_pairs():
    """Cells hold about ``cell_pairs`` pairs where one side alone cannot be cut so finely."""
    guard = SkewGuard(cell_pairs=1_000_000)
    for left, right in ((147_900, 2_000_040), (2_000_040, 147_900), (3, 10**10), (14_790, 200_004)):
        a, b = J._grid(left, right, 16, 16, guard)
        full = guard.most_cells if left == 3 else 0
        assert b == full or left * right / (a * b) <= guard.cell_pairs
        assert left == 3 or left * b + right * a <= 2.2 * (left * right * left * right / guard.cell_pairs) ** 0.5 + left + right


@pytest.mark.parametrize("how", ["LEFT", "INNER", "RIGHT", "FULL"])
def test_sums_of_each_part_equal_sums_of_the_join(spark, how):
    rows = {"a": [("both", 1)] * 70 + [("left", 2)] * 60 + [(f"k{i % 50}", i) for i in range(90)] + [(None, 5)] * 4,
            "b": [("both", 3)] * 50 + [("right", None)] * 55 + [(f"k{i % 70}", i) for i in range(80)] + [(None, 7)] * 3}
    tables = {f"t.{n}": spark.createDataFrame(r, "k string, v bigint").repartition(3) for n, r in rows.items()}
    sums = lambda df: df.agg(F.count(F.lit(1)).alias("n"), F.count("a_v").alias("a"), F.count("b_v").alias("b"), F.sum("a_v").alias("sa"), F.sum("b_v").alias("sb"))
    join = lambda **kw: federate(spark, sources("a", "b"), join_key="k", join_type=how, resolve=lambda s: tables[s.qualified], **kw)
    parts = join(skew_guard=GUARD, each_part=sums)
    assert parts.count() > 1 and join(skew_guard=None, each_part=sums).count() == 1
    assert parts.agg(*[F.sum(c) for c in parts.columns]).first()[:] == sums(join(skew_guard=None)).first()[:]


def test_each_part_takes_no_limit_and_no_sql(spark):
    for more in ({"limit": 3}, {"sql": "SELECT 1"}):
        with pytest.raises(ValueError):
            federate(spark, sources("a", "b"), join_key="k", each_part=lambda df: df, **more)


def test_pairs_of_a_hot_key_are_made_once_for_all_join_types(spark, tmp_path):
    """The four join types of federated_hot_key share the pairs: one join of the cells in the plan run."""
    from eventweave.plans.registry import QUERIES
    from tests.conftest import plan_text
    events = spark.range(600).selectExpr("id AS event_id", "CASE WHEN id % 2 = 0 THEN 'click' ELSE 'view' END AS event_type", "CAST(id AS DOUBLE) AS value")
    events.write.parquet(str(tmp_path / "events.parquet"))
    out = QUERIES["federated_hot_key"](spark, str(tmp_path))
    rows = {r["join_type"]: r for r in out.collect()}
    left = sum(i % 11 != 0 and i % 2 == 0 and i >= 100 for i in range(600))
    assert rows["INNER"]["n"] >= left * 200 and rows["FULL"]["n"] > rows["LEFT"]["n"] > rows["INNER"]["n"]
    final = plan_text(out, "simple").split("Initial Plan")[0]
    cells = [line for line in final.splitlines() if "SortMergeJoin" in line and "__row" in line]
    assert len(cells) == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("how", ["LEFT", "INNER", "RIGHT", "FULL"])
def test_copies_grow_with_the_rows_and_not_with_the_pairs(spark, monkeypatch, how):
    """Twice the rows of a hot key are four times the pairs, but about twice the rows sent, in cells that the tasks share."""
    join, sent, sizes = J._grid_join, [], {}

    def counted(plan, right, base_key, right_key, cells):
        sent.append(sum(sizes[k][0] * columns + sizes[k][1] * rows for k, (rows, columns) in cells.items()))
        assert sum(r * c for r, c in cells.values()) >= 4 * 4
        return join(plan, right, base_key, right_key, cells)
    monkeypatch.setattr(J, "_grid_join", counted)
    for n in (1, 2):
        sizes = {"hot": (300 * n, 500 * n), "warm": (60 * n, 90 * n)}
        rows = [[(k, i % 7) for k, m in sizes.items() for i in range(m[side])] + [(f"k{i}", i) for i in range(20)] + [(None, 1)] for side in (0, 1)]
        tables = {t: spark.createDataFrame(r, "k string, v bigint").repartition(3) for t, r in zip(("t.a", "t.b"), rows)}
        guard = SkewGuard(hot_fraction=0.02, min_rows=20, min_bytes=0, cell_pairs=1, most_cells=64)
        plain, split = (federate(spark, sources("a", "b"), join_key="k", join_type=how, resolve=lambda s: tables[s.qualified], skew_guard=g)
                        .groupBy("a_k", "a_v", "b_k", "b_v").count() for g in (None, guard))
        assert norm(split) == norm(plain)
    assert sent[0] <= 20 * (300 + 500 + 60 + 90) and sent[1] <= 2.2 * sent[0]


def test_disk_of_federated_hot_key_grows_with_the_rows():
    """Rows sent at 6 times the rows are about 6 times as many, not 36 times (guard of the query)."""
    guard, sent = SkewGuard(hot_fraction=0.05, min_rows=10, min_bytes=0, cell_pairs=1_000_000), []
    for n in (60, 360):
        left, right = 2_465 * n, 33_334 * n
        (rows, columns), = J._grids({7: left, 8: None}, {7: right, 9: 5}, 16, 16, guard, 200).values()
        sent.append(left * columns + right * rows)
        assert guard.most_cells <= rows * columns <= 1.2 * guard.most_cells     # still dealt out evenly over 200 tasks
    assert sent[1] <= 6.5 * sent[0]


def test_more_tasks_get_more_cells():
    guard = SkewGuard(cell_pairs=100)
    for tasks in (1, 200, 5_000):
        cells = sum(r * c for r, c in J._grids({1: 10**6, 2: 10**4}, {1: 10**6, 2: 10**4}, 16, 16, guard, tasks).values())
        assert max(4096, 16 * tasks) <= cells <= 1.2 * max(4096, 16 * tasks)
    assert J._grids({1: 1000}, {1: 1000}, 16, 16, guard, 5_000) == {1: J._grid(1000, 1000, 16, 16, guard)}      # bound by pairs as before
