"""Snapshots, pruning, versions without a clock, levelled compaction."""

import datetime as dt
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventweave.schemas import EVENTS, LAKE_BY_DAY
from eventweave.sinks import snapshots as S
from eventweave.sinks import tables as T

VERSIONS = "event_id string, event_type string, payload string, occurred_at timestamp_ntz, partition int, offset bigint"
ORDERS = "event_id string, customer_id bigint, amount decimal(18,2), partition int, offset bigint"


def batch(spark, keys, name, offset=0):
    return spark.createDataFrame([(k, name, None, dt.datetime(2026, 1, 1) + dt.timedelta(minutes=offset), 0, offset + i) for i, k in enumerate(keys)], VERSIONS)


def types(table, spark, **how):
    return {r.event_id: r.event_type for r in table.read(spark, **how).collect()}


def keyed(path, **options):
    return T.KeyedTable(path, EVENTS, order_cols=("partition", "offset"), **options)


def test_create_if_absent_has_one_winner(spark, tmp_dir):
    path = tmp_dir("c")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: S.create_if_absent(spark, f"{path}/x.json", f"writer {i}"), range(8)))
    assert won.count(True) == 1
    assert S.read_text(spark, f"{path}/x.json") == f"writer {won.index(True)}"
    assert S.names_in(spark, path) == ["x.json"] or set(S.names_in(spark, path)) <= {"x.json", ".x.json.crc"}


def test_readers_keep_their_snapshot(spark, tmp_dir):
    table = keyed(tmp_dir("t"))
    table.write(batch(spark, "abc", "first"), 0)
    table.write(batch(spark, "bcd", "second", 10), 1)
    before, number = table.read(spark), table.snapshot(spark).number
    table.write(batch(spark, "d", "replayed", 10), 1)                # the batch again, with other rows
    table.write(batch(spark, "e", "third", 20), 2)
    table.compact(spark)
    assert {r.event_id: r.event_type for r in before.collect()} == {"a": "first", "b": "second", "c": "second", "d": "second"}
    assert types(table, spark, as_of=number) == {"a": "first", "b": "second", "c": "second", "d": "second"}
    assert types(table, spark) == {"a": "first", "b": "first", "c": "first", "d": "replayed", "e": "third"}


def test_a_failed_write_changes_nothing(spark, tmp_dir):
    table = T.AppendTable(tmp_dir("t"))
    table.write(spark.range(5), 0)
    number = table.snapshot(spark).number
    with pytest.raises(Exception):
        table.write(spark.range(5).withColumn("id", F.raise_error(F.lit("lost")).cast("bigint")), 1)
    assert table.snapshot(spark).number == number and table.read(spark).count() == 5


def test_an_empty_batch_leaves_a_readable_table(spark, tmp_dir):
    lake = T.AppendTable(tmp_dir("l"), LAKE_BY_DAY, partition_by=("event_date",))
    assert lake.read(spark).count() == 0
    lake.write(spark.createDataFrame([], LAKE_BY_DAY), 0)
    assert lake.read(spark).columns == LAKE_BY_DAY.fieldNames() and lake.read(spark).count() == 0
    bare = T.AppendTable(tmp_dir("b"))
    bare.write(spark.range(0), 0)                                    # the schema is the batch's
    assert bare.read(spark).columns == ["id"] and bare.read(spark).count() == 0


def test_columns_may_come_but_not_change(spark, tmp_dir):
    table = T.AppendTable(tmp_dir("t"))
    table.write(spark.range(2), 0)
    table.write(spark.range(2, 3).withColumn("more", F.lit("x")), 1)
    assert sorted(map(tuple, table.read(spark).collect()), key=str) == [(0, None), (1, None), (2, "x")]
    with pytest.raises(ValueError, match="bigint in the table"):
        table.write(spark.createDataFrame([("x",)], "id string"), 2)
    with pytest.raises(ValueError, match="no table"):
        T.AppendTable(tmp_dir("none")).read(spark)


def test_order_does_not_come_from_a_clock(spark, tmp_dir, monkeypatch):
    now = time.time_ns()
    steps = iter(range(10_000))
    monkeypatch.setattr(time, "time_ns", lambda: now - next(steps) * 5_000_000_000)     # five seconds back with every look
    monkeypatch.setattr(time, "time", lambda: (now - next(steps) * 5_000_000_000) / 1e9)
    table = keyed(tmp_dir("t"))
    table.write(batch(spark, "k", "first"), 0, "s-1")
    table.write(batch(spark, "k", "second"), 1, "s-1")
    keyed(table.path).write(batch(spark, "k", "third"), 0, "s-2")    # another driver
    assert types(table, spark) == {"k": "third"}
    table.write(batch(spark, "k", "second"), 1, "s-1")               # replayed: keeps its place
    assert types(table, spark) == {"k": "third"}


def test_two_drivers_at_once(spark, tmp_dir):
    path = tmp_dir("t")
    barrier = threading.Barrier(4)

    def driver(n):
        table = keyed(path, fanout=3)
        barrier.wait()
        for b in range(5):
            table.write(batch(spark, [f"k{n}-{b}", "shared"], f"{n}-{b}"), b, f"s-{n}")
    with ThreadPoolExecutor(4) as pool:
        for f in [pool.submit(driver, n) for n in range(4)]:
            f.result()
    got = types(keyed(path), spark)
    assert len(got) == 21 and all(got[f"k{n}-{b}"] == f"{n}-{b}" for n in range(4) for b in range(5))
    assert got["shared"].endswith("-4")
    versions = [p.version for p in S.SnapshotLog(spark, path).head().parts if p.version is not None]
    assert len(versions) == len(set(versions))


def test_versions_are_never_taken_twice(spark, tmp_dir):
    path = tmp_dir("t")
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda _: S.SnapshotLog(spark, path).next_version(), range(60)))
    assert sorted(got) == list(range(1, 61))
    assert len([n for n in S.names_in(spark, f"{path}/{S.SEQUENCE}") if n.isdigit()]) < 40


def opened(df):
    return len(df.inputFiles())


def test_parts_and_files_are_left_out(spark, tmp_dir):
    """Days as batches; a merged part cut into files; only files in question are listed."""
    lake = T.AppendTable(tmp_dir("l"), fanout=100, file_bytes=4000, index_bytes=0)
    for day in range(12):
        rows = spark.range(200).select(F.concat(F.lit(f"{day}-"), F.col("id")).alias("event_id"),
                                       (F.lit(dt.datetime(2026, 1, 1 + day)) + F.expr("make_dt_interval(0, 0, id)")).cast("timestamp_ntz").alias("occurred_at"))
        lake.write(rows.coalesce(1), day)
    late = [S.Between("occurred_at", "2026-01-11T00:00:00Z")]
    assert opened(lake.read(spark)) == 12 and opened(lake.read(spark, late)) == 2
    assert lake.read(spark, late).count() == 400
    lake.compact(spark)                                              # eleven days, cut by time
    every = opened(lake.read(spark))
    assert every > 4
    assert opened(lake.read(spark, late)) < every / 2 and lake.read(spark, late).count() == 400
    one = [S.Between("occurred_at", dt.datetime(2026, 1, 3, 1), dt.datetime(2026, 1, 3, 2))]
    assert opened(lake.read(spark, one)) <= 2 and lake.read(spark, one).count() == 61
    assert lake.read(spark, [S.Between("occurred_at", "2027-01-01")]).count() == 0
    with pytest.raises(ValueError, match="no column"):
        lake.read(spark, [S.Between("nothing", 1)])


def test_key_reads_open_few_files(spark, tmp_dir, small_jobs):
    table = keyed(tmp_dir("t"), fanout=100, file_bytes=3000, index_bytes=0)
    keys = [f"k{i * 7919 % 100_003:06d}" for i in range(1200)]
    for b in range(6):
        table.write(batch(spark, keys[b * 200:(b + 1) * 200], f"v{b}", b * 1000), b)
    table.write(batch(spark, ["last"], "v6", 9000), 6)
    table.compact(spark)
    every = opened(table.read(spark))
    assert every >= 5
    for k in (keys[0], keys[777], keys[1199]):
        got = table.read(spark, keys=[k])
        assert opened(got) == 1 and [r.event_id for r in got.collect()] == [k]
    assert table.read(spark, keys=["k0", "zzz", "k050000x"]).count() == 0
    log, head = table.log(spark), table.snapshot(spark)
    absent = [f"k{i:06d}x" for i in range(0, 100_000, 2500)]         # inside the bounds of a file, not in it
    hit = sum(bool(S.files_of(log, [p for p in head.parts if p.indexed], head.schema, (), "event_id", [k])) for k in absent)
    assert hit <= len(absent) / 4
    assert {r.event_id for r in table.read(spark, keys=keys[::100] + ["last"]).collect()} == {*keys[::100], "last"}
    assert table.read(spark, keys=[]).count() == 0


def test_bounds_of_every_type(spark, tmp_dir):
    table = T.AppendTable(tmp_dir("t"), bounds=("i", "d", "x", "s", "day", "f"), fanout=100)
    row = "i int, d decimal(10,2), x double, s string, day date, f boolean"
    for b in range(3):
        table.write(spark.createDataFrame([(b * 10 + k, Decimal(b), b + 0.5, "äzA"[b], dt.date(2026, 1, 1 + b), True) for k in range(3)], row).coalesce(1), b)
    table.write(spark.createDataFrame([(None, None, float("nan"), None, None, None)], row), 3)
    for where, want in (([S.Between("i", 10, 12)], 3), ([S.Between("i", -5, 0)], 1), ([S.Between("d", Decimal("1.5"), None)], 3), ([S.Between("x", None, 1.5)], 6),
                        ([S.Between("s", "A", "a")], 3), ([S.Between("day", "2026-01-02", dt.date(2026, 1, 2))], 3), ([S.Between("i", 0), S.Between("s", "z", "z")], 3)):
        assert table.read(spark, where).count() == want
    assert opened(table.read(spark, [S.Between("i", 10, 12)])) == 1
    assert opened(table.read(spark, [S.Between("s", "z", "z")])) == 1


@pytest.fixture
def small_jobs(spark):
    """Many tiny writes: one shuffle partition, no re-planning."""
    keys = {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_two_hundred_batches(spark, tmp_dir, small_jobs):
    """Parts a read meets and rows a batch rewrites stay bounded; the result is that of one batch."""
    table, fanout, n = keyed(tmp_dir("t"), fanout=5), 5, 200
    most, written = 0, 0
    seen = set()
    for b in range(n):
        table.write(batch(spark, [f"k{b % 17}", f"own{b}"], f"v{b}", b * 10).coalesce(1), b)
        head = table.snapshot(spark)
        most = max(most, len(head.parts))
        for p in head.parts:
            if p.id not in seen:
                seen.add(p.id)
                written += p.rows
    levels = max(p.level for p in head.parts)
    assert levels == 3 and most <= fanout * (levels + 1) + 1
    assert written <= 2 * n * (levels + 1)                            # each row about once a level
    want = {f"own{b}": f"v{b}" for b in range(n)} | {f"k{b % 17}": f"v{b}" for b in range(n)}
    assert types(table, spark) == want
    with pytest.raises(ValueError, match="merged"):
        table.write(batch(spark, "k", "old"), 3)
    table.write(batch(spark, [f"k{(n - 1) % 17}", f"own{n - 1}"], f"v{n - 1}", (n - 1) * 10), n - 1)       # the last batch may be replayed
    assert types(table, spark) == want


def test_orders_and_lake_are_merged_too(spark, tmp_dir, small_jobs):
    orders, lake = T.InsertOnceTable(tmp_dir("o"), order_cols=("partition", "offset"), fanout=4), T.AppendTable(tmp_dir("l"), partition_by=("event_date",), fanout=4)
    n = 30
    for b in range(n):
        rows = [("hot", b, Decimal(b), 0, 2 * b), (f"own{b}", b, Decimal(b), 0, 2 * b + 1)]
        orders.write(spark.createDataFrame(rows, ORDERS).coalesce(1), b)
        lake.write(spark.range(3).withColumn("event_date", F.lit(f"2026-01-{1 + b % 5:02d}").cast("date")).coalesce(1), b)
    for table in (orders, lake):
        head = table.snapshot(spark)
        assert max(p.level for p in head.parts) >= 2 and len([p for p in head.parts if p.kind == "rows"]) <= 4 * 3
    assert {(r.event_id, r.customer_id) for r in orders.read(spark).collect()} == {("hot", 0), *((f"own{b}", b) for b in range(n))}
    assert sorted(r.customer_id for r in orders.rejected(spark).collect()) == list(range(1, n))
    assert lake.read(spark).count() == 3 * n and lake.read(spark, [S.Between("event_date", "2026-01-02", "2026-01-02")]).count() == 18
    assert [r.customer_id for r in orders.read(spark, keys=["own7", "hot"]).orderBy("event_id").collect()] == [0, 7]
    orders.compact(spark)
    assert sorted(r.customer_id for r in orders.rejected(spark).collect()) == list(range(1, n)) and orders.read(spark).count() == n + 1


def test_a_large_merged_part_is_not_grouped_again(spark, tmp_dir):
    """Few late rows beside a large part: only their keys are compared."""
    table = keyed(tmp_dir("t"), fanout=100)
    for b in range(2):
        table.write(batch(spark, [f"k{i}" for i in range(400)], f"v{b}", b * 1000), b)
    table.write(batch(spark, ["k7", "new"], "v2", 5000), 2)
    table.compact(spark)
    want = {f"k{i}": "v1" for i in range(400)} | {"k7": "v2", "new": "v2"}
    assert types(table, spark) == want
    plan = table.read(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_compaction_gives_way_to_a_replay(spark, tmp_dir, monkeypatch):
    """A batch replayed while its part is being merged: the merge is dropped."""
    table = T.AppendTable(tmp_dir("t"), fanout=100)
    for b in range(3):
        table.write(spark.range(10), b)
    plain = S.SnapshotLog.write_part

    def slow(self, df, *args, **own):
        part = plain(self, df, *args, **own)
        if own.get("level"):
            T.AppendTable(table.path, fanout=100).write(spark.range(1), 0)
        return part
    monkeypatch.setattr(S.SnapshotLog, "write_part", slow)
    table.compact(spark)
    monkeypatch.undo()
    assert table.read(spark).count() == 21 and all(p.level == 0 for p in table.snapshot(spark).parts)
    folders = [n for n in S.names_in(spark, f"{table.path}/data") if n.startswith(S.PART_COL)]
    assert len(folders) == 4                                          # three live parts and the replayed one's old part


def test_expire(spark, tmp_dir):
    table = T.AppendTable(tmp_dir("t"), fanout=100)
    for b in range(4):
        table.write(spark.range(b + 1), b)
    table.write(spark.range(7), 3)
    log = table.log(spark)
    assert len(log.expire(keep=1)) == 1 and log.numbers() == [5]
    assert table.read(spark).count() == 13
    table.compact(spark)
    assert len(log.expire(keep=1)) == 3 and table.read(spark).count() == 13


def test_ensure_makes_one_table(spark, tmp_dir):
    path, schema = tmp_dir("t"), StructType.fromDDL("a int, b string")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: T.ensure_path_table(spark, path, schema), range(4)))
    assert S.SnapshotLog(spark, path).numbers() == [1]
    T.AppendTable(path).write(spark.createDataFrame([(1, "x")], schema), 0)
    T.ensure_path_table(spark, path, StructType.fromDDL("other int"))        # there already
    assert T.read_table(spark, path).columns == ["a", "b"] and T.read_table(spark, path).count() == 1
