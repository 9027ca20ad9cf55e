"""SQL by workload over catalogs (embedded in-memory Derby: in-process, no port)."""

import pytest

from eventweave.sources.catalogs import Router, Workload, jdbc_catalog_conf, mount_catalogs, run_sql

URL = "jdbc:derby:memory:eventweave_tests;create=true"
DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


@pytest.fixture(scope="module")
def oltp(spark):
    mount_catalogs(spark, {"oltp": jdbc_catalog_conf("oltp", URL, DRIVER)})
    df = spark.createDataFrame([("e1", "click", 5), ("e2", "view", 7), ("e3", "click", 9)],
                               "EVENT_ID string, EVENT_TYPE string, N int")
    df.write.format("jdbc").options(url=URL, driver=DRIVER, dbtable="APP.EVENTS",
                                    createTableColumnTypes="EVENT_ID VARCHAR(64), EVENT_TYPE VARCHAR(64)") \
        .mode("overwrite").save()
    return "oltp"


def test_positional_parameters_on_jdbc_catalog(spark, oltp):
    df = run_sql(spark, "SELECT EVENT_ID FROM EVENTS WHERE N >= ? AND EVENT_TYPE = ?", [6, "click"],
                 catalog="oltp", namespace="APP")
    assert [r.EVENT_ID for r in df.collect()] == ["e3"]
    assert spark.catalog.currentCatalog() == "spark_catalog"          # restored


def test_named_parameters_and_pushdown(spark, oltp):
    df = run_sql(spark, "SELECT COUNT(*) AS n FROM oltp.APP.EVENTS WHERE N > :lo", {"lo": 5})
    assert df.first().n == 2


def test_store_table_is_read_by_several_tasks(spark, oltp):
    from eventweave.sources.catalogs import store_table
    df = store_table(spark, URL, "APP.EVENTS", driver=DRIVER, partition_column="N", partitions=3)
    assert df.rdd.getNumPartitions() == 3 and sorted(r.EVENT_ID for r in df.collect()) == ["e1", "e2", "e3"]
    assert store_table(spark, URL, "APP.EVENTS", driver=DRIVER).count() == 3


def _skewed(spark, name, rows, schema, types=None):
    options = dict(url=URL, driver=DRIVER, dbtable=f"APP.{name}", **({"createTableColumnTypes": types} if types else {}))
    spark.createDataFrame(rows, schema).coalesce(1).write.format("jdbc").options(**options).mode("overwrite").save()


def _sizes(df):
    from pyspark.sql import functions as F
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("kind", ["bigint", "double", "string", "timestamp"])
def test_store_table_ranges_hold_equal_numbers_of_rows(spark, oltp, kind):
    """Nearly all keys lie in a thousandth of the range: tasks still read alike."""
    import datetime as dt

    from eventweave.sources.catalogs import store_table
    keys = [int(1.004 ** i) for i in range(4000)] + [10**7] * 5
    value = {"bigint": lambda k: k, "double": lambda k: k / 7, "string": lambda k: f"{k:012d}",
             "timestamp": lambda k: dt.datetime(2020, 1, 1) + dt.timedelta(seconds=k)}[kind]
    name = f"SKEW_{kind.upper()}"
    nulls = [(None, -1), (None, -2)] if kind != "string" else [(value(1), -1), (value(1), -2)]       # the writer binds null text as CLOB
    _skewed(spark, name, [(value(k), i) for i, k in enumerate(keys)] + nulls, f"K {kind}, V int", "K VARCHAR(20)" if kind == "string" else None)
    df = store_table(spark, URL, f"APP.{name}", driver=DRIVER, partition_column="K", partitions=8)
    assert df.count() == 4007 and df.agg({"V": "sum"}).first()[0] == sum(range(4005)) - 3
    sizes = _sizes(df)
    assert 6 <= len(sizes) <= 9 and max(sizes) < 2 * 4007 / 8
    old = (spark.read.format("jdbc").options(url=URL, driver=DRIVER, dbtable=f"APP.{name}", partitionColumn="K", lowerBound=str(value(1)), upperBound=str(value(keys[3999])),
                                             numPartitions="8").load()) if kind in ("bigint",) else None
    if old is not None:
        assert max(_sizes(old)) > 4007 / 2               # what equal widths do


def test_store_table_odd_columns(spark, oltp):
    from eventweave.sources.catalogs import even_predicates, store_table
    _skewed(spark, "ONE_VALUE", [(7, i) for i in range(50)], "K int, V int")
    assert store_table(spark, URL, "APP.ONE_VALUE", driver=DRIVER, partition_column="K", partitions=4).count() == 50
    _skewed(spark, "NO_VALUE", [(None, i) for i in range(5)], "K int, V int")
    assert store_table(spark, URL, "APP.NO_VALUE", driver=DRIVER, partition_column="K", partitions=4).count() == 5
    _skewed(spark, "NO_ROWS", [], "K int, V int")
    assert store_table(spark, URL, "APP.NO_ROWS", driver=DRIVER, partition_column="K", partitions=4).count() == 0
    assert even_predicates("K", []) == ["1 = 1"] and even_predicates("K", ["a'b"])[1] == "K >= 'a''b'"


def test_engine_query_reads_a_store_in_parallel(spark, oltp, tmp_dir):
    from eventweave.engine import Engine
    _skewed(spark, "BIG", [(i * i, "ab"[i % 2]) for i in range(900)], "K bigint, T string", "T VARCHAR(4)")
    eng = Engine(spark, tmp_dir("e"))
    eng.register_store("warehouse.public.big", URL, "APP.BIG", driver=DRIVER, partition_column="K", partitions=6)
    got = eng.query("SELECT T, COUNT(*) AS n FROM big WHERE K >= :k GROUP BY T", "olap_warehouse", {"k": 100})
    assert {r.T: r.n for r in got.collect()} == {"a": 445, "b": 445}
    assert eng.tables["warehouse.public.big"].rdd.getNumPartitions() == 6


def test_router_by_workload(spark, oltp):
    router = Router({Workload.OLTP: ("oltp", "APP")})
    assert router.query(spark, "SELECT COUNT(*) AS n FROM EVENTS", "oltp").first().n == 3
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("ew_lake_view")
    assert router.query(spark, "SELECT COUNT(*) AS n FROM ew_lake_view").first().n == 1   # default LAKEHOUSE
    with pytest.raises(ValueError):
        router.query(spark, "SELECT 1", "nosql")


def test_federation_across_catalogs(spark, oltp):
    from eventweave.operators.federate import SourceRef, federate
    spark.createDataFrame([("e1", "gold"), ("e3", "basic")], "EVENT_ID string, SEGMENT string") \
        .createOrReplaceTempView("ew_segments")
    out = federate(spark, [SourceRef("oltp", "APP", "EVENTS", "i", ("EVENT_ID", "N")),
                           SourceRef(None, None, "ew_segments", "r", ("SEGMENT",))],
                   join_key="EVENT_ID", limit=None)
    assert sorted((r.i_EVENT_ID, r.r_SEGMENT) for r in out.collect()) == [("e1", "gold"), ("e2", None), ("e3", "basic")]


def test_catalog_set_conf():
    from eventweave.sources.catalogs import mysql_catalog_conf, rest_lake_catalog_conf, warehouse_catalog_conf
    lake = rest_lake_catalog_conf("lake", "http://rest:8181", warehouse="s3://bucket/wh")
    assert lake["spark.sql.catalog.lake.type"] == "rest" and lake["spark.sql.catalog.lake.uri"] == "http://rest:8181"
    oltp = mysql_catalog_conf("oltp", "db", 4000, "app", user="u")
    assert oltp["spark.sql.catalog.oltp.url"] == "jdbc:mysql://db:4000/app"
    assert oltp["spark.sql.catalog.oltp.user"] == "u" and "spark.sql.catalog.oltp.password" not in oltp
    wh = warehouse_catalog_conf("wh", "jdbc:postgresql://wh:5439/dev")
    assert wh["spark.sql.catalog.wh"].endswith("JDBCTableCatalog")
