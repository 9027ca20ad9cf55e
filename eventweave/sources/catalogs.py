"""Catalog set-up (S8) and SQL text by workload.

One SparkSession replaces the per-store clients: each store is a catalog
(``spark.sql.catalog.<name>``), a workload label picks the (catalog, namespace) a
statement runs in, and bind parameters go to ``spark.sql(..., args=...)`` — ``?``
markers with a list, ``:name`` markers with a dict.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


class Workload(str, Enum):
    OLTP = "oltp"
    HTAP = "htap"
    OLAP_REALTIME = "olap_realtime"
    OLAP_WAREHOUSE = "olap_warehouse"
    LAKEHOUSE = "lakehouse"
    FEDERATED = "federated"


def catalog_conf(name: str, implementation: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Spark conf entries that mount a catalog under ``name``."""
    conf = {f"spark.sql.catalog.{name}": implementation}
    for k, v in (options or {}).items():
        conf[f"spark.sql.catalog.{name}.{k}"] = str(v)
    return conf


def jdbc_catalog_conf(name: str, url: str, driver: str | None = None, **options: str) -> dict[str, str]:
    opts = {"url": url, **options}
    if driver:
        opts["driver"] = driver
    return catalog_conf(name, JDBC_CATALOG, opts)


def rest_lake_catalog_conf(name: str, uri: str, *, warehouse: str | None = None,
                           implementation: str = "org.apache.iceberg.spark.SparkCatalog",
                           **options: str) -> dict[str, str]:
    """A lake catalog served over REST (the URI is configuration, not code — D12). Needs the
    table format's Spark runtime jar on the classpath."""
    opts = {"type": "rest", "uri": uri, **options}
    if warehouse:
        opts["warehouse"] = warehouse
    return catalog_conf(name, implementation, opts)


def mysql_catalog_conf(name: str, host: str, port: int, database: str, *, user: str | None = None,
                       password: str | None = None, driver: str = "com.mysql.cj.jdbc.Driver",
                       **options: str) -> dict[str, str]:
    """A MySQL-protocol store (OLTP, HTAP or real-time OLAP) as a JDBC catalog."""
    extra = {k: v for k, v in (("user", user), ("password", password)) if v is not None}
    return jdbc_catalog_conf(name, f"jdbc:mysql://{host}:{port}/{database}", driver, **extra, **options)


def warehouse_catalog_conf(name: str, url: str, *, user: str | None = None, password: str | None = None,
                           driver: str = "org.postgresql.Driver", **options: str) -> dict[str, str]:
    """A warehouse reachable over JDBC (PostgreSQL protocol by default)."""
    extra = {k: v for k, v in (("user", user), ("password", password)) if v is not None}
    return jdbc_catalog_conf(name, url, driver, **extra, **options)


def mount_catalogs(spark: SparkSession, catalogs: Mapping[str, Mapping[str, str]]) -> None:
    """Apply catalog conf at run time (catalogs load lazily on first use)."""
    for conf in catalogs.values():
        for k, v in conf.items():
            spark.conf.set(k, v)


#: Counts asked for at once, and rounds of refinement, when a column is cut into even ranges.
COUNTS, ROUNDS = 256, 6


def even_bounds(spark: SparkSession, url: str, table: str, column: str, partitions: int, options: Mapping[str, str]) -> tuple[list, int]:
    """(inner bounds that cut a column's values into ranges of about equal numbers of rows, rows
    without a value), from counts that the store itself makes.

    Numbers: the store counts the rows of ``COUNTS`` equal widths; widths with more than a quarter
    of an even share are cut again where the rows are, so a skewed column takes a few rounds of one
    small query each. Other columns (dates, times, text): the store counts the rows of every value and
    Spark takes the quantiles of these counts. A single value is never cut.
    """
    def ask(sql: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, **options).option("query", sql).load()

    total, valued = ask(f"SELECT COUNT(*) AS N, COUNT({column}) AS V FROM {table}").first()
    share = valued / partitions
    if not valued:
        return [], total
    kind = ask(f"SELECT {column} AS C FROM {table} WHERE 1 = 0").schema[0].dataType
    if not isinstance(kind, NumericType):
        counts = ask(f"SELECT {column} AS C, COUNT(*) AS N FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}")
        places = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        # a slice of values a task, then their running totals: no task sorts all values
        spread = counts.repartitionByRange(partitions * 4, "C").select("C", "N", F.spark_partition_id().alias("slice")).persist()
        try:
            before = spread.groupBy("slice").agg(F.sum("N").alias("n")).select("slice", F.coalesce(F.sum("n").over(places), F.lit(0)).alias("before"))
            inner = Window.partitionBy("slice").orderBy("C").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            run = spread.join(F.broadcast(before), "slice").select("C", (F.col("before") + F.sum("N").over(inner)).alias("upto"), "N")
            first = F.floor((F.col("upto") - F.col("N")) / F.lit(share))
            cuts = run.select(first.alias("part"), "C").groupBy("part").agg(F.min("C").alias("c")).orderBy("part").collect()     # partitions at most
        finally:
            spread.unpersist()
        return [r["c"] for r in cuts[1:]], total - valued
    low, high = ask(f"SELECT MIN({column}) AS LO, MAX({column}) AS HI FROM {table}").first()
    whole = isinstance(kind, IntegralType) or (isinstance(kind, DecimalType) and kind.scale == 0)
    number = (lambda v: int(math.ceil(v))) if whole else float
    bins = [(float(low), float(high), valued, True)]            # from, to, rows, whether the end belongs to it
    for _ in range(ROUNDS):
        wide = [b for b in bins if b[2] > share / 4 and b[1] - b[0] > (1 if whole else 0)]
        if not wide:
            break
        for b in wide:
            step = (b[1] - b[0]) / COUNTS
            if step <= 0 or b[0] + step <= b[0]:
                continue
            end = "<=" if b[3] else "<"
            got = ask(f"SELECT T.B AS B, COUNT(*) AS N FROM (SELECT FLOOR(({column} - {b[0]!r}) / {step!r}) AS B FROM {table} "
                      f"WHERE {column} >= {b[0]!r} AND {column} {end} {b[1]!r}) T GROUP BY T.B").collect()         # COUNTS + 1 rows at most
            bins.remove(b)
            for r in sorted(got, key=lambda r: r["B"]):
                at = min(int(r["B"]), COUNTS - 1)
                bins.append((b[0] + at * step, b[1] if at == COUNTS - 1 else b[0] + (at + 1) * step, int(r["N"]), b[3] and at == COUNTS - 1))
        bins.sort()
    cuts, upto = [], 0
    for b in bins:
        if upto >= share * (len(cuts) + 1):
            cuts.append(number(b[0]))
        upto += b[2]
    return sorted(set(cuts)), total - valued


def _sql_value(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, dt.datetime):
        return f"'{v.isoformat(' ')}'"
    if isinstance(v, dt.date):
        return f"'{v.isoformat()}'"
    return repr(v) if isinstance(v, (int, float)) else str(v)


def even_predicates(column: str, bounds: Sequence) -> list[str]:
    """One condition a task: ranges between the bounds, rows without a value in the first."""
    values = [_sql_value(b) for b in bounds]
    if not values:
        return ["1 = 1"]
    out = [f"({column} < {values[0]} OR {column} IS NULL)"]
    out += [f"({column} >= {a} AND {column} < {b})" for a, b in zip(values, values[1:])]
    return [*out, f"{column} >= {values[-1]}"]


def store_table(spark: SparkSession, url: str, table: str, *, driver: str | None = None, partition_column: str | None = None,
                partitions: int = 16, options: Mapping[str, str] | None = None) -> DataFrame:
    """S4 for large tables: a store's table read by several tasks, each a range of
    ``partition_column`` with about as many rows as the others (see :func:`even_bounds`); rows
    without a value are read by the first. Without a column the read is one task. Filters and
    columns of later statements are pushed into every task's query."""
    opts = {**({"driver": driver} if driver else {}), **(options or {})}
    if partition_column is None:
        return spark.read.format("jdbc").options(url=url, **opts).option("dbtable", table).load()
    bounds, _ = even_bounds(spark, url, table, partition_column, partitions, opts)
    return spark.read.jdbc(url, table, predicates=even_predicates(partition_column, bounds), properties=opts)


def run_sql(spark: SparkSession, sql: str, args: Sequence[Any] | Mapping[str, Any] | None = None,
            *, catalog: str | None = None, namespace: str | Sequence[str] | None = None) -> DataFrame:
    """Run SQL text with bind parameters in the given catalog/namespace, then restore both.

    The returned DataFrame is already analysed, so its tables stay bound after the
    current catalog is restored; nothing is executed here.
    """
    prev_catalog = spark.catalog.currentCatalog()
    prev_db = spark.catalog.currentDatabase()
    try:
        if catalog:
            spark.catalog.setCurrentCatalog(catalog)
        if namespace:
            spark.catalog.setCurrentDatabase(namespace if isinstance(namespace, str) else ".".join(namespace))
        return spark.sql(sql, args=args) if args is not None else spark.sql(sql)
    finally:
        spark.catalog.setCurrentCatalog(prev_catalog)
        spark.catalog.setCurrentDatabase(prev_db)


class Router:
    """Workload label -> (catalog, namespace); unknown labels are errors."""

    def __init__(self, routes: Mapping[Workload | str, tuple[str | None, str | None]] | None = None,
                 default: Workload = Workload.LAKEHOUSE) -> None:
        self.routes = {Workload(k): v for k, v in (routes or {}).items()}
        self.default = default

    def query(self, spark: SparkSession, sql: str, workload: Workload | str | None = None,
              args: Sequence[Any] | Mapping[str, Any] | None = None) -> DataFrame:
        label = Workload(workload) if workload is not None else self.default
        catalog, namespace = self.routes.get(label, (None, None))
        return run_sql(spark, sql, args, catalog=catalog, namespace=namespace)
