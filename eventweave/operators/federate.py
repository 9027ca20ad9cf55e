"""Star equi-join over qualified sources (J1-J7, P6, L1), built as one logical plan.

Every later source joins to the *first* source's key with an explicit condition on
the base key (a USING join would coalesce keys and change FULL-join results). Output
columns are named ``<alias>_<column>`` so the result can be written (names repeat
across sources otherwise). Join strategy is left to Catalyst/AQE, except that a side is not
broadcast for the size of its compressed files alone (see :func:`_join`); otherwise both sides
shuffle on the key once, and later joins reuse the base side's partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SourceRef:
    """One table by ``catalog.schema.table`` with an alias and an optional column list.

    An empty ``columns`` tuple means every column of the table (``alias.*``).
    """

    catalog: str | None
    schema: str | None
    table: str
    alias: str
    columns: tuple[str, ...] = ()

    @property
    def qualified(self) -> str:
        return ".".join(p for p in (self.catalog, self.schema, self.table) if p)


# The default three-way join: lake events, OLAP metrics, warehouse segments (fixed values:
# tables, aliases and columns; catalogs are named by their role).
DEFAULT_SOURCES: tuple[SourceRef, ...] = (
    SourceRef("lake", "analytics", "events", "i", ("event_id", "event_type")),
    SourceRef("olap", "analytics", "event_metrics", "s", ("event_id", "metric_value")),
    SourceRef("warehouse", "public", "event_segments", "r", ("event_id", "segment")),
)

# Accepted join keywords (one type for every join of the star).
JOIN_TYPES = {
    "LEFT": "left", "LEFT OUTER": "left",
    "INNER": "inner",
    "RIGHT": "right", "RIGHT OUTER": "right",
    "FULL": "full", "FULL OUTER": "full",
}


def join_how(join_type: str) -> str:
    key = " ".join(join_type.upper().split())
    if key not in JOIN_TYPES:
        raise ValueError(f"unsupported join type: {join_type!r}")
    return JOIN_TYPES[key]


@dataclass(frozen=True)
class SkewGuard:
    """Two-sided split of hot keys in the star join.

    A key with a large share of a side would put all those rows into one task: AQE splits skewed
    partitions only on the streamed side of an outer join, and neither side of a full one. Keys with
    at least ``hot_fraction`` of the rows of any side (and ``min_rows`` rows) are found without
    shuffling keys: ``freqItems`` (one pass, per-task counters merged on the driver) returns a
    superset, one pass a side counts those candidates alone. A hot key with l left and r right rows
    is dealt out as a grid of tasks: left rows fall into one of its rows of cells by their hash and
    are sent to every cell of it, right rows likewise by columns, so each pair meets in one cell. A
    cell gets about ``cell_bytes`` of either side and ``cell_pairs`` pairs; the grid is as wide as that
    needs, at most ``most_cells`` a side, whatever the other side's size, and its shape is the one
    that sends the fewest rows. Cells get more pairs than ``cell_pairs`` if there would be more than
    ``task_cells`` of them for a task and more than ``most_cells`` in all: a task makes the same pairs
    in fewer cells, and the rows sent grow with the rows, not with the pairs. Hot keys that one side lacks
    are not joined at all. Keys below the bar take the ordinary join. Results are exactly its results.

    A side that the optimizer puts below ``min_bytes`` has no key worth a split and is not counted,
    nor is one whose size it does not know (a store's table, say: counting it would read it twice
    more); with ``min_bytes=0`` every side is.
    """

    hot_fraction: float = 0.01
    min_rows: int = 1_000_000
    min_bytes: int = 256 << 20
    cell_bytes: int = 64 << 20
    cell_pairs: int = 200_000_000
    most_cells: int = 4096
    task_cells: int = 16


def _key_col(alias: str) -> str:
    return f"__{alias}_key"


#: The optimizer's size of what it knows nothing about, about.
UNKNOWN = 1 << 62


def _bytes_of(df: DataFrame) -> int:
    """The optimizer's estimate of a side's size."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no JVM view (Spark Connect)
        return UNKNOWN


def _candidates(df: DataFrame, key: str, guard: SkewGuard) -> set:
    return {k for k in df.freqItems([key], guard.hot_fraction).first()[0] if k is not None}


def _counts(df: DataFrame, key: str, candidates: list) -> tuple[dict, int]:
    """(rows of every candidate, rows of the side)."""
    groups = df.groupBy(F.when(F.col(key).isin(candidates), F.col(key)).alias("k")).count().collect()   # <= candidates + 1 groups
    return {r["k"]: r["count"] for r in groups if r["k"] is not None}, sum(r["count"] for r in groups)


@dataclass
class _Side:
    counts: dict            # rows of every candidate key
    rows: int
    row_bytes: int


def _count_sides(frames: Sequence[DataFrame], keys: Sequence[str], guard: SkewGuard) -> list[_Side]:
    """Rows of all candidate keys on every side. Sides are independent, so their small jobs run
    from parallel driver threads."""
    from concurrent.futures import ThreadPoolExecutor
    if len({f.schema[k].dataType.simpleString() for f, k in zip(frames, keys)}) > 1:
        return []           # keys of different types compare by Spark's casts: the plain join
    sizes = [_bytes_of(f) for f in frames]
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        found = [pool.submit(_candidates, f, k, guard) for f, k, n in zip(frames, keys, sizes) if not guard.min_bytes or guard.min_bytes <= n < UNKNOWN]
        candidates = sorted(set().union(*(x.result() for x in found)), key=str)
        if not candidates:
            return []
        counted = [pool.submit(_counts, f, k, candidates) for f, k in zip(frames, keys)]
        return [_Side(*c.result(), max(16, n // max(c.result()[1], 1)) if n < UNKNOWN else 100) for c, n in zip(counted, sizes)]


def _grid(left: int, right: int, left_bytes: int, right_bytes: int, guard: SkewGuard) -> tuple[int, int]:
    """(rows, columns) of cells for a key with so many rows on either side."""
    a, b = (max(1, -(-n * size // guard.cell_bytes)) for n, size in ((left, left_bytes), (right, right_bytes)))
    most_a, most_b = min(guard.most_cells, left), min(guard.most_cells, right)
    cells = left * right / guard.cell_pairs
    if cells > a * b:       # cells with fewer pairs: left rows are sent b times and right rows a times, least when both send alike
        a = min(most_a, max(a, min(cells / b, math.sqrt(cells * left / right))))
        b = min(most_b, max(b, cells / a))
        a = min(most_a, max(a, cells / b))      # what one side may not be cut into is left to the other
    return tuple(int(min(most, -(-x // 1))) for x, most in ((a, most_a), (b, most_b)))


def _grids(left: dict, right: dict, left_bytes: int, right_bytes: int, guard: SkewGuard, tasks: int) -> dict:
    """Cells (key -> rows, columns) of the keys that both sides have. ``tasks`` share the cells: beyond
    what deals the pairs out evenly, more cells are more copies of the rows and nothing else."""
    pairs = {k: n * right[k] for k, n in left.items() if n and right.get(k)}
    even = -(-sum(pairs.values()) // max(guard.most_cells, guard.task_cells * tasks))
    guard = replace(guard, cell_pairs=max(guard.cell_pairs, even))
    return {k: _grid(left[k], right[k], left_bytes, right_bytes, guard) for k in pairs}


def _salt(df: DataFrame, cells: Column) -> Column:
    """The row or column of cells a row falls into: by its values and the task that reads it, so
    equal rows are dealt out as well (those of one task stay together), and a task that runs
    again deals them alike."""
    plain = [c for c, t in df.dtypes if not any(x in t for x in ("map", "variant"))]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.spark_partition_id()), cells)


def _width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _grid_join(plan: DataFrame, right: DataFrame, base_key: str, right_key: str, cells: dict) -> DataFrame:
    """Inner join of the hot keys in ``cells`` (key -> rows, columns), a cell in one task. The
    grid is made of literals, so joins over the same sides have the same plan and Spark runs it once.
    A cell's bytes say little of its pairs: the number of tasks is given, so that AQE, which goes by
    bytes, does not put the cells into a few tasks."""
    spark, dtype = plan.sparkSession, plan.schema[base_key].dataType
    shape = [F.struct(F.lit(k).cast(dtype).alias("__k"), F.lit(r).alias("__rows"), F.lit(c).alias("__columns")) for k, (r, c) in sorted(cells.items(), key=str)]
    grid = F.broadcast(spark.range(1).select(F.inline(F.array(*shape))))        # a row a hot key
    tasks = min(4 * sum(r * c for r, c in cells.values()), _width(spark))
    left = plan.where(F.col(base_key).isin(list(cells))).join(grid, F.col(base_key) == F.col("__k")).drop("__k")
    left = left.withColumn("__row", _salt(plan, F.col("__rows")).cast("int")).withColumn("__column", F.explode(F.sequence(F.lit(0), F.col("__columns") - 1)))
    other = right.where(F.col(right_key).isin(list(cells))).join(grid, F.col(right_key) == F.col("__k")).drop("__k")
    other = (other.withColumn("__right_column", _salt(right, F.col("__columns")).cast("int"))
             .withColumn("__right_row", F.explode(F.sequence(F.lit(0), F.col("__rows") - 1))).drop("__rows", "__columns"))
    cond = ((F.col(base_key) == F.col(right_key)) & (F.col("__row") == F.col("__right_row")) & (F.col("__column") == F.col("__right_column")))
    left, other = left.repartition(tasks, base_key, "__row", "__column"), other.repartition(tasks, right_key, "__right_row", "__right_column")
    joined = left.hint("merge").join(other, cond)       # both sides may be large: never a broadcast
    return joined.select(*plan.columns, *right.columns)


def _hot_split(plan: DataFrame, right: DataFrame, base_key: str, right_key: str, how: str, guard: SkewGuard,
               left_counts: dict, left: _Side, other: _Side) -> list[DataFrame]:
    """The parts of the join, its hot keys dealt out; the plain join alone if there are none."""
    bars = [max(guard.min_rows, guard.hot_fraction * side.rows) for side in (left, other)]
    hot = sorted((k for k in left_counts.keys() | other.counts.keys() if left_counts.get(k, 0) >= bars[0] or other.counts.get(k, 0) >= bars[1]), key=str)
    if not hot:
        return [_join(plan, right, base_key, right_key, how)]
    both = _grids({k: left_counts.get(k) for k in hot}, other.counts, left.row_bytes, other.row_bytes, guard, _width(plan.sparkSession))
    parts = [_join(plan.where(~F.col(base_key).isin(hot) | F.col(base_key).isNull()),
                   right.where(~F.col(right_key).isin(hot) | F.col(right_key).isNull()), base_key, right_key, how)]
    if both:                # every pair of rows of such a key matches, under all four join types
        parts.append(_grid_join(plan, right, base_key, right_key, both))
    alone = [k for k in hot if k not in both]
    if alone and how in ("left", "full"):
        parts.append(plan.where(F.col(base_key).isin(alone)).select(*plan.columns, *_nulls(right)))
    if alone and how in ("right", "full"):
        parts.append(right.where(F.col(right_key).isin(alone)).select(*_nulls(plan), *right.columns))
    return parts


def _nulls(df: DataFrame) -> list[Column]:
    """The columns of ``df`` for rows of the other side that have no match."""
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]


#: Tasks over which rows with a null key are spread in a FULL join.
NULL_SPREAD = 4096


#: Bytes of a broadcast hash table for a byte of compressed file that the optimizer knows of, about.
EXPANSION = 64


def _guessed_small(spark: SparkSession, *sides: DataFrame) -> bool:
    """Some side is small by the optimizer's estimate alone: few bytes of compressed files whose
    rows need not be few. Each task would hold all of them as a hash table."""
    try:
        limit = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except Exception:  # noqa: BLE001 - no JVM view (Spark Connect)
        return False
    return any(limit < n * EXPANSION and n <= limit for n in map(_bytes_of, sides))


def _join(plan: DataFrame, right: DataFrame, base_key: str, right_key: str, how: str) -> DataFrame:
    """The plain join. A side whose estimate allows a broadcast that its rows may not is shuffled and
    merged. A FULL join keeps the rows without a key on both sides, and the engine splits neither: a
    second join column spreads them (it is 0 for every row with a key, so it decides nothing)."""
    cond = F.col(base_key) == F.col(right_key)
    if _guessed_small(plan.sparkSession, plan, right):
        right = right.hint("merge")
    if how != "full":
        return plan.join(right, cond, how)

    def spread(df: DataFrame, key: str, name: str) -> DataFrame:
        place = _salt(df, F.lit(NULL_SPREAD)) + 1
        return df.withColumn(name, F.when(F.col(key).isNull(), place).otherwise(F.lit(0)))
    left, other = spread(plan, base_key, "__left_spread"), spread(right, right_key, "__right_spread")
    return left.join(other, cond & (F.col("__left_spread") == F.col("__right_spread")), how).drop("__left_spread", "__right_spread")


def _counts_after(counts: dict, other: dict, how: str) -> dict:
    """Rows of every candidate key, by the base's key, after a join."""
    keep = {"inner": lambda l, r: l * r, "right": lambda l, r: l * r,
            "left": lambda l, r: l * max(r, 1), "full": lambda l, r: l * max(r, 1)}[how]
    return {k: n for k, l in counts.items() if (n := keep(l, other.get(k, 0)))}


def federate(spark: SparkSession, sources: Sequence[SourceRef] | None = None, *,
             sql: str | None = None, join_key: str = "event_id", join_type: str = "LEFT",
             limit: int | None = None,
             resolve: Callable[[SourceRef], DataFrame] | None = None,
             skew_guard: SkewGuard | None = SkewGuard(),
             each_part: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """SQL text wins when non-blank; else the given sources; else the default three.

    ``resolve`` maps a source to a DataFrame (default ``spark.table(qualified)``).
    Every row is returned unless ``limit`` is given; a limit without order returns arbitrary rows.
    ``skew_guard`` deals hot keys of large sides out over many tasks (counted up front); None
    leaves the join as it is. ``each_part`` is applied to every part of the join (its rows fall into
    parts if hot keys are dealt out) before the parts are put together: aggregates that can be added
    up then take each row straight from its join. The caller adds them up.
    """
    if each_part is not None and (limit is not None or sql is not None and sql.strip()):
        raise ValueError("each_part goes with sources and without a limit")
    if sql is not None and sql.strip():
        return spark.sql(sql)
    srcs = list(DEFAULT_SOURCES if sources is None else sources)
    if not srcs:
        raise ValueError("at least one source is required")
    resolve = resolve or (lambda s: spark.table(s.qualified))
    how = join_how(join_type)
    frames = [resolve(s) for s in srcs]
    joined = len(srcs) > 1
    if joined:
        for s, f in zip(srcs, frames):
            if join_key not in f.columns:
                raise ValueError(f"join key {join_key!r} not in {s.qualified}")
    # Each source contributes its listed columns (or all), named alias_column; the key
    # travels under a private name so the output holds only what was asked for.
    out_names, projected = [], []
    for s, f in zip(srcs, frames):
        cols = [F.col(c).alias(f"{s.alias}_{c}") for c in (s.columns or tuple(f.columns))]
        out_names += [f"{s.alias}_{c}" for c in (s.columns or tuple(f.columns))]
        if joined:
            cols.append(F.col(join_key).alias(_key_col(s.alias)))
        projected.append(f.select(*cols))
    base_key = _key_col(srcs[0].alias)
    keys = [_key_col(s.alias) for s in srcs]
    sides = _count_sides(projected, keys, skew_guard) if skew_guard and joined else []
    parts = [projected[0]]
    counts = dict(sides[0].counts) if sides else {}
    for i in range(1, len(srcs)):
        plan = reduce(DataFrame.unionByName, parts)
        if sides:
            parts = _hot_split(plan, projected[i], base_key, keys[i], how, skew_guard, counts, sides[0], sides[i])
            counts = _counts_after(counts, sides[i].counts, how)
        else:
            parts = [_join(plan, projected[i], base_key, keys[i], how)]
    parts = [part.select(*out_names) for part in parts]
    out = reduce(DataFrame.unionByName, parts if each_part is None else [each_part(part) for part in parts])
    return out.limit(limit) if limit is not None else out
