"""Shards of near-equal bytes from indivisible groups, by best-fit-decreasing bin packing.

Rows with equal texts form a group that stays in one shard. Groups that weigh a noticeable
part of a shard are items of their own; there are at most ``shards * LARGE`` of them. The
others are dealt by hash into ``shards * BUNDLES`` bundles, which are items too. So the
driver packs a bounded number of items, whatever the corpus holds: sorted by size, each
enters the tightest shard that still has room, found in a balanced tree of remaining rooms.
For a fixed number of shards the capacity is the least (by bisection) that needs no more
shards; a group larger than an even share gets a shard of its own first.

Slots number the rows of a shard without gaps: rows are numbered inside small chunks of an
item and chunks get their offsets from chunk counts, so no task holds a shard or a group.

Defined cases: a null text weighs nothing but the overhead and groups with the empty text;
null and repeated doc_ids and repeated rows are kept; an empty table gives no rows; a group
that outweighs an even share leaves its shard larger than the others, since it is
indivisible; extra columns are ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.frames import need, no_text_as_empty, stored

#: Groups of at least 1 / (shards * LARGE) of all bytes are items of their own.
LARGE = 64
#: Hash bundles a shard for the other groups.
BUNDLES = 100
#: Rows numbered in one piece.
CHUNK_ROWS = 1000


class RoomTree:
    """Treap of (room, bin): a randomised balanced tree. ``tightest(size)`` is the least
    (room, bin) with room >= size, or None."""

    def __init__(self):
        self.root = None            # node: [key, priority, left, right]
        self.rng = random.Random(7)

    def _split(self, t, key):
        if t is None:
            return None, None
        if t[0] < key:
            t[3], right = self._split(t[3], key)
            return t, right
        left, t[2] = self._split(t[2], key)
        return left, t

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] < b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, key) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.rng.random(), None, None]), right)

    def take(self, key) -> None:
        left, rest = self._split(self.root, key)
        _, right = self._split(rest, (key[0], key[1] + 1))
        self.root = self._merge(left, right)

    def tightest(self, size):
        t, best = self.root, None
        while t is not None:
            if t[0][0] >= size:
                best, t = t[0], t[2]
            else:
                t = t[3]
        return best


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of every item (largest first, ties in order); None if more than ``most`` bins are needed."""
    tree, bins, where = RoomTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda j: (-sizes[j], j)):
        got = tree.tightest(sizes[i])
        if got is None:
            if sizes[i] > capacity or bins == most:
                return None
            got, bins = (capacity, bins), bins + 1
        else:
            tree.take(got)
        where[i] = got[1]
        tree.add((got[0] - sizes[i], got[1]))
    return where


def even_bins(sizes: list[int], bins: int) -> list[int]:
    """Bin of every item so that ``bins`` bins are filled as evenly as best fit can."""
    where, rest, left = [0] * len(sizes), list(range(len(sizes))), bins
    order = sorted(rest, key=lambda j: (-sizes[j], j))
    total, at = sum(sizes), 0
    while at < len(order) and left > 1 and sizes[order[at]] * left > total:    # more than an even share
        where[order[at]] = bins - left
        total, left, at = total - sizes[order[at]], left - 1, at + 1
    rest = order[at:]
    own = [sizes[j] for j in rest]
    low = max([-(-total // left), *own[:1]]) if own else 0
    high, best = None, None
    step = max(1, low // 4096)
    while best is None:             # the first capacity that suffices, by growing steps
        high = low + step
        best = best_fit_decreasing(own, high, left)
        if best is None:
            low, step = high, step * 2
    for _ in range(12):
        if high - low <= 1:
            break
        mid = (low + high) // 2
        got = best_fit_decreasing(own, mid, left)
        if got is None:
            low = mid
        else:
            high, best = mid, got
    for j, b in zip(rest, best):
        where[j] = bins - left + b
    return where


def shard(docs: DataFrame, *, shards: int = 40, overhead: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    rows = stored(docs.select("doc_id", no_text_as_empty()).select(
        "doc_id", (F.octet_length("text") + F.lit(overhead)).cast("long").alias("size"), F.crc32("text").alias("text_crc32"),
        F.unhex(F.sha2("text", 256)).alias("group")), "shard-rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    large = groups.filter(F.col("bytes") * (shards * LARGE) >= F.lit(total))       # at most shards * LARGE groups
    bundle = F.pmod(F.xxhash64("group"), F.lit(shards * BUNDLES)).cast("string")
    items = (groups.select(F.when(F.col("bytes") * (shards * LARGE) >= F.lit(total), F.hex("group")).otherwise(bundle).alias("item"), "bytes", "rows")
             .groupBy("item").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
             .orderBy(F.desc("bytes"), "item").collect())                           # at most shards * (LARGE + BUNDLES) rows
    bins = even_bins([r["bytes"] for r in items], shards) if items else []
    plan = spark.createDataFrame([(r["item"], b, -(-r["rows"] // CHUNK_ROWS)) for r, b in zip(items, bins)], "item string, shard int, chunks long")
    placed = (rows.join(F.broadcast(large.select("group", F.hex("group").alias("own"))), "group", "left")
              .withColumn("item", F.coalesce("own", bundle))
              .join(F.broadcast(plan), "item")
              .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "group"), F.col("chunks"))))
    counts = placed.groupBy("shard", "item", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("item", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("item", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("item", "chunk").orderBy("doc_id", "group")
    return (placed.withColumn("i", F.row_number().over(inside) - 1).join(base, ["item", "chunk"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("i")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
