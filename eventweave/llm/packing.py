"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens.

Best-fit decreasing, with a segment tree over remaining capacities. The rule only looks at
lengths, of which there are at most ``capacity`` different ones, so the driver packs the
*histogram* of lengths: equal pieces that the rule would treat alike are placed in one step
(a run: so many pieces of one length into so many consecutive sequences). The plan is exactly
that of packing the pieces one by one, longest first; its size depends on the capacity, not
on the corpus. Each piece then finds its run by its rank among the pieces of its length.

Defined cases: a null text is empty and gives one piece, the end id; texts longer than the
capacity are cut every ``capacity`` ids; repeated rows and null or repeated doc_ids are
packed like any other row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.frames import need, stored
from eventweave.llm.textops import blocks
from eventweave.llm.tokens import encoder

PIECES = ("part int, rank long, doc_id long, piece int, start long, length long, "
          "ids_crc32 long, ids binary")


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity; a leaf is set while an open bin
    has exactly that much room. ``tightest(need)``: the least set leaf not below ``need``."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, int(capacity).bit_length())
        self.node = bytearray(2 * self.size)

    def put(self, room: int, on: bool) -> None:
        i = room + self.size
        self.node[i] = on
        while i > 1:
            i >>= 1
            self.node[i] = self.node[2 * i] | self.node[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        i = need + self.size
        if self.node[i]:
            return need
        while i > 1:                    # up to the first right-hand neighbour with an open bin
            if not i & 1 and self.node[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return None
        while i < self.size:            # and down to its leftmost leaf
            i = 2 * i if self.node[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first rank, pieces, first bin, pieces a bin, offset) of best-fit decreasing.

    Piece ``first rank + i`` goes to bin ``first bin + i // per`` at ``offset + (i % per) * length``."""
    tree = CapacityTree(capacity)
    rooms: dict[int, list[list[int]]] = {}          # room -> [[first bin, bins], ...]
    runs: list[tuple[int, int, int, int, int, int]] = []
    n_bins = 0

    def give(room: int, first: int, n: int) -> None:
        if not n:
            return
        here = rooms.setdefault(room, [])
        if not here:
            tree.put(room, True)
        if here and here[-1][0] + here[-1][1] == first:
            here[-1][1] += n
        else:
            here.append([first, n])

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, bins = capacity, n_bins, -(-left // (capacity // length))
                n_bins += bins
            else:
                first, bins = rooms[room].pop()
                if not rooms[room]:
                    tree.put(room, False)
            per = room // length                    # the tightest bin stays the tightest while it holds more
            full = min(left // per, bins)
            rest = left - full * per if full < bins else 0
            used = full + (rest > 0)
            taken = full * per + rest
            runs.append((length, rank, taken, first, per, capacity - room))
            give(room - per * length, first, full)
            if rest:
                give(room - rest * length, first + full, 1)
            give(room, first + used, bins - used)
            left -= taken
            rank += taken
    return np.array(runs, dtype=np.int64).reshape(-1, 6)


def _ranks(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Rank of each piece among those of its length, after the ``seen`` ones (updated)."""
    order = np.argsort(lengths, kind="stable")
    s = lengths[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    within = np.arange(len(s)) - np.repeat(new, np.diff(np.concatenate([new, [len(s)]])))
    out = np.empty(len(s), dtype=np.int64)
    out[order] = within + seen[s]
    np.add.at(seen, lengths, 1)
    return out


def tokenise(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every document, with their ids (little-endian, 2 bytes each if the
    vocabulary fits, else 4) and their rank among the partition's pieces of that length."""
    need(docs, "doc_id", "text")

    def run(batches):
        enc, seen, part = encoder(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for block in blocks(batch, "text", 1 << 18):
                ids, n = enc.encode(block.column("text"))
                ids = np.insert(ids, np.cumsum(n), np.array(end_id, ids.dtype))
                n = n + 1
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                at = np.repeat(np.cumsum(n) - n, pieces) + start
                raw, wide = ids.tobytes(), memoryview(ids.astype("<u4").tobytes())      # bytes: pyarrow keeps memoryviews alive
                w = ids.dtype.itemsize
                spans = list(zip(at.tolist(), (at + length).tolist()))
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(doc), part, np.int32)), "rank": pa.array(_ranks(length, seen)),
                    "doc_id": block.column("doc_id").cast(pa.int64()).take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start), "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(wide[4 * a:4 * b]) for a, b in spans], pa.int64()),
                    "ids": pa.array([raw[w * a:w * b] for a, b in spans], pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, *, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``: columns ``doc_id, piece,
    start, length, ids_crc32, ids, sequence_id, offset``."""
    spark = docs.sparkSession
    pieces = stored(tokenise(docs, tokenizer, capacity, end_id), "pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    plan = spark.sparkContext.broadcast(best_fit_plan(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = (pieces.join(base, ["part", "length"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("rank") + F.col("base")).alias("rank")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd
        runs = plan.value
        runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
        x = np.rec.fromarrays([runs[:, 0], runs[:, 1]])
        at = np.searchsorted(x, np.rec.fromarrays([length.to_numpy(), rank.to_numpy()], dtype=x.dtype), side="right") - 1
        i = rank.to_numpy() - runs[at, 1]
        return pd.DataFrame({"sequence_id": runs[at, 3] + i // runs[at, 4], "offset": runs[at, 5] + i % runs[at, 4] * runs[at, 0]})

    return (ranked.withColumn("place", place("length", "rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "place.sequence_id", "place.offset"))
