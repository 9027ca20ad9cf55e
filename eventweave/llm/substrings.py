"""Substring dedup with prefix-partitioned suffix trees.

A suffix starts at every word. A repeat of ``length`` words is an internal node at least that
deep of the tree of all suffixes. The tree is built in parts: suffixes are dealt out by a
prefix of variable length, the shortest of ``PREFIXES`` whose bucket holds at most ``GROUP``
suffixes of the corpus (the counts come from the first pass), so that a part fits in memory;
frequent prefixes are split by longer ones, down to the whole window. In a part the suffixes
are ordered by prefix and by the name (64-bit hash) of their first ``length`` words; a run of
equal names is a node with its leaves, read as a stream. Spans are the unions of such leaves'
windows; deeper nodes are not derived, so two repeats that touch are one span.

Most suffixes cannot be that deep and are left out beforehand, exactly: every window is
represented by the least hash of its ``GRAM``-word grams, equal windows have the same one, and
a window whose representative occurs once in the corpus occurs once. Equal windows that meet
in one batch send one of them on; the others are known to be repeated.

Rows are numbered once and written with their number; every later job reads it from there, so
the cut falls on the same rows however the input is split in between. They are written as one
bucket a task, without a shuffle: a row carries a small number whose hash is its task's bucket, so
what is found out about texts is sent to them and no text is ever shuffled.

Defined cases: null and empty texts have no words; a text shorter than a window loses
nothing; equal rows repeat each other; null and repeated doc_ids do not matter; an empty
table gives no rows; columns of ``docs`` are kept (``kept_text, n_words, n_removed, spans``
are replaced).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from eventweave.llm import textops as X
from eventweave.llm.frames import by_blocks, longs, need, stored
from eventweave.session import work_dir

GRAM = 8
#: Prefix lengths in words; the whole window comes after them.
PREFIXES = (2, 6, 14)
BUCKETS = 1 << 12
#: Suffixes of one part at most.
GROUP = 1 << 20
_BLOCK = 1 << 20


def slide(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over all windows of ``width`` entries."""
    if len(a) < width:
        return a[:0]
    have = 1
    while 2 * have <= width:
        a = op(a[:-have], a[have:])
        have *= 2
    rest = width - have
    return op(a[:-rest], a[rest:]) if rest else a


def prefixes(length: int) -> tuple[int, ...]:
    """Prefix lengths shorter than the window."""
    return tuple(p for p in PREFIXES if p < length)


def representatives(w: X.Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(representative of every window, mask of windows in one row, gram hashes)."""
    gram = min(GRAM, length)
    grams = X.window_hashes(w.hash, gram)
    least = slide(grams, length - gram + 1, np.minimum)
    inside = w.row[: len(least)] == w.row[length - 1:] if len(least) else np.zeros(0, bool)
    return least, inside, grams


def prefix_buckets(w: X.Words, words: int, count: int) -> np.ndarray:
    """Bucket of the prefix of ``words`` words of the first ``count`` suffixes."""
    return (X.window_hashes(w.hash, words)[:count] >> np.uint64(64 - 12)).astype(np.int64)


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """One pass over all texts: kind 0: (bucket, rid, h, n) of every gram that represents a window,
    once a text; kind 1: (bucket h, n) counts of suffixes by prefix, summed over a task."""
    def run(batches):
        X.drop_worker_tables()
        counts, gram = np.zeros((len(PREFIXES), BUCKETS), np.int64), min(GRAM, length)
        for batch in batches:
            for block in X.blocks(batch, "text", _BLOCK):
                w = X.split_words(*X.column_bytes(block.column("text")))
                least, inside, grams = representatives(w, length)
                if not len(least):
                    continue
                for i, p in enumerate(prefixes(length)):
                    counts[i] += np.bincount(prefix_buckets(w, p, len(least))[inside], minlength=BUCKETS)
                low = np.where(inside, least, np.uint64(0))
                edge = np.zeros(length - gram, np.uint64)
                chosen = slide(np.concatenate([edge, low, edge]), length - gram + 1, np.maximum) == grams[: len(low) + length - gram]
                at = np.flatnonzero(chosen)
                if not len(at):
                    continue
                row, h = w.row[at], grams[at]
                o = X.ordered(row, h)
                row, h = row[o], h[o]
                begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]))
                yield pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(len(begin), np.int8)), "bucket": block.column("bucket").take(pa.array(row[begin])),
                                                  "rid": block.column("rid").take(pa.array(row[begin])),
                                                  "h": pa.array(longs(h[begin])), "n": pa.array(np.diff(np.concatenate([begin, [len(h)]])))})
        level, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"kind": pa.array(np.ones(len(level), np.int8)), "bucket": pa.array(np.zeros(len(level), np.int32)), "rid": pa.array(np.zeros(len(level), np.int64)),
                                          "h": pa.array(level * BUCKETS + bucket), "n": pa.array(counts[level, bucket])})
    return docs.select("bucket", "rid", "text").mapInArrow(run, "kind byte, bucket int, rid long, h long, n long")


def suffixes(texts: DataFrame, counts: np.ndarray, length: int) -> DataFrame:
    """Suffixes that may be deep: (part, name, bucket, rid, at). ``texts`` has bucket, rid, text and
    ``grams``, the repeated representatives of the text. ``at`` holds position, run length and
    whether the window is known to repeat (see ``packed``). Of equal windows in a batch one is sent
    to its part; the others, known to repeat, travel as runs under parts below zero."""
    small = counts <= GROUP

    def run(block: pa.RecordBatch) -> dict | None:
        w = X.split_words(*X.column_bytes(block.column("text")))
        least, inside, _ = representatives(w, length)
        lists = block.column("grams")
        row_of = np.repeat(np.arange(block.num_rows), np.diff(np.asarray(lists.offsets)))
        mark = X.mix(np.arange(block.num_rows, dtype=np.uint64) + np.uint64(1))
        known = np.unique(np.asarray(lists.values.slice(lists.offsets[0].as_py(), len(row_of))).view(np.uint64) ^ mark[row_of])
        at = np.flatnonzero(inside)
        at = at[np.isin(least[at] ^ mark[w.row[at]], known)]
        if not len(at):
            return None
        name = X.span_hashes(w.hash, at, at + length)
        part = X.mix(name).view(np.int64) & np.int64((1 << 62) - 1)         # the whole window, unless a shorter prefix will do
        for i, p in reversed(list(enumerate(prefixes(length)))):
            b = prefix_buckets(w, p, len(least))[at]
            part = np.where(small[i][b], b + i * BUCKETS, part)
        uniq, first, back, n = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
        sure = n[back] > 1
        lead = np.zeros(len(at), bool)
        lead[first] = True
        others = at[~lead]
        starts = np.ones(len(others), bool)
        starts[1:] = (others[1:] != others[:-1] + 1) | (w.row[others[1:]] != w.row[others[:-1]])
        starts[::_RUN] = True
        begin = np.flatnonzero(starts)
        n = np.concatenate([np.ones(int(lead.sum()), np.int64), np.diff(np.concatenate([begin, [len(others)]]))])
        some = np.concatenate([at[lead], others[begin]])
        row = w.row[some]
        rid = block.column("rid").to_numpy()[row]
        away = -1 - (X.mix(rid[len(rid) - len(begin):].view(np.uint64)) & np.uint64(0xFFFF)).astype(np.int64)
        return {"part": np.concatenate([part[lead], away]), "name": longs(np.concatenate([name[lead], np.zeros(len(begin), np.uint64)])),
                "bucket": block.column("bucket").take(pa.array(row)), "rid": rid,
                "at": packed(some - w.first[row], n, np.concatenate([sure[lead], np.ones(len(begin), bool)]))}

    return by_blocks(texts.select("bucket", "rid", "text", "grams"), "text", run, "part long, name long, bucket int, rid long, at long", _BLOCK)


#: Windows of one run at most.
_RUN = 1 << 20


def packed(pos: np.ndarray, n: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """First position, number of neighbouring windows and the mark of windows known to repeat."""
    return (pos << 21) | ((n - 1) << 1) | sure


def unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 21, ((at >> 1) & (_RUN - 1)) + 1, (at & 1).astype(bool)


def deep_leaves(found: DataFrame) -> DataFrame:
    """(bucket, rid, at) of the suffixes below nodes of the window's depth. Every part is one
    sorted stream; only the last suffix of a batch is carried on."""
    dealt = found.repartition("part").sortWithinPartitions("part", "name")

    def run(batches):
        last = None             # (part, name, bucket, rid, at, given): the leaf that may have a twin in the next batch
        for batch in batches:
            part, name, bucket, rid, at = (batch.column(c).to_numpy() for c in ("part", "name", "bucket", "rid", "at"))
            if not len(part):
                continue
            same = (part[1:] == part[:-1]) & (name[1:] == name[:-1]) & (part[1:] >= 0)
            deep = (at & 1).astype(bool)
            deep[1:] |= same
            deep[:-1] |= same
            carried = None
            if last is not None and last[0] == part[0] and last[1] == name[0] and part[0] >= 0:
                deep[0] = True
                if not last[5]:
                    carried = last
            last = (part[-1], name[-1], bucket[-1], rid[-1], at[-1], bool(deep[-1]))
            out = {"bucket": bucket[deep], "rid": rid[deep], "at": at[deep]}
            if carried is not None:
                out = {c: np.append(v, np.array(x, v.dtype)) for (c, v), x in zip(out.items(), carried[2:5])}
            yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in out.items()})

    return dealt.mapInArrow(run, "bucket int, rid long, at long")


#: Buckets of the stored rows at most (a bucket may hold the rows of several tasks).
MOST_BUCKETS = 20_000


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with ``rid``, a row's number, and ``bucket``, stored in buckets as its tasks read
    them (``bucket`` is a number whose hash is the bucket of the task, so nothing is shuffled), and
    the number of buckets."""
    spark = docs.sparkSession
    # joins on (bucket, rid) may use the buckets as they are
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    n = min(max(docs.rdd.getNumPartitions(), 1), MOST_BUCKETS)
    number = F.col("id").cast("int")
    keys = spark.range(32 * n + 1000).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("_task")).agg(F.min(number).alias("bucket"))     # n rows
    name, path = f"ew_rows_{uuid.uuid4().hex[:12]}", work_dir(spark, "rows")
    (docs.withColumn("text", F.col("text").cast("string")).withColumn("rid", F.monotonically_increasing_id())
     .withColumn("_task", F.spark_partition_id() % n).join(F.broadcast(keys), "_task").drop("_task")
     .write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, "bucket").saveAsTable(name))
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")         # the name alone; the files stay
    return rows, n


def beside(rows: DataFrame, buckets: int, found: DataFrame, how: str = "inner") -> DataFrame:
    """Stored rows with what was found out about them (at most a row a text): that is sent to the
    rows' buckets."""
    return rows.join(found.repartition(buckets, "bucket").hint("shuffle_hash"), ["bucket", "rid"], how)


def remove_repeats(docs: DataFrame, *, length: int = 35) -> DataFrame:
    """``docs`` with ``kept_text`` (kept words joined by one space), ``n_words``, ``n_removed``
    and ``spans`` (first word and number of words of every stretch covered by repeated windows)."""
    need(docs, "text")
    docs = docs.drop("kept_text", "n_words", "n_removed", "spans", "rid", "bucket", "_task", "grams", "at")
    names = docs.columns
    rows, buckets = numbered(docs)
    seen = stored(anchors(rows, length), "anchors", compression="zstd")
    counts = np.zeros(len(PREFIXES) * BUCKETS, np.int64)
    for r in seen.filter("kind = 1").groupBy("h").agg(F.sum("n").alias("n")).collect():       # PREFIXES * BUCKETS rows at most
        counts[r["h"]] = r["n"]
    grams = seen.filter("kind = 0")
    twice = grams.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    lists = grams.select("bucket", "rid", "h").join(twice, "h").groupBy("bucket", "rid").agg(F.collect_list("h").alias("grams"))      # at most a text's own grams
    texts = beside(rows.select("bucket", "rid", "text"), buckets, lists)
    leaves = deep_leaves(suffixes(texts, counts.reshape(len(PREFIXES), BUCKETS), length)).groupBy("bucket", "rid").agg(F.collect_list("at").alias("at"))
    schema = StructType([*docs.schema.fields, StructField("kept_text", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("spans", ArrayType(StructType([StructField("first", LongType()), StructField("words", LongType())])))])

    def cut(block: pa.RecordBatch) -> dict:
        data, offsets = X.column_bytes(block.column("text"))
        w = X.split_words(data, offsets)
        lists = block.column("at").fill_null([])
        row = np.repeat(np.arange(block.num_rows), np.diff(np.asarray(lists.offsets)))
        at, n, _ = unpacked(np.asarray(lists.values.slice(lists.offsets[0].as_py(), len(row))))
        at = np.repeat(at + w.first[row], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        gone = X.covered(len(w.hash), at, length) if len(at) else np.zeros(len(w.hash), bool)
        size = np.where(gone, 0, w.end - w.start + 1)              # a kept word and the space after it
        place = np.concatenate([[0], np.cumsum(size)])
        keep = np.flatnonzero(~gone)
        n = (w.end - w.start)[keep]
        out = np.full(int(place[-1]), 0x20, np.uint8)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(place[keep], n) + k] = data[np.repeat(w.start[keep], n) + k]
        edge = place[w.first]
        raw = out.tobytes()
        texts = [raw[a:max(a, b - 1)] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
        turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        begin, stop = turn[0::2], turn[1::2]
        inner = np.unique(w.first[1:-1])                            # spans end with their row
        split = inner[(np.searchsorted(begin, inner, side="left") > np.searchsorted(stop, inner, side="right"))]
        begin, stop = np.sort(np.concatenate([begin, split])), np.sort(np.concatenate([stop, split]))
        at_row = w.row[begin] if len(begin) else begin
        spans = [[] for _ in range(block.num_rows)]
        for r, a, b in zip(at_row.tolist(), begin.tolist(), stop.tolist()):
            spans[r].append({"first": a - int(w.first[r]), "words": b - a})
        own = {f: block.column(f) for f in names}
        return own | {"kept_text": pa.array(texts, pa.binary()).cast(pa.string()), "n_words": np.diff(w.first),
                      "n_removed": X.per_row(gone, w.first), "spans": spans}

    return by_blocks(beside(rows, buckets, leaves, "left").drop("bucket", "rid"), "text", cut, schema, _BLOCK)
