"""Ranked lexical search: MaxScore with pair bounds over a segmented index.

Index. A segment holds some thousand consecutive documents: its distinct terms and, term by
term, the documents with their occurrences. Nothing is shuffled to build it; a very common term
is in every segment, so no list grows beyond a segment. The lexicon (documents a term) is one
aggregation over the segments. A second pass turns occurrences into impacts, keeps the greatest
impact of every term, and for each pair of the ``PAIR_TERMS`` commonest terms of the corpus the
greatest joint impact over the documents that hold both (their intersection list's maximum).

Search. The items are taken in blocks of bounded size and sent to every segment. In a segment
the terms of an item are ordered by their greatest contribution. What the last terms can add
together is bounded by a matching: two terms of a known pair add no more than their joint
maximum or the larger of the two alone, which is tighter than the sum of both maxima. Lists are
read while that bound reaches the tenth best score so far; the remaining lists are only probed
for documents that may still reach it. The bound never cuts a document off that ties.

Scores are integers: a term's weight w is floor(1000 ln((2N+2)/(2df+1))), a document's m is
100-90+(90 n N) div L, its score the sum of w ((10^9 tf) div (1000 tf + 8 m)).

Defined cases: null and empty texts have no terms and are never found; equal scores go by
ascending doc_id, null last; repeated rows of either table count each for itself; an item
without terms, or whose terms no document holds, gives no rows; empty tables give none; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from eventweave.llm import textops as X
from eventweave.llm.frames import arrow_schema, need, record_batch, stored, stored_at
from eventweave.session import work_dir
from eventweave.sinks.tables import remove_folder

#: Bytes of text and documents of a segment at most (one longer text is a segment of its own).
SEGMENT_BYTES, SEGMENT_DOCS = 8 << 20, 16_384
#: The commonest terms, whose pairs get joint maxima.
PAIR_TERMS = 64
#: Terms of the items of one block (repeats between items included).
BLOCK_TERMS = 200_000

_APART = np.zeros(256, bool)
_APART[[b for b in range(128) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

SEGMENT = "doc_ids array<long>, n binary, with_terms long, total long, terms binary, ends binary, first binary, docs binary, tf binary"
INDEX = "doc_ids array<long>, terms binary, ends binary, first binary, docs binary, impact binary, top binary, joint binary"


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[X.Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words, folded bytes, number of each word's term, first word of each term). Words are
    grouped by hash and compared by their bytes."""
    w = X.split_words(data, offsets, _APART, _LOWER)
    folded = _LOWER[data]
    _, at, term = np.unique(w.hash, return_index=True, return_inverse=True)
    size, like = w.end - w.start, at[term]
    more = np.flatnonzero(like != np.arange(len(like)))
    same = size[more] == size[like[more]]
    same[same] = X.same_bytes(folded, w.start[more[same]], folded, w.start[like[more[same]]], size[more[same]])
    if not same.all():          # different terms with one hash
        raw, known = folded.tobytes(), {}
        term = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(w.start.tolist(), w.end.tolist())], np.int64)
        at = np.unique(term, return_index=True)[1]
    return w, folded, term, at


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the spans' bytes put together, offsets)."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    return data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])], offsets


def segment(ids: pa.Array, texts: pa.Array) -> dict:
    """The inverted lists of some documents."""
    data, offsets = X.column_bytes(texts)
    w, folded, term, at = terms_of(data, offsets)
    rows = len(offsets) - 1
    place, tf = np.unique(term * rows + w.row, return_counts=True)
    n = np.diff(w.first)
    blob, ends = _spans(folded, w.start[at], w.end[at])
    return {"doc_ids": [ids], "n": n.astype("<i4").tobytes(), "with_terms": int((n > 0).sum()), "total": int(n.sum()),
            "terms": blob.tobytes(), "ends": ends.astype("<i4").tobytes(),
            "first": np.searchsorted(place, np.arange(len(at) + 1) * rows).astype("<i4").tobytes(),
            "docs": (place % max(rows, 1)).astype("<u2").tobytes(), "tf": tf.astype("<i4").tobytes()}


def segments(docs: DataFrame) -> DataFrame:
    """One row a segment."""
    target = _parse_datatype_string(SEGMENT)

    def emit(parts: list[pa.RecordBatch], schema: pa.Schema) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        got = segment(t.column(0).chunk(0), t.column(1).chunk(0))
        ids = got["doc_ids"][0].cast(pa.int64())
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return record_batch({k: lists if k == "doc_ids" else [v] for k, v in got.items()}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, parts, size, rows = arrow_schema(target), [], 0, 0
        X.drop_worker_tables()
        for batch in batches:
            for block in X.blocks(batch, "text", SEGMENT_BYTES):
                own = int(X.column_bytes(block.column("text"))[1][-1])
                if parts and (size + own > SEGMENT_BYTES or rows + block.num_rows > SEGMENT_DOCS):
                    yield emit(parts, schema)
                    parts, size, rows = [], 0, 0
                parts.append(block)
                size, rows = size + own, rows + block.num_rows
                if rows > SEGMENT_DOCS:         # batches larger than a segment
                    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    for lo in range(0, rows, SEGMENT_DOCS):
                        yield emit([whole.slice(lo, SEGMENT_DOCS)], schema)
                    parts, size, rows = [], 0, 0
        if parts:
            yield emit(parts, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, target)


def _numbers(raw, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(raw, kind)


def _terms(terms: bytes, ends: bytes) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) // 4 - 1, [None, pa.py_buffer(ends), pa.py_buffer(terms)])


def lexicon(parts: DataFrame) -> DataFrame:
    """``term, df`` of every term of the corpus."""
    def run(batches):
        for batch in batches:
            for terms, ends, first in zip(*(batch.column(c).to_pylist() for c in range(3))):
                yield pa.RecordBatch.from_arrays([_terms(terms, ends), pa.array(np.diff(_numbers(first)).astype(np.int64))], names=["term", "df"])

    return parts.select("terms", "ends", "first").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m), m from the documents' lengths."""
    m = 10 + (90 * n_docs * n.astype(np.int64)) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def joint_maxima(rows: int, lists: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Greatest sum of two lists' contributions over the documents that both hold (0: none)."""
    value, held = np.zeros((len(lists), rows), np.int64), np.zeros((len(lists), rows), bool)
    for i, (docs, v) in enumerate(lists):
        value[i, docs], held[i, docs] = v, True
    out = np.zeros((len(lists), len(lists)), np.int64)
    for i, (docs, _) in enumerate(lists):
        if len(docs):
            both = held[:, docs]
            out[i] = np.where(both, value[:, docs] + value[i, docs], 0).max(axis=1)
    return out


@dataclass
class Index:
    """The stored segments with impacts, the lexicon, and the numbers of the corpus."""
    segments: DataFrame
    lexicon: DataFrame
    n_docs: int
    total: int
    common: list[bytes]


def build(docs: DataFrame) -> Index:
    """Index every document."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    path = work_dir(spark, "segments")
    parts = stored_at(segments(docs), path, compression="zstd")
    sums = parts.agg(F.sum("with_terms").alias("n"), F.sum("total").alias("l")).first()
    n_docs, total = int(sums["n"] or 0), int(sums["l"] or 0)
    words = stored(lexicon(parts), "lexicon", compression="zstd")
    common = words.orderBy(F.desc("df"), "term").limit(PAIR_TERMS).collect()
    frequent = [bytes(r["term"]) for r in common]
    target = _parse_datatype_string(INDEX)
    shared = spark.sparkContext.broadcast((pa.array(frequent, pa.binary()), [weight(n_docs, r["df"]) for r in common]))

    def run(batches):
        schema = arrow_schema(target)
        names, weights = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("n", "terms", "ends", "first", "docs", "tf")}
                n, first, at, tf = _numbers(row["n"]), _numbers(row["first"]), _numbers(row["docs"], "<u2"), _numbers(row["tf"]).astype(np.int64)
                t = impacts(tf, n[at], n_docs, total)
                top = np.maximum.reduceat(t, first[:-1]) if len(t) else t
                where = pc.index_in(names, value_set=_terms(row["terms"], row["ends"])).to_pylist()
                lists = [(at[first[k]:first[k + 1]], w * t[first[k]:first[k + 1]]) if k is not None else (at[:0], t[:0]) for k, w in zip(where, weights)]
                yield record_batch({"doc_ids": batch.column("doc_ids").slice(i, 1), "terms": [row["terms"]], "ends": [row["ends"]], "first": [row["first"]],
                                    "docs": [row["docs"]], "impact": [t.astype("<i4").tobytes()], "top": [top.astype("<i4").tobytes()],
                                    "joint": [joint_maxima(len(n), lists).tobytes()]}, schema)

    own = parts.drop("with_terms", "total").mapInArrow(run, INDEX)
    index = stored(own, "index", compression="zstd")
    remove_folder(spark, path)          # its last reader is done
    return Index(index, words, n_docs, total, frequent)


@dataclass
class Items:
    """A block of items: their terms by number, and each term's weight and place among the pairs."""
    ids: list
    names: pa.Array             # the block's distinct terms
    weights: np.ndarray
    pair: np.ndarray            # number among the commonest terms, or -1
    queries: list[np.ndarray]   # numbers of each item's terms


def suffix_bounds(top: np.ndarray, pair: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """What the terms from the i-th on can add together, for every i (0 behind the last). Terms
    of known pairs are matched from the end on, each with the one that saves most."""
    k = len(top)
    saving = np.zeros(k, np.int64)
    own = np.flatnonzero(pair >= 0)
    if len(own) > 1:
        a, b = top[own][:, None], top[own][None, :]
        saved = np.maximum(a + b - np.maximum(joint[np.ix_(pair[own], pair[own])], np.maximum(a, b)), 0)
        free = np.zeros(len(own), bool)
        for i in range(len(own) - 1, -1, -1):
            gain = saved[i] * free
            j = int(gain.argmax())
            if gain[j] > 0:
                saving[own[i]] = gain[j]
                free[j] = False
            else:
                free[i] = True
    out = np.zeros(k + 1, np.int64)
    out[:-1] = np.cumsum((top - saving)[::-1])[::-1]
    return out


def _tenth(scores: np.ndarray, k: int) -> int:
    """The k-th largest (0 if there are fewer)."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_item(where: np.ndarray, weights: np.ndarray, pair: np.ndarray, first: np.ndarray, docs: np.ndarray, impact: np.ndarray,
                top: np.ndarray, joint: np.ndarray, rows: int, least: int, k: int, read: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(documents of a segment that score ``least`` or more, their scores); those surely below the
    k-th best may be left out. ``read`` counts list entries that were added up or probed."""
    none = np.zeros(0, np.int64)
    ub = weights * top[where]
    order = np.argsort(-ub, kind="stable")
    order = order[ub[order] > 0]
    bound = suffix_bounds(ub[order], pair[order], joint)
    if not len(order) or bound[0] < least:
        return none, none
    score, i, step = np.zeros(rows, np.int64), 0, 1
    while i < len(order) and bound[i] >= least:
        a, b = first[where[order[i]]], first[where[order[i]] + 1]
        score[docs[a:b]] += weights[order[i]] * impact[a:b]
        i += 1
        if read is not None:
            read.append(int(b - a))
        if i == step:           # partial scores already bound the k-th best
            least, step = max(least, _tenth(score, k)), 2 * step
    found = np.flatnonzero(score)
    least = max(least, _tenth(score[found], k))
    found = found[score[found] + bound[i] >= least]
    for j in range(i, len(order)):
        if not len(found):
            break
        a, b = first[where[order[j]]], first[where[order[j]] + 1]
        own = docs[a:b]
        at = np.minimum(np.searchsorted(own, found), len(own) - 1)
        hit = own[at] == found
        score[found[hit]] += weights[order[j]] * impact[a:b][at[hit]]
        found = found[score[found] + bound[j + 1] >= least]
        if read is not None:
            read.append(int(len(found)))
    return found, score[found]


def _best(score: np.ndarray, doc: np.ndarray, known: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then lowest doc_id, null last."""
    return np.lexsort((doc, ~known, -score))[:k]


def search_block(index: DataFrame, items: Items, k: int) -> DataFrame:
    """``query, item_id, doc_id, score`` of every task's best documents."""
    shared = index.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        q = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in q.queries]
        least = np.ones(len(q.queries), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in INDEX_BINARY}
                ids = batch.column("doc_ids").slice(i, 1).flatten()
                doc, known = np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid())
                place = np.asarray(pc.index_in(q.names, value_set=_terms(row["terms"], row["ends"])).fill_null(-1))
                first, docs, impact, top = _numbers(row["first"]), _numbers(row["docs"], "<u2"), _numbers(row["impact"]), _numbers(row["top"])
                size = math.isqrt(len(row["joint"]) // 8)
                joint = _numbers(row["joint"], "<i8").reshape(size, size)
                for n, terms in enumerate(q.queries):
                    terms = terms[place[terms] >= 0]
                    found, score = search_item(place[terms], q.weights[terms], q.pair[terms], first, docs, impact, top, joint, len(doc), int(least[n]), k)
                    if len(found):
                        s, d, v = (np.concatenate(p) for p in zip(best[n], (score, doc[found], known[found])))
                        keep = _best(s, d, v, k)
                        best[n] = s[keep], d[keep], v[keep]
                        if len(keep) == k:
                            least[n] = max(1, s[keep[-1]])
        size = [len(s) for s, *_ in best]
        if sum(size):
            s, d, v = (np.concatenate(p) for p in zip(*best))
            number = np.repeat(np.arange(len(size)), size)
            yield pa.RecordBatch.from_pydict({"query": pa.array(number, pa.int32()), "item_id": pa.array(q.ids, pa.int64()).take(pa.array(number)),
                                              "doc_id": pa.array(d, mask=~v), "score": pa.array(s)})

    return index.mapInArrow(run, "query int, item_id long, doc_id long, score long")


INDEX_BINARY = ("terms", "ends", "first", "docs", "impact", "top", "joint")


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and the distinct terms of every item."""
    def run(batches):
        for batch in batches:
            data, offsets = X.column_bytes(batch.column(1))
            w, folded, term, at = terms_of(data, offsets)
            place = np.unique(w.row * max(len(at), 1) + term)
            blob, ends = _spans(folded, w.start[at], w.end[at])
            names = _terms(blob.tobytes(), ends.astype("<i4").tobytes())
            edge = np.searchsorted(place, np.arange(batch.num_rows + 1) * max(len(at), 1)).astype(np.int32)
            own = names.take(pa.array(place % max(len(at), 1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(edge), own)], names=["item_id", "terms"])

    return (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "item_id long, terms array<binary>").filter(F.size("terms") > 0))


def _block(index: Index, rows: list) -> Items:
    """Weights and places of the terms of some items (the lexicon is joined with them)."""
    spark = index.segments.sparkSession
    number: dict[bytes, int] = {}
    queries = [np.array([number.setdefault(bytes(t), len(number)) for t in r["terms"]], np.int64) for r in rows]
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in number], "term binary"))      # BLOCK_TERMS and one item at most
    df = {bytes(r["term"]): r["df"] for r in index.lexicon.join(wanted, "term", "left_semi").collect()}
    place = {t: i for i, t in enumerate(index.common)}
    return Items([r["item_id"] for r in rows], pa.array(list(number), pa.binary()),
                 np.array([weight(index.n_docs, df[t]) if t in df else 0 for t in number], np.int64),
                 np.array([place.get(t, -1) for t in number], np.int64), queries)


def search(index: Index, items: DataFrame, *, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents with a score above 0 of every item."""
    need(items, "item_id", "text")
    spark = items.sparkSession
    path = work_dir(spark, "found")
    schema = "item_id long, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)

    def answer(rows: list) -> None:
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = search_block(index.segments, _block(index, rows), k)
        (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
         .select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path))

    rows, size = [], 0
    for r in stored(item_terms(items), "items").toLocalIterator():      # a block of items at a time
        if rows and size + len(r["terms"]) > block_terms:
            answer(rows)
            rows, size = [], 0
        rows.append(r)
        size += len(r["terms"])
    if rows:
        answer(rows)
    return spark.read.schema(schema).parquet(path)


#: The same ranking in SQL.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
tf AS MATERIALIZED (SELECT r, any_value(doc_id) AS doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM w GROUP BY r, term),
nn AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
g AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS l FROM nn),
m AS (SELECT r, 100 - 90 + ((90 * n * nd) // l) AS m FROM nn, g),
df AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, g),
b AS (SELECT row_number() OVER () AS q, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
bt AS (SELECT DISTINCT q, item_id, term FROM (SELECT q, item_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM b) x),
s AS (SELECT q, any_value(item_id) AS item_id, tf.r, any_value(tf.doc_id) AS doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM bt JOIN wt USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r GROUP BY q, tf.r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0) t
WHERE rank <= 10"""
