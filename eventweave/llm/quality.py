"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are estimated: one from the trusted target (rows
labelled good), one from the raw corpus (every document). A text's score is the sum of
log(target / raw) over its n-grams, divided by their number. One half of the trusted rows
teaches the target; the threshold is the score that all but ``miss`` of the other half reach,
counted over its rows that pass the base rule (for others the score decides nothing), so every
document gets a fixed verdict; it also fails when the base counts say so. Weights are integers (units of 1e-4), so a score
does not depend on how rows are grouped into batches.

The corpus counts cover all documents; the target and the threshold come from all labelled
rows. Up to ``BROADCAST_LABELLED`` of them are sent to every task; more are joined by a shuffle, which
writes no text twice: a document is of one half. Counts per bucket are summed on the executors;
the driver gets ``BUCKETS`` rows at most.

Defined cases: null and empty texts have zero counts, score 0 and fail the base rule; texts
shorter than an n-gram score 0; without trusted labels every score is 0 and the base rule
alone decides; repeated rows are judged alike; an empty table gives no rows; extra columns
are kept by ``judge`` (columns named like its own are replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from eventweave.llm import textops as X
from eventweave.llm.frames import all_labelled, by_blocks, need, percentile, stored

GRAM = 4
BUCKETS = 1 << 18
#: Labelled rows up to which they are sent to every task; the texts stay where they are then.
BROADCAST_LABELLED = 200_000
UNIT = 1e-4

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_HUGE = 16 << 20


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every byte n-gram, index of each row's first one), rows kept apart."""
    n = len(data)
    if n < GRAM:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    code = np.zeros(n - GRAM + 1, np.uint32)
    for i in range(GRAM):
        code = (code << np.uint32(8)) | data[i:n - GRAM + 1 + i]
    code = (code * np.uint32(0x9E3779B1)) ^ (code >> np.uint32(15))
    bucket = ((code * np.uint32(0x85EBCA77)) >> np.uint32(32 - 18)).astype(np.int32)
    count = np.maximum(np.diff(offsets) - GRAM + 1, 0)
    first = np.concatenate([[0], np.cumsum(count)])
    if len(offsets) > 2:        # n-grams that run into the next row go
        keep = np.arange(count.sum()) + np.repeat(offsets[:-1] - first[:-1], count)
        bucket = bucket[keep]
    return bucket, first


def _dup_lines(data: np.ndarray, offsets: np.ndarray, words: X.Words) -> np.ndarray:
    rows = len(offsets) - 1
    if len(data) > _HUGE:       # one very long text
        out = np.zeros(rows, np.int64)
        for r in range(rows):
            seen: set[bytes] = set()
            for line in bytes(data[offsets[r]:offsets[r + 1]]).split(b"\n"):
                if line.translate(None, b" \t\n\v\f\r"):
                    out[r] += line in seen
                    seen.add(line)
        return out
    if not len(data):
        return np.zeros(rows, np.int64)
    cut = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    begin = begin[begin < len(data)]
    stop = np.concatenate([begin[1:], [len(data)]])
    stop = stop - (data[stop - 1] == 0x0A)
    has = np.searchsorted(words.start, stop) > np.searchsorted(words.start, begin)
    begin, stop = begin[has], stop[has]
    h = X.byte_hashes(data, begin, stop)
    row = np.searchsorted(offsets, begin, side="right") - 1
    _, later = X.repeated_in_row(row, h)
    return np.bincount(row[later], minlength=rows)


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every row."""
    w = X.split_words(data, offsets)
    rows = len(offsets) - 1
    h, inside = X.windows_in_rows(w, 8)
    at = np.flatnonzero(inside)
    twice, _ = X.repeated_in_row(w.row[at], h[at])
    mask = X.covered(len(w.hash), at[twice], 8)
    visible = ~X.SPACE[data] & ((data & 0xC0) != 0x80)
    return {"n_words": np.diff(w.first), "word_chars": X.per_row(visible, offsets),
            "n_symbols": X.per_row(_SYMBOL[data], offsets), "n_dup_lines": _dup_lines(data, offsets, w),
            "n_repeat_words": X.per_row(mask, w.first) if len(mask) else np.zeros(rows, np.int64)}


@dataclass
class Model:
    """Integer weight of each bucket and the least mean weight that is kept."""
    weights: np.ndarray
    threshold: float


def _bucket_counts(texts: DataFrame) -> np.ndarray:
    """N-grams of all texts by bucket."""
    def count(batches):
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for block in X.blocks(batch, "text"):
                n += np.bincount(gram_buckets(*X.column_bytes(block.column("text")))[0], minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "n": pa.array(n[some])})

    out = np.zeros(BUCKETS)
    for r in texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():     # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def fit(docs: DataFrame, labels: DataFrame, *, miss: float = 0.001, broadcast_labelled: int = BROADCAST_LABELLED) -> Model:
    """Estimate both multinomials and the threshold."""
    need(docs, "doc_id", "text")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))       # one half teaches the target, the other sets the threshold
    good = all_labelled(labels, "quality").filter("label = 1").select("doc_id")
    few = good.limit(broadcast_labelled + 1).count() <= broadcast_labelled
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def trusted(own: int) -> DataFrame:
        known = good.filter(half == own)
        return texts.filter(half == own).join(F.broadcast(known) if few else known.hint("shuffle_hash"), "doc_id", "left_semi")

    raw, target = _bucket_counts(texts), _bucket_counts(trusted(0))
    if not target.sum():
        return Model(np.zeros(BUCKETS, np.int32), 0.0)
    prior = (raw + 1) / (raw.sum() + BUCKETS)       # the target is smoothed towards the corpus
    weight = 0.1 * target.sum()
    ratio = np.log((target + weight * prior) / (target.sum() + weight)) - np.log(prior)
    weights = np.round(np.clip(ratio, -8, 8) / UNIT).astype(np.int32)
    def passing(block: pa.RecordBatch) -> dict:
        n = base_counts(*X.column_bytes(block.column("text")))
        return {"score": mean_weight(block, weights)[~base_failed(n["n_words"], n["n_repeat_words"])]}

    low = percentile(stored(by_blocks(trusted(1), "text", passing, "score double"), "quality_scores"), "score", miss)
    return Model(weights, float(low) if low is not None else 0.0)


def base_failed(n_words, n_repeat_words):
    """The base rule, over columns or arrays."""
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def mean_weight(block: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    data, offsets = X.column_bytes(block.column("text"))
    bucket, first = gram_buckets(data, offsets)
    return X.per_row(weights[bucket], first) * UNIT / np.maximum(np.diff(first), 1)


VERDICT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the base counts, ``score``, ``base_failed`` and ``kept``."""
    need(docs, "text")
    own = (*VERDICT, "score")
    docs = docs.drop(*own, "base_failed", "kept")
    schema = StructType([*docs.schema.fields, *(StructField(c, LongType()) for c in VERDICT), StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    def score(block: pa.RecordBatch) -> dict:
        data, offsets = X.column_bytes(block.column("text"))
        return ({n: c for n, c in zip(block.schema.names, block.columns)} | base_counts(data, offsets)
                | {"score": mean_weight(block, shared.value)})

    counted = by_blocks(docs, "text", score, schema)
    return (counted.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(model.threshold))))
