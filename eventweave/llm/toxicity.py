"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

Weights: for every token and every token stem (its first 4 to 7 bytes) the log-odds of
occurring in a toxic against a clean labelled document, with a Dirichlet prior that follows
the corpus, so that unseen features weigh nothing; features whose z-score is below ``Z``,
whose log-odds are below ``WEAK`` or that fewer than ``LEAST`` toxic documents hold are left out. A token scores the largest
weight among its features, any other token ``-DRIFT``.

Segments: one linear scan finds all maximal-scoring segments of a text (the partition by
Ruzzo and Tompa). Scores of segments in clean text have an exponential tail; from its rate
and density a segment of score S among n tokens has the E-value K n exp(-lambda S). A text's
evidence is the sum of -ln E over its segments with E below 1, and the share of toxic
labelled texts at each level of evidence (a monotone fit) makes it a probability.

The model is fitted on at most about ``MAX_LABELLED`` labelled rows, chosen by a hash of
doc_id; every document is scored from its whole text.

Defined cases: null and empty texts have no segments and get the probability of no evidence;
without toxic labels every text gets 0; repeated rows score alike; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm import textops as X
from eventweave.llm.frames import by_blocks, labelled, longs, need

STEMS = (4, 5, 6, 7)
Z, LEAST, WEAK, DRIFT = 3.3, 4, 1.5, 0.5
MAX_LABELLED = 200_000

_APART = X.SPACE.copy()
_APART[[b for b in range(128) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[X.Words, list[np.ndarray]]:
    """Tokens (ASCII case folded, ASCII signs apart) and, for each, the hashes of the token
    and of its stems."""
    w = X.split_words(data, offsets, _APART, _LOWER)
    out = [w.hash]
    for k in STEMS:
        h = np.empty(len(w.hash), np.uint64)
        for lo in range(0, len(h), 1 << 17):        # spans of a slice of words lie close together
            s, e = w.start[lo:lo + (1 << 17)], w.end[lo:lo + (1 << 17)]
            base = int(s[0])
            part = _LOWER[data[base:int(e[-1])]]
            h[lo:lo + len(s)] = X.byte_hashes(part, s - base, np.minimum(e, s + k) - base)
        out.append(h ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return w, out


@dataclass
class Model:
    key: np.ndarray             # sorted feature hashes
    weight: np.ndarray
    rate: float                 # lambda
    density: float              # K
    level: np.ndarray           # evidence steps and the probability from each on
    chance: np.ndarray


def maximal_segments(position: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a text whose tokens score ``score``
    at ``position`` and ``-drift`` elsewhere; one pass with a stack of candidates."""
    stack: list[list[float]] = []       # [first, last, sum before, sum to the end]
    total, last = 0.0, -1
    for p, s in zip(position.tolist(), score.tolist()):
        total -= drift * (p - last - 1)
        own = [p, p, total, total + s]
        total, last = own[3], p
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= own[2]:
                j -= 1
            if j < 0 or stack[j][3] >= own[3]:
                stack.append(own)
                break
            own = [stack[j][0], own[1], stack[j][2], own[3]]
            del stack[j:]
    return [(int(a), int(b), z - l) for a, b, l, z in stack]


def hot_tokens(block: pa.RecordBatch, key: np.ndarray, weight: np.ndarray) -> tuple[X.Words, np.ndarray, np.ndarray]:
    """(tokens, indexes of those that hold a feature, their scores)."""
    w, own = features(*X.column_bytes(block.column("text")))
    score = np.zeros(len(w.hash))
    if len(key):
        for h in own:
            at = np.minimum(np.searchsorted(key, h), len(key) - 1)
            score = np.maximum(score, np.where(key[at] == h, weight[at], 0.0))
    at = np.flatnonzero(score > 0)
    return w, at, score[at]


def text_segments(block: pa.RecordBatch, key: np.ndarray, weight: np.ndarray) -> list[tuple[int, list[tuple[int, int, float]]]]:
    """Per row: (tokens, maximal segments by token index)."""
    w, at, score = hot_tokens(block, key, weight)
    edge = np.searchsorted(at, w.first)
    return [(int(w.first[r + 1] - w.first[r]),
             maximal_segments(at[edge[r]:edge[r + 1]] - w.first[r], score[edge[r]:edge[r + 1]], DRIFT) if edge[r + 1] > edge[r] else [])
            for r in range(block.num_rows)]


def evidence(tokens: int, segments: list, rate: float, density: float) -> float:
    least = np.log(max(density * max(tokens, 1), 1e-300))
    return float(sum(x for *_, s in segments if (x := rate * s - least) > 0))


def monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the non-decreasing fit of y on x (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    level, first = np.unique(x[order], return_index=True)
    sums = np.add.reduceat(y[order].astype(float), first)
    size = np.diff(np.concatenate([first, [len(x)]])).astype(float)
    pools: list[list[float]] = []
    for v, s, n in zip(level.tolist(), sums.tolist(), size.tolist()):
        pools.append([v, s, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, s, n = pools.pop()
            pools[-1][1] += s
            pools[-1][2] += n
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(docs: DataFrame, labels: DataFrame, *, most_labelled: int = MAX_LABELLED) -> Model:
    """Fit weights, tail and calibration on labelled documents."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    known = F.broadcast(labelled(labels, "toxic", most_labelled))       # bounded by most_labelled
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id")
    size = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    none = np.zeros(0)
    if not n1:
        return Model(none.astype(np.uint64), none, 1.0, 1.0, np.zeros(1), np.zeros(1))

    def present(only: np.ndarray | None):
        def run(block: pa.RecordBatch) -> dict:
            w, own = features(*X.column_bytes(block.column("text")))
            h, row = np.concatenate(own), np.concatenate([w.row] * len(own))
            if only is not None and len(only):
                keep = only[np.minimum(np.searchsorted(only, h), len(only) - 1)] == h
                h, row = h[keep], row[keep]
            o = X.ordered(h, row)
            h, row = h[o], row[o]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            uniq, n = np.unique(h[first], return_counts=True)
            return {"feature": longs(uniq), "n": n}
        return run

    def holders(part: DataFrame, only: np.ndarray | None = None) -> DataFrame:
        return by_blocks(part.select("text"), "text", present(only), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))

    # features of toxic documents first: the labelled sample bounds how many there are
    seen = holders(texts.filter("label = 1")).filter(F.col("n") >= LEAST).toPandas()
    feature = seen["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(feature)
    feature, y1 = feature[order], seen["n"].to_numpy(float)[order]
    y0 = np.zeros(len(feature))
    if len(feature):
        clean = holders(texts.filter("label = 0"), feature).toPandas()
        y0[np.searchsorted(feature, clean["feature"].to_numpy(np.int64).view(np.uint64))] = clean["n"].to_numpy(float)
    odds = n0 / n1
    prior = np.maximum(0.5, 0.01 * (y1 + y0) / (1 + odds))      # pseudo-documents; the clean prior is odds times as large
    a1, a0 = y1 + prior, y0 + prior * odds
    delta = np.log(a1 / (n1 + 1)) - np.log(a0 / (n0 + odds))
    keep = (delta / np.sqrt(1 / a1 + 1 / a0) >= Z) & (delta >= WEAK)
    key, weight = feature[keep], delta[keep]

    def scan(block: pa.RecordBatch) -> dict:
        rows = text_segments(block, key, weight)
        return {"label": block.column("label"), "tokens": [n for n, _ in rows], "scores": [[s for *_, s in x] for _, x in rows]}

    # one row a labelled document, with the scores of its few segments
    got = by_blocks(texts.select("label", "text"), "text", scan, "label int, tokens long, scores array<double>").toPandas()
    tail = np.array([s for l, x in zip(got["label"], got["scores"]) if l == 0 for s in x])
    clean_tokens = max(1, int(got.loc[got["label"] == 0, "tokens"].sum()))
    least = float(tail.min()) if len(tail) else 1.0
    rate = 1.0 / max(float(tail.mean()) - least, 0.05) if len(tail) > 1 else 1.0
    rate = min(rate, 4.0)
    density = max(len(tail), 1) / clean_tokens * float(np.exp(rate * least))
    x = np.array([evidence(n, [(0, 0, v) for v in s], rate, density) for n, s in zip(got["tokens"], got["scores"])])
    level, chance = monotone(np.round(x, 6), got["label"].to_numpy())
    return Model(key, weight, rate, density, level, chance)


def probability(x: np.ndarray, model: Model) -> np.ndarray:
    at = np.maximum(np.searchsorted(model.level, np.round(x, 6), side="right") - 1, 0)
    return 0.999 * model.chance[at] + 0.001 * x / (1 + x)


def score(docs: DataFrame, model: Model, *, cut: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted, evidence, passages`` of every row; a passage is the first
    token, the number of tokens and the score of a significant segment."""
    need(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(block: pa.RecordBatch) -> dict:
        m = shared.value
        rows = text_segments(block, m.key, m.weight)
        x = np.array([evidence(n, s, m.rate, m.density) for n, s in rows])
        p = probability(x, m)
        least = [np.log(max(m.density * max(n, 1), 1e-300)) for n, _ in rows]
        found = [[{"first": a, "tokens": b - a + 1, "score": z} for a, b, z in s if m.rate * z > l] for (_, s), l in zip(rows, least)]
        return {"doc_id": block.column("doc_id"), "score": p, "predicted": (p >= cut).astype(np.int32), "evidence": x, "passages": found}

    return by_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", run,
                     "doc_id long, score double, predicted int, evidence double, "
                     "passages array<struct<first:long,tokens:long,score:double>>")
