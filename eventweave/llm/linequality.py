"""Quality classifier: a linear-chain conditional random field over the lines of a text.

A line (with a word; lines are cut at line breaks) has features of its characters, words and
repeats and the mean log-ratio of its byte n-grams between good and bad labelled texts; its own
features stand beside those of the line before and the line after. The field labels every line
good or bad; a text's quality is the mean of its lines' forward-backward chances of being good,
weighted by their length, brought to a probability by a logistic fit.

Labels are given for texts. Lines of good texts are good; a bad text holds at least one bad line:
a model without the chain says which of its lines are, its worst line always, and the field learns
from those. Three parts of the labelled rows, chosen by a hash of doc_id, teach the n-grams, the
field and the logistic fit. The field and the fit use at most about ``MAX_LINES`` lines, of texts
of at most ``MAX_TEXT_LINES`` lines (a bound on the training sample only: every text is scored from all its lines);
n-gram counts come from at most about ``MAX_LABELLED`` rows and are summed on the executors.

Defined cases: null, empty and blank texts have no lines and get the share of good labels; so does
every text if the labels are all alike, and 0.5 if there are none; conflicting labels of a document
count as bad; repeated rows score alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm import textops as X
from eventweave.llm.crf import Chain, train
from eventweave.llm.frames import by_blocks, labelled, need

GRAM, GRAM_BITS = 4, 16
#: N-gram weights are integers in this unit, so sums do not depend on how rows are grouped.
UNIT = 1e-4
MAX_LABELLED = 200_000
MAX_LINES, MAX_TEXT_LINES = 120_000, 2_000
_BLOCK = 2 << 20


def _mask(chars) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT = _mask(range(0x41, 0x5B)), _mask(range(0x30, 0x3A))
_LETTER = _mask([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_SIGN = _mask([b for b in range(0x21, 0x7F) if not chr(b).isalnum()])
_MARKUP, _BANG, _STOP, _COMMA = _mask(b"#*$%&|<>{}[]\\^~=_@"), _mask(b"!"), _mask(b".!?:;\"')"), _mask(b",.;:'\"-?()")
_CHAR = ~_mask(range(0x80, 0xC0))

FEATURES = ("words", "chars", "word_length", "longest_word", "letters", "upper", "digits", "signs", "markup", "bangs",
            "word_end_signs", "no_letters", "same_as_last", "seen_in_line", "seen_in_text", "seen_line", "ends_sentence", "starts_upper", "grams")


@dataclass
class Lines:
    """Lines of a block of texts: features, length in characters, and each text's first line."""
    x: np.ndarray
    length: np.ndarray
    first: np.ndarray


def gram_codes(data: np.ndarray) -> np.ndarray:
    """Bucket of the byte n-gram that starts at every byte (ASCII case folded)."""
    n = max(len(data) - GRAM + 1, 0)
    low = np.where(_UPPER[data], data + 0x20, data).astype(np.uint32)
    code = np.zeros(n, np.uint32)
    for i in range(GRAM):
        code = (code << np.uint32(8)) | low[i:n + i]
    code = (code * np.uint32(0x9E3779B1)) ^ (code >> np.uint32(15))
    return ((code * np.uint32(0x85EBCA77)) >> np.uint32(32 - GRAM_BITS)).astype(np.int32)


def line_spans(data: np.ndarray, offsets: np.ndarray, w: X.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first line of every row) of the lines that hold a word."""
    begin = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 0x0A) + 1]))
    begin = begin[begin < len(data)]
    stop = np.concatenate([begin[1:], [len(data)]]).astype(np.int64)
    stop = stop - (data[stop - 1] == 0x0A) if len(stop) else stop
    has = np.searchsorted(w.start, stop) > np.searchsorted(w.start, begin)
    begin, stop = begin[has], stop[has]
    return begin, stop, np.searchsorted(begin, offsets)


def lines(data: np.ndarray, offsets: np.ndarray, grams: np.ndarray | None) -> Lines:
    """The lines of every row and their features; ``grams`` is the weight of every bucket."""
    w = X.split_words(data, offsets)
    begin, stop, first = line_spans(data, offsets, w)
    k = len(begin)
    if not k:
        return Lines(np.zeros((0, len(FEATURES))), np.zeros(0), first)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    one, end = np.searchsorted(w.start, begin), np.searchsorted(w.start, stop)
    words = (end - one).astype(float)

    def over(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(values)])
        return (c[b] - c[a]).astype(float)

    def chars(mask: np.ndarray) -> np.ndarray:
        return over(mask[data], begin, stop)

    size = chars(_CHAR)
    line_of = np.searchsorted(begin, w.start, side="right") - 1
    as_last = np.zeros(len(w.hash), bool)
    as_last[1:] = (w.hash[1:] == w.hash[:-1]) & (line_of[1:] == line_of[:-1])
    in_line = X.repeated_in_row(line_of, w.hash)[1]
    in_text = X.repeated_in_row(w.row, w.hash)[1]
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    length = w.end - w.start
    sign_end = _SIGN[data[w.end - 1]] & ~_COMMA[data[w.end - 1]]
    seen = X.repeated_in_row(row, X.byte_hashes(data, begin, stop))[1]
    gram = np.zeros(k)
    if grams is not None and len(data) >= GRAM:
        value = grams[gram_codes(data)]
        inner = np.minimum(np.maximum(stop - GRAM + 1, begin), len(value))
        gram = over(value, np.minimum(begin, inner), inner) * UNIT / np.maximum(inner - begin, 1)
    columns = [
        np.log1p(words), np.log1p(size), over(length, one, end) / words,
        np.log1p(np.maximum.reduceat(length, one)), chars(_LETTER) / size, chars(_UPPER) / size, chars(_DIGIT) / size, chars(_SIGN) / size, chars(_MARKUP) / size,
        chars(_BANG) / size, over(sign_end, one, end) / words, over(letters[w.end] == letters[w.start], one, end) / words,
        over(as_last, one, end) / words, over(in_line, one, end) / words, over(in_text, one, end) / words, seen.astype(float),
        _STOP[data[w.end[end - 1] - 1]].astype(float), _UPPER[data[w.start[one]]].astype(float), gram]
    return Lines(np.stack(columns, axis=1), size, first)


def beside(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features with those of the line before and after it (zeros at a text's ends)
    and marks of the ends."""
    n = len(x)
    begins, ends = np.zeros((n, 1)), np.zeros((n, 1))
    some = np.diff(first) > 0
    begins[first[:-1][some]] = 1
    ends[first[1:][some] - 1] = 1
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    return np.concatenate([x, before * (1 - begins), after * (1 - ends), begins, ends], axis=1)


@dataclass
class Model:
    grams: np.ndarray           # weight of every n-gram bucket
    middle: np.ndarray          # of every feature, for scaling
    spread: np.ndarray
    chain: Chain | None
    slope: float                # of the logistic fit
    base: float
    share: float                # of good labels

    def line_chances(self, found: Lines) -> np.ndarray:
        return self.chain.label_chances(beside((found.x - self.middle) / self.spread, found.first), found.first)


def text_quality(chance: np.ndarray, found: Lines) -> np.ndarray:
    """Length-weighted mean of the lines' chances (nan without lines)."""
    total = X.per_row_float(found.length, found.first)
    with np.errstate(invalid="ignore", divide="ignore"):
        return X.per_row_float(chance * found.length, found.first) / total


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-6, 1 - 1e-6)
    return np.log(q / (1 - q))


def line_labels(chance: np.ndarray, good: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels of lines: all good in a good text; in a bad one those with a chance of a half, but
    its worst line is bad."""
    of = np.repeat(np.arange(len(good)), np.diff(first))
    y = (good[of] == 1) | (chance >= 0.5)
    order = np.lexsort((chance, of))
    worst = order[first[:-1][np.diff(first) > 0]]
    y[worst[good[of[worst]] == 0]] = False
    return y.astype(np.int64)


def gram_weights(texts: DataFrame) -> np.ndarray:
    """Log-ratio (in ``UNIT``) of every n-gram bucket between good and bad texts (``text, label``)."""
    buckets = 1 << GRAM_BITS

    def count(batches):
        sums = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for block in X.blocks(batch, "text", _BLOCK):
                data, offsets = X.column_bytes(block.column("text"))
                code = gram_codes(data)
                label = np.repeat(np.asarray(block.column("label")), np.diff(offsets))[:len(code)]
                for y in (0, 1):
                    sums[y] += np.bincount(code[label == y], minlength=buckets)
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "bad": pa.array(sums[0, some]), "good": pa.array(sums[1, some])})

    got = (texts.select("text", "label").mapInArrow(count, "bucket int, bad long, good long").groupBy("bucket")
           .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas())         # 2^GRAM_BITS rows at most
    n = np.zeros((2, buckets))
    n[0, got["bucket"]], n[1, got["bucket"]] = got["bad"], got["good"]
    prior = (n.sum(axis=0) + 1) / (n.sum() + buckets)
    held = [np.log((n[y] + 1000 * prior) / (n[y].sum() + 1000)) for y in (0, 1)]
    return np.round(np.clip(held[1] - held[0], -4, 4) / UNIT).astype(np.int64)


def _sample(texts: DataFrame, grams: np.ndarray, most_lines: int) -> tuple[Lines, np.ndarray]:
    """(lines, label of every text) of a bounded sample."""
    shared = texts.sparkSession.sparkContext.broadcast(grams)

    def size(block: pa.RecordBatch) -> dict:
        data, offsets = X.column_bytes(block.column("text"))
        return {"doc_id": block.column("doc_id"), "lines": np.diff(line_spans(data, offsets, X.split_words(data, offsets))[2])}

    sizes = by_blocks(texts.select("doc_id", "text"), "text", size, "doc_id long, lines long", _BLOCK).filter(F.col("lines").between(1, MAX_TEXT_LINES))
    total = sizes.agg(F.sum("lines")).first()[0] or 0
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most_lines / max(total, 1)))

    def features(block: pa.RecordBatch) -> dict:
        found = lines(*X.column_bytes(block.column("text")), shared.value)
        cells = found.first * len(FEATURES)
        return {"label": block.column("label"), "x": pa.ListArray.from_arrays(pa.array(cells.astype(np.int32)), pa.array(found.x.astype(np.float32).ravel())),
                "length": pa.ListArray.from_arrays(pa.array(found.first.astype(np.int32)), pa.array(found.length))}

    rows = by_blocks(texts.filter(chosen).select("label", "text"), "text", features, "label int, x array<float>, length array<double>", _BLOCK)
    got = rows.filter(F.size("length").between(1, MAX_TEXT_LINES)).toArrow()         # most_lines lines in expectation
    first = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(got["length"])))]).astype(np.int64)
    x = np.asarray(pa.compute.list_flatten(got["x"]), float).reshape(-1, len(FEATURES))
    return Lines(x, np.asarray(pa.compute.list_flatten(got["length"]), float), first), np.asarray(got["label"])


def fit(docs: DataFrame, labels: DataFrame, *, most_lines: int = MAX_LINES, most_labelled: int = MAX_LABELLED) -> Model:
    """Learn from labelled texts."""
    need(docs, "doc_id", "text")
    known = F.broadcast(labelled(labels, "quality", most_labelled))       # bounded by most_labelled
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    size = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, every = size.get(1, 0), sum(size.values())
    share = good / every if every else 0.5
    none = Model(np.zeros(0), np.zeros(0), np.zeros(0), None, 0.0, 0.0, share)
    if not 0 < good < every:
        return none
    grams = gram_weights(texts.filter(part == 0))
    teach, label = _sample(texts.filter(part == 1), grams, most_lines)
    rest, truth = _sample(texts.filter(part == 2), grams, most_lines)
    if len(set(label.tolist())) < 2 or len(set(truth.tolist())) < 2:        # few labelled rows: no parts
        teach, label = rest, truth = _sample(texts, grams, most_lines)
        if len(set(label.tolist())) < 2:
            return none
    middle, spread = teach.x.mean(axis=0), teach.x.std(axis=0) + 1e-6
    x = beside((teach.x - middle) / spread, teach.first)
    n = np.maximum(np.diff(teach.first), 1)
    weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1)) * len(label) / n      # a text counts once, both labels alike
    y = np.repeat((label == 1).astype(np.int64), np.diff(teach.first))
    for _ in range(2):
        alone = train(x, y, teach.first, weight, chained=False)
        y = line_labels(1 / (1 + np.exp(-np.clip(x @ alone.weight[:-1] + alone.weight[-1], -500, 500))), label, teach.first)
    model = Model(grams, middle, spread, train(x, y, teach.first, weight), 1.0, 0.0, share)
    q = _logit(text_quality(model.line_chances(rest), rest))
    curve = train(q[:, None] / 4, (truth == 1).astype(np.int64), np.arange(len(q) + 1), np.ones(len(q)), ridge=0.01, chained=False)
    model.slope, model.base = float(curve.weight[0]) / 4, float(curve.weight[1])
    return model


def score(docs: DataFrame, model: Model, *, cut: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted, n_lines, n_bad_lines, line_chances`` of every row; a line's
    chance of being good, in the order of the lines that hold a word."""
    need(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(block: pa.RecordBatch) -> dict:
        m = shared.value
        found = lines(*X.column_bytes(block.column("text")), m.grams if m.chain else None)
        n = np.diff(found.first)
        if m.chain is None:
            chance, p = np.full(len(found.length), m.share), np.full(block.num_rows, m.share)
        else:
            chance = m.line_chances(found)
            p = 1 / (1 + np.exp(-(m.slope * _logit(np.where(n > 0, text_quality(chance, found), 0.5)) + m.base)))
            p = np.where(n > 0, p, m.share)
        p = np.round(p, 12)
        return {"doc_id": block.column("doc_id"), "score": p, "predicted": (p >= cut).astype(np.int32), "n_lines": n,
                "n_bad_lines": X.per_row(chance < 0.5, found.first),
                "line_chances": pa.ListArray.from_arrays(pa.array(found.first.astype(np.int32)), pa.array(chance))}

    return by_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", run,
                     "doc_id long, score double, predicted int, n_lines long, n_bad_lines long, line_chances array<double>", _BLOCK)
