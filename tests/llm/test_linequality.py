"""Line field: recursions against enumeration, features against plain Python, held-out accuracy."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventweave.llm import crf, linequality as L, queries, textops as X
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def enumerate_chain(unary, step):
    """(chance of label 1 everywhere, chance of every pair of labels, log sum) by all labellings."""
    n, total, one, pairs = len(unary), 0.0, np.zeros(len(unary)), np.zeros((len(unary), 2, 2))
    for y in itertools.product((0, 1), repeat=n):
        v = np.exp(sum(u * k for u, k in zip(unary, y)) + sum(step[a, b] for a, b in zip(y, y[1:])))
        total += v
        one += v * np.array(y)
        for t in range(1, n):
            pairs[t, y[t - 1], y[t]] += v
    return one / total, pairs / total, np.log(total)


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    size = [3, 1, 0, 6, 2, 0, 5]
    first = np.concatenate([[0], np.cumsum(size)])
    unary, step = rng.normal(0, 2, first[-1]), rng.normal(0, 1, (2, 2))
    p, pairs, total = crf.marginals(unary, step, first)
    for i, n in enumerate(size):
        if n:
            a, b, t = enumerate_chain(unary[first[i]:first[i + 1]], step)
            assert np.allclose(p[first[i]:first[i + 1]], a) and np.allclose(pairs[first[i]:first[i + 1]], b) and np.isclose(total[i], t)
        else:
            assert total[i] == 0


def test_long_sequences_keep_their_scale():
    unary, first = np.tile([40.0, -40.0], 3000), np.array([0, 6000])
    p, _, _ = crf.marginals(unary, np.zeros((2, 2)), first)
    assert np.allclose(p, np.tile([1, 0], 3000))


@pytest.mark.parametrize("chained", [True, False])
def test_gradient(chained):
    rng = np.random.default_rng(2)
    first = np.array([0, 4, 4, 5, 9])
    x, y, weight = rng.normal(size=(9, 3)), rng.integers(0, 2, 9), rng.uniform(0.5, 2, 4)
    theta = rng.normal(size=8)
    value, slope = crf.objective(theta, x, y, first, weight, 0.3, chained)
    for i in range(8):
        d = np.zeros(8)
        d[i] = 1e-6
        up, down = (crf.objective(theta + s * d, x, y, first, weight, 0.3, chained)[0] for s in (1, -1))
        assert np.isclose((up - down) / 2e-6, slope[i], atol=1e-5)


def test_training_finds_neighbours():
    """Labels that only the order tells: a bad line follows a marked one."""
    rng = np.random.default_rng(3)
    first = np.arange(0, 4001, 8)
    x = rng.normal(size=(4000, 1))
    y = np.ones(4000, np.int64)
    after = np.flatnonzero((x[:-1, 0] > 0.5) & (np.arange(1, 4000) % 8 != 0)) + 1
    y[after] = 0
    full = L.beside(x, first)
    chance = crf.train(full, y, first, np.ones(500), ridge=0.1).label_chances(full, first)
    assert ((chance >= 0.5) == (y == 1)).mean() > 0.97


def test_minimise():
    a = np.diag([1.0, 10.0, 100.0])
    got = crf.minimise(lambda v: (0.5 * (v - 3) @ a @ (v - 3), a @ (v - 3)), np.zeros(3), tolerance=1e-14)
    assert np.allclose(got, 3, atol=1e-4)


def plain(text):
    """Some features of the lines of a text, in plain Python."""
    out, seen_words, seen_lines = [], set(), set()
    for line in (text or "").encode().split(b"\n"):
        words = re.findall(rb"[^\x20\x09-\x0d]+", line)
        if not words:
            continue
        chars = len(line.decode())
        out.append({"words": np.log1p(len(words)), "chars": np.log1p(chars),
                    "same_as_last": sum(a == b for a, b in zip(words, words[1:])) / len(words),
                    "seen_in_line": 1 - len(set(words)) / len(words),
                    "seen_line": float(line in seen_lines),
                    "digits": sum(48 <= b <= 57 for b in line) / chars,
                    "longest_word": np.log1p(max(map(len, words))),
                    "no_letters": sum(not re.search(rb"[A-Za-z\x80-\xff]", w) for w in words) / len(words)})
        n = 0
        for w in words:
            n += w in seen_words
            seen_words.add(w)
        out[-1]["seen_in_text"] = n / len(words)
        seen_lines.add(line)
    return out


def test_features_against_plain_python():
    rng = random.Random(6)
    texts = [r[1] for r in cases.rows()] + ["".join(rng.choice("ab \n\t1é!") for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["a\n\n", "\na", "x\r\ny\n \nz"]
    found = L.lines(*X.column_bytes(pa.array(texts, pa.string())), None)
    for i, t in enumerate(texts):
        want = plain(t)
        got = found.x[found.first[i]:found.first[i + 1]]
        assert len(got) == len(want)
        for row, w in zip(got, want):
            for name, v in w.items():
                assert np.isclose(row[L.FEATURES.index(name)], v), (t, name)
    assert np.isfinite(found.x).all()


def test_line_labels():
    first = np.array([0, 2, 2, 5])
    assert L.line_labels(np.array([0.1, 0.2, 0.9, 0.8, 0.3]), np.array([1, 0, 0]), first).tolist() == [1, 1, 1, 1, 0]
    assert L.line_labels(np.array([0.1, 0.2, 0.9, 0.8, 0.7]), np.array([0, 1, 0]), first).tolist() == [0, 0, 1, 1, 0]


def auc(score, truth):
    _, back, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[back]
    good = truth == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op12_quality_classifier"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count()
    rows = got.filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    score, truth = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert auc(score, truth) > 0.99 and np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_are_not_used(spark):
    """Turned labels of held-out rows change nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    own = docs.select("doc_id").withColumn("quality", F.when(queries.line_held_out(), F.lit(0)).otherwise(F.lit(1)))
    a = L.fit(docs, labels.filter(~queries.line_held_out()))
    turned = labels.withColumn("quality", F.when(queries.line_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    b = L.fit(docs, turned.filter(~queries.line_held_out()))
    assert a.share == b.share and (a.chain is None) == (b.chain is None)
    one = L.fit(docs, own.filter(~queries.line_held_out()))
    assert one.chain is None and {r.score for r in L.score(docs, one).select("score").distinct().collect()} == {1.0}


def test_odd_rows(spark):
    docs = cases.frame(spark)
    rows = docs.select("doc_id").distinct().collect()
    labels = spark.createDataFrame([(r.doc_id, 0 if (r.doc_id or 0) % 3 else 1, "own") for r in rows] + [(1, 0, ""), (2, None, "")], "doc_id long, quality int, score string")
    model = L.fit(docs, labels)
    got = L.score(docs, model).collect()
    assert len(got) == docs.count()
    by, text = {}, {x.doc_id: x.text for x in docs.collect()}
    for r, t in ((r, text[r.doc_id]) for r in got):
        by.setdefault(t, set()).add(r.score)
        assert 0 <= r.score <= 1 and len(r.line_chances) == r.n_lines == len(plain(t)) and r.n_bad_lines <= r.n_lines
    assert all(len(v) == 1 for v in by.values())
    assert by[None] == by[""] == by[" \t\n "] == {round(model.share, 12)}
    empty = docs.limit(0)
    assert L.score(empty, L.fit(empty, labels)).count() == 0
    nothing = L.fit(docs, labels.limit(0))
    assert {r.score for r in L.score(docs, nothing).collect()} == {0.5}


def test_many_lines(spark):
    docs = spark.createDataFrame([(1, "good line here.\n" * 30_000 + "x"), (2, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.n_lines for r in L.score(docs, L.fit(docs, labels)).collect()}
    assert got == {1: 30_001, 2: 1}
