"""Ranked search against scoring every document in plain Python, and its bounds."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventweave.llm import lexical, textops as X
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {i: i + 32 for i in range(65, 91)}
ITEMS = "item_id long, text string, rank string, score string"


def words(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) of the definition."""
    bags = [(d, Counter(words(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(words(text)) if t in df}
        scored = []
        for d, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * n_docs) // total
            s = sum(w * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t, w in terms.items() if b[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "own", "own") for i, t in docs], "doc_id long, text string, n string, item_id string").repartition(5)
    q = spark.createDataFrame([(i, t, "own", "own") for i, t in items], ITEMS).repartition(2)
    got = lexical.search(lexical.build(d), q, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return key([tuple(r) for r in got.collect()])


def skewed(rng, n, size, vocabulary=400):
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), vocabulary)}" for _ in range(rng.randint(1, size)))


@pytest.mark.parametrize("small", [False, True])
def test_against_all_documents(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(lexical, "SEGMENT_BYTES", 2000)
    rng = random.Random(4)
    docs = [(i, skewed(rng, i, 120)) for i in range(400)] + [(1000 + i, "W1 w2, w3! w1") for i in range(40)] + [(5, "w1 w2"), (5, "w1 w2"), (None, "w3 w9"), (None, "w3 w9")]
    items = [(i, skewed(rng, i, 40)) for i in range(30)] + [(100, "w1"), (101, "W1 w2 W3"), (101, "w399 w398"), (None, "w7")]
    want = key(brute(docs, items))
    assert run(spark, docs, items) == want
    if small:
        assert run(spark, docs, items, block_terms=50) == want          # many blocks of items


def test_odd_texts(spark):
    docs = [(r[0], r[1]) for r in cases.rows()] + [(3000, "İstanbul ÄÖ äö ſ K k\x00x a_b-c"), (3001, "中文字 中文字,中文字")]
    items = [(1, None), (2, ""), (3, "!!! ..."), (4, "ÄÖ äö istanbul K"), (5, "中文字"), (6, "nowhere-to-be-found zzqq"),
             (7, "w1 w2 w9000 again and LINE one no id"), (8, docs[5][1]), (9, "x" * 50_000)]
    assert run(spark, docs, items) == key(brute(docs, items))


@pytest.mark.parametrize("docs,items", [([], []), ([], [(1, "a b")]), ([(1, "a b")], []), ([(1, None), (2, "")], [(1, "a")])])
def test_empty(spark, docs, items):
    assert run(spark, docs, items) == []


def test_terms_with_one_hash(monkeypatch, spark):
    monkeypatch.setattr(X, "byte_hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
    data, offsets = X.column_bytes(pa.array(["ab ba ab c", "BA c c"]))
    w, folded, term, at = lexical.terms_of(data, offsets)
    names = [folded[w.start[i]:w.end[i]].tobytes() for i in at]
    assert [names[t] for t in term] == [b"ab", b"ba", b"ab", b"c", b"ba", b"c", b"c"]


def test_pair_bounds_hold_and_are_tighter():
    rng = np.random.default_rng(2)
    tighter = 0
    for _ in range(200):
        k, rows = int(rng.integers(1, 9)), 60
        lists = []
        for _ in range(k):
            docs = np.flatnonzero(rng.random(rows) < rng.uniform(0.02, 0.5))
            lists.append((docs, rng.integers(1, 1000, len(docs))))
        top = np.array([v.max(initial=0) for _, v in lists])
        joint = lexical.joint_maxima(rows, lists)
        pair = np.where(rng.random(k) < 0.8, np.arange(k), -1)
        order = np.argsort(-top, kind="stable")
        bound = lexical.suffix_bounds(top[order], pair[order], joint)
        for i in range(k + 1):
            score = np.zeros(rows, np.int64)
            for j in order[i:]:
                score[lists[j][0]] += lists[j][1]
            assert score.max(initial=0) <= bound[i] <= top[order[i:]].sum()
        tighter += bound[0] < top.sum()
    assert tighter > 100


def test_pair_bounds_read_less():
    """Two common terms that never meet: their lists are not read once the tenth score is known."""
    rows = 4000
    lists = [(np.arange(0, rows, 2), np.full(rows // 2, 10)), (np.arange(1, rows, 2), np.full(rows // 2, 10)), (np.arange(0, 400), np.full(400, 15))]
    first = np.concatenate([[0], np.cumsum([len(d) for d, _ in lists])])
    docs, impact = np.concatenate([d for d, _ in lists]).astype("<u2"), np.concatenate([v for _, v in lists])
    top, joint = np.array([10, 10, 15]), lexical.joint_maxima(rows, lists)
    args = (np.arange(3), np.ones(3, np.int64)), (first, docs, impact, top)
    read = {}
    for name, pair in (("pairs", np.arange(3)), ("alone", np.full(3, -1))):
        read[name] = []
        found, score = lexical.search_item(*args[0], pair, *args[1], joint, rows, 18, 10, read[name])
        assert set(score) == {25} and len(found) == 400
    assert sum(read["pairs"]) < sum(read["alone"]) / 2
