"""Substring dedup and SimHash components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from eventweave.llm import components, simhash, substrings
from tests.llm import cases

WORD = re.compile("[^\x20\x09-\x0D]+")


def cut_brute(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        out.append((w, gone))
    return out


@pytest.mark.parametrize("length, group", [(35, 1 << 20), (12, 1 << 20), (5, 1 << 20), (35, 3)])
def test_repeats_are_cut(spark, tmp_dir, monkeypatch, length, group):
    monkeypatch.setattr(substrings, "GROUP", group)         # 3: nearly every prefix is split by longer ones
    docs = cases.table(spark, tmp_dir)
    rows = substrings.remove_repeats(docs, length=length).collect()
    assert {"score", "piece", "n_chars"} <= set(rows[0].asDict())
    own = {(r.doc_id, r.text): r for r in rows}
    want = cut_brute([r.text for r in rows], length)
    for r, (w, gone) in zip(rows, want):
        assert (r.n_words, r.n_removed, r.kept_text) == (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
        covered = [False] * len(w)
        for s in r.spans:
            assert s.words >= length
            covered[s.first:s.first + s.words] = [True] * s.words
        assert covered == gone
    assert own[1003, next(r.text for r in rows if r.doc_id == 1003)].n_removed > 0
    assert sum(r.n_removed for r in rows) > 1000
    empty = cases.table(spark, tmp_dir, [])
    assert substrings.remove_repeats(empty, length=length).count() == 0


def test_self_overlapping_and_short_texts(spark, tmp_dir):
    data = [(1, "a " * 40, None, None, 0), (2, "b " * 9, None, None, 0), (3, "c d e f g h i j", None, None, 0), (4, "c d e f g h i j", None, None, 0)]
    docs = cases.table(spark, tmp_dir, data)
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs, length=8).collect()}
    assert got == {1: 40, 2: 9, 3: 8, 4: 8}


def test_many_texts_shorter_than_a_window(spark, tmp_dir):
    docs = cases.table(spark, tmp_dir, [(i, "a b c d e f g h i j", None, None, 0) for i in range(50)])
    got = substrings.remove_repeats(docs, length=35).collect()
    assert len(got) == 50 and not any(r.n_removed for r in got)


def fingerprint_brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h)) if h else 0


def roots_brute(fps, most):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("parts, cell", [(None, 1 << 14), (4, 1 << 14), (2, 1 << 14), (3, 2)])
def test_simhash_components(spark, tmp_dir, monkeypatch, parts, cell):
    monkeypatch.setattr(simhash, "CELL", cell)              # 2: buckets are dealt out as grids of cells
    docs = cases.table(spark, tmp_dir)
    rows = simhash.near_duplicates(docs, parts=parts).collect()
    data = docs.select("doc_id", "text").collect()
    fps = [fingerprint_brute(r.text) for r in data]
    roots = roots_brute(fps, 3)
    least = {}
    for r, k in zip(data, roots):
        if r.doc_id is not None:
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{f:016x}", least.get(k)) for r, f, k in zip(data, fps, roots))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want
    kept = simhash.keep_one(docs, parts=parts).collect()
    assert len(kept) == len(set(roots)) and kept[0].asDict().keys() == docs.first().asDict().keys()
    assert Counter(r.doc_id for r in kept) == Counter(least.get(k) for k in set(roots))
    assert simhash.near_duplicates(cases.table(spark, tmp_dir, [])).count() == 0


def test_pigeonhole_finds_every_close_pair(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = [int(b) for b in base]
    for b in base:                                          # dense clusters, and chains of three bits a step
        x = int(b)
        for _ in range(12):
            x ^= sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 4), replace=False))
            fps.append(x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for parts in (2, 3, 4):
        roots = {r.node: r.root for r in components.components(simhash.links(df, most=3, parts=parts)).collect()}
        got = [roots.get(f - (1 << 64) if f >> 63 else f, f - (1 << 64) if f >> 63 else f) for f in fps]
        want = roots_brute(fps, 3)
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_allocation_is_the_cheapest():
    rng, budget = np.random.default_rng(7), 1
    costs = np.concatenate([np.zeros((50, 3, 1)), np.cumsum(rng.random((50, 3, 3)), axis=2)], axis=2)
    t = simhash.allocate(costs, budget)
    ways = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == budget]
    for row, own in zip(costs, t.tolist()):
        price = lambda w: sum(row[i, x + 1] for i, x in enumerate(w))       # noqa: E731
        assert sum(own) == budget and abs(price(own) - min(map(price, ways))) < 1e-12


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 300)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sha_of_kept_words(spark):
    from eventweave.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in QUERIES["op1_substring_dedup"](spark, sf).collect()}
    data = spark.read.parquet(f"{sf}/documents.parquet").collect()
    for d, (w, gone) in zip(data, cut_brute([d.text for d in data], 35)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert (rows[d.doc_id].n_words, rows[d.doc_id].n_removed, rows[d.doc_id].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_no_text_is_shuffled(spark, tmp_dir):
    """The stored rows are joined in their buckets: no exchange stands above their scan."""
    docs = cases.table(spark, tmp_dir)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        plan = substrings.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("Bucketed: true") == 2
    assert not [line for line in plan.splitlines() if "Exchange" in line and "text" in line]
