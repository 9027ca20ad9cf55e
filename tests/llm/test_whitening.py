"""Whitening against exact integers and a dense eigen solver."""

import numpy as np
import pytest

from eventweave.llm import eigen, queries, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, component string, n string"


def vectors(rng, n, dim, scale):
    return (rng.standard_normal((n, dim)) * scale).tolist()


def brute(rows, k=16):
    """(n, sums, kept rows as exact integers, covariance) of the definition."""
    kept = [(i, [int(np.floor(64 * c)) + 1000000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    listed = sorted({tuple(x) for _, x in kept})
    n, dim = len(listed), len(listed[0])
    sums = [sum(x[j] for x in listed) for j in range(dim)]
    c = np.array([[x[j] - sums[j] / n for j in range(dim)] for x in listed])
    return n, sums, kept, c.T @ c / n, c


def check(got, rows):
    n, sums, kept, v, centred = brute(rows)
    k = int(min(16, (np.linalg.eigvalsh(v) > 1e-9 * np.trace(v)).sum()))
    assert len(got) == len(kept) * k
    values = np.linalg.eigvalsh(v)[::-1][:k]
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for i, x in kept:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for c in range(1, k + 1):
            r = by[(i, c)][0]
            assert r["n"] == n and r["deviation"] == dev
            assert abs(r["explained"] - values[c - 1] / np.trace(v)) <= 1e-10
            assert r["identity_error"] < 1e-8
    # the whitened fit list is white, and each column spans its eigenspace
    z = {}
    for r in got:
        z.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    first = {}
    for i, x in kept:
        first.setdefault(tuple(x), i)
    w = np.array([[z[i][c] for c in range(1, k + 1)] for x, i in sorted(first.items())])
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-8
    # component c's loading is an eigenvector: V q = e q
    for c in range(k):
        q = centred.T @ w[:, c] / n / np.sqrt(values[c])
        assert np.abs(v @ q - values[c] * q).max() < 1e-7 * values[0]


@pytest.mark.parametrize("a", [
    np.diag([3.0, 3.0, 3.0, 1.0]), np.eye(20) * 7, np.zeros((3, 3)), np.array([[2.0]]),
    np.diag([1.0, 1 + 1e-12, 1 - 1e-12, 0.5]), np.outer(np.arange(5.0), np.arange(5.0))])
def test_eigen_ties_and_ranks(a):
    values, found = eigen.leading(a, 16)
    want = np.linalg.eigvalsh(a)[::-1][:16]
    want = want[want > 1e-12 * max(want[0], 1e-300)]
    assert np.allclose(values, want, rtol=1e-12)
    assert np.abs(found.T @ found - np.eye(len(values))).max(initial=0) < 1e-12
    assert np.abs(a @ found - found * values).max(initial=0) < 1e-12 * max(1.0, np.abs(a).max())


def test_eigen_random():
    rng = np.random.default_rng(3)
    for size in (2, 3, 17, 64, 130):
        b = rng.standard_normal((size, size)) * np.linspace(0.01, 3, size)
        a = b @ b.T
        values, found = eigen.leading(a, 16)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:16], rtol=1e-11)
        assert np.abs(a @ found - found * values).max() < 1e-11 * values[0]
        assert np.abs(found.T @ found - np.eye(len(values))).max() < 1e-11


def test_query_against_definition(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(queries.QUERIES["op11_whitening"](spark, SF_SMALL).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = vectors(rng, 40, 5, 2.0)
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(100 + i, good[0]) for i in range(50)]                          # copies count once
    rows += [(None, good[1]), (3, good[3]), (200, [1.0, None, 2.0, 0.0, 0.0]), (201, None),
             (202, [float("nan")] * 5), (203, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (204, [])]
    odd = [(205, [1.0, 2.0])]                                                # another length
    df = spark.createDataFrame([(i, v, "own", "own") for i, v in rows + odd], SCHEMA).repartition(7)
    check(whitening.whiten(df, whitening.fit(df)).collect(), rows)


def test_wide_entries(spark):
    """Vectors of every width, and entries beyond a long."""
    rows = [(0, [0.0, 1.0]), (1, [3.0, -2.0]), (2, [700.0, 5.0]), (3, [-9e6, 1.0]), (4, [4e9, -1.0])]
    df = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
    n, sums, kept, *_ = brute(rows)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df, whitening.fit(df)).collect()}
    want = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in kept}
    assert got == {i: v if v < 1 << 63 else None for i, v in want.items()}
    huge = df.union(spark.createDataFrame([(9, [1e300, -1e300], "", "")], SCHEMA))
    # beside such a row the second direction is zero to double precision
    assert [r["component"] for r in whitening.whiten(huge, whitening.fit(huge)).collect()] == [1] * 6


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_without_variance(spark, rows):
    df = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)
    got = whitening.whiten(df, whitening.fit(df))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0
