"""The vectorised text helpers against plain Python."""

import random
import re

import pyarrow as pa
import pytest

from eventweave.llm import textops as X

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def texts(rng):
    return [None if rng.random() < 0.1 else "".join(rng.choice("ab \té\n") if rng.random() < 0.9 else "x" * rng.randint(0, 200) for _ in range(rng.randint(0, 60)))
            for _ in range(rng.randint(0, 12))]


@pytest.mark.parametrize("slice_bytes", [64, 1 << 18])
def test_words_equal_a_regular_expression(monkeypatch, slice_bytes):
    monkeypatch.setattr(X, "SLICE", slice_bytes)
    monkeypatch.setattr(X, "_powers", {})
    rng, seen = random.Random(1), {}
    for _ in range(120):
        t = texts(rng)
        data, offsets = X.column_bytes(pa.array(t, pa.string()).slice(1))
        w = X.split_words(data, offsets)
        got = [[bytes(data[w.start[i]:w.end[i]]) for i in range(w.first[r], w.first[r + 1])] for r in range(len(t[1:]))]
        assert got == [WORD.findall((x or "").encode()) for x in t[1:]]
        for words, first in zip(got, w.first):
            for i, b in enumerate(words):
                assert seen.setdefault(b, w.hash[first + i]) == w.hash[first + i]
    assert len(set(seen.values())) == len(seen)


def test_window_hashes_name_equal_windows_alike():
    data, offsets = X.column_bytes(pa.array(["a b c a b c a b", "b c a", None, "c"]))
    w = X.split_words(data, offsets)
    h, inside = X.windows_in_rows(w, 3)
    names = [bytes(data[w.start[i]:w.end[i]]) for i in range(len(w.start))]
    by = {}
    for i in range(len(h)):
        if inside[i]:
            by.setdefault(tuple(names[i:i + 3]), set()).add(int(h[i]))
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by) == 3


def test_blocks_are_bounded_and_keep_all_rows():
    t = ["a" * n for n in (5, 0, 100, 3, 3, 3)]
    got = list(X.blocks(pa.record_batch({"text": pa.array(t)}), "text", 8))
    assert [x for b in got for x in b.column(0).to_pylist()] == t
    assert all(b.num_rows == 1 or sum(map(len, b.column(0).to_pylist())) <= 8 for b in got)
