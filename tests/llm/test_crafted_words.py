"""Words made to share a weak hash: everything that rests on word hashes stays right."""

import random

import numpy as np
import pyarrow as pa
import pytest

from eventweave.llm import packing, quality, substrings, textops as X, tokenfile, tokens
from eventweave.llm.queries import tokenizer_path
from tests.llm import cases
from tests.llm.test_tokens import BYTE, WORD, library


def twins(bits=10, a="a", b="b"):
    """A Thue-Morse word and its complement: equal under a polynomial modulo 2^64."""
    first, second = a, b
    for _ in range(bits):
        first, second = first + second, second + first
    return "zzzzzzzz" + first, "zzzzzzzz" + second


def hashes(words):
    w = X.split_words(*X.column_bytes(pa.array([" ".join(words)])))
    return w.hash.tolist()


def test_words_have_their_own_hash():
    words = [*twins(10), *twins(4), *twins(5), *twins(12, "ab", "ba")]
    rng = random.Random(5)
    words += ["".join(rng.choice("ab") for _ in range(n)) for n in (1, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200) for _ in range(200)]
    seen = {}
    words += ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in range(1, 9) for _ in range(3000)]
    for word, h in zip(words, hashes(words)):
        assert seen.setdefault(h, word) == word
    assert len(seen) == len(set(words))


@pytest.mark.parametrize("slice_bytes", [64, 1 << 18])
def test_hash_does_not_depend_on_the_slice(monkeypatch, slice_bytes):
    words = [*twins(9), "a", "ab" * 4, "é" * 40]
    want = [hashes([w])[0] for w in words]
    monkeypatch.setattr(X, "SLICE", slice_bytes)
    assert hashes(words) == want


def test_same_bytes():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    a, n = rng.integers(0, 3000, 3000), rng.integers(0, 12, 3000)
    b = rng.integers(0, 3000, 3000)
    n[:50] = 300
    b[:25] = a[:25]
    got = X.same_bytes(data, a, data, b, n)
    assert got.tolist() == [data[i:i + k].tobytes() == data[j:j + k].tobytes() for i, j, k in zip(a, b, n)]


@pytest.mark.parametrize("name", [BYTE, WORD])
@pytest.mark.parametrize("weak", [False, True])
def test_token_ids(monkeypatch, name, weak):
    if weak:        # long words of one length have the same hash: only their bytes tell them apart
        true = X.byte_hashes
        monkeypatch.setattr(X, "byte_hashes", lambda d, s, e: np.where(e - s > 8, (e - s).astype(np.uint64) + np.uint64(1), true(d, s, e)))
    one, two = twins()
    texts = [f"{one} {two} x", f"{two} {one}", *(f"ab{i} cd{i} longerword{i} x" for i in range(60)), f"{one[:40]} {two[:40]}"] * 2
    enc = tokens.WordEncoder(tokenizer_path(name), 1000, 1000)
    for some in (texts, texts[::-1]):
        ids, n = enc.encode(pa.array(some, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == library(name, some)


def crafted(spark):
    one, two = twins()
    lines = [f"{one}\n{two}", " ".join([one, two] * 20), " ".join([one] * 35 + ["end"]), " ".join([two] * 35 + ["stop"]),
             " ".join([one] * 8 + [two] * 8)]
    return cases.frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(lines)], partitions=2), lines


def test_base_counts_and_windows(spark):
    docs, lines = crafted(spark)
    model = quality.Model(np.zeros(quality.BUCKETS, np.int32), 0.0)
    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    assert got[0].n_dup_lines == 0 and got[4].n_repeat_words == 0 and got[1].n_repeat_words == 40
    cut = {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()}
    assert cut == {0: 0, 1: 40, 2: 0, 3: 0, 4: 0}       # windows of document 1 repeat in itself only


def test_files_and_sequences(spark):
    docs, lines = crafted(spark)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in tokenfile.token_file(docs, tokenizer=tokenizer_path(BYTE), end_id=2).collect()}
    assert ids == {i: x + [2] for i, x in enumerate(library(BYTE, lines))}
    pieces = packing.pack(docs, tokenizer=tokenizer_path(WORD), capacity=4096, end_id=1).collect()
    assert {d: sum(p.length for p in pieces if p.doc_id == d) for d in ids} == {i: len(x) + 1 for i, x in enumerate(library(WORD, lines))}
