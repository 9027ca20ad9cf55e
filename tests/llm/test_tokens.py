"""Token files and packing: exact ids, exact round trip, best fit against one-by-one packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from eventweave.llm import packing, sharding, tokenfile, tokens
from eventweave.llm.queries import tokenizer_path
from tests.llm import cases

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def library(name, texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_ids_are_those_of_the_library(name):
    rng = random.Random(2)
    odd = list(" \n\t\r abcéÉ'sST123!<|>  　\x1c\x85́.,中文Σ") + ["<|endoftext|>", " <|startoftext|> ", "'ll", "  ", "\n\n", " \n"]
    plain = list(" \nabcéÉ'sST123! é¼ª\xadab  ab ba") + ["'ll", "<|endoftext|>"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + [None, ""]
    for bound in (10, 10_000):          # with most words encoded again and again, and with all kept
        enc = tokens.WordEncoder(tokenizer_path(name), bound, bound)
        ids, n = enc.encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == library(name, texts)


def test_elias_fano_select():
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 1), (1, 10**12), (500, 3), (500, 10**9), (5000, 10**15)):
        v = np.sort(rng.integers(0, top, n))
        e, at = tokenfile.EliasFano.read(memoryview(raw := tokenfile.EliasFano.of(v).to_bytes()), 0)
        assert at == len(raw) and e.values().tolist() == v.tolist() == [e.select(i) for i in range(n)]
    big = np.sort(rng.integers(0, 1 << 30, 20_000))
    assert len(tokenfile.EliasFano.of(big).to_bytes()) < 20_000 * 3        # 64-bit offsets take 8 bytes


def test_token_file_round_trip(spark, tmp_dir):
    docs = cases.frame(spark)
    got = tokenfile.token_file(docs, tokenizer=tokenizer_path(BYTE), end_id=2).collect()
    want = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    ids = Counter(((d, tuple(i + [2])) for (d, _), i in zip(want, library(BYTE, [t for _, t in want]))))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == ids
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [d for d, _ in want]
    at = 0
    for r in ordered:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(r.ids))
        at += r.n_tokens
    empty = spark.createDataFrame([], cases.SCHEMA)
    assert tokenfile.token_file(empty, tokenizer=tokenizer_path(BYTE), end_id=2).count() == 0


def one_by_one(lengths, capacity):
    """Best-fit decreasing, piece by piece: the rooms that are left."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            fit = capacity
        else:
            rooms.remove(fit)
        rooms.append(fit - n)
    return sorted(rooms)


def test_plan_equals_packing_one_by_one():
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.randint(1, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        counts = Counter(lengths)
        room, at, done = defaultdict(lambda: capacity), defaultdict(list), Counter()
        for length, rank, n, first, per, offset in packing.best_fit_plan(counts, capacity).tolist():
            assert rank == done[length]
            done[length] += n
            for i in range(n):
                room[first + i // per] -= length
                at[first + i // per].append((offset + i % per * length, length))
        assert done == counts and sorted(room.values()) == one_by_one(lengths, capacity)
        for spans in at.values():
            end = 0
            for a, n in sorted(spans):
                assert a == end
                end += n


def test_packed_pieces(spark):
    docs = cases.frame(spark)
    rows = packing.pack(docs, tokenizer=tokenizer_path(WORD), capacity=256, end_id=1).collect()
    data = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter()
    for (d, _), ids in zip(data, library(WORD, [t for _, t in data])):
        ids = ids + [1]
        for k in range(0, len(ids), 256):
            want[d, k // 256, k, tuple(ids[k:k + 256])] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in rows) == want
    assert all(r.ids_crc32 == zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) and r.length == len(r.ids) // 2 for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for a, n in sorted(spans):
            assert a == end
            end += n
        assert end <= 256
    assert len(by) == len(one_by_one([r.length for r in rows], 256))
    assert packing.pack(spark.createDataFrame([], cases.SCHEMA), tokenizer=tokenizer_path(WORD)).count() == 0


def test_best_fit_decreasing_takes_the_tightest_bin():
    rng = random.Random(5)
    for _ in range(100):
        capacity = rng.randint(5, 60)
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        where = sharding.best_fit_decreasing(sizes, capacity)
        left = Counter()
        for s, b in zip(sizes, where):
            left[b] += s
        assert sorted(capacity - v for v in left.values()) == one_by_one(sizes, capacity)
    assert sharding.best_fit_decreasing([3, 3, 3], 3, most=2) is None


def test_shards(spark):
    docs = cases.frame(spark)
    rows = sharding.shard(docs, shards=4).collect()
    data = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in data)
    shard_of, text_of = {}, defaultdict(set)
    for r in rows:
        assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard     # equal texts stay together
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    even = spark.range(3000).selectExpr("id AS doc_id", "repeat(chr(97 + cast(id % 26 as int)), cast(id % 300 as int)) || id AS text")
    sizes = Counter()
    for r in sharding.shard(even, shards=7).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 0.01 * max(sizes.values())
    assert sharding.shard(spark.createDataFrame([], cases.SCHEMA)).count() == 0


def test_a_group_above_an_even_share_gets_a_shard_of_its_own():
    where = sharding.even_bins([1000, 10, 10, 10, 10, 10, 10], 4)
    assert where.count(where[0]) == 1 and max(Counter(where[1:]).values()) == 2
