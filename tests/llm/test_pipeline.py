"""The pipeline: each stage against a brute-force version of its operator on its own input."""

import json

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from eventweave.llm import mixing, packing, quality
from eventweave.llm.frames import read, stored
from eventweave.llm.queries import tokenizer_path
from tests.llm.test_dedup import cut_brute, fingerprint_brute, roots_brute
from tests.llm.test_tokens import library, one_by_one

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert json.dumps(sorted(entry.oracle_sql())) and {"op3_mixing", "op13_lexical_search"} <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def steps(spark):
    """(input, result) rows of every stage."""
    docs, out = read(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), name)
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark, steps):
    assert all(after.columns == COLUMNS for _, after in steps[:-1])
    docs, kept = steps[0]
    judged = quality.judge(docs, quality.fit(docs, read(spark, SF, "labels")))
    assert ids(kept) == ids(judged.filter("kept")) and 0 < kept.count() < docs.count()

    docs, kept = steps[1]
    data = sorted((r.doc_id, r.text) for r in docs.collect())
    roots = roots_brute([fingerprint_brute(t) for _, t in data], 3)
    assert ids(kept) == sorted(data[k][0] for k in set(roots))

    docs, kept = steps[2]
    data = docs.collect()
    want = {d.doc_id: d.text if not any(g) else " ".join(x for x, y in zip(w, g) if not y) for d, (w, g) in zip(data, cut_brute([d.text for d in data], 35))}
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect()} == {k: (t, len(t)) for k, t in want.items()}

    docs, kept = steps[3]
    drawn = mixing.mix(docs).filter("selected").select("doc_id").collect()
    assert ids(kept) == sorted(r.doc_id for r in drawn)
    same = {r.doc_id: (r.lang, r.source, r.text) for r in docs.collect()}
    assert all(same[r.doc_id] == (r.lang, r.source, r.text) for r in kept.collect())

    docs, rows = steps[4]
    lengths = []
    for n in (len(i) + 1 for i in library("word_bpe_49k.json", [r.text for r in docs.collect()])):
        lengths += [4096] * (n // 4096) + [n % 4096] * (n % 4096 > 0)
    got = rows.collect()
    assert sorted(r.length for r in got) == sorted(lengths)
    assert len({r.sequence_id for r in got}) == len(one_by_one(lengths, 4096))


def test_run_equals_its_stages(spark, steps):
    key = lambda r: (r.doc_id, r.piece)     # noqa: E731
    a, b = (sorted(df.collect(), key=key) for df in (corpus_pipeline.run(spark, SF), steps[-1][1]))
    assert [(r.doc_id, r.piece, r.length, r.ids_crc32) for r in a] == [(r.doc_id, r.piece, r.length, r.ids_crc32) for r in b]


def test_stages_take_empty_and_wider_tables(spark, tmp_dir):
    from tests.llm import cases
    wide = cases.table(spark, tmp_dir)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, SF)
        assert out.count() >= 0 and ("sequence_id" in out.columns or out.columns == COLUMNS)
    empty = cases.table(spark, tmp_dir, [], clashing=False)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
    assert np.sum(packing.best_fit_plan({}, 10)) == 0 and tokenizer_path("word_bpe_49k.json")
