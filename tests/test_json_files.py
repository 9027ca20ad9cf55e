"""JSON documents cut into elements by many tasks, against json.loads."""

import json
import os
import random

import pytest

from eventweave.operators.canonical import MALFORMED, NOT_OBJECT, OK, STATUS
from eventweave.sources import json_files as J
from eventweave.sources.files import read_event_files


def local(folder):
    path = folder.removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    return path


def write(folder, name, text):
    with open(f"{local(folder)}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return folder


def value(rng, depth=0):
    kind = rng.randint(0, 8 if depth < 3 else 5)
    if kind <= 2:
        return rng.choice(['', 'plain', 'br}ce', '[{', '"quote"', 'back\\slash', '\\"', '\\\\', 'ü中"}', 'line\nbreak', ',', '{"a":[1,2}'])
    if kind <= 5:
        return rng.choice([None, True, 1, -2.5, 10**12])
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice("abc}\"\\") + str(i): value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def events(rng, n):
    return [{"event_id": f"e{i}", "x": value(rng), "y": value(rng)} for i in range(n)]


def elements(spark, path):
    return [json.loads(r.value) for r in J.json_elements(spark, path).collect()]


def same(a, b):
    key = lambda x: json.dumps(x, sort_keys=True)        # noqa: E731
    return sorted(map(key, a)) == sorted(map(key, b))


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1500b", "spark.sql.files.openCostInBytes": "100b", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_arrays_over_many_splits(spark, tmp_dir, small_splits, indent, ascii_only):
    rng, folder, want = random.Random(3), tmp_dir("json"), []
    for i in range(3):
        own = events(rng, 150)
        write(folder, f"{i}.json", json.dumps(own, indent=indent, ensure_ascii=ascii_only))
        want += own
    assert J._records(spark, folder).rdd.getNumPartitions() > 15
    assert same(elements(spark, folder), want)
    got = read_event_files(spark, folder, whole_files=True)
    assert {r[STATUS] for r in got.select(STATUS).distinct().collect()} == {OK} and got.count() == 450


def test_elements_larger_than_a_split(spark, tmp_dir, small_splits):
    want = [{"a": "x" * 9000 + "}"}, {"b": [{"c": "}" * 3000}] * 3}, {"d": 1}]
    assert same(elements(spark, write(tmp_dir("json"), "a.json", json.dumps(want))), want)


@pytest.mark.parametrize("split", [False, True])
def test_shapes_of_files(spark, tmp_dir, request, split):
    if split:
        request.getfixturevalue("small_splits")
    pad = " " * (2000 if split else 0)
    for name, text, want in (
            ("object", '{"a": {"b": [1, 2]}}', [{"a": {"b": [1, 2]}}]), ("object, newline", '{"a": 1}\n', [{"a": 1}]),
            ("one after another", '{"a": 1}\n{"a": 2} {"a": 3}', [{"a": 1}, {"a": 2}, {"a": 3}]),
            ("array", '[{"a": 1}, {"a": 2}]', [{"a": 1}, {"a": 2}]), ("array, newline", ' \n[{"a": 1}\n,\n{"a": 2}\n]\n\n', [{"a": 1}, {"a": 2}]),
            ("empty array", "[]", []), ("nested", '[[1, {"a": "]"}], {"b": [[]]}]', [[1, {"a": "]"}], {"b": [[]]}]),
            ("scalars", '[1, "a,b", null, true]', [1, "a,b", None, True]), ("byte order mark", '﻿[{"a": 1}]', [{"a": 1}]),
            ("blank", " \n ", []), ("braces in keys", '[{"}": "{", "[": "\\\\"}, {"\\"": 1}]', [{"}": "{", "[": "\\"}, {'"': 1}])):
        assert same(elements(spark, write(tmp_dir(name.replace(",", "").replace(" ", "_")), "f.json", pad + text + pad)), want), name


@pytest.mark.parametrize("split", [False, True])
def test_a_bad_element_does_not_lose_the_file(spark, tmp_dir, request, split):
    if split:
        request.getfixturevalue("small_splits")
    good = [json.dumps({"event_id": f"e{i}", "t": "x" * 50}) for i in range(100)]
    good[40], good[70] = '{"event_id": oops}', "17"
    got = read_event_files(spark, write(tmp_dir("bad"), "f.json", "[" + ",\n".join(good) + "]"), whole_files=True)
    assert {r[STATUS]: r["count"] for r in got.groupBy(STATUS).count().collect()} == {OK: 98, MALFORMED: 1, NOT_OBJECT: 1}
    cut = read_event_files(spark, write(tmp_dir("cut"), "f.json", "[" + ",".join(good[:40]) + ',{"event_id": "e4'), whole_files=True)
    assert {r[STATUS]: r["count"] for r in cut.groupBy(STATUS).count().collect()} == {OK: 40, MALFORMED: 1}


def test_compressed_files(spark, tmp_dir):
    import gzip
    folder, rng = tmp_dir("gz"), random.Random(1)
    want = events(rng, 60)
    for name, text in (("a", json.dumps(want[:30])), ("b", json.dumps(want[30:59], indent=1) + "\n"), ("c", json.dumps(want[59]))):
        with gzip.open(f"{local(folder)}/{name}.json.gz", "wt", encoding="utf-8") as f:
            f.write(text)
    assert same(elements(spark, folder), want)


def test_a_large_array_is_many_tasks(spark, tmp_dir):
    """One document without line breaks: every split is a task, every event arrives."""
    n, pad = 60_000, "x" * 300
    text = "[" + ",".join(f'{{"event_id":"e{i}","payload":{{"k":{i},"s":"{pad}"}}}}' for i in range(n)) + "]"
    folder = write(tmp_dir("large"), "f.json", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
        got = read_event_files(spark, folder, whole_files=True)
        assert J._records(spark, folder).rdd.getNumPartitions() >= 10
        assert got.where(got[STATUS] == OK).select("value").distinct().count() == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_publish_with_bad_elements(spark, tmp_dir):
    from eventweave.engine import Engine
    eng, file = Engine(spark, tmp_dir("e")), write(tmp_dir("f"), "f.json", '[{"event_id":"a"}, 5, {"event_id":"b"}, {bad}]')
    with pytest.raises(Exception, match="not an event"):
        eng.publish_file("t", file)
    eng = Engine(spark, tmp_dir("e"))
    for _ in range(2):
        eng.publish_file("t", file, bad="quarantine")
    assert sorted((r.reason, r.raw) for r in eng.quarantine.read(spark).collect()) == [("malformed_json", "{bad}"), ("not_object", "5")]
    assert eng.stream("t", targets=["events"]) == 4
    with pytest.raises(ValueError):
        eng.publish_file("t", file, bad="ignore")
