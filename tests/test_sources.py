"""Event files (objects, arrays, pretty-printed), lake scan, staged Parquet."""

import json

from eventweave.operators import canonical as C
from eventweave.schemas import LAKE_EVENTS
from eventweave.sources.files import lake_scan, read_event_files, read_staged
from tests.conftest import plan_text
from tests.fixtures import sample_lines


def _write_text(spark, path, texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(path)


def test_pretty_printed_array_file(spark, tmp_dir):
    path = tmp_dir("files")
    doc = "[\n  " + ",\n  ".join(sample_lines()) + "\n]\n"
    _write_text(spark, path, [doc])
    events = read_event_files(spark, path, whole_files=True)
    assert events.count() == 25
    assert events.where(f"{C.STATUS} = 'ok'").count() == 25
    ids = sorted(json.loads(r.value)["event_id"] for r in events.collect())
    assert ids[0] == "evt-001" and ids[-1] == "evt-025"


def test_object_file_wraps_to_one_event_and_lines_mix(spark, tmp_dir):
    path = tmp_dir("lines")
    _write_text(spark, path, ['{"event_id":"a"}', '[{"event_id":"b"},{"event_id":"c"}]', "{bad"])
    events = read_event_files(spark, path)
    status = sorted(r[C.STATUS] for r in events.collect())
    assert status == ["malformed_json", "ok", "ok", "ok"]
    canon = C.canonicalise(events.drop("_v", C.STATUS))
    assert sorted(r.event_id for r in canon.collect()) == ["a", "b", "c"]


def test_lake_scan_pushes_predicate(spark):
    df = lake_scan(spark, spark.read.parquet("/root/testdata/sf0.001/events.parquet"),
                   "ts >= TIMESTAMP_NTZ'2024-01-15 00:00:00' AND event_type = 'click'")
    plan = plan_text(df)
    assert "EqualTo(event_type,click)" in plan and "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan


def test_staged_parquet_with_schema(spark, tmp_dir):
    path = tmp_dir("staged")
    spark.createDataFrame([("e", "t", None, "{}")], LAKE_EVENTS).write.parquet(path)
    assert read_staged(spark, path, LAKE_EVENTS).schema == LAKE_EVENTS
