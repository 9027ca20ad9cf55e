import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventweave.session import build_session, work_dir  # noqa: E402
from tests.fixtures import sample_lines  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # local[4,2]: a failed task is retried once, as on a cluster after an executor loss
    s = build_session("local[4,2]", shuffle_partitions=4, app_name="eventweave-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    """A new folder under the session's checkpoint root."""
    def make(name: str = "t") -> str:
        return work_dir(spark, name)
    return make


@pytest.fixture
def sample_raw(spark):
    """The 25 demo events as topic records (partition 0, offsets 0..24)."""
    rows = [("events.raw", 0, i, None, line) for i, line in enumerate(sample_lines())]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string")


@pytest.fixture
def sample_canonical(sample_raw):
    from eventweave.operators.canonical import canonicalise
    return canonicalise(sample_raw, keep=("partition", "offset"))


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain(mode)`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
