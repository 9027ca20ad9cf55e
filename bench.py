"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then ``BENCH_REPEATS`` (default 3) timed runs; the
median wall time is reported. ``BENCH_ALL=1`` times every registered query (the headline
total stays the sum of the four headline queries); ``BENCH_QUERIES=a,b`` picks queries. Results are forced with the ``noop`` sink, so every row
is computed and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventweave.plans import registry  # noqa: E402
from eventweave.session import build_session  # noqa: E402

HEADLINE = ("incremental_summary", "federated_three_way", "stream_fanout", "upsert_latest")


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    default = ",".join(registry.QUERIES) if os.environ.get("BENCH_ALL") else ",".join(HEADLINE)
    names = [n for n in os.environ.get("BENCH_QUERIES", default).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = registry.QUERIES[name]
        runs = []
        try:
            for i in range(repeats + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    runs.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(runs), 3)
        except Exception as e:  # noqa: BLE001 - report and go on; one JSON line is always printed
            timings[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    headline = [n for n in names if n in HEADLINE] or names
    print(json.dumps({
        "metric": "headline_median_sec_total",
        "value": round(sum(timings[n] or 0.0 for n in headline), 3),
        "unit": "sec",
        "queries": timings,
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark.version,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
