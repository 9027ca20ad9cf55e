"""eventweave: event analytics on Spark DataFrames, Spark SQL and Structured Streaming.

Layout:
    functions/  column expressions (JSON field access with defaults, time helpers)
    operators/  DataFrame -> DataFrame operators (canonicalise, projections,
                per-type summary, star join, latest-per-key, shard layout)
    sources/    readers (event files, topics, lake scan, staged Parquet, SQL by workload)
    sinks/      writers (keyed JSON publish, idempotent appends, upsert, bulk load, export)
    streaming/  the fan-out Structured Streaming query
    plans/      end-to-end jobs (incremental sync) and the registered queries
"""

from eventweave.session import build_session, prepare, scale_conf, work_dir

__all__ = ["build_session", "prepare", "scale_conf", "work_dir"]
