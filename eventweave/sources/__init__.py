"""Readers: event files, topics, lake scans, staged Parquet, SQL by workload."""
