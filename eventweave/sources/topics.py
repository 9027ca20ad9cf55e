"""Topic source (S2): records ``topic, partition, offset, key, value`` as a batch or a stream.

``fmt="kafka"`` reads a Kafka topic (from the earliest offset on first start; the stream
checkpoint holds the offsets after that). Without the Kafka connector on the classpath,
a *file topic* stands in: a folder of JSON lines with the same five columns, read with
a fixed schema. ``max_per_trigger`` caps one micro-batch (offsets or files). Offsets that the
broker no longer holds fail the query (Kafka's ``failOnDataLoss``, true unless the caller
passes otherwise): lost records are not skipped unseen.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.schemas import RAW_RECORD


def _kafka_columns(df: DataFrame) -> DataFrame:
    return df.select("topic", "partition", "offset",
                     F.col("key").cast("string").alias("key"),      # UTF-8 decode
                     F.col("value").cast("string").alias("value"))


def read_topic(spark: SparkSession, topic_or_path: str, *, fmt: str = "json", streaming: bool = True,
               max_per_trigger: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    opts = dict(options or {})
    if fmt == "kafka":
        if not any(k in opts for k in ("subscribe", "subscribePattern", "assign")):
            opts["subscribe"] = topic_or_path
        opts.setdefault("startingOffsets", "earliest")
        if max_per_trigger and streaming:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        reader = spark.readStream if streaming else spark.read
        return _kafka_columns(reader.format("kafka").options(**opts).load())
    if max_per_trigger and streaming:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger))
    reader = (spark.readStream if streaming else spark.read).schema(RAW_RECORD).options(**opts)
    return reader.format(fmt).load(topic_or_path)


def read_slice(spark: SparkSession, topic_or_path: str, *, fmt: str = "json", after: Mapping[tuple[str, int], int],
               until: Mapping[tuple[str, int], int] | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """The records of a topic, as a batch, with offsets above ``after`` (by topic and partition;
    from the start where it has none) and, if given, up to ``until``.

    Kafka reads only that range (the offsets go to the broker; partitions added to a topic later
    need its ``until``). A file topic is scanned and filtered.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        for name, ends in (("startingOffsets", after), ("endingOffsets", until)):
            if ends:
                by: dict[str, dict[str, int]] = {}
                for (t, p), o in ends.items():
                    by.setdefault(t, {})[str(p)] = o + 1         # the next offset, excluded at the end
                opts[name] = json.dumps(by)
    df = read_topic(spark, topic_or_path, fmt=fmt, streaming=False, options=opts)
    shape = "topic string, partition int, _offset bigint"

    def ends_of(ends):          # a row a partition
        return F.broadcast(spark.createDataFrame([(t, p, o) for (t, p), o in ends.items()], shape))

    same = [F.col("r.topic").eqNullSafe(F.col("e.topic")), F.col("r.partition").eqNullSafe(F.col("e.partition"))]
    if after:
        df = df.alias("r").join(ends_of(after).alias("e"), same, "left").where(F.col("_offset").isNull() | (F.col("offset") > F.col("_offset"))).select("r.*")
    if until is not None:
        df = df.alias("r").join(ends_of(until).alias("e"), same).where(F.col("offset") <= F.col("_offset")).select("r.*")
    return df
