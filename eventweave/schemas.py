"""Fixed schemas of the engine (never inferred from data)."""

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

AMOUNT = DecimalType(18, 2)


def schema_of(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# A topic record; key and value already decoded from UTF-8 bytes.
RAW_RECORD = schema_of(("topic", StringType()), ("partition", IntegerType()), ("offset", LongType()),
                     ("key", StringType()), ("value", StringType()))

# The canonical event every input is brought to. payload is JSON text, occurred_at ISO text.
CANONICAL = schema_of(("event_id", StringType()), ("event_type", StringType()),
                    ("customer_id", LongType()), ("amount", AMOUNT),
                    ("payload", StringType()), ("occurred_at", StringType()))

# Target tables. Timestamps are UTC wall-clock values (TIMESTAMP_NTZ).
ORDERS = schema_of(("event_id", StringType()), ("customer_id", LongType()), ("amount", AMOUNT),
                 ("created_at", TimestampNTZType()))
EVENTS = schema_of(("event_id", StringType()), ("event_type", StringType()),
                 ("payload", StringType()), ("occurred_at", TimestampNTZType()))
EVENT_METRICS = schema_of(("event_id", StringType()), ("event_type", StringType()),
                        ("metric_value", LongType()), ("event_date", DateType()))
EVENT_SEGMENTS = schema_of(("event_id", StringType()), ("segment", StringType()), ("score", DoubleType()))
LAKE_EVENTS = schema_of(("event_id", StringType()), ("event_type", StringType()),
                      ("occurred_at", TimestampNTZType()), ("payload", StringType()))
TYPE_SUMMARY = schema_of(("event_type", StringType()), ("event_count", LongType()),
                       ("unique_events", LongType()))
LAKE_BY_DAY = StructType([*LAKE_EVENTS.fields, StructField("event_date", DateType(), True)])
QUARANTINE = schema_of(("reason", StringType()), ("raw", StringType()))
