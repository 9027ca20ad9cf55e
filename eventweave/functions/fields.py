"""Column expressions for open-schema JSON events (all JVM-side, inside codegen).

Events are parsed once into a VARIANT column. A key that is *absent* and a key that
holds JSON ``null`` must stay apart (a default applies only to the absent case):
``try_variant_get(v, path, 'variant')`` is SQL NULL only when the key is missing, while
a JSON null comes back as a (non-NULL) variant null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text formats of the ISO-8601 timestamps written and read by the engine.
ISO_UTC_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_UTC_OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _path(key: str) -> str:
    return "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def parse(text: Column, strict: bool = False) -> Column:
    """JSON text -> VARIANT. Lenient form yields NULL for text that is not JSON."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def is_object(v: Column) -> Column:
    """True when a parsed VARIANT is an object (a cast to the empty struct succeeds)."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def has_key(v: Column, key: str) -> Column:
    """The object holds ``key`` (its value may be JSON null)."""
    return F.try_variant_get(v, _path(key), "variant").isNotNull()


def field(v: Column, key: str, dtype: str) -> Column:
    """Value of ``key`` cast to ``dtype``; NULL when absent, null or not castable."""
    return F.try_variant_get(v, _path(key), dtype)


def field_or(v: Column, key: str, dtype: str, default: Column) -> Column:
    """``dict.get(key, default)``: the default applies only when the key is absent."""
    return F.when(has_key(v, key), field(v, key, dtype)).otherwise(default)


def json_text(v: Column) -> Column:
    """VARIANT -> JSON text (JSON null gives the text ``null``)."""
    return F.to_json(v)


def iso_text(ts: Column, offset_form: bool = False) -> Column:
    """Timestamp -> ISO-8601 UTC text, microsecond precision."""
    return F.date_format(ts, ISO_UTC_OFFSET if offset_form else ISO_UTC_Z)


def iso_to_ts(text: Column) -> Column:
    """ISO-8601 text (zone suffix honoured) -> UTC wall-clock TIMESTAMP_NTZ; bad text -> NULL."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def date_prefix(text: Column) -> Column:
    """The first 10 characters as a date: the day as written, not the UTC day."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def truncate_to_bigint(x: Column) -> Column:
    """Numeric -> BIGINT by truncation toward zero (249.99 -> 249)."""
    return x.cast("bigint")
