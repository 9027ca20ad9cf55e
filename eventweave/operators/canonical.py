"""Raw JSON events -> the canonical event shape (P1), the lake shape (P5), and the
split of records that cannot be canonicalised (P9, P10).

Every function is a column transform over a DataFrame that holds JSON text, so it runs
unchanged on a batch or a streaming DataFrame and stays inside whole-stage codegen. The
text is parsed exactly once per record (see :func:`classify`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.functions import fields as J
from eventweave.schemas import AMOUNT

STATUS = "_status"
OK = "ok"
MALFORMED = "malformed_json"
NOT_OBJECT = "not_object"
MISSING_EVENT_ID = "missing_event_id"
#: What the lake shape (P5) needs beside the canonical fields.
HAS_EVENT_ID, LAKE_PAYLOAD, LAKE_TIME = "_has_event_id", "_lake_payload", "_lake_time"

CANONICAL_COLUMNS = ("event_id", "event_type", "customer_id", "amount", "payload", "occurred_at")
LAKE_COLUMNS = ("event_id", "event_type", "occurred_at", "payload")


def ok_predicate(v: Column) -> Column:
    """Boolean form of ``_status = 'ok'``. It refers to the parsed variant only, so a filter
    on it stays above the parse instead of being pushed (with copies of its input) below."""
    return J.is_object(v)


def classify(df: DataFrame, value_col: str = "value", *, strict: bool = False,
             variant_col: str = "_v") -> DataFrame:
    """Parse ``value_col`` once into ``variant_col`` and tag each row with ``_status``.

    ``strict=True`` restores the raising behaviour: bad JSON or a non-object fails the job.
    """
    text = F.col(value_col)
    # The variant comes out of a 1:1 generator, not a projection: Catalyst pushes a filter
    # through a projection by copying its expressions, so a later filter on the status
    # would parse every record a second time. A filter on generator output stays above it.
    out = df.select("*", F.explode(F.array(J.parse(text, strict=strict))).alias(variant_col))
    status = (F.when(F.col(variant_col).isNull(), F.lit(MALFORMED))
              .when(~J.is_object(F.col(variant_col)), F.lit(NOT_OBJECT))
              .otherwise(F.lit(OK)))
    if strict:
        status = F.when(status == OK, status).otherwise(
            F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring(text, 1, 200))))
    return out.withColumn(STATUS, status)


def canonical_columns(v: Column, ingest_ts: Column | None = None) -> list[Column]:
    """The six canonical fields from a parsed object; defaults only for absent keys."""
    now = J.iso_text(ingest_ts if ingest_ts is not None else F.current_timestamp(), offset_form=True)
    # event_id, else id: an explicit null event_id does not fall through to id.
    event_id = F.when(J.has_key(v, "event_id"), J.field(v, "event_id", "string")) \
        .otherwise(J.field(v, "id", "string"))
    payload = F.when(J.has_key(v, "payload"), J.json_text(J.field(v, "payload", "variant"))) \
        .otherwise(J.json_text(v))
    return [
        event_id.alias("event_id"),
        J.field_or(v, "event_type", "string", F.lit("unknown")).alias("event_type"),
        J.field(v, "customer_id", "bigint").alias("customer_id"),
        J.field_or(v, "amount", "decimal(18,2)", F.lit(0).cast(AMOUNT)).alias("amount"),
        payload.alias("payload"),
        J.field_or(v, "occurred_at", "string", now).alias("occurred_at"),
    ]


def with_field_status(status: Column, v: Column, fields: tuple[str, ...] = ("customer_id", "amount", "occurred_at")) -> Column:
    """``status``, or ``bad_<field>`` for a value that is there, is not JSON null and does not
    fit its type: it would be stored as a null that looks like a missing value."""
    fits = {"customer_id": J.field(v, "customer_id", "bigint"), "amount": J.field(v, "amount", "decimal(18,2)"),
            "occurred_at": J.iso_to_ts(J.field(v, "occurred_at", "string"))}
    out = status
    for f in reversed(fields):
        given = J.field(v, f, "variant")
        bad = given.isNotNull() & ~F.is_variant_null(given) & fits[f].isNull()
        out = F.when((status == OK) & bad, F.lit(f"bad_{f}")).otherwise(out)
    return out


def canonicalise(df: DataFrame, value_col: str = "value", *, keep: tuple[str, ...] = (),
                 ingest_ts: Column | None = None, strict: bool = False,
                 with_status: bool = False, lake_fields: bool = False) -> DataFrame:
    """JSON text rows -> canonical events (plus ``keep`` columns, e.g. partition/offset).

    Rows that are not JSON objects are removed unless ``with_status`` is set, in which case
    every row is kept and ``_status`` tells them apart (see :func:`split`).
    """
    tagged = classify(df, value_col, strict=strict)
    v = F.col("_v")
    cols = [F.col(c) for c in keep] + canonical_columns(v, ingest_ts)
    if with_status:
        cols.append(with_field_status(F.col(STATUS), v).alias(STATUS))
        cols.append(F.col(value_col).alias("_raw"))
        if lake_fields:
            cols += [F.coalesce(J.has_key(v, "event_id"), F.lit(False)).alias(HAS_EVENT_ID), lake_columns(v)[3].alias(LAKE_PAYLOAD),
                     J.field(v, "occurred_at", "string").alias(LAKE_TIME)]
        return tagged.select(*cols)
    return tagged.where(ok_predicate(v)).select(*cols)


def lake_columns(v: Column) -> list[Column]:
    """P5: event_id required; event_type else 'unknown'; occurred_at as timestamp; payload else {}."""
    payload = F.when(J.has_key(v, "payload"), J.json_text(J.field(v, "payload", "variant"))) \
        .otherwise(F.lit("{}"))
    return [
        J.field(v, "event_id", "string").alias("event_id"),
        J.field_or(v, "event_type", "string", F.lit("unknown")).alias("event_type"),
        J.iso_to_ts(J.field(v, "occurred_at", "string")).alias("occurred_at"),
        payload.alias("payload"),
    ]


def lake_normalise(df: DataFrame, value_col: str = "value", *, keep: tuple[str, ...] = (),
                   strict: bool = False) -> DataFrame:
    """Raw JSON text -> lake rows with ``_status`` (missing event_id key is a reject)."""
    tagged = classify(df, value_col, strict=strict)
    v = F.col("_v")
    status = F.when((F.col(STATUS) == OK) & ~J.has_key(v, "event_id"), F.lit(MISSING_EVENT_ID)) \
        .otherwise(with_field_status(F.col(STATUS), v, ("occurred_at",)))
    if strict:
        status = F.when(status == OK, status).otherwise(
            F.raise_error(F.lit("lake record without event_id")))
    return tagged.select(*[F.col(c) for c in keep], *lake_columns(v), status.alias(STATUS),
                         F.col(value_col).alias("_raw"))


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without bookkeeping columns, quarantined rows: reason + raw text)."""
    good = tagged.where(F.col(STATUS) == OK).drop(STATUS, "_raw", "_v", HAS_EVENT_ID, LAKE_PAYLOAD, LAKE_TIME)
    bad = tagged.where(F.col(STATUS) != OK).select(F.col(STATUS).alias("reason"), F.col("_raw").alias("raw"))
    return good, bad
