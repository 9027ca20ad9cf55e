"""DuckDB statements that restate each registered query over the driver tables.

Shared pieces restate the derivation rules of ``plans/derived.py`` in SQL.
"""

from __future__ import annotations

# The shape rule of the raw records (see plans/derived.py).
EVENT_TYPE_RULE = ("CASE WHEN event_id % 7 = 0 THEN 'unknown' "
                   "WHEN event_id % 11 = 0 THEN NULL ELSE event_type END")
AMOUNT_RULE = ("CASE WHEN event_id % 5 = 0 THEN CAST(0 AS DECIMAL(18,2)) "
               "ELSE CAST(value AS DECIMAL(18,2)) END")
PAYLOAD_K_RULE = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END"
PAYLOAD_IS_RECORD_RULE = "(event_id % 3 = 0)"
LAKE_PAYLOAD_RULE = ("CASE WHEN event_id % 3 = 0 THEN '{}' ELSE "
                     "'{\"k\":' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) || '}' END")
ISO_RULE = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"

CANONICAL_CTE = f"""canon AS (
  SELECT event_id AS seq, CAST(event_id AS VARCHAR) AS event_id, {EVENT_TYPE_RULE} AS event_type,
         user_id AS customer_id, {AMOUNT_RULE} AS amount, {PAYLOAD_K_RULE} AS payload_k,
         {PAYLOAD_IS_RECORD_RULE} AS payload_is_record, {ISO_RULE} AS occurred_at, ts
  FROM events)"""

LAKE_CTE = f"""lake AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, {EVENT_TYPE_RULE} AS event_type,
         ts AS occurred_at, {LAKE_PAYLOAD_RULE} AS payload
  FROM events WHERE event_id % 10 <> 0)"""

METRICS_CTE = """metrics AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
         CAST(TRUNC(CAST(value AS DECIMAL(18,2))) AS BIGINT) AS metric_value, CAST(ts AS DATE) AS event_date
  FROM events WHERE event_type <> 'error'
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), event_type, CAST(1 AS BIGINT), CAST(ts AS DATE)
  FROM events WHERE event_type = 'purchase')"""

SEGMENTS_CTE = """segments AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN value >= 100 THEN 'high_value' WHEN event_type IN ('click', 'view') THEN 'engagement'
              ELSE 'standard' END AS segment,
         value / 500.0 AS score
  FROM events WHERE event_type <> 'signup')"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def three_way(join: str) -> str:
    return with_ctes(LAKE_CTE, METRICS_CTE, SEGMENTS_CTE) + f"""
SELECT i.event_id AS i_event_id, i.event_type AS i_event_type, s.event_id AS s_event_id,
       s.metric_value AS s_metric_value, r.event_id AS r_event_id, r.segment AS r_segment
FROM lake i {join} JOIN metrics s ON i.event_id = s.event_id
{join} JOIN segments r ON i.event_id = r.event_id"""
