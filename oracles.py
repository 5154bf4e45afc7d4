"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

SCANS = """
scans AS (
  SELECT event_id,
         'TRK-' || user_id || '-' || strftime(date_trunc('week', ts), '%Y%m%d') AS tracking_number,
         CASE event_type WHEN 'signup' THEN 'PICKUP' WHEN 'purchase' THEN 'DELIVERED'
                         WHEN 'error' THEN 'UNKNOWN_ERROR' ELSE 'TRANSIT' END AS scan_type,
         ts AS "timestamp",
         CASE WHEN event_id % 10 = 0 THEN -99.0 ELSE value END AS ping_latency_ms
  FROM events)"""



def parcels(source: str) -> str:
    """Milestones and transit hours from a relation of scans."""
    return f"""
parcels AS (
  SELECT tracking_number,
         min("timestamp") FILTER (WHERE scan_type = 'PICKUP') AS pickup_time,
         max("timestamp") FILTER (WHERE scan_type = 'DELIVERED') AS delivery_time
  FROM {source} GROUP BY tracking_number
  HAVING count(*) FILTER (WHERE scan_type = 'DELIVERED') > 0),
hours AS (
  SELECT *, (epoch_us(delivery_time) - epoch_us(pickup_time)) / 3.6e9 AS h FROM parcels)"""


ROLLING_ROWS = ("round(avg(h) OVER (ORDER BY delivery_time, tracking_number ROWS 6 PRECEDING), 6)"
                " AS rolling_7_delivery_avg_hours")
ROLLING_DAYS = ("round(avg(h) OVER (ORDER BY delivery_time RANGE BETWEEN INTERVAL 7 DAY PRECEDING"
                " AND CURRENT ROW), 6) AS rolling_7_day_avg_hours")
MART_ROWS = f"""
SELECT tracking_number, pickup_time, delivery_time, round(h, 6) AS transit_hours, {ROLLING_ROWS},
       coalesce(h > 48, false) AS is_sla_breached
FROM hours"""
PARCELS = f"{SCANS},{parcels('scans')}"
MART = f"WITH {PARCELS}{MART_ROWS}"


def silver(source: str) -> str:
    return f"""
SELECT tracking_number, max(scan_type) AS latest_status, round(avg(ping_latency_ms), 6) AS avg_latency
FROM {source} WHERE ping_latency_ms > 0 GROUP BY tracking_number"""


SILVER = f"WITH {SCANS}{silver('scans')}"


def judged(*rules: tuple[str, str]) -> str:
    """What a JSON text is: whether it is one object, the kind and text of each
    field, and the broken rules, from DuckDB's own JSON functions."""
    fields = ", ".join(f"json_type(doc, '$.{name}') AS {name}_kind, json_extract_string(doc, '$.{name}') AS {name}_text"
                       for name, _ in rules)
    reasons = ", ".join(f"CASE {rule} END" for _, rule in rules)
    return f"""
docs AS (
  SELECT *, CASE WHEN json_valid(value) THEN CASE WHEN json_type(value) = 'OBJECT' THEN value::JSON END END AS doc
  FROM messages),
fields AS (SELECT *, {fields} FROM docs),
checked AS (
  SELECT *, CASE WHEN doc IS NULL THEN 'malformed_json' ELSE concat_ws(',', {reasons}) END AS reasons
  FROM fields)"""


def required(name: str, rest: str = "") -> tuple[str, str]:
    return name, (f"WHEN coalesce({name}_kind, 'NULL') = 'NULL' THEN 'missing:{name}'"
                  f" WHEN {name}_kind <> 'VARCHAR' THEN 'type:{name}' {rest}")


def listed(*scans: str) -> str:
    return f"WHEN scan_type_text NOT IN {scans} THEN 'pattern:scan_type'"


# Text with or without an offset of whole hours, in UTC.
TIME = r"""(try_cast(regexp_replace(timestamp_text, '[+-]\d\d:00$', '') AS TIMESTAMP)
            - coalesce(try_cast(regexp_extract(timestamp_text, '([+-]\d\d):00$', 1) AS INTEGER), 0) * INTERVAL 1 HOUR)"""
BAD_TIME = f"WHEN {TIME} IS NULL THEN 'type:timestamp'"

# The message texts, built by SQL, and what their contract makes of them.
CHECKED = f"""{SCANS},
messages AS (
  SELECT event_id, "timestamp" AS sent_at, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS iso,
         json_object('tracking_number', tracking_number, 'scan_type', scan_type, 'timestamp', iso,
                     'ping_latency_ms', 1.5::DOUBLE)::VARCHAR AS good,
         CASE event_id % 20
           WHEN 0 THEN '{{bad'
           WHEN 1 THEN json_object('tracking_number', event_id, 'scan_type', scan_type, 'timestamp', iso,
                                   'ping_latency_ms', 1.5::DOUBLE)::VARCHAR
           WHEN 2 THEN json_object('tracking_number', tracking_number, 'scan_type', 'LOST', 'timestamp', iso,
                                   'ping_latency_ms', 1.5::DOUBLE)::VARCHAR
           WHEN 3 THEN json_object('tracking_number', tracking_number, 'scan_type', scan_type,
                                   'ping_latency_ms', 1.5::DOUBLE)::VARCHAR
           WHEN 4 THEN json_object('tracking_number', tracking_number, 'scan_type', scan_type, 'timestamp', 'nope',
                                   'ping_latency_ms', 1.5::DOUBLE)::VARCHAR
           WHEN 5 THEN json_object('tracking_number', tracking_number, 'scan_type', scan_type, 'timestamp', iso,
                                   'ping_latency_ms', NULL)::VARCHAR
           WHEN 6 THEN json_object('tracking_number', tracking_number, 'scan_type', scan_type, 'timestamp', iso,
                                   'ping_latency_ms', 1.5::DOUBLE, 'extra', 'x')::VARCHAR
           WHEN 7 THEN json_object('tracking_number', tracking_number, 'scan_type', scan_type, 'timestamp', iso,
                                   'ping_latency_ms', '12.5')::VARCHAR
           WHEN 8 THEN '[1]'
           WHEN 9 THEN json_object('tracking_number', tracking_number, 'scan_type', 'LOST',
                                   'ping_latency_ms', 1.5::DOUBLE)::VARCHAR
           WHEN 10 THEN json_object('tracking_number', event_id, 'scan_type', scan_type, 'timestamp', 'nope',
                                    'ping_latency_ms', 1.5::DOUBLE)::VARCHAR
           WHEN 17 THEN good || ' ' || good
           WHEN 18 THEN json_object('tracking_number', tracking_number, 'scan_type', scan_type,
                                    'timestamp', iso || '+02:00', 'ping_latency_ms', 1.5::DOUBLE)::VARCHAR
           ELSE good END AS value
  FROM scans),{judged(
    required("tracking_number"),
    required("scan_type", listed("PICKUP", "TRANSIT", "DELIVERED", "UNKNOWN_ERROR")),
    required("timestamp", BAD_TIME),
    ("ping_latency_ms", "WHEN coalesce(ping_latency_ms_kind, 'NULL') = 'NULL' THEN NULL"
                        " WHEN ping_latency_ms_kind IN ('BOOLEAN', 'ARRAY', 'OBJECT')"
                        " OR try_cast(ping_latency_ms_text AS DOUBLE) IS NULL THEN 'type:ping_latency_ms'"))},
valid AS (
  SELECT sent_at, tracking_number_text AS tracking_number, scan_type_text AS scan_type,
         {TIME} AS "timestamp", ping_latency_ms_text::DOUBLE AS ping_latency_ms
  FROM checked WHERE reasons = '')"""
REJECT = """CASE WHEN doc IS NULL THEN 'Unknown' ELSE coalesce(tracking_number_text, 'Unknown') END"""
REASON = "split_part(reasons, ',', 1) AS reason, len(string_split(reasons, ','))::INTEGER AS reason_count"

WEBHOOKS = f"""{SCANS},
messages AS (
  SELECT event_id AS arrival, 'EVT-' || event_id AS id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS iso,
         strftime("timestamp", '%Y-%m-%dT00:00:00.000000') AS midnight,
         coalesce(CASE event_id % 20
           WHEN 0 THEN '{{bad'
           WHEN 1 THEN NULL
           WHEN 2 THEN json_object('event_id', id, 'tracking_number', event_id, 'scan_type', scan_type,
                                   'timestamp', iso)::VARCHAR
           WHEN 3 THEN json_object('event_id', NULL, 'tracking_number', tracking_number, 'scan_type', scan_type,
                                   'timestamp', iso)::VARCHAR
           WHEN 4 THEN json_object('event_id', id, 'tracking_number', tracking_number, 'scan_type', scan_type,
                                   'timestamp', 'nope')::VARCHAR
           WHEN 5 THEN json_object('event_id', id, 'tracking_number', tracking_number, 'scan_type', scan_type,
                                   'timestamp', iso, 'facility_code', 'FAC-1')::VARCHAR
           WHEN 6 THEN json_object('event_id', id, 'tracking_number', tracking_number, 'scan_type', scan_type,
                                   'timestamp', iso, 'facility_code', 1)::VARCHAR
           WHEN 7 THEN json_object('event_id', id, 'tracking_number', tracking_number, 'scan_type', scan_type,
                                   'timestamp', iso, 'is_duplicate', true)::VARCHAR
           WHEN 8 THEN json_object('event_id', id, 'tracking_number', tracking_number, 'scan_type', scan_type,
                                   'timestamp', iso, 'is_duplicate', 'yes')::VARCHAR
           WHEN 9 THEN json_object('event_id', id, 'tracking_number', tracking_number, 'scan_type', scan_type,
                                   'timestamp', iso, 'is_duplicate', NULL)::VARCHAR
           WHEN 10 THEN json_object('event_id', id, 'tracking_number', tracking_number,
                                    'scan_type', 'OUT_FOR_DELIVERY', 'timestamp', iso)::VARCHAR
           WHEN 11 THEN '[1]'
           ELSE json_object('event_id', id, 'tracking_number', tracking_number, 'scan_type', scan_type, 'timestamp',
                            CASE WHEN event_id % 20 IN (12, 13) THEN midnight ELSE iso END)::VARCHAR
         END, '{{}}') AS value
  FROM scans),{judged(
    required("event_id"),
    required("tracking_number"),
    required("scan_type", listed("PICKUP", "TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED")),
    required("timestamp", BAD_TIME),
    ("facility_code", "WHEN coalesce(facility_code_kind, 'NULL') NOT IN ('NULL', 'VARCHAR') THEN 'type:facility_code'"),
    ("is_duplicate", "WHEN is_duplicate_kind = 'NULL' OR (is_duplicate_kind IS NOT NULL AND lower(is_duplicate_text)"
                     " NOT IN ('1', 'on', 't', 'true', 'y', 'yes', '0', 'off', 'f', 'false', 'n', 'no'))"
                     " THEN 'type:is_duplicate'"))},
requests AS (
  SELECT arrival, CASE WHEN doc IS NULL THEN 500 WHEN reasons <> '' THEN 400 ELSE 200 END AS status_code FROM checked),
events_in AS (
  SELECT event_id_text AS event_id, tracking_number_text AS tracking_number, scan_type_text AS scan_type,
         {TIME} AS "timestamp", facility_code_text AS facility_code,
         coalesce(lower(is_duplicate_text) IN ('1', 'on', 't', 'true', 'y', 'yes'), false) AS is_duplicate, arrival
  FROM checked WHERE reasons = ''),
stored AS (
  SELECT tracking_number || '_' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS event_key, * FROM events_in)"""
WEBHOOK_STORE = f"""WITH {WEBHOOKS}
SELECT * FROM stored QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY arrival DESC) = 1"""

TELEMETRY_COLUMNS = 'tracking_number, scan_type, "timestamp", ping_latency_ms'

ORACLES = {
    "gold_sla": MART,
    "milestones": f"WITH {PARCELS} SELECT * FROM parcels",
    "transit_hours": f"WITH {PARCELS} SELECT tracking_number, round(h, 6) AS transit_hours FROM hours",
    "sla_flag": f"WITH {PARCELS} SELECT tracking_number, coalesce(h > 48, false) AS is_sla_breached FROM hours",
    "rolling_7_rows": f"WITH {PARCELS} SELECT tracking_number, {ROLLING_ROWS} FROM hours",
    "rolling_7_days": f"WITH {PARCELS} SELECT tracking_number, {ROLLING_DAYS} FROM hours",
    "gold_table": MART,
    "staging_events": f"""WITH {SCANS}
SELECT 'EVT-' || event_id AS event_id, tracking_number, scan_type, "timestamp" FROM scans""",
    "staging_union": f"""WITH {WEBHOOKS}
SELECT 'EVT-' || event_id AS event_id, tracking_number, scan_type, "timestamp" FROM scans
UNION ALL
SELECT event_id, tracking_number, scan_type, "timestamp" FROM events_in""",
    "silver_clean_events": f"WITH {SCANS} SELECT * FROM scans WHERE ping_latency_ms > 0",
    "silver_status": SILVER,
    "silver_exact": f"""WITH {SCANS},
clean AS (
  SELECT tracking_number, scan_type, floor(ping_latency_ms) AS whole,
         (ping_latency_ms - floor(ping_latency_ms)) * 1125899906842624::DOUBLE AS rest
  FROM scans WHERE ping_latency_ms > 0),
sums AS (
  SELECT tracking_number, max(scan_type) AS latest_status, count(*) AS n, sum(whole::HUGEINT) AS whole,
         sum(floor(rest)::HUGEINT) AS upper,
         sum(floor((rest - floor(rest)) * 1125899906842624::DOUBLE)::HUGEINT) AS lower
  FROM clean GROUP BY tracking_number),
carried AS (
  SELECT tracking_number, latest_status, n, whole, upper + lower // 1125899906842624 AS upper,
         lower % 1125899906842624 AS lower
  FROM sums)
SELECT tracking_number, latest_status,
       ((whole + upper // 1125899906842624)::DOUBLE
        + ((upper % 1125899906842624)::DOUBLE + lower::DOUBLE / 1125899906842624::DOUBLE) / 1125899906842624::DOUBLE)
       / n::DOUBLE AS avg_latency
FROM carried""",
    "silver_latest_scan": f"""WITH {SCANS}
SELECT tracking_number, arg_max(scan_type, ("timestamp", scan_type)) AS latest_status,
       max("timestamp") AS latest_time
FROM scans WHERE ping_latency_ms > 0 GROUP BY tracking_number""",
    "silver_roundtrip": SILVER,
    "gate_report": f"""WITH {SCANS},
counts AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE tracking_number IS NULL) AS no_key,
         count(ping_latency_ms) AS m,
         count(*) FILTER (WHERE ping_latency_ms NOT BETWEEN 0 AND 10000) AS outside
  FROM scans)
SELECT 'tracking_number is not null' AS expectation, n AS evaluated, no_key AS unexpected,
       no_key = 0 AS success FROM counts
UNION ALL
SELECT 'ping_latency_ms between 0 and 10000', m, outside, m = 0 OR (m - outside) / m >= 0.85 FROM counts""",
    "gate_violations": f"""WITH {SCANS}
SELECT event_id, tracking_number, ping_latency_ms FROM scans WHERE ping_latency_ms NOT BETWEEN 0 AND 10000""",
    "gate_halt": f"""WITH {SCANS},
counts AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE tracking_number IS NULL) AS no_key, count(ping_latency_ms) AS m,
         count(*) FILTER (WHERE ping_latency_ms NOT BETWEEN 0 AND 50) AS outside
  FROM scans),
report AS (
  SELECT 'tracking_number is not null' AS expectation, n AS evaluated, no_key AS unexpected, no_key = 0 AS success
  FROM counts
  UNION ALL
  SELECT 'ping_latency_ms between 0 and 50', m, outside, m = 0 OR (m - outside) / m >= 0.85 FROM counts)
SELECT *, (SELECT NOT bool_and(success) FROM report) AS halted FROM report""",
    "gate_no_rows": """
SELECT 'tracking_number is not null' AS expectation, count(*) AS evaluated, count(*) AS unexpected, true AS success
FROM events WHERE event_type = 'returned'
UNION ALL
SELECT 'ping_latency_ms between 0 and 10000', count(*), count(*), true FROM events WHERE event_type = 'returned'""",
    "message_text": """
SELECT event_id, CASE WHEN event_id % 13 > 1 THEN 'é ' || event_type END AS value,
       CASE WHEN event_id % 13 = 0 THEN base64(encode('é ' || event_type) || '\\xFF\\xFE'::BLOB) END AS payload_base64
FROM events""",
    "iso_times": """
SELECT event_id, CASE event_id % 9
  WHEN 3 THEN ts - INTERVAL 2 HOUR
  WHEN 4 THEN date_trunc('minute', ts) + INTERVAL 90 MINUTE
  WHEN 5 THEN date_trunc('day', ts)
  WHEN 6 THEN NULL WHEN 7 THEN NULL
  ELSE ts END AS "timestamp"
FROM events""",
    "contract_valid": f"WITH {CHECKED} SELECT * FROM valid",
    "contract_rejects": f"""WITH {CHECKED}
SELECT event_id, {REJECT} AS tracking_number, {REASON} FROM checked WHERE reasons <> ''""",
    "batch_counts": f"""WITH {CHECKED}
SELECT event_id // 100 AS batch_id, 'batch_' || strftime(min(sent_at), '%Y%m%d%H%M%S') AS batch_label,
       count(*) AS "rows", count(*) FILTER (WHERE reasons = '') AS valid
FROM checked GROUP BY 1""",
    "webhook_status": f"""WITH {WEBHOOKS}
SELECT arrival, status_code,
       CASE status_code WHEN 500 THEN 'malformed_json' WHEN 400 THEN 'Invalid Payload Schema'
            ELSE 'Event Validated and Ingested' END AS message
FROM requests""",
    "webhook_defaults": f"""WITH {WEBHOOKS}
SELECT arrival, event_id, scan_type, facility_code, is_duplicate FROM events_in""",
    "webhook_upsert": WEBHOOK_STORE,
    "duplicate_flag": f"""WITH {SCANS},
sent AS (
  SELECT event_id, "timestamp" AS arrival FROM scans
  UNION ALL
  SELECT event_id, CASE event_id % 2 WHEN 0 THEN "timestamp" ELSE "timestamp" + INTERVAL 1 HOUR END
  FROM scans WHERE scan_type = 'UNKNOWN_ERROR'),
known AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN arrival END AS arrival FROM sent)
SELECT event_id, arrival, row_number() OVER (PARTITION BY event_id ORDER BY arrival NULLS LAST) > 1 AS is_duplicate
FROM known""",
    "json_encode": f"""WITH {SCANS}
SELECT event_id, json_object('tracking_number', tracking_number, 'scan_type', scan_type,
         'timestamp', strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f'),
         'ping_latency_ms', ping_latency_ms)::VARCHAR AS record
FROM scans""",
    "bronze_roundtrip": f"WITH {SCANS} SELECT {TELEMETRY_COLUMNS} FROM scans",
    "stream_bronze": f"WITH {CHECKED} SELECT {TELEMETRY_COLUMNS} FROM valid",
    "stream_rejects": f"""WITH {CHECKED}
SELECT {REJECT} AS reject_key, {REASON}, value AS payload FROM checked WHERE reasons <> ''""",
    "stream_counts": f"""WITH {CHECKED}
SELECT 4::BIGINT AS batches, count(*) AS "rows", count(*) FILTER (WHERE reasons = '') AS valid FROM checked""",
    "stream_duplicates": "SELECT event_id FROM events",
    "stream_webhooks": WEBHOOK_STORE,
    "stream_duplicate_flag": """
SELECT event_id, 0 AS part, false AS is_duplicate FROM events
UNION ALL SELECT event_id, 1, true FROM events WHERE event_id % 5 = 0
UNION ALL SELECT event_id, 2, true FROM events WHERE event_id % 3 = 0 AND event_id % 4 < 3""",
    "ingest_audit": """WITH kept AS (
  SELECT event_id, (event_id % 3)::INTEGER AS p, event_id // 3 AS o FROM events
  WHERE NOT (event_id // 3 BETWEEN 100 AND 140 AND event_id % 3 = 1) AND event_id % 977 <> 5),
counted AS (
  SELECT p, o, count(*) AS copies FROM (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE event_id BETWEEN 300 AND 420)
  GROUP BY p, o),
gaps AS (SELECT p, lag(o) OVER (PARTITION BY p ORDER BY o) + 1 AS low, o - 1 AS high FROM counted),
doubled AS (
  SELECT p, o, o - row_number() OVER (PARTITION BY p ORDER BY o) AS run FROM counted WHERE copies > 1)
SELECT 'scans' AS topic, p AS "partition", 'missing' AS kind, low AS first_offset, high AS last_offset,
       high - low + 1 AS offsets FROM gaps WHERE high >= low
UNION ALL
SELECT 'scans', p, 'doubled', min(o), max(o), max(o) - min(o) + 1 FROM doubled GROUP BY p, run""",
    "rejects_replayed": f"""WITH {CHECKED}
SELECT {TELEMETRY_COLUMNS}, 0 AS attempt FROM valid
UNION ALL SELECT tracking_number, 'TRANSIT', "timestamp", 1.5, 1 FROM scans WHERE event_id % 20 = 2
UNION ALL SELECT tracking_number, scan_type, TIMESTAMP '2024-01-01', 1.5, 3 FROM scans WHERE event_id % 20 = 4""",
    "bronze_arrays": f"""WITH {SCANS}
SELECT event_id // 200 AS batch, {TELEMETRY_COLUMNS}, false AS damaged FROM scans WHERE event_id // 200 % 10 <> 3
UNION ALL SELECT DISTINCT event_id // 200, NULL, NULL, NULL, NULL, true FROM scans WHERE event_id // 200 % 10 = 3""",
    "bronze_inferred": f"""WITH {SCANS}
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN floor(abs(ping_latency_ms)) ELSE ping_latency_ms END AS latency,
       CASE WHEN event_id % 2 = 0 THEN (event_id % 7)::VARCHAR ELSE scan_type END AS code,
       CASE WHEN event_id % 2 = 1 AND event_id % 3 = 0 THEN 'late' END AS note,
       CASE WHEN event_id % 2 = 0 THEN true END AS seen
FROM scans""",
    "gold_incremental": f"WITH {CHECKED},{parcels('valid')}{MART_ROWS}",
    "medallion_gold": f"WITH {CHECKED},{parcels('valid')}{MART_ROWS}",
    "medallion_silver": f"WITH {CHECKED}{silver('valid')}",
}
