"""Schemas and fixed values shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Scan types, thresholds and texts that results depend on.
PICKUP = "PICKUP"
DELIVERED = "DELIVERED"
TELEMETRY_SCANS = ("PICKUP", "TRANSIT", "DELIVERED", "UNKNOWN_ERROR")
WEBHOOK_SCANS = ("PICKUP", "TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED")
UNKNOWN_KEY = "Unknown"
LATENCY_LOW = 0.0
LATENCY_HIGH = 10000.0
LATENCY_MOSTLY = 0.85
SLA_HOURS = 48
ROLLING_DELIVERIES = 7
ROLLING_DAYS = 7
ACCEPTED_MESSAGE = "Event Validated and Ingested"
REJECTED_MESSAGE = "Invalid Payload Schema"

# A telemetry record as every layer after bronze sees it.
TELEMETRY = T.StructType([
    T.StructField("tracking_number", T.StringType()),
    T.StructField("scan_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("ping_latency_ms", T.DoubleType()),
])

# The same record inside a bronze JSON file, where the timestamp is text.
BRONZE = T.StructType([
    T.StructField("tracking_number", T.StringType()),
    T.StructField("scan_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("ping_latency_ms", T.DoubleType()),
])

# A rejected payload: the key it names, why, its text or else its bytes, where it came from and its batch.
REJECTS = T.StructType([
    T.StructField("reject_key", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("reasons", T.ArrayType(T.StringType())),
    T.StructField("payload", T.StringType()),
    T.StructField("payload_base64", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("arrival", T.LongType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("batch_id", T.IntegerType()),
])

# A stored webhook event; `arrival` says which of two under one key is later.
WEBHOOK_EVENT = T.StructType([
    T.StructField("event_key", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("tracking_number", T.StringType()),
    T.StructField("scan_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("facility_code", T.StringType()),
    T.StructField("is_duplicate", T.BooleanType()),
    T.StructField("arrival", T.LongType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("source", T.StringType()),
    T.StructField("batch_id", T.IntegerType()),
])
