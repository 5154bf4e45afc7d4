"""The data of the registered queries: scan events, messages and webhook requests
derived from the `events` test table.

One parcel per user and week; the event type gives the scan type, and every
tenth event carries the sensor's error value as its latency.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.text import record_json
from waybill.functions.time import iso_text

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
SENSOR_ERROR = -99.0
# A small Parquet file is read by one task, whatever it holds.
FILE_ROWS = 100_000
# Event type -> scan type; every other type is TRANSIT.
SCAN_OF_TYPE = {"signup": "PICKUP", "purchase": "DELIVERED", "error": "UNKNOWN_ERROR"}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def file_count(events: DataFrame, batches: int = 1) -> int:
    """Into how many files the events of each of `batches` batches go. The tasks that read a batch are about as many."""
    return max(1, -(-events.count() // (batches * FILE_ROWS)))


def stream_events(spark: SparkSession, folder: str, files: int = 1) -> DataFrame:
    """The files of a folder of events as a stream, so many files a batch."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(folder)


def telemetry(events: DataFrame, scans: tuple[str, ...] | None = None) -> DataFrame:
    """Scan events. `scans` keeps only the named scan types (other than TRANSIT)
    through a filter on the event type, so that it reaches the Parquet scan."""
    if scans is not None:
        events = events.filter(F.col("event_type").isin(
            [kind for kind, scan in SCAN_OF_TYPE.items() if scan in scans]))
    return events.select(
        "event_id",
        _tracking_number().alias("tracking_number"),
        _scan_type().alias("scan_type"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 10 == 0, SENSOR_ERROR).otherwise(F.col("value")).alias("ping_latency_ms"),
    )


def _tracking_number() -> Column:
    """`TRK-<user>-<Monday as yyyyMMdd>`; numbers are cheaper here than a date format."""
    monday = F.date_sub(F.to_date("ts"), F.weekday("ts"))
    digits = F.year(monday) * 10000 + F.month(monday) * 100 + F.day(monday)
    return F.concat(F.lit("TRK-"), F.col("user_id"), F.lit("-"), digits)


def _scan_type() -> Column:
    scan = F.lit("TRANSIT")
    for kind, name in SCAN_OF_TYPE.items():
        scan = F.when(F.col("event_type") == kind, name).otherwise(scan)
    return scan


def _broken(cases: dict[int, Column], regular: Column) -> Column:
    """Pick a payload by `event_id % 20`."""
    payload = regular
    for remainder, case in cases.items():
        payload = F.when(F.col("event_id") % 20 == remainder, case).otherwise(payload)
    return payload


def telemetry_messages(events: DataFrame) -> DataFrame:
    """`event_id, sent_at, value`: one JSON text per event, some classes odd.

    Class 0 is cut off, 1 has a number as tracking number, 2 an unlisted scan
    type, 3 no timestamp, 4 a bad timestamp, 5 a null latency, 6 an extra
    field, 7 the latency as text, 8 is an array, 9 an unlisted scan type and no
    timestamp, 10 a number as tracking number and a bad timestamp, 17 has two
    documents in one payload, 18 an offset on the timestamp.
    """
    good = dict(
        tracking_number=F.col("tracking_number"),
        scan_type=F.col("scan_type"),
        timestamp=iso_text(F.col("timestamp")),
        ping_latency_ms=F.lit(1.5),
    )
    without_time = {name: column for name, column in good.items() if name != "timestamp"}
    offset_time = F.concat(iso_text(F.col("timestamp")), F.lit("+02:00"))
    cases = {
        0: F.lit("{bad"),
        1: record_json(**{**good, "tracking_number": F.col("event_id")}),
        2: record_json(**{**good, "scan_type": F.lit("LOST")}),
        3: record_json(**without_time),
        4: record_json(**{**good, "timestamp": F.lit("nope")}),
        5: record_json(**{**good, "ping_latency_ms": F.lit(None).cast("double")}),
        6: record_json(**good, extra=F.lit("x")),
        7: record_json(**{**good, "ping_latency_ms": F.lit("12.5")}),
        8: F.lit("[1]"),
        9: record_json(**{**without_time, "scan_type": F.lit("LOST")}),
        10: record_json(**{**good, "tracking_number": F.col("event_id"), "timestamp": F.lit("nope")}),
        17: F.concat(record_json(**good), F.lit(" "), record_json(**good)),
        18: record_json(**{**good, "timestamp": offset_time}),
    }
    return telemetry(events).select("event_id", F.col("timestamp").alias("sent_at"),
                                    _broken(cases, record_json(**good)).alias("value"))


def webhook_requests(events: DataFrame) -> DataFrame:
    """`arrival, body`: one webhook request per event, several classes odd.

    Class 0 is cut off, 1 has no body, 2 a number as tracking number, 3 a null
    event id, 4 a bad timestamp, 5 a facility, 6 a facility that is a number,
    7 the flag set, 8 the flag as text, 9 the flag null, 10 another scan type,
    11 an array. Events of classes 12 and 13 give midnight as their time, so
    that some keys repeat.
    """
    midnight = F.concat(F.substring(iso_text(F.col("timestamp")), 1, 10), F.lit("T00:00:00.000000"))
    good = dict(
        event_id=F.concat(F.lit("EVT-"), F.col("event_id")),
        tracking_number=F.col("tracking_number"),
        scan_type=F.col("scan_type"),
        timestamp=iso_text(F.col("timestamp")),
    )
    cases = {
        0: F.lit("{bad"),
        1: F.lit(None).cast("string"),
        2: record_json(**{**good, "tracking_number": F.col("event_id")}),
        3: record_json(**{**good, "event_id": F.lit(None).cast("string")}),
        4: record_json(**{**good, "timestamp": F.lit("nope")}),
        5: record_json(**good, facility_code=F.lit("FAC-1")),
        6: record_json(**good, facility_code=F.lit(1)),
        7: record_json(**good, is_duplicate=F.lit(True)),
        8: record_json(**good, is_duplicate=F.lit("yes")),
        9: record_json(**good, is_duplicate=F.lit(None).cast("boolean")),
        10: record_json(**{**good, "scan_type": F.lit("OUT_FOR_DELIVERY")}),
        11: F.lit("[1]"),
        12: record_json(**{**good, "timestamp": midnight}),
        13: record_json(**{**good, "timestamp": midnight}),
    }
    return telemetry(events).select(F.col("event_id").alias("arrival"),
                                    _broken(cases, record_json(**good)).alias("body"))
