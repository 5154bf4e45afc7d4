from datetime import datetime

import pytest

from waybill import schemas
from waybill.operators.status import latest_scan, status_summary

SCHEMA = "tracking_number string, scan_type string, timestamp timestamp_ntz, ping_latency_ms double"


def events(spark, *rows):
    return spark.createDataFrame([(key, kind, datetime(2024, 1, day), latency) for key, kind, day, latency in rows],
                                 SCHEMA)


@pytest.mark.parametrize("statuses", [None, schemas.TELEMETRY_SCANS])
def test_alphabetically_last_status_of_clean_events(spark, statuses):
    df = events(spark, ("a", "DELIVERED", 3, 2.0), ("a", "UNKNOWN_ERROR", 1, 4.0), ("a", "PICKUP", 2, 0.0),
                ("b", "DELIVERED", 3, 20000.0), ("b", "UNKNOWN_ERROR", 4, -1.0), ("b", "TRANSIT", 5, None),
                ("c", "PICKUP", 1, 0.0), ("d", None, 1, 3.0))
    got = {row[0]: tuple(row)[1:] for row in status_summary(df, statuses).collect()}
    assert got == {"a": ("UNKNOWN_ERROR", 3.0), "b": ("DELIVERED", 20000.0), "d": (None, 3.0)}


def test_last_scan_goes_by_time_then_name(spark):
    df = events(spark, ("a", "DELIVERED", 3, 2.0), ("a", "UNKNOWN_ERROR", 1, 4.0), ("a", "TRANSIT", 9, 0.0),
                ("b", "PICKUP", 5, 1.0), ("b", "DELIVERED", 5, 1.0))
    got = {row["tracking_number"]: (row["latest_status"], row["latest_time"].day) for row in latest_scan(df).collect()}
    assert got == {"a": ("DELIVERED", 3), "b": ("PICKUP", 5)}


@pytest.mark.parametrize("query", [lambda df: status_summary(df, schemas.TELEMETRY_SCANS), latest_scan])
def test_a_status_outside_a_closed_set_is_an_error(spark, query):
    with pytest.raises(Exception, match="status outside the closed set: LOST"):
        query(events(spark, ("a", "LOST", 1, 1.0))).collect()


def test_any_status_works_without_a_closed_set(spark):
    df = events(spark, ("a", "LOST", 1, 1.0), ("a", "FOUND", 2, 1.0), ("a", "EARLY", 2, 1.0))
    assert status_summary(df).first()["latest_status"] == "LOST"
    assert latest_scan(df, None).first()["latest_status"] == "FOUND"
