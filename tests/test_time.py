from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waybill.functions import time

ISO = {
    "2024-01-02T03:04:05": datetime(2024, 1, 2, 3, 4, 5),
    "2024-01-02 03:04:05.123456": datetime(2024, 1, 2, 3, 4, 5, 123456),
    "2024-01-02T03:04:05.1234567": datetime(2024, 1, 2, 3, 4, 5, 123456),
    "2024-01-02t03:04:05,5z": datetime(2024, 1, 2, 3, 4, 5, 500000),
    "2024-01-02_03:04": datetime(2024, 1, 2, 3, 4),
    "2024-01-02T03:04Z": datetime(2024, 1, 2, 3, 4),
    "2024-01-02": datetime(2024, 1, 2),
    "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
    "2024-01-02T03:04:05+02:00": datetime(2024, 1, 2, 1, 4, 5),
    "2024-01-02T03:04:05-0530": datetime(2024, 1, 2, 8, 34, 5),
    "2024-01-02T03:04+01:00": datetime(2024, 1, 2, 2, 4),
    "2024-01-02T25:04:05": None,
    "2024-02-30T00:00:00": None,
    "2024-01": None,
    "2024": None,
    "T10:00": None,
    "now": None,
    "2024-01-02T03:04:05\n": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_text_is_read_as_utc_in_any_session_zone(spark, zone):
    rows = spark.createDataFrame([(text,) for text in ISO], "text string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = rows.select("text", time.iso_to_timestamp(F.col("text")).alias("ts")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {row["text"]: row["ts"] for row in got} == ISO


def test_epoch_numbers_count_seconds_or_milliseconds(spark):
    numbers = [0.0, 1704164645.0, 1704164645.5, 1704164645000.0, -1.0, 1e300, None]
    rows = spark.createDataFrame([(n,) for n in numbers], "n double")
    got = [row[0] for row in rows.select(time.epoch_to_timestamp(F.col("n"))).collect()]
    assert got == [
        datetime(1970, 1, 1), datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 500000),
        datetime(2024, 1, 2, 3, 4, 5), datetime(1969, 12, 31, 23, 59, 59), None, None]


def test_hours_are_signed_and_null_without_a_start(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 3, 6)), (datetime(2024, 1, 2), datetime(2024, 1, 1)),
         (None, datetime(2024, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    got = [row[0] for row in rows.select(time.hours_between(F.col("a"), F.col("b"))).collect()]
    assert got == [54.0, -24.0, None]


def test_texts(spark):
    row = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz").select(
        time.iso_text(F.col("ts")).alias("iso"), time.compact_text(F.col("ts")).alias("compact")).first()
    assert row["iso"] == "2024-01-02T03:04:05.000000"
    assert row["compact"] == "20240102030405"
