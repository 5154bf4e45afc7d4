"""Literal rows as a relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The known two-scan parcel, 54 hours from pickup to delivery.
SAMPLE_SCANS = [
    ("EVT-001", "TRK-98765", "PICKUP", "2023-10-01 08:00:00"),
    ("EVT-002", "TRK-98765", "DELIVERED", "2023-10-03 14:00:00"),
]


def sample_events(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(SAMPLE_SCANS, "event_id string, tracking_number string, scan_type string, ts string")
    return rows.select("event_id", "tracking_number", "scan_type",
                       F.col("ts").try_cast("timestamp_ntz").alias("timestamp"))


def staged_scans(events: DataFrame) -> DataFrame:
    """The staging columns of scan events, of whatever type."""
    return events.select(F.concat(F.lit("EVT-"), F.col("event_id")).alias("event_id"), "tracking_number", "scan_type",
                         "timestamp")


def stacked(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Relations of different sources under each other, by position; copies stay."""
    for other in others:
        first = first.unionAll(other)
    return first


def register(name: str, df: DataFrame) -> DataFrame:
    """Make `df` a named view and return the view, so later steps refer to it by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
