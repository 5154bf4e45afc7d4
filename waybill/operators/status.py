"""Status and latency per tracking number.

A maximum of text makes Spark sort its input. Where the set of statuses is
closed, as a contract guarantees, the aggregates below work on fixed-width
buffers instead, which keeps them in hash aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas


def clean_events(events: DataFrame) -> DataFrame:
    """Events with a positive latency."""
    return events.filter(F.col("ping_latency_ms") > 0)


def status_rank(statuses: Sequence[str], status: str = "scan_type") -> Column:
    """Alphabetical rank of a status; a status outside the set is an error."""
    column = F.col(status)
    rank = F.when(column.isNull(), F.lit(None).cast("int"))
    for position, name in enumerate(sorted(statuses)):
        rank = rank.when(column == name, position)
    return rank.otherwise(F.raise_error(F.concat(F.lit("status outside the closed set: "), column)).cast("int"))


def rank_status(rank: Column, statuses: Sequence[str]) -> Column:
    names = F.array(*[F.lit(name) for name in sorted(statuses)])
    return F.get(names, rank)


def status_summary(events: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Alphabetically last status and mean latency of clean events, per parcel."""
    latency = F.avg("ping_latency_ms").alias("avg_latency")
    groups = clean_events(events).groupBy("tracking_number")
    if statuses is None:
        return groups.agg(F.max("scan_type").alias("latest_status"), latency)
    ranked = groups.agg(F.max(status_rank(statuses)).alias("_rank"), latency)
    return ranked.select("tracking_number", rank_status(F.col("_rank"), statuses).alias("latest_status"), "avg_latency")


def latest_scan(events: DataFrame, statuses: Sequence[str] | None = schemas.TELEMETRY_SCANS) -> DataFrame:
    """Status of the last clean scan by event time, per parcel.

    Keeps the last time of every status and compares those; of several scans
    at the same time the alphabetically last one counts. Without `statuses` any
    text is a status.
    """
    if statuses is None:
        last = clean_events(events).groupBy("tracking_number").agg(F.max(F.struct("timestamp", "scan_type")).alias("_last"))
        return last.select("tracking_number", F.col("_last.scan_type").alias("latest_status"),
                           F.col("_last.timestamp").alias("latest_time"))
    ordered = sorted(statuses, reverse=True)
    known = F.col("scan_type").isin(*ordered) | F.col("scan_type").isNull()
    checked = F.when(known, F.col("scan_type")).otherwise(
        F.raise_error(F.concat(F.lit("status outside the closed set: "), F.col("scan_type"))).cast("string"))
    times = clean_events(events).withColumn("scan_type", checked).groupBy("tracking_number").agg(
        *[F.max(F.when(F.col("scan_type") == name, F.col("timestamp"))).alias(name) for name in ordered])
    last = F.greatest(*[F.col(name) for name in ordered])
    status = F.lit(None).cast("string")
    for name in reversed(ordered):
        status = F.when(F.col(name) == last, F.lit(name)).otherwise(status)
    return times.select("tracking_number", status.alias("latest_status"), last.alias("latest_time"))
