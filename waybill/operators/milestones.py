"""Pickup and delivery milestones, transit time and the SLA flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import schemas
from waybill.functions.time import hours_between, micros_between

MILESTONE_SCANS = (schemas.PICKUP, schemas.DELIVERED)


def first_time(scan: str) -> Column:
    return F.min(F.when(F.col("scan_type") == scan, F.col("timestamp")))


def last_time(scan: str) -> Column:
    return F.max(F.when(F.col("scan_type") == scan, F.col("timestamp")))


def milestones(events: DataFrame) -> DataFrame:
    """First pickup and last delivery of every delivered parcel.

    Parcels without either scan would have no delivery and drop out anyway,
    so other scans are left out before the shuffle.
    """
    return delivered(
        events.filter(F.col("scan_type").isin(*MILESTONE_SCANS))
        .groupBy("tracking_number")
        .agg(first_time(schemas.PICKUP).alias("pickup_time"), last_time(schemas.DELIVERED).alias("delivery_time"))
    )


def delivered(parcels: DataFrame) -> DataFrame:
    return parcels.filter(F.col("delivery_time").isNotNull())


def transit(parcels: DataFrame) -> DataFrame:
    """Signed hours from pickup to delivery; NULL without a pickup."""
    return parcels.withColumn("transit_hours", hours_between(F.col("pickup_time"), F.col("delivery_time")))


def transit_micros(parcels: DataFrame) -> DataFrame:
    """The same span as an exact integer, for sums that must not drift."""
    return parcels.withColumn("transit_micros", micros_between(F.col("pickup_time"), F.col("delivery_time")))


def sla_flag(parcels: DataFrame, hours: float = schemas.SLA_HOURS) -> DataFrame:
    """True only above the limit; an unknown transit time is no breach."""
    late = F.when(F.col("transit_hours") > hours, True).otherwise(False)
    return parcels.withColumn("is_sla_breached", late)
