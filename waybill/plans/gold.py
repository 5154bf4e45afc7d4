"""The SLA mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.time import micros_to_hours
from waybill.operators.milestones import milestones, sla_flag, transit, transit_micros
from waybill.operators.rolling import rolling_days, rolling_rows

DELIVERY_ORDER = ("delivery_time", "tracking_number")
COLUMNS = ("tracking_number", "pickup_time", "delivery_time", "transit_hours",
           "rolling_7_delivery_avg_hours", "is_sla_breached")


def sla_mart(parcels: DataFrame, **options) -> DataFrame:
    """The mart over delivered parcels with their milestones."""
    return (
        parcels.transform(transit)
        .transform(rolling_rows, "transit_hours", DELIVERY_ORDER, "rolling_7_delivery_avg_hours", **options)
        .transform(sla_flag)
        .select(*COLUMNS)
    )


def gold_sla(events: DataFrame) -> DataFrame:
    """The mart over scan events."""
    return sla_mart(milestones(events))


def rolling_week(parcels: DataFrame) -> DataFrame:
    """Average transit hours over the seven days up to each delivery."""
    rolled = rolling_days(transit_micros(parcels), "transit_micros", "delivery_time", "_micros")
    return (rolled.withColumn("rolling_7_day_avg_hours", micros_to_hours(F.col("_micros")))
            .drop("_micros", "transit_micros"))
