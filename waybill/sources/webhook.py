"""Webhook requests: a `body` column of JSON text, in a table or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.text import or_default

# Messages of one millisecond in one partition are told apart by so many bits of their offsets; the rest lasts to 2248.
OFFSET_BITS = 20


def read_webhooks(requests: DataFrame) -> DataFrame:
    """Request bodies as `value`; an absent body counts as an empty object.

    `arrival` orders requests. Without such a column it is the millisecond of the
    request's message and, within it, the offset; without a partition, which
    says that offsets do not compare, the offset alone; or else the microsecond
    it was taken in (`timestamp`) or this is run.
    """
    if "arrival" in requests.columns:
        arrival = F.col("arrival")
    elif {"partition", "offset", "timestamp"} <= set(requests.columns):
        millis = F.unix_millis(F.col("timestamp").cast("timestamp"))
        arrival = F.shiftleft(millis, OFFSET_BITS) + F.col("offset") % (1 << OFFSET_BITS)
    elif "offset" in requests.columns:
        arrival = F.col("offset")
    elif "timestamp" in requests.columns:
        arrival = F.unix_micros(F.col("timestamp").cast("timestamp"))
    else:
        arrival = F.unix_micros(F.current_timestamp())
    return (requests.withColumn("value", or_default(F.col("body"), "{}")).withColumn("arrival", arrival.cast("bigint"))
            .drop("body"))
