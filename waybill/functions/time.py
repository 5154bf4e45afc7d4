"""Time functions on zone-less timestamps. None depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text shapes, the number above which Unix time counts
# milliseconds, and the epoch seconds of the years 1 to 9999.
PLAIN_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?\z"
OTHER_ISO = r"^\d{4}-\d{2}-\d{2}[Tt _]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?([Zz]|[+-]\d{2}:?\d{2})?\z"
MILLISECONDS_ABOVE = 2e10
EPOCH_SECONDS = (-62135596800, 253402300799)


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text as a zone-less UTC timestamp, NULL if it has another shape.

    A direct cast ignores a zone suffix and completes partial dates and bare
    times, so it is used for the plain shape only. Other shapes get a zone and
    seconds if they lack them, and go through their instant.
    """
    plain = F.translate(text, "t_,z", "T .Z")
    zoned = F.regexp_replace(plain, r"^(.{11}[^Z+-]+)\z", "$1Z")
    full = F.regexp_replace(zoned, r"^(.{16})([Z+-].*)\z", "$1:00$2")
    return (F.when(text.rlike(PLAIN_ISO), text.try_cast("timestamp_ntz"))
            .when(text.rlike(OTHER_ISO), _from_micros(F.unix_micros(full.try_cast("timestamp")))))


def epoch_to_timestamp(number: Column) -> Column:
    """Unix time as a zone-less UTC timestamp; large values count milliseconds."""
    seconds = F.when(F.abs(number) > MILLISECONDS_ABOVE, number / 1000).otherwise(number)
    return F.when(seconds.between(*EPOCH_SECONDS), _from_micros(F.round(seconds * 1e6).cast("bigint")))


def _from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def micros_between(start: Column, end: Column) -> Column:
    """Signed microseconds from `start` to `end`, exact."""
    return F.timestamp_diff("MICROSECOND", start, end)


def micros_to_hours(micros: Column) -> Column:
    return micros / F.lit(3.6e9)


def hours_between(start: Column, end: Column) -> Column:
    """Signed hours from `start` to `end`; NULL if either is NULL."""
    return micros_to_hours(micros_between(start, end))


def iso_text(ts: Column) -> Column:
    """ISO-8601 text, always with six fraction digits."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def compact_text(ts: Column) -> Column:
    """`yyyyMMddHHmmss`, used in batch labels."""
    return F.date_format(ts, "yyyyMMddHHmmss")
