"""Text and JSON functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.functions.time import compact_text, iso_text


def utf8_text(raw: Column) -> Column:
    """Bytes as UTF-8 text; NULL if they are not valid UTF-8."""
    return F.try_validate_utf8(raw.cast("string"))


def bytes_if_no_text(raw: Column) -> Column:
    """Base64 of bytes that are not valid UTF-8; NULL for text, which needs none."""
    return F.when(utf8_text(raw).isNull(), F.base64(raw))


def quoted_text(text: str) -> str:
    """A text literal for SQL statements."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def or_default(column: Column, default) -> Column:
    return F.coalesce(column, F.lit(default))


def event_key(tracking_number: Column, ts: Column) -> Column:
    """The key one webhook event is stored under."""
    return F.concat_ws("_", tracking_number, iso_text(ts))


def batch_label(ts: Column) -> Column:
    return F.concat_ws("_", F.lit("batch"), compact_text(ts))


def record_json(**fields: Column) -> Column:
    """JSON text of a record: nulls are kept, timestamps must come as text."""
    record = F.struct(*[column.alias(name) for name, column in fields.items()])
    return F.to_json(record, {"ignoreNullFields": "false"})


def telemetry_json() -> Column:
    """JSON text of the telemetry record in the current row."""
    return record_json(
        tracking_number=F.col("tracking_number"),
        scan_type=F.col("scan_type"),
        timestamp=iso_text(F.col("timestamp")),
        ping_latency_ms=F.col("ping_latency_ms"),
    )
