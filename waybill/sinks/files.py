"""File sinks. A batch owns its partitions, so that a replay replaces its own rows.

A batch is known by the query it came from and its number there, so a second
stream, or the same one with a fresh checkpoint, adds to what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from waybill import schemas
from waybill.functions.time import iso_text
from waybill.operators.contracts import first_reason, is_accepted, reason_list

ACCEPTED = "accepted"
REJECTED = "rejected"
# Where a message came from, if its source says so, its bytes if they are no text, and what it was sent again for.
ORIGIN = ("topic", "partition", "offset", "arrival", "request_id", "payload_base64", "origin")
# What an accepted message keeps of it.
PLACE = ("topic", "partition", "offset")


def outcome_path(path: str, outcome: str) -> str:
    """Where `write_batch` puts the records of one outcome."""
    return f"{path}/outcome={outcome}"


def write_batch(checked: DataFrame, names: list[str], batch_id: int, path: str, source: str = "batch",
                value: str = "value", key: str = "tracking_number", **partitions: Column) -> None:
    """Accepted and rejected records of one checked batch, in one pass.

    `names` are the columns of accepted records. Both outcomes become Parquet,
    told apart by the partition they are written to, so nothing has to be kept
    or parsed again for the second output. `partitions` adds partition columns
    between outcome and batch; rows are then gathered by these, or every task
    would open a file for each of their values. Rebalancing splits crowded ones.
    """
    ok = is_accepted()
    rejects = {"reject_key": F.coalesce("reject_key", F.lit(schemas.UNKNOWN_KEY)), "reason": first_reason(),
               "reasons": reason_list(), "payload": F.col(value)}
    rejects |= {name: F.col(name).cast(schemas.REJECTS[name].dataType) for name in ORIGIN if name in checked.columns}
    rejects = {name: column for name, column in rejects.items() if name not in names}
    rows = checked.select(
        *[(F.col(name) if name in ORIGIN else F.when(ok, F.col(name))).alias(name) for name in names],
        *[F.when(~ok, column).alias(name) for name, column in rejects.items()],
        F.when(ok, ACCEPTED).otherwise(REJECTED).alias("outcome"),
        *[F.when(ok, column).alias(name) for name, column in partitions.items()],
        F.lit(source).alias("source"), F.lit(batch_id).alias("batch_id"))
    if partitions:
        rows = rows.hint("rebalance", "outcome", *partitions)
    replacing(rows, "outcome", *partitions, "source", "batch_id").parquet(path)


def write_bronze(valid: DataFrame, batch_id: int, path: str, source: str = "batch") -> None:
    """Accepted records of one batch as JSON lines; no records, no partition."""
    records = valid.select(
        "tracking_number",
        "scan_type",
        iso_text(F.col("timestamp")).alias("timestamp"),
        "ping_latency_ms",
        F.lit(source).alias("source"),
        F.lit(batch_id).alias("batch_id"),
    )
    replacing(records, "source", "batch_id").option("ignoreNullFields", "false").json(path)


def replacing(df: DataFrame, *partitions: str) -> DataFrameWriter:
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
