"""Sending rejected records again once they were put right.

Every rejected record has an origin: its place in the topic, or else its batch
and a digest of its payload. An attempt keeps the origin with what it writes, so
a record is traced through all of its attempts. What was accepted in one of them
is not sent again, and neither is a payload that was rejected before: an attempt
that puts nothing new right changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from waybill import schemas
from waybill.operators.contracts import Contract, validate
from waybill.sinks.files import ACCEPTED, PLACE, REJECTED, outcome_path, write_batch
from waybill.sources.bronze import read_accepted

SOURCE = "replay"


def origin() -> Column:
    """Where a rejected record came from first."""
    place = F.concat_ws("/", *[F.col(name).cast("string") for name in PLACE])
    known = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    batch = F.concat_ws("/", F.coalesce("source", F.lit("")), F.col("batch_id").cast("string"),
                        F.sha2(F.coalesce("payload", "payload_base64", F.lit("")), 256))
    return F.coalesce("origin", F.when(known, place), batch)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """All rejections below `path`, with the origin of each."""
    return read_accepted(spark, outcome_path(path, REJECTED), schemas.REJECTS).withColumn("origin", origin())


def replay_rejects(spark: SparkSession, path: str, contract: Contract, fix: Callable[[Column], Column], attempt: int) -> int:
    """Send the rejected payloads below `path` again as `fix` makes them, and give the number of records sent.

    `attempt` is the number of the batch that they are written as; to repeat it after a failure is safe, as a batch
    replaces itself and does not look at what it wrote. Payloads that are null, before or after, are not sent.
    """
    rejected, accepted = read_attempts(spark, path), _accepted_origins(spark, path)
    own = (F.col("source") == SOURCE) & (F.col("batch_id") == attempt)
    earlier = rejected.filter(~F.coalesce(own, F.lit(False)))
    tried = earlier.select(F.col("origin").alias("_origin"), _digest("payload").alias("_digest"))
    done = accepted.filter(~F.coalesce(own, F.lit(False))).select(F.col("origin").alias("_origin"),
                                                                  F.lit(None).cast("binary").alias("_digest"))
    # A record that was rejected several times is put right from its first payload. One that is as it was is among those tried.
    first = earlier.filter(~F.coalesce(F.col("source") == SOURCE, F.lit(False)))
    again = (first.withColumn("value", fix(F.col("payload")))
             .filter(F.col("value").isNotNull() & ~F.col("value").eqNullSafe(F.col("payload")))
             .select("value", "origin", *PLACE))
    # One join by origin, so that the payloads travel once.
    settled = tried.filter("_digest IS NOT NULL").unionByName(done).distinct()
    same = F.col("_digest").isNull() | (F.col("_digest") == _digest("value"))
    sent = again.join(settled, (F.col("origin") == F.col("_origin")) & same, "left_anti")
    counts = Observation()
    # Without a record to send nothing is written, as there is no partition to replace.
    write_batch(validate(sent, contract, counts=counts), [*contract.names, "origin", *PLACE], attempt, path, SOURCE)
    return counts.get["rows"]


def _digest(payload: str) -> Column:
    return F.unhex(F.sha2(payload, 256))


def _accepted_origins(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType().add("origin", StringType()).add("source", StringType()).add("batch_id", IntegerType())
    return read_accepted(spark, outcome_path(path, ACCEPTED), schema).filter(F.col("origin").isNotNull())
