"""Topic to gold: ingest, gate, silver, gold, each step after the one before.

Gate, silver and gold all group by tracking number or not at all, so one summary
per parcel holds what the three need, and its counters add up: a refresh reads
only the batches that are new, adds their summary to the stored one, and makes
gate, silver and gold from the result. Sums of latencies are exact, so silver is
the same to the last bit however the events came in. All of them are written to a new version,
which is published as a whole; until then the last one stays.

Statuses outside the contract, which only a foreign writer can have put into
bronze, count like any other. Their text maximum per parcel stands in a table of
its own, which is there only if there are any: a summary keeps fixed width.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from waybill import schemas
from waybill.functions.exact import exact_mean, exact_sum
from waybill.operators.milestones import delivered, first_time, last_time
from waybill.operators.quality import bronze_suite, enforce, expectation_counts, report
from waybill.operators.status import clean_events, rank_status, status_rank
from waybill.plans.gold import sla_mart
from waybill.session import remove
from waybill.sinks.batches import BatchSet
from waybill.sinks.files import ACCEPTED, REJECTED, outcome_path
from waybill.sinks.tables import ensure_database, point_table
from waybill.sinks.versions import Versions
from waybill.sources.bronze import read_accepted
from waybill.streaming.ingest import bronze_sink, drain

STATUSES = schemas.TELEMETRY_SCANS
BRONZE = StructType([*schemas.TELEMETRY]).add("source", StringType()).add("batch_id", IntegerType())


@dataclass(frozen=True)
class Lake:
    """Where the layers live. `root` must be shared storage on a cluster. Without
    a name the database has one of its own for each root."""

    root: str
    name: str | None = None

    @property
    def database(self) -> str:
        return self.name or f"waybill_{hashlib.sha1(self.root.rstrip('/').encode()).hexdigest()[:12]}"

    @property
    def messages(self) -> str:
        return f"{self.root}/messages"

    @property
    def bronze(self) -> str:
        return outcome_path(self.messages, ACCEPTED)

    @property
    def rejects(self) -> str:
        return outcome_path(self.messages, REJECTED)

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/messages_checkpoint"

    @property
    def marts(self) -> str:
        return f"{self.root}/marts"

    @property
    def gold(self) -> str:
        return f"{self.database}.sla_mart"


def known_status() -> Column:
    return F.col("scan_type").isNull() | F.col("scan_type").isin(*STATUSES)


def parcel_summary(events: DataFrame) -> DataFrame:
    """One row per tracking number with all that gate, silver and gold need but
    the names of statuses outside the contract."""
    clean = F.col("ping_latency_ms") > 0
    return events.groupBy("tracking_number").agg(
        *expectation_counts(bronze_suite()),
        F.count_if(clean).alias("clean_rows"),
        F.max(F.when(clean & known_status(), status_rank(STATUSES))).alias("status_rank"),
        *exact_sum(F.when(clean, F.col("ping_latency_ms")), "latency"),
        first_time(schemas.PICKUP).alias("pickup_time"),
        last_time(schemas.DELIVERED).alias("delivery_time"),
    )


def add_summaries(summaries: DataFrame) -> DataFrame:
    """Several summaries, stacked, as one."""
    how = {"status_rank": F.max, "pickup_time": F.min, "delivery_time": F.max, "latency_beyond": F.max}
    return summaries.groupBy("tracking_number").agg(
        *[how.get(name, F.sum)(name).cast(summaries.schema[name].dataType).alias(name)
          for name in summaries.columns if name != "tracking_number"])


def other_statuses(events: DataFrame) -> DataFrame:
    """The alphabetically last clean status outside the contract, per parcel that has one."""
    return (clean_events(events).filter(~known_status()).groupBy("tracking_number")
            .agg(F.max("scan_type").alias("other_status")))


def with_others(parcels: DataFrame, others: DataFrame) -> DataFrame:
    """The summaries with `other_status`; a null tracking number is a parcel too."""
    other = others.withColumnRenamed("tracking_number", "_other")
    return parcels.join(other, F.col("tracking_number").eqNullSafe(F.col("_other")), "left").drop("_other")


def gate_of(parcels: DataFrame) -> DataFrame:
    suite = bronze_suite()
    names = [f"{kind}_{i}" for i in range(len(suite)) for kind in ("evaluated", "unexpected")]
    return report(parcels.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names]), suite)


def silver_of(parcels: DataFrame) -> DataFrame:
    status = rank_status(F.col("status_rank"), STATUSES)
    if "other_status" in parcels.columns:
        status = F.greatest(status, F.col("other_status"))
    return parcels.filter(F.col("clean_rows") > 0).select(
        "tracking_number", status.alias("latest_status"),
        exact_mean("latency", F.col("clean_rows")).alias("avg_latency"))


def gold_of(parcels: DataFrame) -> DataFrame:
    return sla_mart(delivered(parcels).select("tracking_number", "pickup_time", "delivery_time"))


def new_events(spark: SparkSession, lake: Lake, done: list) -> DataFrame:
    """Bronze of the batches that are not in `done`, the facts of a set of
    batches. Only the partitions of new batches are read."""
    return read_accepted(spark, lake.bronze, BRONZE).filter(~BatchSet.from_facts(done).condition())


def refresh(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Bring silver and gold up to date with bronze and return gold.

    Nothing happens without bronze. A gate that fails raises, and like any other
    failure leaves the published silver and gold as they are. Records whose
    status is none of the contract's count like all others; the version's facts
    have their number under `left_out`. A version that still left them out of
    its summary, or has sums that depend on the order, is rebuilt from all of bronze.
    """
    versions = Versions(spark, lake.marts)
    published = versions.current()
    # A version without exact sums cannot be added to.
    rebuilt = published and ("exact" not in published or published["left_out"] and "others" not in published)
    before = None if rebuilt else published
    done = before["batches"] if before else []
    new = new_events(spark, lake, done)
    batches = new.groupBy("source", "batch_id").agg(F.count_if(~known_status())).collect()  # one row per new batch
    if not batches:
        return read_gold(spark, lake) if published else None
    outside = sum(row[2] for row in batches)
    had_others = bool(before and before.get("others"))
    folder = versions.fresh()
    try:
        summary = parcel_summary(new)
        if before:
            summary = add_summaries(spark.read.parquet(f"{before['folders'][0]}/parcels").unionByName(summary))
        summary.write.parquet(f"{folder}/parcels")
        parcels = spark.read.parquet(f"{folder}/parcels")
        enforce(gate_of(parcels))
        if outside or had_others:
            others = other_statuses(new)
            if had_others:
                others = (spark.read.parquet(f"{before['folders'][0]}/others").unionByName(others)
                          .groupBy("tracking_number").agg(F.max("other_status").alias("other_status")))
            others.write.parquet(f"{folder}/others")
            parcels = with_others(parcels, spark.read.parquet(f"{folder}/others"))
        silver_of(parcels).write.parquet(f"{folder}/silver")
        gold_of(parcels).write.parquet(f"{folder}/gold")
    except BaseException:
        remove(spark, folder)
        raise
    merged = BatchSet.from_facts(done).plus((row[0], row[1]) for row in batches)
    versions.publish([folder], batches=merged.facts(),
                     left_out=(before["left_out"] if before else 0) + outside, others=bool(outside or had_others), exact=True)
    ensure_database(spark, lake.database, f"{lake.root}/database")
    gold = read_gold(spark, lake)
    point_table(spark, lake.gold, f"{folder}/gold", gold.schema.toDDL())
    return gold


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Silver of the published version."""
    return spark.read.parquet(f"{Versions(spark, lake.marts).current()['folders'][0]}/silver")


def read_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    """Gold of the published version."""
    return spark.read.parquet(f"{Versions(spark, lake.marts).current()['folders'][0]}/gold")


def run(spark: SparkSession, messages: DataFrame, lake: Lake) -> DataFrame | None:
    """Drain the messages into bronze, then refresh. Returns gold."""
    drain(messages, bronze_sink(lake.messages), lake.checkpoint)
    return refresh(spark, lake)
