"""Whether every message of a topic arrived, and once: gaps and repeats in offsets.

Offsets of a topic partition are looked at in buckets of 32,768. Of each bucket
a bitmap of the offsets that are there, put together before the shuffle, and the
number of messages are kept. A bucket whose bits are all set, by as many
messages, is one run. Offsets of the others are listed and made into runs within
their bucket. What is missing is what lies between two runs, so gaps go on over buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 32_768
TOPIC = ("topic", "partition")


def offset_audit(messages: DataFrame) -> DataFrame:
    """Ranges of offsets that are `missing` between the first and the last one
    that arrived, or that arrived more than once (`doubled`): `topic`,
    `partition`, `kind`, `first_offset`, `last_offset`, `offsets`.

    Messages without an offset are not looked at. The columns `topic` and
    `partition` may be null; that is a topic or partition of its own.
    """
    placed = messages.filter(F.col("offset").isNotNull()).select(
        *TOPIC, F.col("offset").cast("bigint").alias("offset")).withColumn(
        "_bucket", F.expr(f"(offset - pmod(offset, {BUCKET})) div {BUCKET}"))
    position = F.pmod("offset", F.lit(BUCKET)).cast("bigint")
    buckets = placed.groupBy(*TOPIC, "_bucket").agg(
        F.bitmap_count(F.bitmap_construct_agg(position)).alias("_present"), F.count(F.lit(1)).alias("_messages"))
    whole = (F.col("_present") == BUCKET) & (F.col("_messages") == BUCKET)
    start = F.col("_bucket") * BUCKET
    full = buckets.filter(whole).select(*TOPIC, start.alias("first_offset"), (start + BUCKET - 1).alias("last_offset"))
    names = [F.col(name).alias(f"_{name}") for name in TOPIC]
    broken = buckets.filter(~whole).select(*names, F.col("_bucket").alias("_broken"))
    same = (F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
            & (F.col("_bucket") == F.col("_broken")))
    counted = placed.join(broken, same, "left_semi").groupBy(*TOPIC, "_bucket", "offset").agg(
        F.count(F.lit(1)).alias("_copies"))
    there = full.unionByName(_runs(counted))
    # One row per run: at most one per bucket, and one per gap.
    order = Window.partitionBy(*TOPIC).orderBy("first_offset")
    missing = (there.withColumn("_end", F.lag("last_offset").over(order))
               .filter(F.col("first_offset") > F.col("_end") + 1)
               .select(*TOPIC, F.lit("missing").alias("kind"), (F.col("_end") + 1).alias("first_offset"),
                       (F.col("first_offset") - 1).alias("last_offset")))
    doubled = _joined(_runs(counted.filter("_copies > 1")), order).select(
        *TOPIC, F.lit("doubled").alias("kind"), "first_offset", "last_offset")
    return missing.unionByName(doubled).withColumn("offsets", F.col("last_offset") - F.col("first_offset") + 1)


def _runs(offsets: DataFrame) -> DataFrame:
    """Runs of neighbouring offsets, each within its bucket."""
    within = Window.partitionBy(*TOPIC, "_bucket").orderBy("offset")
    return (offsets.withColumn("_run", F.col("offset") - F.row_number().over(within))
            .groupBy(*TOPIC, "_bucket", "_run").agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
            .select(*TOPIC, "first_offset", "last_offset"))


def _joined(runs: DataFrame, order: Column) -> DataFrame:
    """Runs that follow each other without a gap as one."""
    begins = F.coalesce(F.col("first_offset") > F.lag("last_offset").over(order) + 1, F.lit(True))
    numbered = runs.withColumn("_begins", begins.cast("int")).withColumn("_group", F.sum("_begins").over(order))
    return numbered.groupBy(*TOPIC, "_group").agg(F.min("first_offset").alias("first_offset"),
                                                  F.max("last_offset").alias("last_offset"))
