"""Repeated events: last write wins, and the duplicate flag.

Aggregates use fixed-width buffers and combine before the shuffle, so a key with
very many copies sends one row per task. What is joined back per key is split by
adaptive skew handling where a key is crowded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Copies of one row that are written out together.
COPIES = 100_000


def last_write_wins(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """The row that arrived last under each key. Of different rows that arrived
    at the same moment the one with the greatest hash counts; a NULL arrival is
    before all others. The limit to one row per key also works before the
    shuffle, so a crowded key sends one row per task."""
    last = Window.partitionBy(key).orderBy(F.desc_nulls_last(arrival), F.desc("_hash"))
    return (df.withColumn("_hash", F.xxhash64(*[F.col(name) for name in df.columns]))
            .withColumn("_place", F.row_number().over(last)).filter("_place = 1").select(*df.columns))


def duplicate_flag(df: DataFrame, key: str, *order: str, output: str = "is_duplicate") -> DataFrame:
    """Flag every row that is not the first of its key.

    The first is the least by `order`, NULLs last, then by the other columns; of
    equal rows one is the first. The first place of every key with several rows
    is found, combined before the shuffle, and joined back. Only rows that stand in the
    first place of a key with several can be equal to others there; these are
    counted and written out again, one of them as the first.
    """
    columns = list(df.columns)
    places = [*order, *[name for name in columns if name != key and name not in order]]
    if len(places) == 1:  # a single column is compared as it is, which keeps the aggregate in fixed-width buffers
        place, first = F.col(places[0]), F.col("_first")
        after = (place > first) | (place.isNull() & first.isNotNull())
    else:
        place = F.struct(*[part for name in places for part in (F.col(name).isNull(), F.col(name))])
        after = place > F.col("_first")
    firsts = (df.groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_rows"))
              .filter("_rows > 1"))
    known = df.join(firsts, F.col(key).eqNullSafe(F.col("_key")), "left")
    later = F.col("_rows").isNotNull() & F.coalesce(after, F.lit(False))
    plain = known.filter(later | F.col("_rows").isNull()).select(*columns, later.alias(output))
    equal = known.filter(~later & F.col("_rows").isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPIES)))
    within = F.explode(F.sequence(F.col("_part") * COPIES,
                                  F.least((F.col("_part") + 1) * COPIES, F.col("_copies")) - 1))
    written = (equal.withColumn("_part", parts).withColumn("_copy", within)
               .select(*columns, (F.col("_copy") > 0).alias(output)))
    return plain.unionAll(written)


def drop_duplicates_stream(stream: DataFrame, key: str, time: str, delay: str, salts: int = 16) -> DataFrame:
    """Pass on the first event of each key; a key is remembered for at least `delay`.

    State is kept per key, so all copies of a crowded key would meet in one
    task. They are first reduced per key and salt, the salt being the task they
    were read in, and then per key. `salts=1` does without the first step.
    """
    watched = stream.withWatermark(time, delay)
    if salts > 1:
        watched = (watched.withColumn("_salt", F.spark_partition_id() % salts)
                   .dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt"))
    return watched.dropDuplicatesWithinWatermark([key])
