"""Flagging repeated events on a stream, with an index of the keys that were seen.

A batch is flagged within itself and against the keys of other batches. The
index has the keys that a batch was the first to bring, in partitions by batch
and day of the event, so a batch that is replayed finds what it found before and
replaces what it wrote. Days that are over before the batch's earliest event by
more than the delay are not looked at, and `forget` removes them.

The batch's keys are matched against the index by a join. A small batch is sent
to the index, whose rows then stay where they are; for a large one Spark
shuffles both, after a Bloom filter where it pays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegerType, StringType, StructType

from waybill.operators.latest import duplicate_flag
from waybill.session import remove
from waybill.sinks.files import replacing
from waybill.sources.bronze import read_accepted
from waybill.streaming.ingest import BatchSink, query_of

FLAGS, KEYS = "flags", "keys"


def flag_sink(path: str, key: str, time: str, *order: str, days: int, output: str = "is_duplicate") -> BatchSink:
    """A sink that writes each batch below `path` with a flag for every event
    whose key came before.

    Of several events with one key in a batch the first by `order` is none. A
    key is remembered for at least `days` days from the day of its event; without a time it is for good.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, source = batch.sparkSession, query_of(batch)
        flagged = duplicate_flag(batch, key, *order, output="_again").persist()
        try:
            day = F.to_date(F.col(time))
            earliest = flagged.agg(F.min(day)).first()[0]
            first = flagged.filter(~F.col("_again")).select(F.col(key).alias("_key"), day.alias("day"))
            own = F.col("source").eqNullSafe(F.lit(source)) & F.col("batch_id").eqNullSafe(F.lit(batch_id))
            seen = _index(spark, path, batch.schema[key].dataType).filter(~own)
            if earliest is not None:
                seen = seen.filter(F.col("day").isNull() | (F.col("day") >= F.date_sub(F.lit(earliest), days)))
            same = F.col("_key").eqNullSafe(F.col("seen_key"))
            before = (seen.join(first.select("_key"), same, "left_semi").select("seen_key").distinct()
                      .withColumn("_known", F.lit(True)))
            new = first.join(before, same, "left_anti").select(F.col("_key").alias("seen_key"), "day")
            marked = flagged.join(before, F.col(key).eqNullSafe(F.col("seen_key")), "left").select(
                *batch.columns, (F.col("_again") | F.coalesce("_known", F.lit(False))).alias(output))
            batched = {"source": F.lit(source), "batch_id": F.lit(batch_id)}
            replacing(marked.withColumns(batched), "source", "batch_id").parquet(f"{path}/{FLAGS}")
            # Gathered by day, or every task would write a file for each of the days.
            gathered = new.withColumns(batched).hint("rebalance", "day")
            replacing(gathered, "source", "batch_id", "day").parquet(f"{path}/{KEYS}")
        finally:
            flagged.unpersist()

    return write


def read_flags(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The flagged events of all batches, with the columns of `schema`."""
    return read_accepted(spark, f"{path}/{FLAGS}", schema)


def forget(spark: SparkSession, path: str, before: str) -> None:
    """Remove the keys of days before the date `before` (`yyyy-mm-dd`) from the index."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{KEYS}/source=*/batch_id=*/day=*")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    for status in found or []:
        day = status.getPath().getName().partition("=")[2]
        if day[:1].isdigit() and day < before:
            remove(spark, status.getPath().toString())


def _index(spark: SparkSession, path: str, key: DataType) -> DataFrame:
    schema = (StructType().add("seen_key", key).add("source", StringType()).add("batch_id", IntegerType())
              .add("day", DateType()))
    return read_accepted(spark, f"{path}/{KEYS}", schema)
