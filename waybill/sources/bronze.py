"""Bronze files: JSON records, one or an array of them per line."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waybill import schemas
from waybill.functions.time import iso_to_timestamp

def read_bronze(spark: SparkSession, path: str, infer: bool = False, multi_line: bool = False) -> DataFrame:
    """All records under `path`; an absent or empty path gives no rows.

    The default takes JSON lines and one-line arrays alike and can split large
    files. `multi_line` is for arrays spread over several lines, one task per
    file. A damaged file fails the read, as bronze holds only checked records.
    """
    found = _read_json(spark, path, None if infer else schemas.BRONZE, multi_line)
    return found.select(*[_as_telemetry(found, field) for field in schemas.TELEMETRY])


def read_accepted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Accepted records of all batches under `path`, with the columns of
    `schema`, among which may be `source` and `batch_id`; an absent path gives
    no rows."""
    return _found(lambda: spark.read.schema(schema).parquet(path), spark, schema).select(*schema.names)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """All rejected payloads under `path` with the batch each came in."""
    return read_accepted(spark, path, schemas.REJECTS)


def _found(read, spark: SparkSession, schema: StructType) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def _read_json(spark: SparkSession, path: str, schema: StructType | None, multi_line: bool) -> DataFrame:
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", multi_line)
    return _found(lambda: reader.json(path) if schema is None else reader.schema(schema).json(path), spark,
                  schemas.BRONZE)


def _as_telemetry(found: DataFrame, field):
    if field.name not in found.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    if field.name == "timestamp":
        return iso_to_timestamp(F.col("timestamp")).alias("timestamp")
    return F.col(field.name).cast(field.dataType).alias(field.name)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
