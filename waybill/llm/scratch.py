"""Intermediate tables in the cluster's shared folder, removed once nothing reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.session import remove, scratch_path


class Scratch:
    """Tables of one run. What a lazy result still reads must be kept."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, scratch_path(spark, label)
        self._made: list[tuple[DataFrame, str]] = []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        """Write `df` and read it back. A lost executor then costs a re-read,
        and what was drawn, sampled or trained once never changes."""
        path = f"{self.root}/{label}-{len(self._made)}"
        df.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._made.append((table, path))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Remove stored tables that no later job reads."""
        for made, path in self._made:
            if any(made is table for table in tables):
                remove(self.spark, path)
