"""Catalog tables, replaced as a whole on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.functions.text import quoted_text


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {quoted_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def write_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Write `df` to the new folder `path` and let the table `name` point to it.
    Until all is written the table shows what it showed before."""
    df.write.parquet(path)
    point_table(df.sparkSession, name, path, df.schema.toDDL())
    return df.sparkSession.table(name)


def point_table(spark: SparkSession, name: str, path: str, ddl: str) -> None:
    """Let a table show the Parquet files of a folder; one step in the catalog."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted_text(path)}")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION {quoted_text(path)}")
