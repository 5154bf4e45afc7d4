"""Running this package's functions over Arrow batches on the executors."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from waybill.llm.columns import free_name, quoted

_shipped: set[str] = set()


def ship(context: SparkContext) -> None:
    """Give the executors this package once per application, as `--py-files` would."""
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def with_made(df: DataFrame, keep: tuple[str, ...], made: str) -> StructType:
    """The columns `keep` of `df` and new ones, given as DDL; a new name that
    is taken by a kept column, in either case, gets underscores appended."""
    kept = df.select(*[quoted(name) for name in keep])
    new = [StructField(free_name(kept, field.name), field.dataType) for field in StructType.fromDDL(made)]
    return StructType([*kept.schema.fields, *new])


def over_batches(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """`mapInArrow` with this package at hand in the tasks."""
    ship(df.sparkSession.sparkContext)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return what a task no longer uses to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
