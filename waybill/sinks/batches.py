"""Sets of batches, and the marks of those that are complete.

A batch is known by its source and its number there. Batches come in any order,
so what was taken over is a set: intervals of numbers per source, which stay few
as long as batches come about one after the other.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Batch = tuple[str | None, int]


class BatchSet:
    def __init__(self, intervals: dict[str | None, list[list[int]]] | None = None):
        self._intervals = {source: [list(one) for one in own] for source, own in (intervals or {}).items()}

    @classmethod
    def of(cls, batches: Iterable[Batch]) -> BatchSet:
        return cls().plus(batches)

    @classmethod
    def from_facts(cls, facts: list) -> BatchSet:
        """The set that `facts` gave as plain lists."""
        return cls({source: intervals for source, intervals in facts})

    def facts(self) -> list:
        return [[source, intervals] for source, intervals in
                sorted(self._intervals.items(), key=lambda one: (one[0] is not None, one[0] or ""))]

    def __contains__(self, batch: Batch) -> bool:
        source, number = batch
        return any(low <= number <= high for low, high in self._intervals.get(source, []))

    def __bool__(self) -> bool:
        return bool(self._intervals)

    def plus(self, batches: Iterable[Batch]) -> BatchSet:
        """This set and further batches. Neighbouring intervals become one."""
        added: dict[str | None, list[list[int]]] = {}
        for source, number in batches:
            added.setdefault(source, []).append([number, number])
        made = dict(self._intervals)
        for source, numbers in added.items():
            joined: list[list[int]] = []
            for low, high in sorted([*made.get(source, []), *numbers]):
                if joined and low <= joined[-1][1] + 1:
                    joined[-1][1] = max(joined[-1][1], high)
                else:
                    joined.append([low, high])
            made[source] = joined
        return BatchSet(made)

    def condition(self) -> Column:
        """Whether a row's `source` and `batch_id` are in the set; on partition columns it prunes."""
        conditions = []
        for source, intervals in self._intervals.items():
            numbers = reduce(Column.__or__, [F.col("batch_id").between(low, high) for low, high in intervals])
            conditions.append(F.col("source").eqNullSafe(F.lit(source)) & F.coalesce(numbers, F.lit(False)))
        return reduce(Column.__or__, conditions, F.lit(False))


class Marks:
    """One small file for every batch that is written as a whole and not merged yet.

    The files of a batch become visible one after the other. What merges batches
    takes only marked ones, so it never takes half a batch for the whole.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._folder = spark, f"{path.rstrip('/')}/_complete"
        self._files = self._path(self._folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path(text)

    def _mark(self, batch: Batch):
        # The sources are ids of streaming queries or names; any text may be one.
        return self._path(f"{self._folder}/{batch[1]}@{quote(batch[0], safe='')}")

    def add(self, source: str, number: int) -> None:
        self._files.create(self._mark((source, number)), True).close()

    def all(self) -> list[Batch]:
        if not self._files.exists(self._path(self._folder)):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._path(self._folder))]
        return sorted((unquote(name.partition("@")[2]), int(name.partition("@")[0])) for name in names)

    def remove(self, batches: Iterable[Batch]) -> None:
        for batch in batches:
            self._files.delete(self._mark(batch), False)
