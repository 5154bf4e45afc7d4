"""Published versions of a dataset: readers see the last complete one.

A version's data are written to a folder of their own. Publishing adds one small
numbered file that names them; a rebuild that fails before that leaves what is
published untouched. Publishing renames a complete file to a number that must be
free, so of two concurrent writers one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from waybill.session import remove

KEPT = 2


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._notes = self._path(f"{self.root}/_versions")
        self._files = self._notes.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _numbers(self) -> list[int]:
        if not self._files.exists(self._notes):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._notes)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def _note(self, number: int):
        return self._path(f"{self.root}/_versions/{number:012d}.json")

    def _read(self, number: int) -> dict:
        stream = self._files.open(self._note(number))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> dict | None:
        """What was published last, or None."""
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else None

    def fresh(self) -> str:
        """A folder for the data of a new version."""
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def publish(self, folders: list[str], **facts) -> None:
        """Make the data in `folders` the current version. Versions before the
        last `KEPT` go, with the folders that only they name."""
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 0
        draft = self._path(f"{self.root}/_versions/{uuid.uuid4().hex}.draft")
        stream = self._files.create(draft, True)
        stream.write(json.dumps({"folders": folders, **facts}).encode())
        stream.close()
        if not self._files.rename(draft, self._note(number)):
            self._files.delete(draft, False)
            raise RuntimeError(f"version {number} of {self.root} was published meanwhile")
        kept = {folder for one in [*numbers, number][-KEPT:] for folder in self._read(one)["folders"]}
        for old in [*numbers, number][:-KEPT]:
            for folder in set(self._read(old)["folders"]) - kept:
                remove(self.spark, folder)
            self._files.delete(self._note(old), False)
