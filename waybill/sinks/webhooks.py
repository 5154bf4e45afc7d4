"""The webhook store: an event is kept under its key, a repeat replaces it.

A batch writes its accepted events by event date and its rejects next to them,
in one job, and is marked as complete; a batch that is repeated after a failure
replaces its own rows. Reading resolves repeats with one shuffle.

`compact` merges complete batches into a run: one event per key, by date. Which
batches are in runs is a set, so one that comes after a later one was merged is
neither lost nor merged twice. Runs are merged in tiers, so their number grows
with the logarithm of the number of merges. Readers go by the version published last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from waybill import schemas
from waybill.functions.text import event_key
from waybill.operators.latest import last_write_wins
from waybill.session import remove
from waybill.sinks.batches import BatchSet, Marks
from waybill.sinks.files import ACCEPTED, outcome_path, write_batch
from waybill.sinks.runs import due
from waybill.sinks.versions import Versions
from waybill.sources.bronze import read_accepted

COLUMNS = tuple(name for name in schemas.WEBHOOK_EVENT.names if name not in ("event_date", "source", "batch_id"))
# Event times are the sender's. Dates outside this span share one partition, so their number has a bound.
FIRST_DATE, LAST_DATE = "2000-01-01", "2099-12-31"

RUN = StructType([field for field in schemas.WEBHOOK_EVENT if field.name not in ("source", "batch_id")])


def write_webhooks(checked: DataFrame, batch_id: int, path: str, source: str = "batch") -> None:
    """Store accepted and rejected requests of one checked batch."""
    keyed = checked.withColumn("event_key", event_key(F.col("tracking_number"), F.col("timestamp")))
    write_batch(keyed, list(COLUMNS), batch_id, path, source, event_date=_event_date())
    Marks(checked.sparkSession, path).add(source, batch_id)


def upsert_events(events: DataFrame, path: str, batch_id: int, source: str = "batch") -> None:
    """Store accepted events; `arrival` says which of two under one key is later."""
    write_webhooks(events.withColumns({"reasons": F.lit(""), "reject_key": F.lit(None).cast("string"),
                                       "value": F.lit(None).cast("string")}), batch_id, path, source)


def _event_date() -> Column:
    date = F.to_date("timestamp")
    return F.when(date.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")), date)


def _published(versions: Versions) -> tuple[BatchSet, list[dict]]:
    """The batches that are merged, and the runs they are in."""
    facts = versions.current() or {"merged": [], "runs": []}
    return BatchSet.from_facts(facts["merged"]), facts["runs"]


def current_events(spark: SparkSession, path: str, dates: Column | None = None) -> DataFrame:
    """The stored events, one per key. `dates`, a condition on `event_date`,
    limits the read to those partitions; a key never leaves its date. A store
    without events has no rows."""
    merged, runs = _published(Versions(spark, path))
    stored = _batches(spark, path).filter(~merged.condition()).select(*RUN.names)
    if runs:
        stored = stored.unionByName(_read_runs(spark, path, runs))
    if dates is not None:
        stored = stored.filter(dates)
    return last_write_wins(stored.select(*COLUMNS), "event_key", "arrival")


def _batches(spark: SparkSession, path: str) -> DataFrame:
    return read_accepted(spark, outcome_path(path, ACCEPTED), schemas.WEBHOOK_EVENT)


def _read_runs(spark: SparkSession, path: str, runs: list[dict]) -> DataFrame:
    """All runs in one scan."""
    schema = StructType([*RUN]).add("run", StringType())
    found = spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/data").parquet(*[run["folder"] for run in runs])
    return found.select(*RUN.names)


def compact(spark: SparkSession, path: str) -> None:
    """Merge the batches that are complete and in no run yet, with as many runs as their tiers ask for, and publish."""
    versions, marks = Versions(spark, path), Marks(spark, path)
    merged, runs = _published(versions)
    complete = marks.all()
    new = [batch for batch in complete if batch not in merged]
    if new:
        taken, tier = due(runs)
        events = _batches(spark, path).filter(BatchSet.of(new).condition()).select(*RUN.names)
        if taken:
            events = events.unionByName(_read_runs(spark, path, taken))
        folder = f"{path.rstrip('/')}/data/run={uuid.uuid4().hex}"
        try:
            (last_write_wins(events.select(*COLUMNS), "event_key", "arrival").withColumn("event_date", _event_date())
             .hint("rebalance", "event_date").write.partitionBy("event_date").parquet(folder))
            kept = [run for run in runs if run not in taken] + [{"folder": folder, "tier": tier}]
            versions.publish([run["folder"] for run in kept], runs=kept, merged=merged.plus(new).facts())
        except BaseException:
            remove(spark, folder)
            raise
    marks.remove(complete)
