"""Checkpointed ingestion of scan messages into bronze."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from waybill.operators.contracts import TELEMETRY, WEBHOOK, validate
from waybill.sinks.files import PLACE, write_batch
from waybill.sinks.webhooks import write_webhooks
from waybill.sources.webhook import read_webhooks

BatchSink = Callable[[DataFrame, int], None]
OnCounts = Callable[[int, dict], None]


def query_of(batch: DataFrame) -> str:
    """The id of the streaming query a batch belongs to, which its checkpoint keeps across restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def bronze_sink(path: str, on_counts: OnCounts | None = None) -> BatchSink:
    """Validate a batch and write what passes and what does not, in one job.

    Both outputs are keyed by the query and the batch id, so a batch that is
    replayed after a failure replaces what it wrote before and nothing else.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = Observation()
        names = [*TELEMETRY.names, *[name for name in PLACE if name in batch.columns]]
        write_batch(validate(batch, TELEMETRY, counts=counts), names, batch_id, path, query_of(batch))
        if on_counts is not None:
            on_counts(batch_id, counts.get)

    return write


def webhook_sink(path: str, on_counts: OnCounts | None = None) -> BatchSink:
    """Store the accepted webhook events of a batch and keep the others aside, in one job."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = Observation()
        write_webhooks(validate(read_webhooks(batch), WEBHOOK, counts=counts), batch_id, path, query_of(batch))
        if on_counts is not None:
            on_counts(batch_id, counts.get)

    return write


def drain(stream: DataFrame, sink: BatchSink, checkpoint: str) -> StreamingQuery:
    """Process everything available now in bounded batches, then stop.

    How much one batch holds is set on the source: `max_per_batch` of
    `topic_options`, or `maxFilesPerTrigger` / `maxBytesPerTrigger` for files.
    """
    query = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
