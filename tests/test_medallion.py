import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waybill import schemas
from waybill.operators.contracts import TELEMETRY, WEBHOOK, accepted, validate
from waybill.operators.quality import QualityGateError, run_gate
from waybill.operators.status import status_summary
from waybill.plans import gold, medallion
from waybill.sinks.files import REJECTED, outcome_path
from waybill.sinks.tables import ensure_database, write_table
from waybill.sinks.versions import Versions
from waybill.sinks.webhooks import current_events
from waybill.sources.bronze import read_accepted, read_rejects
from waybill.sources.webhook import read_webhooks
from waybill.streaming.ingest import bronze_sink, drain, webhook_sink


def bronze(spark, lake):
    return read_accepted(spark, lake.bronze, schemas.TELEMETRY)


def message(key, scan, when, latency=1.0):
    return json.dumps({"tracking_number": key, "scan_type": scan, "timestamp": when, "ping_latency_ms": latency})


GOOD = [message("TRK-1", "PICKUP", "2024-01-01T00:00:00"), message("TRK-1", "DELIVERED", "2024-01-03T06:00:00"),
        message("TRK-2", "PICKUP", "2024-01-01T00:00:00", None), message("TRK-2", "TRANSIT", "2024-01-02T00:00:00", 0)]


@pytest.fixture
def topic(tmp_path):
    """A folder of message files, read as a stream of one file per batch. A
    file stream goes by modification time, so each file gets its own."""
    folder = tmp_path / "topic"
    folder.mkdir()

    class Topic:
        def send(self, *lines):
            number = len(os.listdir(folder))
            file = folder / f"{number:04d}.txt"
            file.write_text("\n".join(lines) + "\n")
            os.utime(file, (1.7e9 + number, 1.7e9 + number))

        def stream(self, spark):
            return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))

    return Topic()


@pytest.fixture
def lake(tmp_path, request):
    return medallion.Lake(f"{tmp_path}/lake", name=f"lake_{abs(hash(request.node.name)) % 10**8}")


def test_batches_land_with_their_rejects_and_counts(spark, topic, lake):
    topic.send(*GOOD[:2], "{bad")
    topic.send(*GOOD[2:], message("TRK-9", "LOST", "2024-01-01T00:00:00"))
    seen = {}
    sink = bronze_sink(lake.messages, lambda batch, counts: seen.update({batch: counts}))
    drain(topic.stream(spark), sink, lake.checkpoint)
    assert seen == {0: {"rows": 3, "valid": 2}, 1: {"rows": 3, "valid": 2}}
    assert bronze(spark, lake).count() == 4
    rejects = read_rejects(spark, lake.rejects)
    lost = message("TRK-9", "LOST", "2024-01-01T00:00:00")
    assert sorted((row["batch_id"], row["reject_key"], row["reason"], row["reasons"], row["payload"])
                  for row in rejects.collect()) == [
        (0, "Unknown", "malformed_json", ["malformed_json"], "{bad"),
        (1, "TRK-9", "pattern:scan_type", ["pattern:scan_type"], lost)]
    drain(topic.stream(spark), sink, lake.checkpoint)
    assert seen.keys() == {0, 1}
    topic.send(GOOD[0])
    drain(topic.stream(spark), sink, lake.checkpoint)
    assert seen[2] == {"rows": 1, "valid": 1}


def test_a_replayed_batch_changes_nothing(spark, topic, lake):
    sink = bronze_sink(lake.messages)
    batch = spark.createDataFrame([(line,) for line in [*GOOD, "{bad"]], "value string")
    for _ in range(2):
        sink(batch, 7)
        assert bronze(spark, lake).count() == 4
        assert read_rejects(spark, lake.rejects).count() == 1


def test_from_topic_to_gold(spark, topic, lake):
    topic.send(*GOOD)
    mart = medallion.run(spark, topic.stream(spark), lake)
    assert [tuple(row) for row in mart.collect()] == [
        ("TRK-1", datetime(2024, 1, 1), datetime(2024, 1, 3, 6), 54.0, 54.0, True)]
    silver = medallion.read_silver(spark, lake)
    assert [tuple(row) for row in silver.collect()] == [("TRK-1", "PICKUP", 1.0)]
    topic.send(message("TRK-2", "DELIVERED", "2024-01-01T10:00:00"))
    assert medallion.run(spark, topic.stream(spark), lake).count() == 2
    assert spark.table(lake.gold).count() == 2


def test_one_summary_gives_what_the_single_steps_give(spark, topic, lake):
    topic.send(*GOOD, *[message(f"TRK-{i % 40}", scan, f"2024-02-{1 + i % 28:02d}T00:00:{i % 60:02d}", i % 9 - 0.5)
                        for i in range(400) for scan in ("PICKUP", "DELIVERED", "UNKNOWN_ERROR")])
    drain(topic.stream(spark), bronze_sink(lake.messages), lake.checkpoint)
    found = bronze(spark, lake)
    halves = [found.filter("hash(tracking_number, timestamp, ping_latency_ms) % 2 = 0"),
              found.filter("hash(tracking_number, timestamp, ping_latency_ms) % 2 <> 0")]
    parcels = medallion.add_summaries(medallion.parcel_summary(halves[0]).unionByName(medallion.parcel_summary(halves[1])))

    def rows(df):
        cut = [F.round(name, 9).alias(name) if kind == "double" else F.col(name) for name, kind in sorted(df.dtypes)]
        return sorted(map(str, df.select(*cut).collect()))

    assert rows(medallion.gate_of(parcels)) == rows(run_gate(found))
    assert rows(medallion.silver_of(parcels)) == rows(status_summary(found))
    assert rows(medallion.gold_of(parcels)) == rows(gold.gold_sla(found))


def test_a_failed_gate_stops_silver_and_gold(spark, topic, lake):
    topic.send(*GOOD, *[message("TRK-3", "TRANSIT", "2024-01-01T00:00:00", -99.0)] * 5)
    with pytest.raises(QualityGateError):
        medallion.run(spark, topic.stream(spark), lake)
    assert bronze(spark, lake).count() == 9
    assert not os.path.exists(lake.marts) or not os.listdir(f"{lake.marts}/data")
    assert not spark.catalog.tableExists(lake.gold)


def test_an_empty_topic_is_skipped(spark, topic, lake):
    assert medallion.run(spark, topic.stream(spark), lake) is None
    topic.send("{bad")
    assert medallion.run(spark, topic.stream(spark), lake) is None


def test_contracts_work_on_a_stream_and_report_counts(spark, topic, tmp_path):
    hook = json.dumps({"event_id": "E1", "tracking_number": "TRK-1", "scan_type": "PICKUP",
                       "timestamp": "2024-01-01T00:00:00"})
    topic.send(hook, "{bad")
    bodies = topic.stream(spark).withColumnRenamed("value", "body")
    valid = accepted(validate(read_webhooks(bodies), WEBHOOK), WEBHOOK)
    query = (valid.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
             .option("path", f"{tmp_path}/out").trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    counts = [progress.observedMetrics["webhook_counts"] for progress in query.recentProgress
              if "webhook_counts" in progress.observedMetrics]
    assert [(row["rows"], row["valid"]) for row in counts] == [(2, 1)]


def test_two_contracts_in_one_stream(spark, topic, tmp_path):
    topic.send(*GOOD, "{bad")
    both = validate(validate(topic.stream(spark), TELEMETRY).select("value"), WEBHOOK)
    query = (both.select("reasons").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
             .option("path", f"{tmp_path}/out").trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_a_replayed_webhook_batch_changes_nothing(spark, tmp_path):
    hook = {"event_id": "E1", "tracking_number": "TRK-1", "scan_type": "PICKUP", "timestamp": "2024-01-01T00:00:00"}
    batch = spark.createDataFrame([(json.dumps(hook), 1), (json.dumps({**hook, "event_id": "E2"}), 2), ("{bad", 3)],
                                  "body string, arrival bigint")
    store = f"{tmp_path}/store"
    for _ in range(2):
        webhook_sink(store)(batch, 0)
        assert [row["event_id"] for row in current_events(spark, store).collect()] == ["E2"]
        assert read_rejects(spark, outcome_path(store, REJECTED)).count() == 1


def test_another_stream_and_a_fresh_checkpoint_add_to_bronze(spark, topic, lake, tmp_path):
    topic.send(*GOOD)
    for checkpoint in ("one", "two"):
        drain(topic.stream(spark), bronze_sink(lake.messages), f"{tmp_path}/{checkpoint}")
    assert bronze(spark, lake).count() == 8
    drain(topic.stream(spark), bronze_sink(lake.messages), f"{tmp_path}/one")
    assert bronze(spark, lake).count() == 8


def test_a_refresh_reads_new_batches_only(spark, topic, lake):
    topic.send(*GOOD)
    first = sorted(medallion.run(spark, topic.stream(spark), lake).collect())
    done = Versions(spark, lake.marts).current()["batches"]
    assert [numbers for _, numbers in done] == [[[0, 0]]] and medallion.new_events(spark, lake, done).count() == 0
    assert sorted(medallion.run(spark, topic.stream(spark), lake).collect()) == first
    topic.send(message("TRK-2", "DELIVERED", "2024-01-02T10:00:00"))
    drain(topic.stream(spark), bronze_sink(lake.messages), lake.checkpoint)
    assert medallion.new_events(spark, lake, done).count() == 1
    whole = gold.gold_sla(bronze(spark, lake))
    assert sorted(medallion.refresh(spark, lake).collect()) == sorted(whole.collect())


@pytest.mark.parametrize("step", ["silver_of", "gold_of"])
def test_a_failed_rebuild_leaves_what_was_published(spark, topic, lake, monkeypatch, step):
    topic.send(*GOOD)
    mart = medallion.run(spark, topic.stream(spark), lake).collect()
    silver = medallion.read_silver(spark, lake).collect()
    topic.send(message("TRK-2", "DELIVERED", "2024-01-02T10:00:00"))

    def fails(parcels):
        return parcels.select(F.raise_error(F.lit("no space left")).alias("x"))

    with monkeypatch.context() as patched:
        patched.setattr(medallion, step, fails)
        with pytest.raises(Exception, match="no space left"):
            medallion.run(spark, topic.stream(spark), lake)
    assert spark.table(lake.gold).collect() == mart
    assert medallion.read_gold(spark, lake).collect() == mart
    assert medallion.read_silver(spark, lake).collect() == silver
    assert medallion.refresh(spark, lake).count() == spark.table(lake.gold).count() == 2


def test_lakes_without_a_name_stay_apart(spark, topic, tmp_path):
    one, other = (medallion.Lake(f"{tmp_path}/{name}") for name in "ab")
    topic.send(*GOOD)
    medallion.run(spark, topic.stream(spark), one)
    topic.send(message("TRK-7", "DELIVERED", "2024-01-02T10:00:00"))
    medallion.run(spark, topic.stream(spark), other)
    assert one.gold != other.gold
    assert (spark.table(one.gold).count(), spark.table(other.gold).count()) == (1, 2)


def test_a_foreign_status_does_not_end_the_refresh(spark, topic, lake):
    topic.send(*GOOD)
    drain(topic.stream(spark), bronze_sink(lake.messages), lake.checkpoint)
    (spark.createDataFrame([("TRK-1", "LOST", datetime(2024, 1, 1), 5.0)], schemas.TELEMETRY)
     .write.parquet(f"{lake.bronze}/source=foreign/batch_id=0"))
    assert medallion.refresh(spark, lake).count() == 1
    assert Versions(spark, lake.marts).current()["left_out"] == 1


def test_batches_may_come_late_and_without_a_source(spark, topic, lake):
    def put(folder, key, hour):
        (spark.createDataFrame([(key, "DELIVERED", datetime(2024, 1, 1, hour), 1.0)], schemas.TELEMETRY)
         .write.parquet(f"{lake.bronze}/{folder}"))

    put("source=a/batch_id=5", "T5", 5)
    medallion.refresh(spark, lake)
    put("source=a/batch_id=3", "T3", 3)
    put("source=__HIVE_DEFAULT_PARTITION__/batch_id=2", "T2", 2)
    assert medallion.refresh(spark, lake).count() == 3
    put("source=__HIVE_DEFAULT_PARTITION__/batch_id=1", "T1", 1)
    assert medallion.refresh(spark, lake).count() == 4
    assert medallion.refresh(spark, lake).count() == 4


def foreign(spark, lake, batch, *rows):
    (spark.createDataFrame([(key, scan, datetime(2024, 1, 1), latency) for key, scan, latency in rows], schemas.TELEMETRY)
     .write.parquet(f"{lake.bronze}/source=foreign/batch_id={batch}"))


def both_silvers(spark, lake):
    return [sorted(map(str, df.select("tracking_number", "latest_status", F.round("avg_latency", 9)).collect()))
            for df in (medallion.read_silver(spark, lake), status_summary(bronze(spark, lake)))]


def test_foreign_statuses_count(spark, topic, lake):
    topic.send(*GOOD)
    drain(topic.stream(spark), bronze_sink(lake.messages), lake.checkpoint)
    foreign(spark, lake, 0, ("TRK-1", "LOST", 5.0), ("TRK-1", "ZZZ", -1.0), ("TRK-8", "RETURNED", 2.0),
            *[("TRK-2", "DELIVERED", 1.0)] * 9)
    medallion.refresh(spark, lake)
    found, whole = both_silvers(spark, lake)
    assert found == whole and len(found) == 3
    topic.send(message("TRK-8", "TRANSIT", "2024-01-02T10:00:00", 4.0))
    medallion.run(spark, topic.stream(spark), lake)
    foreign(spark, lake, 1, ("TRK-1", "SEIZED", 5.0), ("TRK-8", "ABSENT", 5.0))
    medallion.refresh(spark, lake)
    found, whole = both_silvers(spark, lake)
    assert found == whole and any("SEIZED" in row for row in found)
    assert Versions(spark, lake.marts).current()["left_out"] == 5
    foreign(spark, lake, 2, *[("TRK-9", "LOST", 99999.0)] * 20)
    with pytest.raises(QualityGateError):
        medallion.refresh(spark, lake)


def test_a_version_that_left_statuses_out_is_rebuilt(spark, topic, lake):
    topic.send(*GOOD)
    drain(topic.stream(spark), bronze_sink(lake.messages), lake.checkpoint)
    foreign(spark, lake, 0, ("TRK-1", "LOST", 5.0), ("TRK-8", "RETURNED", 2.0))
    medallion.refresh(spark, lake)
    versions = Versions(spark, lake.marts)
    facts = versions.current()
    versions.publish(facts["folders"], batches=facts["batches"], left_out=2)
    medallion.refresh(spark, lake)
    found, whole = both_silvers(spark, lake)
    assert found == whole and versions.current()["left_out"] == 2 and versions.current()["others"]


def test_a_table_is_replaced_on_success_only(spark, tmp_path):
    ensure_database(spark, "replaced", f"{tmp_path}/o'ne")
    assert write_table(spark.range(3), "replaced.it", f"{tmp_path}/v'1").count() == 3
    with pytest.raises(Exception, match="no space left"):
        write_table(spark.range(5).select(F.raise_error(F.lit("no space left")).cast("bigint").alias("id")), "replaced.it",
                    f"{tmp_path}/v2")
    assert spark.table("replaced.it").count() == 3
    assert write_table(spark.range(4), "replaced.it", f"{tmp_path}/v3").count() == 4
