import base64
import glob
import json
import os
from datetime import datetime

import pytest

from waybill import schemas
from waybill.operators.contracts import TELEMETRY, validate
from waybill.sinks.files import ACCEPTED, REJECTED, outcome_path, write_batch, write_bronze
from waybill.sources.bronze import is_empty, read_accepted, read_bronze, read_rejects
from waybill.sinks.versions import Versions
from waybill.sources.topic import messages, topic_options

RECORDS = [
    {"tracking_number": "TRK-1", "scan_type": "PICKUP",
     "timestamp": "2024-01-02 03:04:05.123456", "ping_latency_ms": 1.5},
    {"tracking_number": "TRK-2", "scan_type": "DELIVERED",
     "timestamp": "2024-01-02 03:04:05+02:00", "ping_latency_ms": None},
]
ROWS = [("TRK-1", "PICKUP", datetime(2024, 1, 2, 3, 4, 5, 123456), 1.5),
        ("TRK-2", "DELIVERED", datetime(2024, 1, 2, 1, 4, 5), None)]


def rows(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("infer", [False, True])
def test_arrays_and_lines_read_alike(spark, tmp_path, infer):
    (tmp_path / "a.json").write_text(json.dumps(RECORDS[:1]))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(record) for record in RECORDS[1:]) + "\n")
    found = read_bronze(spark, f"{tmp_path}/*.json", infer=infer)
    assert found.schema == schemas.TELEMETRY
    assert rows(found) == ROWS


def test_arrays_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(RECORDS, indent=2))
    assert rows(read_bronze(spark, str(tmp_path), multi_line=True)) == ROWS


def test_inferred_files_may_lack_a_field(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"tracking_number": "TRK-1", "scan_type": "PICKUP"}]))
    assert rows(read_bronze(spark, str(tmp_path), infer=True)) == [("TRK-1", "PICKUP", None, None)]


@pytest.mark.parametrize("infer", [False, True])
def test_absent_and_empty_paths_give_no_rows(spark, tmp_path, infer):
    for path in (f"{tmp_path}/absent", f"{tmp_path}/absent/*.json", str(tmp_path)):
        assert is_empty(read_bronze(spark, path, infer=infer))


def test_damaged_files_fail(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"tracking_number": "TRK-1"')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_bronze(spark, str(tmp_path)).collect()


def test_a_replayed_batch_replaces_only_itself(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    first, second = (spark.createDataFrame([row], schemas.TELEMETRY) for row in ROWS)
    write_bronze(first, 0, path)
    write_bronze(second, 1, path)
    write_bronze(first, 0, path)
    assert rows(read_bronze(spark, path)) == ROWS
    write_bronze(second, 0, path)
    assert rows(read_bronze(spark, path)) == [ROWS[1], ROWS[1]]


def test_nulls_are_written_and_an_empty_batch_is_not(spark, tmp_path):
    path = tmp_path / "bronze"
    write_bronze(spark.createDataFrame(ROWS[1:], schemas.TELEMETRY), 3, str(path))
    write_bronze(spark.createDataFrame([], schemas.TELEMETRY), 4, str(path))
    assert [child.name for child in path.glob("source=batch/*") if child.is_dir()] == ["batch_id=3"]
    written = [json.loads(line) for file in path.glob("source=batch/batch_id=3/*.json") for line in file.read_text().splitlines()]
    assert written == [{"tracking_number": "TRK-2", "scan_type": "DELIVERED",
                        "timestamp": "2024-01-02T01:04:05.000000", "ping_latency_ms": None}]


def test_topic_options():
    assert topic_options("broker:9092", "scans") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "scans", "startingOffsets": "earliest"}
    limited = topic_options("broker:9092", "scans", max_per_batch=100, min_partitions=8)
    assert (limited["maxOffsetsPerTrigger"], limited["minPartitions"]) == ("100", "8")


def test_messages_are_decoded_and_other_columns_stay(spark):
    raw = spark.createDataFrame([(bytearray(b"TRK-1"), bytearray(b"{}"), 7)], "key binary, value binary, offset long")
    assert tuple(messages(raw).first()) == ("TRK-1", "{}", 7, None)


def test_one_write_keeps_both_outcomes_readable(spark, tmp_path):
    good = {"tracking_number": "TRK-1\n\"x\"", "scan_type": "PICKUP", "timestamp": "2024-01-02", "ping_latency_ms": "nan"}
    payloads = [json.dumps(good), json.dumps({**good, "ping_latency_ms": "-inf"}), "{bad\nline", None]
    checked = validate(spark.createDataFrame([(p,) for p in payloads], "value string"), TELEMETRY)
    for _ in range(2):
        write_batch(checked, TELEMETRY.names, 5, str(tmp_path))
        kept = read_accepted(spark, outcome_path(str(tmp_path), ACCEPTED), schemas.TELEMETRY).collect()
        latencies = [row["ping_latency_ms"] for row in kept]
        assert sorted(map(str, latencies)) == ["-inf", "nan"]
        rejects = read_rejects(spark, outcome_path(str(tmp_path), REJECTED)).collect()
        assert {(row["payload"], row["batch_id"]) for row in rejects} == {("{bad\nline", 5), (None, 5)}
    assert {row["tracking_number"] for row in kept} == {"TRK-1\n\"x\""}


def test_rejects_of_nothing_are_no_rows(spark, tmp_path):
    assert is_empty(read_rejects(spark, f"{tmp_path}/absent"))


def test_rejects_keep_bytes_and_origin(spark, tmp_path):
    raw = spark.createDataFrame(
        [(bytearray(b'{"a":"\xff"}'), "scans", 3, 70), (bytearray(b"{bad"), "scans", 3, 71)],
        "value binary, topic string, partition int, offset bigint")
    write_batch(validate(messages(raw), TELEMETRY), TELEMETRY.names, 0, str(tmp_path))
    rows_ = read_rejects(spark, outcome_path(str(tmp_path), REJECTED)).orderBy("offset").collect()
    assert [(r.topic, r.partition, r.offset, r.payload, r.payload_base64) for r in rows_] == [
        ("scans", 3, 70, None, base64.b64encode(b'{"a":"\xff"}').decode()), ("scans", 3, 71, "{bad", None)]


def test_published_versions(spark, tmp_path):
    versions = Versions(spark, f"{tmp_path}/it")
    assert versions.current() is None
    folders = [versions.fresh() for _ in range(4)]
    for i, folder in enumerate(folders):
        spark.range(i).write.parquet(folder)
        versions.publish([folder, folders[0]] if i == 2 else [folder], number=i)
        assert versions.current()["number"] == i
    left = {os.path.basename(f) for f in glob.glob(f"{tmp_path}/it/data/*")}
    assert left == {os.path.basename(folders[i]) for i in (2, 3)} | ({os.path.basename(folders[0])} & left)
    assert len(glob.glob(f"{tmp_path}/it/_versions/*.json")) == 2
