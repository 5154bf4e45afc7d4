import json

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from waybill.operators.contracts import TELEMETRY, validate
from waybill.sinks.files import ACCEPTED, outcome_path, write_batch
from waybill.sinks.replay import read_attempts, replay_rejects
from waybill.sources.bronze import read_accepted
from waybill.plans.medallion import BRONZE


def payload(key, scan, when="2024-01-01T00:00:00"):
    return json.dumps({"tracking_number": key, "scan_type": scan, "timestamp": when})


def put(spark, path, rows, number=0, names=(), schema="value string"):
    write_batch(validate(spark.createDataFrame(rows, schema), TELEMETRY), [*TELEMETRY.names, *names], number, path)


def bronze(spark, path):
    rows = read_accepted(spark, outcome_path(path, ACCEPTED), BRONZE).collect()
    return sorted((row.tracking_number, row.scan_type, row.source, row.batch_id) for row in rows)


def attempts(spark, path):
    return sorted((row.source, row.batch_id, row.origin, row.payload) for row in read_attempts(spark, path).collect())


def scans(column):
    return F.replace(column, F.lit("LOST"), F.lit("TRANSIT"))


def test_what_was_put_right_is_sent_once(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, [(payload("A", "PICKUP"),), (payload("B", "LOST"),), (payload("C", "LOST", "nope"),), ("{bad",),
                      (payload("B", "LOST"),)])
    assert replay_rejects(spark, path, TELEMETRY, scans, 1) == 3
    want = [("A", "PICKUP", "batch", 0), ("B", "TRANSIT", "replay", 1), ("B", "TRANSIT", "replay", 1)]
    assert bronze(spark, path) == want
    told = attempts(spark, path)
    assert len(told) == 5 and len({row[2] for row in told}) == 3 and [row[0] for row in told].count("replay") == 1
    assert replay_rejects(spark, path, TELEMETRY, scans, 2) == 0
    assert (bronze(spark, path), attempts(spark, path)) == (want, told)
    fix = lambda column: F.replace(scans(column), F.lit("nope"), F.lit("2024-02-02T00:00:00"))
    for _ in range(2):  # the second time the attempt is repeated, as after a failure
        assert replay_rejects(spark, path, TELEMETRY, fix, 3) == 1
        assert bronze(spark, path) == [*want, ("C", "TRANSIT", "replay", 3)]
    assert replay_rejects(spark, path, TELEMETRY, fix, 4) == 0


def test_the_place_in_the_topic_is_the_origin(spark, tmp_path):
    path, schema = str(tmp_path), "value string, topic string, partition int, offset bigint"
    place = ("topic", "partition", "offset")
    put(spark, path, [(payload("B", "LOST"), "t", 0, 7), (payload("B", "LOST"), "t", 0, 8)], 0, place, schema)
    put(spark, path, [(payload("B", "LOST"), "t", 0, 7)], 1, place, schema)
    assert {row[2] for row in attempts(spark, path)} == {"t/0/7", "t/0/8"}
    replay_rejects(spark, path, TELEMETRY, scans, 1)
    found = read_accepted(spark, outcome_path(path, ACCEPTED), StructType([*BRONZE]).add("origin", StringType())
                          .add("offset", LongType()))
    assert sorted((row.origin, row.offset) for row in found.collect()) == [("t/0/7", 7), ("t/0/7", 7), ("t/0/8", 8)]


def test_nothing_to_send(spark, tmp_path):
    assert replay_rejects(spark, str(tmp_path), TELEMETRY, scans, 1) == 0
    put(spark, str(tmp_path), [("{bad",)])
    assert replay_rejects(spark, str(tmp_path), TELEMETRY, lambda column: F.lit(None).cast("string"), 1) == 0
