from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from waybill.operators import latest
from waybill.operators.latest import drop_duplicates_stream, duplicate_flag, last_write_wins
from waybill.sinks.batches import BatchSet, Marks
from waybill.sinks.files import ACCEPTED, REJECTED, outcome_path
from waybill.sinks.versions import Versions
from waybill.sinks.webhooks import compact, current_events, upsert_events
from waybill.sources.bronze import read_rejects
from waybill.sources.webhook import read_webhooks
from waybill.streaming.ingest import webhook_sink

SCHEMA = ("event_id string, tracking_number string, scan_type string, timestamp timestamp_ntz,"
          " facility_code string, is_duplicate boolean, arrival bigint")
NOON = datetime(2024, 1, 2, 12)


def event(event_id, key="TRK-1", when=NOON, arrival=0, facility=None):
    return (event_id, key, "PICKUP", when, facility, False, arrival)


def stored(df):
    return {row["event_key"]: row["event_id"] for row in df.collect()}


def test_a_repeated_key_replaces_the_event(spark, tmp_path):
    path = f"{tmp_path}/events"
    first = spark.createDataFrame([event("E1", arrival=1), event("E2", "TRK-2", arrival=2)], SCHEMA)
    second = spark.createDataFrame([event("E3", arrival=3), event("E4", arrival=5), event("E5", arrival=4),
                                    event("E6", when=datetime(2024, 1, 3), arrival=6)], SCHEMA)
    want = {"TRK-1_2024-01-02T12:00:00.000000": "E4", "TRK-2_2024-01-02T12:00:00.000000": "E2",
            "TRK-1_2024-01-03T00:00:00.000000": "E6"}
    upsert_events(first, path, 0)
    upsert_events(second, path, 1)
    assert stored(current_events(spark, path)) == want
    upsert_events(second, path, 1)
    assert stored(current_events(spark, path)) == want
    upsert_events(first, path, 0, source="another stream")
    assert stored(current_events(spark, path)) == want


def test_merged_batches_are_read_from_their_runs(spark, tmp_path):
    path = f"{tmp_path}/events"
    compact(spark, path)
    far = datetime(9999, 1, 1)
    upsert_events(spark.createDataFrame([event("E1", arrival=1), event("E2", arrival=2), event("F1", when=far, arrival=1),
                                         event("G1", when=datetime(2024, 5, 1))], SCHEMA), path, 0)
    compact(spark, path)
    first = Versions(spark, path).current()
    assert first["merged"] == [["batch", [[0, 0]]]] and [run["tier"] for run in first["runs"]] == [0]
    run = spark.read.parquet(first["folders"][0])
    assert run.count() == 3 and run.select("event_date").distinct().count() == 3
    upsert_events(spark.createDataFrame([event("E3", arrival=3), event("F0", when=far, arrival=0)], SCHEMA), path, 1)
    want = {"TRK-1_2024-01-02T12:00:00.000000": "E3", "TRK-1_9999-01-01T00:00:00.000000": "F1",
            "TRK-1_2024-05-01T00:00:00.000000": "G1"}
    assert stored(current_events(spark, path)) == want
    compact(spark, path)
    second = Versions(spark, path).current()
    assert second["merged"] == [["batch", [[0, 1]]]] and second["runs"][0] == first["runs"][0]
    assert stored(current_events(spark, path)) == want
    assert stored(current_events(spark, path, F.col("event_date").isNull())) == {"TRK-1_9999-01-01T00:00:00.000000": "F1"}
    compact(spark, path)
    assert Versions(spark, path).current() == second


def test_batches_may_come_in_any_order(spark, tmp_path):
    """Merged in between or not, the last arrival under a key is what is read; none is lost or merged twice."""
    path = f"{tmp_path}/events"

    def put(number, *events, source="batch"):
        upsert_events(spark.createDataFrame(list(events), SCHEMA), path, number, source)

    put(5, event("E5", arrival=5), event("X5", "TRK-X", arrival=50))
    compact(spark, path)
    put(3, event("E3", "TRK-3", arrival=3), event("X3", "TRK-X", arrival=30))
    noon = "_2024-01-02T12:00:00.000000"
    want = {f"TRK-1{noon}": "E5", f"TRK-X{noon}": "X5", f"TRK-3{noon}": "E3"}
    assert stored(current_events(spark, path)) == want
    compact(spark, path)
    assert Versions(spark, path).current()["merged"] == [["batch", [[3, 3], [5, 5]]]]
    put(4, event("E4", "TRK-4", arrival=4))
    put(3, event("E3", "TRK-3", arrival=3), event("X3", "TRK-X", arrival=30))
    put(3, event("O3", "TRK-O", arrival=1), source="other/stream @1")
    want |= {f"TRK-4{noon}": "E4", f"TRK-O{noon}": "O3"}
    assert stored(current_events(spark, path)) == want
    compact(spark, path)
    assert Versions(spark, path).current()["merged"] == [["batch", [[3, 5]]], ["other/stream @1", [[3, 3]]]]
    assert stored(current_events(spark, path)) == want
    assert Marks(spark, path).all() == []


def test_a_batch_that_is_not_complete_is_read_but_not_merged(spark, tmp_path):
    path = f"{tmp_path}/events"
    upsert_events(spark.createDataFrame([event("E1", arrival=1)], SCHEMA), path, 0)
    upsert_events(spark.createDataFrame([event("E2", "TRK-2", arrival=2)], SCHEMA), path, 1)
    Marks(spark, path).remove([("batch", 1)])
    compact(spark, path)
    assert Versions(spark, path).current()["merged"] == [["batch", [[0, 0]]]]
    assert sorted(stored(current_events(spark, path)).values()) == ["E1", "E2"]


def test_events_without_a_source_are_read(spark, tmp_path):
    path = f"{tmp_path}/events"
    upsert_events(spark.createDataFrame([event("E1", arrival=1)], SCHEMA), path, 0)
    compact(spark, path)
    folder = f"{outcome_path(path, ACCEPTED)}/event_date=2024-01-02"
    row = spark.createDataFrame([event("E2", "TRK-2", arrival=2)], SCHEMA).withColumn("event_key", F.lit("TRK-2_x"))
    row.write.parquet(f"{folder}/source=__HIVE_DEFAULT_PARTITION__/batch_id=0")
    assert sorted(stored(current_events(spark, path)).values()) == ["E1", "E2"]


def test_runs_stay_few(spark, tmp_path):
    """After 50 merges a read scans the batches and the runs once each, and shuffles once."""
    path = f"{tmp_path}/events"
    for number in range(50):
        upsert_events(spark.createDataFrame([event(f"E{number}", f"TRK-{number % 7}", arrival=number)], SCHEMA), path, number)
        compact(spark, path)
    current = Versions(spark, path).current()
    assert current["merged"] == [["batch", [[0, 49]]]] and len(current["runs"]) <= 9
    assert len(list((tmp_path / "events" / "data").iterdir())) <= 9 + 8
    found = current_events(spark, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and plan.count("Exchange") == 1 and "WindowGroupLimit" in plan
    assert sorted(stored(found).values()) == sorted(f"E{number}" for number in range(43, 50))


def test_a_merge_that_fails_leaves_no_run(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/events"
    upsert_events(spark.createDataFrame([event("E1", arrival=1)], SCHEMA), path, 0)
    monkeypatch.setattr(Versions, "publish", lambda *args, **facts: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compact(spark, path)
    assert list((tmp_path / "events" / "data").iterdir()) == []
    monkeypatch.undo()
    compact(spark, path)
    assert list(stored(current_events(spark, path)).values()) == ["E1"]


def test_sets_of_batches():
    held = BatchSet.of([("a", 1), ("a", 3), ("b", 0), (None, 7)])
    assert held.facts() == [[None, [[7, 7]]], ["a", [[1, 1], [3, 3]]], ["b", [[0, 0]]]]
    held = BatchSet.from_facts(held.facts()).plus([("a", 2), ("a", 3), ("a", 5)])
    assert held.facts()[1] == ["a", [[1, 3], [5, 5]]]
    assert ("a", 2) in held and ("a", 4) not in held and ("c", 0) not in held and (None, 7) in held
    assert not BatchSet() and held


def test_a_store_without_events_can_be_read(spark, tmp_path):
    assert current_events(spark, f"{tmp_path}/absent").count() == 0
    rejected = spark.createDataFrame([("{bad", 3)], "body string, arrival bigint")
    webhook_sink(f"{tmp_path}/store")(rejected, 0)
    assert current_events(spark, f"{tmp_path}/store").count() == 0
    row = read_rejects(spark, outcome_path(f"{tmp_path}/store", REJECTED)).first()
    assert (row["reason"], row["payload"], row["arrival"], row["batch_id"]) == ("malformed_json", "{bad", 3, 0)


def test_arrival_comes_from_the_request_or_its_source(spark):
    def arrival(columns, *values):
        rows = spark.createDataFrame([("{}", *values)], f"body string{columns}")
        return read_webhooks(rows).first()["arrival"]

    assert arrival(", arrival int, offset bigint", 4, 9) == 4
    assert arrival(", offset bigint, timestamp timestamp", 9, NOON) == 9
    assert arrival(", timestamp timestamp_ntz", NOON) == 1704196800000000
    placed = ", partition int, offset bigint, timestamp timestamp"
    order = [arrival(placed, *one) for one in [(1, 900, NOON), (1, 901, NOON), (0, 5, datetime(2024, 1, 2, 12, 0, 1)),
                                               (3, 10 ** 14, datetime(2240, 1, 1))]]
    assert order == sorted(set(order)) and order[0] == (1704196800000 << 20) + 900
    assert arrival("") > 1704196800000000


def test_dates_limit_the_partitions_read(spark, tmp_path):
    path = f"{tmp_path}/events"
    upsert_events(spark.createDataFrame([event("E1"), event("E2", when=datetime(2024, 1, 3))], SCHEMA), path, 0)
    one_day = current_events(spark, path, F.col("event_date") == "2024-01-03")
    assert list(stored(one_day).values()) == ["E2"]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_nulls_may_win(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 2, None)], "key string, arrival int, note string")
    assert [tuple(row) for row in last_write_wins(df, "key", "arrival").collect()] == [("k", 2, None)]


def test_of_rows_at_one_moment_one_wins(spark):
    rows = [("k", 2, "x"), ("k", 2, "y"), ("k", 2, "y"), ("k", 1, "z"), ("k", None, "w"), (None, 5, "a"), (None, 5, "a"),
            ("n", None, "b")]
    df = spark.createDataFrame(rows, "key string, arrival int, note string")
    won = {row["key"]: row["note"] for row in last_write_wins(df, "key", "arrival").collect()}
    assert won.keys() == {"k", None, "n"} and won["k"] in "xy" and (won[None], won["n"]) == ("a", "b")
    assert last_write_wins(df, "key", "arrival").count() == 3


def test_equal_rows_are_told_apart_as_duplicates(spark):
    rows = [("a", 1, "x")] * 3 + [("a", 1, "y"), ("b", None, "x"), ("b", None, "x"), ("b", 4, "x"), ("c", 1, "x"),
                                 (None, 1, "x"), (None, 1, "x")]
    flagged = duplicate_flag(spark.createDataFrame(rows, "id string, place int, note string"), "id", "place")
    assert sorted(map(str, flagged.select("id", "place", "note", "is_duplicate").collect())) == sorted(map(str, [
        Row(id=i, place=p, note=n, is_duplicate=d) for i, p, n, d in [
            ("a", 1, "x", False), ("a", 1, "x", True), ("a", 1, "x", True), ("a", 1, "y", True), ("b", 4, "x", False),
            ("b", None, "x", True), ("b", None, "x", True), ("c", 1, "x", False), (None, 1, "x", False),
            (None, 1, "x", True)]]))


def test_very_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(latest, "COPIES", 7)
    flagged = duplicate_flag(spark.range(50).selectExpr("1 AS id", "2 AS place"), "id", "place")
    assert [flagged.count(), flagged.filter("NOT is_duplicate").count()] == [50, 1]


def test_only_the_first_of_a_key_is_no_duplicate(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 3), ("b", 1), (None, 5), (None, 4), ("c", None)],
                               "id string, place int")
    got = {(row["id"], row["place"]): row["is_duplicate"] for row in duplicate_flag(df, "id", "place").collect()}
    assert got == {("a", 1): False, ("a", 2): True, ("a", 3): True, ("b", 1): False,
                   (None, 4): False, (None, 5): True, ("c", None): False}


def test_several_columns_may_give_the_order(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 1), ("a", 2, 0)], "id string, part int, offset int")
    got = {(row["part"], row["offset"]): row["is_duplicate"]
           for row in duplicate_flag(df, "id", "part", "offset").collect()}
    assert got == {(1, 1): False, (1, 2): True, (2, 0): True}


def test_a_crowded_key_is_flagged_whole(spark):
    df = spark.range(30000).selectExpr("IF(id % 3 = 0, -1, id) AS key", "id AS place")
    flagged = duplicate_flag(df, "key", "place")
    assert flagged.filter("is_duplicate").count() == 9999
    assert flagged.count() == 30000


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_drops_repeats_within_the_delay(spark, tmp_path, salts):
    source = f"{tmp_path}/in"
    schema = "event_id string, at timestamp"

    def send(*ids):
        rows = spark.createDataFrame([(event_id, NOON) for event_id in ids], schema)
        rows.repartition(4).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        unique = drop_duplicates_stream(stream, "event_id", "at", "1 hour", salts)
        query = (unique.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
                 .option("path", f"{tmp_path}/out").trigger(availableNow=True).start())
        query.awaitTermination()

    send("E1", "E2", *["hot"] * 300)
    run()
    send("E1", "E3", *["hot"] * 300)
    run()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(row["event_id"] for row in out.collect()) == ["E1", "E2", "E3", "hot"]
    assert out.columns == ["event_id", "at"]
