import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql.types import StructType

from waybill.streaming.flags import flag_sink, forget, read_flags
from waybill.streaming.ingest import drain

SCHEMA = "event_id string, at timestamp_ntz, place int"
OUT = SCHEMA + ", is_duplicate boolean"
NOON = datetime(2024, 1, 10, 12)


def flags(spark, path):
    return sorted(map(tuple, read_flags(spark, path, StructType.fromDDL(OUT)).collect()), key=str)


def test_random_batches_and_replays(spark, tmp_path):
    draw, path = random.Random(3), str(tmp_path)
    sink = flag_sink(path, "event_id", "at", "place", days=1000)
    seen, want, batches = set(), [], []
    for number in range(4):
        rows = [(draw.choice(["a", "b", "c", None, f"x{draw.randrange(30)}"]), NOON + timedelta(hours=draw.randrange(900)),
                 1000 * number + i) for i in range(25)]
        for row in rows:
            want.append((*row, row[0] in seen))
            seen.add(row[0])
        batches.append(spark.createDataFrame(rows, SCHEMA))
        sink(batches[-1], number)
    assert flags(spark, path) == sorted(want, key=str)
    for number in (2, 0, 3):
        sink(batches[number], number)
        assert flags(spark, path) == sorted(want, key=str)


def test_keys_are_forgotten_after_the_delay(spark, tmp_path):
    path = str(tmp_path)
    sink = flag_sink(path, "event_id", "at", "place", days=3)

    def send(number, *rows):
        sink(spark.createDataFrame([(key, when, number) for key, when in rows], SCHEMA), number)

    send(0, ("a", NOON), ("b", NOON + timedelta(days=2)), ("n", None))
    send(1, ("a", NOON + timedelta(days=3)))
    send(2, ("a", NOON + timedelta(days=4)), ("b", NOON + timedelta(days=4)), ("n", NOON + timedelta(days=4)))
    assert [(row[0], row[2], row[3]) for row in flags(spark, path)] == [
        ("a", 0, False), ("a", 1, True), ("a", 2, False), ("b", 0, False), ("b", 2, True), ("n", 0, False), ("n", 2, True)]
    forget(spark, path, "2024-01-12")
    send(3, ("b", NOON + timedelta(days=4)), ("a", NOON + timedelta(days=4)), ("n", NOON + timedelta(days=4)))
    assert [row[3] for row in flags(spark, path) if row[2] == 3] == [True] * 3
    forget(spark, path, "2024-01-13")
    send(4, ("b", NOON + timedelta(days=4)))
    assert [row[3] for row in flags(spark, path) if row[2] == 4] == [False]
    send(5)


def test_a_crowded_key(spark, tmp_path):
    sink = flag_sink(str(tmp_path), "event_id", "at", "place", days=3)
    rows = spark.range(20_000).selectExpr("IF(id % 2 = 0, 'hot', string(id)) AS event_id",
                                          "timestamp_ntz'2024-01-01 00:00:00' AS at", "CAST(id AS INT) AS place")
    for number in range(2):
        sink(rows, number)
    found = read_flags(spark, str(tmp_path), StructType.fromDDL(OUT))
    assert (found.count(), found.filter("NOT is_duplicate").count()) == (40_000, 10_001)


@pytest.mark.parametrize("files", [3])
def test_on_a_stream(spark, tmp_path, files):
    for number in range(files):
        (spark.createDataFrame([("same", NOON, number), (f"own{number}", NOON, number)], SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{tmp_path}/in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    drain(stream, flag_sink(f"{tmp_path}/out", "event_id", "at", days=9), f"{tmp_path}/checkpoint")
    found = [(row[0], row[2], row[3]) for row in flags(spark, f"{tmp_path}/out")]
    assert found == [("own0", 0, False), ("own1", 1, False), ("own2", 2, False), ("same", 0, False), ("same", 1, True),
                     ("same", 2, True)]
