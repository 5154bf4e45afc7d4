import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waybill.operators import ordering, rolling
from waybill.plans.gold import DELIVERY_ORDER

SCHEMA = "tracking_number string, delivery_time timestamp_ntz, hours double, micros bigint"
START = datetime(2024, 1, 1)


def parcels(spark, size, seed=0, hot_share=0.0, span_hours=24 * 40):
    """Random deliveries; `hot_share` of them happen at one instant, a tenth have no known transit."""
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        hot = rng.random() < hot_share
        when = START + timedelta(hours=100) if hot else START + timedelta(seconds=rng.randrange(span_hours * 3600))
        micros = None if rng.random() < 0.1 else rng.randrange(-10**9, 10**12)
        rows.append((f"TRK-{i:06d}", when, None if micros is None else micros / 3.6e9, micros))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA), rows


def expected_rows(rows, frame=7):
    ordered = sorted(rows, key=lambda row: (row[1], row[0]))
    averages = {}
    for i, row in enumerate(ordered):
        known = [other[2] for other in ordered[max(0, i - frame + 1):i + 1] if other[2] is not None]
        averages[row[0]] = sum(known) / len(known) if known else None
    return averages


def expected_days(rows, days=7):
    averages = {}
    for row in rows:
        known = [other[3] for other in rows
                 if other[3] is not None and row[1] - timedelta(days=days) <= other[1] <= row[1]]
        averages[row[0]] = sum(known) / len(known) if known else None
    return averages


def same(got, want):
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value, rel=1e-12, abs=1e-9)), key


def result(df, column):
    return {row["tracking_number"]: row[column] for row in df.collect()}


@pytest.mark.parametrize("size", [0, 1, 5, 6, 7, 12, 13, 300])
@pytest.mark.parametrize("block_rows", [6, 7, 50])
def test_row_frames_in_blocks(spark, size, block_rows):
    df, rows = parcels(spark, size, seed=size)
    rolled = rolling.rolling_rows(df, "hours", DELIVERY_ORDER, "avg", block_rows=block_rows)
    same(result(rolled, "avg"), expected_rows(rows))


def test_row_frames_with_a_third_of_all_rows_at_one_instant(spark):
    df, rows = parcels(spark, 2000, seed=3, hot_share=0.4)
    blocks = rolling.rolling_rows(df, "hours", DELIVERY_ORDER, "avg", block_rows=100)
    same(result(blocks, "avg"), expected_rows(rows))


def test_a_block_must_hold_a_frame(spark):
    df, _ = parcels(spark, 10)
    with pytest.raises(ValueError):
        rolling.rolling_rows(df, "hours", DELIVERY_ORDER, "avg", block_rows=5)


def test_other_frame_lengths(spark):
    df, rows = parcels(spark, 100, seed=5)
    for frame in (1, 3):
        rolled = rolling.rolling_rows(df, "hours", DELIVERY_ORDER, "avg", rows=frame, block_rows=4)
        same(result(rolled, "avg"), expected_rows(rows, frame))


@pytest.mark.parametrize("hot_rows", [0, 100, rolling.HOT_ROWS])
@pytest.mark.parametrize("size, hot_share", [(0, 0), (1, 0), (400, 0), (600, 0.4)])
def test_day_frames(spark, size, hot_share, hot_rows):
    df, rows = parcels(spark, size, seed=size, hot_share=hot_share)
    rolled = rolling.rolling_days(df, "micros", "delivery_time", "avg", hot_rows=hot_rows)
    same(result(rolled, "avg"), expected_days(rows))


@pytest.mark.parametrize("hot_rows", [3, rolling.HOT_ROWS])
def test_day_frames_of_odd_times(spark, hot_rows):
    """Before 1970, many in one minute and over its border, and rows without a time."""
    rng = random.Random(6)
    rows = [(f"T{i}", datetime(1969, 12, 31, 23, 58) + timedelta(microseconds=rng.randrange(200_000_000))
             + timedelta(days=rng.choice([0, 0, 7])), None, rng.randrange(100)) for i in range(300)]
    df = spark.createDataFrame(rows + [("none", None, None, 5)], SCHEMA)
    rolled = rolling.rolling_days(df, "micros", "delivery_time", "avg", hot_rows=hot_rows)
    assert rolled.columns == [*df.columns, "avg"]
    same(result(rolled, "avg"), {**expected_days(rows), "none": None})


def test_day_frames_move_rows_once(spark):
    df, _ = parcels(spark, 200)
    plan = rolling.rolling_days(df, "micros", "delivery_time", "avg")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_minute") <= 2 and "rangepartitioning" not in plan


def test_day_frame_includes_its_edge(spark):
    rows = [("a", START, 1.0, 10), ("b", START + timedelta(days=7), 1.0, 20),
            ("c", START + timedelta(days=7, microseconds=1), 1.0, 30)]
    rolled = rolling.rolling_days(spark.createDataFrame(rows, SCHEMA), "micros", "delivery_time", "avg")
    assert result(rolled, "avg") == {"a": 10.0, "b": 15.0, "c": 25.0}


def test_running_totals(spark):
    df = spark.range(1000).select(F.col("id").alias("at"), (F.col("id") % 7).alias("n"))
    total = 0
    for row in ordering.running_totals(df, "at", "n").orderBy("at").collect():
        total += row["at"] % 7
        assert row["n"] == total


def test_ranges_split_a_crowded_instant(spark):
    df, _ = parcels(spark, 4000, seed=1, hot_share=1.0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = ordering.in_order(df, *DELIVERY_ORDER, label="test")
        sizes = [row["count"] for row in ordered.groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 1500
