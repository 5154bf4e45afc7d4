from datetime import datetime, timedelta

from pyspark.sql import functions as F

from waybill.operators.milestones import milestones
from waybill.plans.gold import gold_sla
from waybill.sources.samples import register, sample_events, stacked, staged_scans

SCANS = "tracking_number string, scan_type string, timestamp timestamp_ntz"
START = datetime(2024, 1, 1)


def scans(spark, *rows):
    return spark.createDataFrame([(key, kind, START + timedelta(hours=hours)) for key, kind, hours in rows], SCANS)


def mart(df):
    return {row["tracking_number"]: row for row in gold_sla(df).collect()}


def test_sample_parcel(spark):
    staged = register("stg_sample", sample_events(spark))
    assert [tuple(row) for row in staged.orderBy("event_id").collect()] == [
        ("EVT-001", "TRK-98765", "PICKUP", datetime(2023, 10, 1, 8)),
        ("EVT-002", "TRK-98765", "DELIVERED", datetime(2023, 10, 3, 14))]
    assert [tuple(row) for row in gold_sla(staged).collect()] == [
        ("TRK-98765", datetime(2023, 10, 1, 8), datetime(2023, 10, 3, 14), 54.0, 54.0, True)]


def test_stacking_goes_by_position_and_keeps_copies(spark):
    events = sample_events(spark).withColumn("event_id", F.lit(1))
    other = staged_scans(events).toDF("a", "b", "c", "d")
    rows = stacked(staged_scans(events), other, other).collect()
    assert len(rows) == 6 and sorted({row["scan_type"] for row in rows}) == ["DELIVERED", "PICKUP"]


def test_limit_is_exclusive_and_unknown_transit_is_no_breach(spark):
    rows = mart(scans(
        spark,
        ("on time", "PICKUP", 0), ("on time", "DELIVERED", 48),
        ("late", "PICKUP", 0), ("late", "DELIVERED", 48.001),
        ("no pickup", "DELIVERED", 50),
        ("backwards", "PICKUP", 60), ("backwards", "DELIVERED", 52),
        ("pickup only", "PICKUP", 0), ("transit only", "TRANSIT", 0), ("error only", "UNKNOWN_ERROR", 0)))
    assert set(rows) == {"on time", "late", "no pickup", "backwards"}
    assert [rows[key]["is_sla_breached"] for key in ("on time", "late", "no pickup", "backwards")] == [
        False, True, False, False]
    assert rows["no pickup"]["transit_hours"] is None
    assert rows["backwards"]["transit_hours"] == -8.0


def test_first_pickup_and_last_delivery_count(spark):
    row = milestones(scans(spark, ("a", "PICKUP", 5), ("a", "PICKUP", 3), ("a", "DELIVERED", 9),
                           ("a", "DELIVERED", 20), ("a", "TRANSIT", 99))).first()
    assert (row["pickup_time"], row["delivery_time"]) == (START + timedelta(hours=3), START + timedelta(hours=20))


def test_frame_fills_slides_and_counts_unknown_rows(spark):
    rows = []
    for i in range(9):
        rows.append((f"p{i}", "DELIVERED", 100 + i))
        if i != 4:
            rows.append((f"p{i}", "PICKUP", 100))
    found = mart(scans(spark, *rows))
    assert [found[f"p{i}"]["rolling_7_delivery_avg_hours"] for i in range(9)] == [
        0.0, 0.5, 1.0, 1.5, 1.5, 11 / 5, 17 / 6, 24 / 6, 31 / 6]
