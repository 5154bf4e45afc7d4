"""The plans that have to hold at scale."""

import re

import pytest
from tests.conftest import TESTDATA
from waybill import queries, schemas
from waybill.operators import contracts, latest, milestones, quality, status
from waybill.operators.rolling import rolling_days
from waybill.plans import medallion
from waybill.query_data import read_events, telemetry, telemetry_messages
from waybill.session import clear_scratch, scratch_path
from waybill.sinks.files import ACCEPTED, outcome_path
from waybill.sinks.webhooks import current_events, upsert_events

SMALL = f"{TESTDATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", [name for name in queries.QUERIES if "stream" not in name and "medallion" not in name])
def test_no_query_runs_python_or_joins_without_a_key(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_milestones_read_two_columns_and_push_the_scan_filter(spark):
    text = formatted(queries.milestone_times(spark, SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    assert re.search(r"PushedFilters: \[.*In\(event_type, \[purchase,signup\]\)", text)
    assert text.count("Exchange hashpartitioning") <= 1


def test_clean_filter_reaches_a_parquet_scan(spark):
    path = scratch_path(spark, "clean")
    telemetry(read_events(spark, SMALL)).write.parquet(path)
    text = plan(status.status_summary(spark.read.parquet(path), schemas.TELEMETRY_SCANS))
    assert "GreaterThan(ping_latency_ms,0.0)" in text


def test_per_parcel_aggregates_hash_and_combine_before_the_shuffle(spark):
    scans = telemetry(read_events(spark, SMALL))
    for df in (milestones.milestones(scans), status.status_summary(scans, schemas.TELEMETRY_SCANS),
               status.latest_scan(scans), medallion.parcel_summary(scans)):
        text = plan(df)
        assert "SortAggregate" not in text
        assert text.count("HashAggregate") == 2
        assert text.count("Exchange") == 1


def test_gate_is_one_pass(spark):
    text = plan(quality.run_gate(telemetry(read_events(spark, SMALL))))
    assert text.count("FileScan") == 1


def test_payloads_are_parsed_once(spark):
    checked = contracts.validate(telemetry_messages(read_events(spark, SMALL)), contracts.TELEMETRY)
    assert plan(contracts.accepted(checked, contracts.TELEMETRY)).count("parseJson") == 1


@pytest.mark.parametrize("name", [name for name in queries.QUERIES if "gate" not in name and "counts" not in name])
def test_registered_queries_never_gather_rows_in_one_task(spark, name):
    """Apart from one row per range, nothing meets in a single partition."""
    text = plan(queries.QUERIES[name](spark, SMALL))
    for position in [match.start() for match in re.finditer("Exchange SinglePartition", text)]:
        below = text[position:].split("\n")[1:4]
        assert any("HashAggregate(keys=[_range" in line for line in below), below


def test_the_webhook_store_is_resolved_by_hashing(spark):
    path = scratch_path(spark, "hashed")
    events = spark.range(100).selectExpr(
        "concat('E', id) AS event_id", "concat('T', id % 9) AS tracking_number", "'PICKUP' AS scan_type",
        "timestamp_ntz'2024-01-01 00:00:00' AS timestamp", "CAST(NULL AS STRING) AS facility_code",
        "false AS is_duplicate", "id AS arrival")
    upsert_events(events, path, 0)
    found = current_events(spark, path)
    assert "SortAggregate" not in plan(found) and found.count() == 9


@pytest.fixture
def tiny_skew(spark):
    """Thresholds at which a few hundred kilobytes count as skewed, and no broadcast joins."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_crowded_keys_are_split_where_rows_are_joined_back(spark, tiny_skew):
    copies = spark.range(300000, numPartitions=16).selectExpr("IF(id % 3 = 0, -1, id) AS key", "id AS place")
    flagged = latest.duplicate_flag(copies, "key", "place")
    assert len(flagged.filter("NOT is_duplicate").collect()) == 200001
    deliveries = spark.range(300000, numPartitions=16).selectExpr(
        "id AS micros", "IF(id % 3 = 0, timestamp_ntz'2024-01-03 00:00:00',"
        " timestampadd(SECOND, id, timestamp_ntz'2024-01-01 00:00:00')) AS at")
    rolled = rolling_days(deliveries, "micros", "at", "avg")
    flagged.collect()
    assert len(rolled.collect()) == 300000
    for df in (flagged, rolled):
        assert re.search(r"(SortMerge|ShuffledHash)Join\(skew=true\)", plan(df))


def test_dates_are_gathered_before_they_are_written(spark):
    path = scratch_path(spark, "dates")
    events = spark.range(2000, numPartitions=16).selectExpr(
        "concat('E', id) AS event_id", "concat('T', id) AS tracking_number", "'PICKUP' AS scan_type",
        "timestampadd(HOUR, id, timestamp_ntz'2024-01-01 00:00:00') AS timestamp",
        "CAST(NULL AS STRING) AS facility_code", "false AS is_duplicate", "id AS arrival")
    upsert_events(events, path, 0)
    stored = spark.read.parquet(outcome_path(path, ACCEPTED))
    dates = stored.select("event_date").distinct().count()
    assert stored.count() == 2000
    assert len(stored.inputFiles()) == dates


def test_scratch_goes_where_the_cluster_says(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_of_the_application_can_be_removed(spark):
    path = scratch_path(spark, "kept")
    spark.range(3).write.parquet(path)
    other = scratch_path(spark, "other").rsplit("/", 1)[0]
    assert path.startswith(other + "/") and spark.sparkContext.applicationId in other
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
