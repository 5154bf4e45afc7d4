import pytest

from waybill.operators.quality import (
    QualityGateError,
    between,
    bronze_suite,
    enforce,
    not_null,
    run_gate,
    violations,
)

SCHEMA = "tracking_number string, ping_latency_ms double"


def latencies(spark, *values, key="TRK-1"):
    return spark.createDataFrame([(key, value) for value in values], SCHEMA)


def report_of(df):
    return {row["expectation"]: (row["evaluated"], row["unexpected"], row["success"]) for row in run_gate(df).collect()}


@pytest.mark.parametrize("good, passes", [(17, True), (16, False)])
def test_tolerance_is_inclusive(spark, good, passes):
    report = report_of(latencies(spark, *[1.0] * good, *[-99.0] * (20 - good)))
    assert report["ping_latency_ms between 0 and 10000"] == (20, 20 - good, passes)


def test_bounds_are_inclusive_and_missing_values_do_not_count(spark):
    df = latencies(spark, 0.0, 10000.0, 10000.01, None, float("nan"))
    assert report_of(df)["ping_latency_ms between 0 and 10000"] == (3, 1, False)
    assert [row["ping_latency_ms"] for row in violations(df).collect()] == [10000.01]


def test_one_missing_key_fails(spark):
    df = latencies(spark, 1.0, 2.0).union(latencies(spark, 1.0, key=None))
    assert report_of(df)["tracking_number is not null"] == (3, 1, False)
    with pytest.raises(QualityGateError, match="tracking_number is not null: 1 of 3"):
        enforce(run_gate(df))


def test_no_rows_and_no_values_pass(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert all(success for _, _, success in report_of(empty).values())
    assert all(success for _, _, success in report_of(latencies(spark, None, None)).values())
    enforce(run_gate(empty))


def test_any_suite_is_one_aggregate(spark):
    suite = (*bronze_suite(), not_null("ping_latency_ms"), between("ping_latency_ms", 0, 5, 0.5))
    plan = run_gate(latencies(spark, 1.0), suite)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
