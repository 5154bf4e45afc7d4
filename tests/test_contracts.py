import json
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from waybill.functions.text import utf8_text
from waybill.operators.contracts import (
    TELEMETRY,
    WEBHOOK,
    Contract,
    Field,
    accepted,
    rejected,
    validate,
    webhook_status,
)
from waybill.sources.webhook import read_webhooks

GOOD = {"tracking_number": "TRK-1", "scan_type": "PICKUP", "timestamp": "2024-01-02T03:04:05", "ping_latency_ms": 1.5}
HOOK = {"event_id": "E1", "tracking_number": "TRK-1", "scan_type": "PICKUP", "timestamp": "2024-01-02T03:04:05"}


def text(**changes):
    record = {**GOOD, **changes}
    return json.dumps({name: value for name, value in record.items() if value is not ...})


def check(spark, contract, payloads):
    rows = spark.createDataFrame(list(enumerate(payloads)), "id int, value string")
    return validate(rows, contract).orderBy("id").collect()


@pytest.mark.parametrize("payload, reasons", [
    (text(), ""),
    (text(extra={"a": [1]}), ""),
    (text(ping_latency_ms=None), ""),
    (text(ping_latency_ms=...), ""),
    (text(ping_latency_ms="12.5"), ""),
    (text(ping_latency_ms=-99), ""),
    (text(ping_latency_ms="1.5f"), "type:ping_latency_ms"),
    (text(ping_latency_ms="fast"), "type:ping_latency_ms"),
    (text(ping_latency_ms=True), "type:ping_latency_ms"),
    (text(ping_latency_ms=[1]), "type:ping_latency_ms"),
    (text(timestamp=1704164645), ""),
    (text(timestamp="nope"), "type:timestamp"),
    (text(timestamp=True), "type:timestamp"),
    (text(timestamp=...), "missing:timestamp"),
    (text(timestamp=None), "missing:timestamp"),
    (text(tracking_number=5), "type:tracking_number"),
    (text(tracking_number={"a": 1}), "type:tracking_number"),
    (text(tracking_number=""), ""),
    (text(scan_type="PICKUP\n"), "pattern:scan_type"),
    (text(scan_type="pickup"), "pattern:scan_type"),
    (text(scan_type="OUT_FOR_DELIVERY"), "pattern:scan_type"),
    (text(scan_type="UNKNOWN_ERROR"), ""),
    (text(scan_type=3, timestamp="nope"), "type:scan_type,type:timestamp"),
    ("{}", "missing:tracking_number,missing:scan_type,missing:timestamp"),
    ("{bad", "malformed_json"),
    ("", "malformed_json"),
    (None, "malformed_json"),
    ("[1]", "malformed_json"),
    ("[" + text() + "]", "malformed_json"),
    ("null", "malformed_json"),
    ("7", "malformed_json"),
    ("NaN", "malformed_json"),
    (text() + " " + text(), "malformed_json"),
    (text() + "," + text(), "malformed_json"),
    (text() + " x", "malformed_json"),
    (text() + "]", "malformed_json"),
    (text() + "],[0]", "malformed_json"),
    ("  " + text() + "\n", ""),
])
def test_telemetry_reasons(spark, payload, reasons):
    assert check(spark, TELEMETRY, [payload])[0]["reasons"] == reasons


def test_accepted_records_are_typed_and_lose_other_fields(spark):
    rows = spark.createDataFrame([(text(extra=1, ping_latency_ms="12.5"),), ("{bad",)], "value string")
    result = accepted(validate(rows, TELEMETRY), TELEMETRY)
    assert [tuple(row) for row in result.collect()] == [("TRK-1", "PICKUP", datetime(2024, 1, 2, 3, 4, 5), 12.5)]
    assert result.columns == TELEMETRY.names


def test_rejects_keep_key_reasons_and_payload(spark):
    payloads = [text(tracking_number=5, scan_type="LOST"), "{bad", text(tracking_number=None)]
    rows = spark.createDataFrame([(p,) for p in payloads], "value string")
    got = {row["payload"]: (row["tracking_number"], row["reason"], row["reasons"])
           for row in rejected(validate(rows, TELEMETRY), TELEMETRY).collect()}
    assert got == {
        payloads[0]: ("5", "type:tracking_number", ["type:tracking_number", "pattern:scan_type"]),
        payloads[1]: ("Unknown", "malformed_json", ["malformed_json"]),
        payloads[2]: ("Unknown", "missing:tracking_number", ["missing:tracking_number"]),
    }


@pytest.mark.parametrize("setting", ["true", "false"])
def test_duplicate_keys_take_the_last_value_in_any_session(spark, setting):
    payload = text()[:-1] + ', "tracking_number": "TRK-2"}'
    key = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(key, setting)
    try:
        assert check(spark, TELEMETRY, [payload])[0]["tracking_number"] == "TRK-2"
        assert spark.conf.get(key) == setting
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("changes, flag, code", [
    ({}, False, 200),
    ({"is_duplicate": True}, True, 200),
    ({"is_duplicate": "Yes"}, True, 200),
    ({"is_duplicate": "off"}, False, 200),
    ({"is_duplicate": 1}, True, 200),
    ({"is_duplicate": 0.0}, False, 200),
    ({"is_duplicate": 2}, None, 400),
    ({"is_duplicate": "maybe"}, None, 400),
    ({"is_duplicate": None}, None, 400),
    ({"facility_code": None}, False, 200),
    ({"facility_code": 7}, False, 400),
    ({"scan_type": "OUT_FOR_DELIVERY"}, False, 200),
    ({"scan_type": "UNKNOWN_ERROR"}, False, 400),
])
def test_webhook_contract(spark, changes, flag, code):
    rows = spark.createDataFrame([(json.dumps({**HOOK, **changes}),)], "body string")
    checked = validate(read_webhooks(rows), WEBHOOK)
    assert checked.first()["is_duplicate"] == flag
    assert webhook_status(checked).first()["status_code"] == code


def test_webhook_without_body_is_invalid_and_cut_off_body_is_an_error(spark):
    rows = spark.createDataFrame([(1, None), (2, "{bad"), (3, json.dumps(HOOK))], "id int, body string")
    got = {row["id"]: (row["status_code"], row["message"])
           for row in webhook_status(validate(read_webhooks(rows), WEBHOOK), "id").collect()}
    assert got == {1: (400, "Invalid Payload Schema"), 2: (500, "malformed_json"),
                   3: (200, "Event Validated and Ingested")}


def test_patterns_are_anchored_at_both_ends(spark):
    contract = Contract(key="code", fields=(Field("code", required=True, pattern="[A-Z]{2}|[0-9]+"),))
    payloads = [json.dumps({"code": code}) for code in ("AB", "12", "ABC", "xAB", "AB\n")]
    assert [row["reasons"] for row in check(spark, contract, payloads)] == ["", ""] + ["pattern:code"] * 3


def test_counts_come_with_the_job(spark):
    counts = Observation()
    rows = spark.createDataFrame([(text(),), ("{bad",), (text(),)], "value string")
    validate(rows, TELEMETRY, counts=counts).write.format("noop").mode("overwrite").save()
    assert counts.get == {"rows": 3, "valid": 2}


def test_bytes_that_are_no_text_are_malformed(spark):
    rows = spark.createDataFrame([(bytearray(text().encode()),), (bytearray(b'{"a":"\xff"}'),)], "raw binary")
    decoded = rows.select(utf8_text(F.col("raw")).alias("value"))
    assert sorted(row["reasons"] for row in validate(decoded, TELEMETRY).collect()) == ["", "malformed_json"]


def test_valid_and_rejected_make_up_the_input(spark):
    payloads = [text(), "{bad", text(scan_type="LOST"), None] * 25
    checked = validate(spark.createDataFrame([(p,) for p in payloads], "value string"), TELEMETRY)
    assert accepted(checked, TELEMETRY).count() + rejected(checked, TELEMETRY).count() == 100
