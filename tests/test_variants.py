import json
from datetime import datetime

from waybill.sources import variants
from waybill.sources.variants import damaged_files, elements, field_kinds, inferred, merged_kinds, read_documents, telemetry_of

RECORD = {"tracking_number": "T1", "scan_type": "PICKUP", "timestamp": "2024-01-02T03:04:05", "ping_latency_ms": 2}


def test_arrays_objects_and_damaged_files(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([RECORD, {**RECORD, "tracking_number": "T2"}], indent=2))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "object.json").write_text("\n" + json.dumps({**RECORD, "tracking_number": "T3"}, indent=1))
    (tmp_path / "cut.json").write_text(json.dumps([RECORD, RECORD])[:-9])
    (tmp_path / "number.json").write_text("5")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "bytes.json").write_bytes(b"[\xff\xfe]")
    documents = read_documents(spark, str(tmp_path))
    assert sorted(row["file"].rsplit("/", 1)[1] for row in damaged_files(documents).collect()) == [
        "bytes.json", "cut.json", "number.json"]
    found = telemetry_of(elements(documents), "place")
    when = datetime(2024, 1, 2, 3, 4, 5)
    assert sorted(map(tuple, found.collect())) == [(0, "T1", "PICKUP", when, 2.0), (0, "T3", "PICKUP", when, 2.0),
                                                   (1, "T2", "PICKUP", when, 2.0)]


def test_elements_of_one_file_are_dealt_out(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"n": i, "odd": "]},[{" + "\\\"" * (i % 3)} for i in range(4000)], indent=1))
    found = elements(read_documents(spark, str(tmp_path)), 8)
    assert found.count() == 4000 and found.rdd.getNumPartitions() == 8
    sizes = found.selectExpr("spark_partition_id() AS task").groupBy("task").count().collect()
    assert len(sizes) == 8 and max(row["count"] for row in sizes) < 1000


def kinds(spark, *records):
    texts = spark.createDataFrame([(json.dumps(record),) for record in records], "text string")
    return texts.selectExpr("text", "parse_json(text) AS record")


def test_fields_and_their_types(spark):
    records = kinds(spark, {"a": 1, "b": "x", "c": None, "d": 1, "e": True, "f": {"g": 1}, "k": 1},
                    {"a": 2.5, "b": 3, "c": None, "d": 10 ** 12, "e": False, "f": [1], "it's \\": 1e300, "k": None}, 5, [7])
    found = field_kinds(records)
    assert found == {"a": "DOUBLE", "b": "STRING", "c": "VOID", "d": "BIGINT", "e": "BOOLEAN", "f": "STRING",
                     "it's \\": "DOUBLE", "k": "BIGINT"}
    rows = [tuple(row) for row in inferred(records, found).collect()]
    assert rows[0] == (1.0, "x", None, 1, True, '{"g":1}', None, 1)
    assert rows[1] == (2.5, "3", None, 10 ** 12, False, "[1]", 1e300, None) and set(rows[2]) == {None}


def test_types_of_batches_only_widen():
    assert merged_kinds({"a": "BIGINT", "b": "STRING", "v": "VOID"}, {"a": "DOUBLE", "c": "BOOLEAN", "v": "BIGINT"}, {"b": "BIGINT"},
                        {"c": "BIGINT"}) == {"a": "DOUBLE", "b": "STRING", "c": "STRING", "v": "BIGINT"}
    for one in variants.TYPES:
        for other in variants.TYPES:
            wide = variants.widen(one, other)
            assert wide == variants.widen(other, one) == variants.widen(wide, one)


def test_no_records(spark):
    empty = spark.createDataFrame([], "text string").selectExpr("parse_json(text) AS record")
    assert field_kinds(empty) == {} and inferred(empty, {"a": "BIGINT"}).count() == 0
