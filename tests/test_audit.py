import random

from waybill.operators import audit

SCHEMA = "topic string, partition int, offset bigint"


def brute(rows):
    found = []
    for topic, partition in {row[:2] for row in rows}:
        offsets = [row[2] for row in rows if row[:2] == (topic, partition) and row[2] is not None]
        for kind, ranged in (("missing", set(range(min(offsets), max(offsets) + 1)) - set(offsets)),
                             ("doubled", {one for one in offsets if offsets.count(one) > 1})):
            for one in sorted(ranged):
                if found and found[-1][:3] == (topic, partition, kind) and found[-1][4] == one - 1:
                    found[-1] = (*found[-1][:4], one)
                else:
                    found.append((topic, partition, kind, one, one))
    return sorted(((*row, row[4] - row[3] + 1) for row in found), key=str)


def test_random_damage(spark):
    draw, rows = random.Random(7), []
    for topic, partition in (("a", 0), ("a", 1), ("b", 0), (None, None)):
        for offset in range(draw.randrange(40), 200 + draw.randrange(40)):
            rows += [(topic, partition, offset)] * draw.choices([0, 1, 2, 3], [2, 20, 1, 1])[0]
    rows = [row for row in rows if not 30 < row[2] < 90 or row[1]] + [("a", 0, None)]
    found = audit.offset_audit(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_ranges_go_on_over_buckets(spark):
    start, end = audit.BUCKET - 3, 5 * audit.BUCKET + 7
    rows = spark.range(start, end).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    assert audit.offset_audit(rows).count() == 0
    lost = (audit.BUCKET - 1, 3 * audit.BUCKET + 4)
    damaged = rows.filter(f"offset NOT BETWEEN {lost[0]} AND {lost[1]}")
    again = damaged.filter(f"offset BETWEEN {4 * audit.BUCKET - 2} AND {4 * audit.BUCKET + 2}")
    found = audit.offset_audit(damaged.unionAll(again).unionAll(again))
    assert sorted(map(tuple, found.collect())) == [
        ("t", 0, "doubled", 4 * audit.BUCKET - 2, 4 * audit.BUCKET + 2, 5),
        ("t", 0, "missing", *lost, lost[1] - lost[0] + 1)]


def test_whole_buckets_are_not_listed(spark):
    """What is listed offset by offset is joined with the broken buckets; bitmaps are put together before the shuffle."""
    rows = spark.range(10).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    plan = audit.offset_audit(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "LeftSemi" in plan


def test_no_messages(spark):
    assert audit.offset_audit(spark.createDataFrame([], SCHEMA)).count() == 0
    assert audit.offset_audit(spark.createDataFrame([("t", 0, None)], SCHEMA)).count() == 0
