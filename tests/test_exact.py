import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from waybill import schemas
from waybill.functions.exact import exact_mean, exact_sum, exact_total, names
from waybill.plans import medallion
from waybill.sinks.files import write_batch


def sums(df):
    return df.groupBy().agg(*exact_sum(F.col("x"), "x"), F.count("x").alias("n"))


def test_sums_are_exact_in_any_order(spark):
    draw = random.Random(4)
    values = [draw.choice([draw.random(), draw.uniform(-1e6, 1e6), 2.0 ** draw.randint(-40, 60), 0.1, -1e-9, 1e15 + 0.3])
              for _ in range(3000)]
    want = sum(map(Fraction, values))
    found = []
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(x,) for x in values] + [(None,)], "x double").repartition(seed + 1)
        row = sums(df).select("*", exact_total("x").alias("total"), exact_mean("x", F.col("n")).alias("mean")).first()
        exact = Fraction(int(row.x_whole)) + Fraction(int(row.x_upper), 1 << 50) + Fraction(int(row.x_lower), 1 << 100)
        assert exact == want and row.n == 3000
        assert abs(Fraction(row.total) - want) <= abs(want) * Fraction(1, 2 ** 52)
        found.append(row.mean)
    assert len(set(found)) == 1


@pytest.mark.parametrize("values, want", [
    ([1.0, math.inf], math.inf), ([-2.0 ** 62, 5.0], -math.inf), ([1.0, math.nan, math.inf], math.nan), ([1e300], math.inf),
    ([], None), ([-0.5, -0.25], -0.375), ([5e-324, 1.0], 0.5), ([2.0 ** 61] * 4, 2.0 ** 61), ([0.0, -0.0], 0.0)])
def test_edges(spark, values, want):
    row = sums(spark.createDataFrame([(x,) for x in values], "x double")).select(exact_mean("x", F.col("n")).alias("m")).first()
    assert row.m == want or (want is not None and math.isnan(want) and math.isnan(row.m))


def test_sums_of_sums(spark):
    draw = random.Random(8)
    df = spark.createDataFrame([(i % 5, draw.uniform(0, 1e4)) for i in range(1000)], "part int, x double")
    whole = sums(df).first()
    added = df.groupBy("part").agg(*exact_sum(F.col("x"), "x")).agg(
        *[(F.max if name.endswith("beyond") else F.sum)(name).alias(name) for name in names("x")]).first()
    assert all(whole[name] == added[name] for name in names("x"))


def test_many_refreshes_and_one_agree_to_the_last_bit(spark, tmp_path):
    draw = random.Random(2)
    from datetime import datetime
    rows = [(f"T{draw.randrange(6)}", draw.choice(["PICKUP", "DELIVERED"]), datetime(2024, 1, 1, i % 24), draw.uniform(0, 300))
            for i in range(600)]

    def put(lake, part, number):
        events = spark.createDataFrame(part, schemas.TELEMETRY).withColumns(
            {"reasons": F.lit(""), "reject_key": F.lit(None).cast("string"), "value": F.lit(None).cast("string")})
        write_batch(events, schemas.TELEMETRY.names, number, lake.messages)

    one, many = medallion.Lake(f"{tmp_path}/one"), medallion.Lake(f"{tmp_path}/many")
    put(one, rows, 0)
    medallion.refresh(spark, one)
    for number in range(4):
        put(many, rows[number::4], number)
        medallion.refresh(spark, many)
    found = [sorted(map(tuple, medallion.read_silver(spark, lake).collect())) for lake in (one, many)]
    assert found[0] == found[1] and len(found[0]) == 6
