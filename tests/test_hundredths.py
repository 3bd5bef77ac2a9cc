"""Exact sums of whole hundredths are sums of longs (F7 of round 3); mixed with other doubles they stay exact."""

import random
from decimal import Context, Decimal

from pyspark.sql import functions as F

from quayside.functions.exprs import exact_lanes, exact_sum


def test_hundredths_need_no_decimals(spark):
    df = spark.createDataFrame([(float(i) / 100,) for i in range(-500, 500)] + [(9999999.99,), (0.0,), (-0.0,)], "x double")
    kinds = [t for _, t in df.select(exact_lanes(F.col("x"))).dtypes]
    used = df.select([F.count(c).alias(f"c{i}") for i, c in enumerate(exact_lanes(F.col("x")))]).first()
    assert [k for k, n in zip(kinds, used) if n] == ["bigint"]


def test_sums_are_the_decimals_that_print(spark):
    rnd = random.Random(3)
    some = [round(rnd.uniform(-1e6, 1e6), 2) for _ in range(300)]
    fine = [rnd.uniform(-3, 3) for _ in range(60)] + [0.1 + 0.2, 7.0 - 4.9, 1e7, 1e7 + 0.01, 12345678.125, 0.005, 1 / 3, 99999999.99]
    sets = [some, [0.1] * 10, [0.005, 0.01], fine, some + fine, some[:3] + [1 / 3], [5e13 + 0.25, 0.01], [0.0], [None], [None, 0.5]]
    df = spark.createDataFrame([(i, x) for i, xs in enumerate(sets) for x in xs], "k int, x double").repartition(5)
    got = dict(df.groupBy("k").agg(exact_sum(F.col("x")).alias("s")).collect())
    for i, xs in enumerate(sets):
        there = [Decimal(repr(x)).quantize(Decimal("1e-15"), context=Context(prec=60)) for x in xs if x is not None]
        assert got[i] == (float(sum(there)) if there else None), i


def test_huge_sums_beside_hundredths(spark):
    df = spark.createDataFrame([(9e13 + 0.125,)], "x double").crossJoin(spark.range(2_000_000)).select("x")
    df = df.union(spark.createDataFrame([(0.25,)], "x double"))
    got = df.agg(exact_sum(F.col("x"))).first()[0]
    assert abs(got / (2_000_000 * (9e13 + 0.125)) - 1) < 1e-15
