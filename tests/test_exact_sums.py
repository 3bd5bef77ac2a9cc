"""Sums that don't depend on the order of rows (C8, L4): any magnitude, no failed job."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.functions.exprs import exact_sum
from quayside.operators import cut_orders
from tests.conftest import rows
from tests.lines_fixture import make_lines


def total(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_sum(F.col("x")).alias("s")).first().s


@pytest.mark.parametrize("values,want", [
    ([1e24], 1e24), ([1e24, 1.0, -1e24], 1.0), ([1e-16], 1e-16), ([1e-16] * 10, 1e-15), ([1e24, 1e-16, -1e24], 1e-16),
    ([0.1] * 10, 1.0), ([0.1, 0.2], 0.3), ([29.7, 0.3], 30.0), ([1e14, 0.25, -1e14], 0.25), ([-5.5, 5.5], 0.0),
    ([123456789.123456, 1e-20], 123456789.123456), ([1e-30] * 4, 4e-30), ([None, 2.0], 2.0), ([None], None), ([], None), ([1e300, 1e300], 2e300),
    ([1.7e27, 1.0], 1.7e27), ([7.0 - 4.9], 2.1), ([0.0], 0.0), ([3e-10, -1e-10], 2e-10)])
def test_sums_of_any_magnitude(spark, values, want):
    assert total(spark, values) == want


def test_not_a_number_and_infinities_go_through(spark):
    assert math.isnan(total(spark, [1.0, float("nan")])) and total(spark, [1.0, float("-inf")]) == float("-inf")


def test_any_order_gives_the_same_bits_and_the_decimal_value(spark):
    rng = random.Random(5)
    values = [round(rng.uniform(-1, 1) * 10 ** rng.randint(-6, 13), rng.randint(0, 12)) or 1.0 for _ in range(3000)]
    got = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        got.add(total(spark, values, parts=seed + 1))
    assert len(got) == 1
    assert got.pop() == pytest.approx(float(sum(Fraction(repr(v)) for v in values)), rel=1e-15)


def test_as_a_window(spark):
    df = spark.createDataFrame([(1, 1e24), (1, 0.1), (1, -1e24), (2, 0.1), (2, 0.2)], "k int, x double")
    out = df.select("k", exact_sum(F.col("x"), Window.partitionBy("k")).alias("s"))
    assert rows(out) == [(1, 0.1)] * 3 + [(2, 0.3)] * 2


def test_cut_share_of_very_large_and_very_small_quantities(spark):
    line = lambda n, cut, whole: dict(SalesOrderId=n, CUT_QTY_PALLET=cut, AGREED_ORDEREDQTY_PALLET=whole)
    lines = make_lines(spark, line(1, 3e23, 1e24), line(2, 2.9e23, 1e24), line(3, 3e-17, 1e-16), line(4, 2e-17, 1e-16),
                       line(5, 3e299, 1e300)).withColumns({"FlagPriceDisagreement": F.lit(None).cast("int"),
                                                           "AlertPriceDisagreement": F.lit(None).cast("string")})
    assert rows(cut_orders(lines, "2000-12-31", warehouses=[0]), "SalesOrderId") == [(1,), (3,), (5,)]
