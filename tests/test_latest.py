from pyspark.sql import functions as F

from quayside.operators import latest_per_key
from tests.conftest import rows


def test_one_row_per_key_latest_wins(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 5, "d")], "k int, v int, x string")
    out = latest_per_key(df, ["k"], [F.col("v").desc()])
    assert rows(out, "k", "x") == [(1, "b"), (2, "d")]


def test_tie_break_makes_pick_total(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 5, "c")], "k int, v int, x string")
    out = latest_per_key(df, ["k"], [F.col("v").desc()], tie_break=[F.col("x").asc()])
    assert rows(out, "x") == [("a",)]


def test_nulls_last_in_descending_order(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 1, "one")], "k int, v int, x string")
    assert rows(latest_per_key(df, ["k"], [F.col("v").desc()]), "x") == [("one",)]


def test_deleted_latest_version_vanishes(spark):
    # the filter on deletion applies after deduplication.
    df = spark.createDataFrame([(1, 1, None), (1, 2, "2020-01-01"), (2, 1, None)], "k int, v int, removed string")
    out = latest_per_key(df, ["k"], [F.col("v").desc()], keep=F.col("removed").isNull())
    assert rows(out, "k") == [(2,)]


def test_partial_limit_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
