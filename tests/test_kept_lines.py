"""Lines that several branches read are written once, in buckets by order (F4, F5, F8 of round 3)."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.operators import merge_decisions, whole_order_feasible
from quayside.plans import binding as b
from quayside.plans.queries import QUERIES
from quayside.sources.sinks import write_once_by
from tests.test_by_order import alerts

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_are_read_in_place(spark):
    kept = write_once_by(spark.range(100).selectExpr("id % 10 as k", "id as v"), "t", "k", 8)
    assert sorted(map(tuple, kept.collect())) == [(k, v) for k in range(10) for v in range(k, 100, 10)]
    assert "Exchange" not in plan_of(kept.groupBy("k", "v").count())


def test_alerts_by_hash_give_the_same_rows(spark):
    lines, stock, later, quota, mats, src = alerts(spark)
    plain = merge_decisions(lines, stock, later, quota, mats, src)
    near = merge_decisions(lines, stock, later, quota, mats, src, by_order=True)
    assert sorted(map(repr, near.collect())) == sorted(map(repr, plain.collect())) and "ShuffledHashJoin" in plan_of(near)


def test_division_of_rows_by_order_gives_the_same_rows(spark):
    rows = [(o, m, d, 2.0, 1.0, int(o % 3 > 0 and (d == 1 + o % 2 or (d is None and o % 4 == 0)))) for o in range(30) for m in ("a", "bb", "ccc") for d in (1, 2, None)]
    covered = spark.createDataFrame(rows, "SalesOrderId long, Material string, DonorPlant int, CsOrdered double, CsConfirmed double, AlertForGRD int")
    kept = write_once_by(covered, "c", "SalesOrderId", 8)
    got, want = whole_order_feasible(kept, by_order=True), whole_order_feasible(covered)
    assert got.columns == want.columns and want.count() > 0
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert "Exchange hashpartitioning" not in plan_of(got)


@tables
def test_kept_lines_are_the_lines(spark):
    kept, lines = b.kept_order_lines(spark, SF), b.order_lines(spark, SF)
    lines = lines.select(*kept.columns)
    assert kept.dtypes == lines.dtypes
    total = [F.count("*"), F.sum(F.xxhash64(*kept.columns).cast("decimal(38,0)"))]
    assert kept.agg(*total).first() == lines.agg(*total).first()


@tables
@pytest.mark.parametrize("name", ["decisions", "decisions_with_donor"])
def test_decisions_scan_the_orders_once_for_lines(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "customer.parquet" not in plan  # customers meet the orders only where the lines are made
