"""Whole lines are dealt by order once: lookups by other columns come to them (F1-F9 of round 3)."""

import os
import re

import pytest
from pyspark.sql import functions as F

from quayside.operators import discontinued_alert, keyed_by_order, may_ask_quota, merge_decisions
from quayside.plans import binding as b
from quayside.plans.queries import QUERIES
from quayside.session import dealt_by, planned_bytes
from tests.lines_fixture import make_lines

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def alerts(spark):
    lines = make_lines(
        spark,
        dict(SalesOrderId=1, Material="p", Allocation=True, AllocationAvailable=0.0),
        dict(SalesOrderId=1, Material="p", Allocation=True, AllocationAvailable=0.0),      # the same line twice
        dict(SalesOrderId=1, Material="p", PositionNumber=2, Allocation=True),             # something available
        dict(SalesOrderId=2, Material="p", Customer=None, Allocation=True, AllocationAvailable=0.0),
        dict(SalesOrderId=3, Material=None, Allocation=True, AllocationAvailable=0.0),
        dict(SalesOrderId=4, Material="q", Allocation=None, AllocationAvailable=0.0),
        dict(SalesOrderId=5, Material="q", Allocation=True, AllocationAvailable=None))
    src = lines.columns
    lines = lines.withColumns({"FlagPriceDisagreement": F.lit(None).cast("int"), "AlertPriceDisagreement": F.lit(None).cast("string")})
    stock = spark.createDataFrame([], "SalesOrderId bigint, Material string, PositionNumber int, MarsDc int, Alert string, AlertPriority int")
    later = spark.createDataFrame([], "A_SalesOrderId bigint, A_Material string, A_SoldTo int, Alert string, AlertPriority int")
    quota = spark.createDataFrame([("p", 7, "Q1;", 4), ("p", 7, "Q2;", 4), ("q", 7, "Q3;", 4)],  # one key repeats
                                  "Alert4_Material string, Alert4_Customer bigint, Alert string, AlertPriority int")
    mats = spark.createDataFrame([("p", "P"), ("q", "Q"), ("z", "Z")], "MATERIAL string, Brand string")
    return discontinued_alert(lines), stock, later, quota, mats, src


def test_lookups_keyed_by_order_give_the_same_rows(spark):
    lines, stock, later, quota, mats, src = alerts(spark)
    plain = merge_decisions(lines, stock, later, quota, mats, src)
    by_order = merge_decisions(lines, stock, later, keyed_by_order(
        lines.where(may_ask_quota(lines)), quota, {"Material": "Alert4_Material", "Customer": "Alert4_Customer"}),
        keyed_by_order(lines, mats, {"Material": "MATERIAL"}), src)
    assert by_order.columns == plain.columns
    assert sorted(map(repr, by_order.collect())) == sorted(map(repr, plain.collect()))
    assert plain.count() == 9 and plain.where("Decision = 4").count() == 4


def shuffled_columns(df) -> list[int]:
    """Numbers of columns that the exchanges of a plan move."""
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if p.nodeName() == "Exchange":
            found.append(p.output().size())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return found


@tables
def test_whole_lines_are_never_shuffled(spark):
    # the typed output has 60 columns; the widest exchange is that of the line files' own
    wide = len(b.table(spark, SF, "lineitem").columns)
    assert max(shuffled_columns(QUERIES["typed_output"](spark, SF))) <= wide


@tables
def test_tasks_by_order_grow_with_the_files(spark):
    df = spark.range(10)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = lambda size: df.transform(lambda x: dealt_by(x, "id", size, 1 << 20)).rdd.getNumPartitions()
    assert parts(1000 << 20) == 1000 and parts(6000 << 20) == 6000 and parts(1 << 20) == least
    plan = b.order_lines(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and len(re.findall(r"SortMergeJoin", plan)) == 1


@tables
@pytest.mark.parametrize("name, wide", [("windowed_distinct", 4), ("rank_ties", 2)])
def test_lines_are_dealt_to_tasks_that_grow_with_the_files_and_not_again(spark, monkeypatch, name, wide):
    monkeypatch.setattr(b, "ORDER_PARTITION_BYTES", 1 << 15)
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((.*), (\d+)\), (\w+)", plan)
    tasks = -(-planned_bytes(b.table(spark, SF, "lineitem")) // (1 << 15))
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(dealt) == wide and {(int(n), why) for _, n, why in dealt} == {(tasks, "REPARTITION_BY_NUM")}
