"""The typed output reads lines that are written once, and no alert is dealt by order twice (F4 of round 4)."""

import os
import re

import pytest
from pyspark.sql import functions as F

from quayside.plans import binding as b
from quayside.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_kept_lines_are_the_lines(spark):
    kept, lines = b.kept_order_lines(spark, SF, whole=True), b.order_lines(spark, SF)
    assert kept.dtypes == lines.dtypes
    total = [F.count("*"), F.sum(F.xxhash64(*kept.columns).cast("decimal(38,0)"))]
    assert kept.agg(*total).first() == lines.agg(*total).first()


def test_typed_output_deals_the_lines_once(spark):
    assert "customer.parquet" not in plan_of(QUERIES["typed_output"](spark, SF))  # customers are met where the lines are made


@pytest.mark.parametrize("name", ["typed_output", "decisions"])
def test_the_restock_alert_is_dealt_by_order_to_the_tasks_of_the_lines(spark, monkeypatch, name):
    monkeypatch.setattr(b, "ORDER_PARTITION_BYTES", 1 << 16)
    tasks = b.order_tasks(spark, SF)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = re.findall(r"Exchange hashpartitioning\(SalesOrderId#\d+L, (\d+)\)", plan_of(QUERIES[name](spark, SF)))
    assert dealt and set(map(int, dealt)) == {tasks}
