"""Theta join by date ranges (J14, C17), windowed distinct counts (L9), ties (L2), shared sub-results (C11-C13), no early jobs."""

import datetime as dt
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.functions.calendar import generate_calendar
from quayside.operators import (count_distinct_over, later_order_pairs, most_frequent, project_demand, quota_in_later_order,
                                split_by_date)
from quayside.operators.joins import SLOT
from quayside.plans import queries
from quayside.sources.sinks import write_once
from tests.lines_fixture import D, make_lines

SF = "/root/testdata/sf0.001"
DAY = dt.timedelta(1)


def two_sides(spark, seed=1, asks=400, holds=600):
    """A hot key with most rows, one date with a third of its holders, NULL keys and dates."""
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.03 else D(2001, 1, 1) + rng.randint(0, 40) * DAY
    key = lambda: rng.choice([(1, "a")] * 12 + [(1, "b"), (2, "a"), (None, "a"), (3, None)])
    left = [(*key(), day(), i) for i in range(asks)]
    right = [(*key(), day() if rng.random() < 0.66 else D(2001, 1, 20), i) for i in range(holds)]
    ddl = "s int, m string, d date, n int"
    return left, right, spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl)


@pytest.mark.parametrize("pairs", [1, 50, 3000, 10 ** 9])
def test_split_join_equals_the_plain_theta_join(spark, pairs):
    left, right, a, b = two_sides(spark)
    want = Counter((x[3], y[3]) for x in left for y in right
                   if None not in (*x, *y) and x[:2] == y[:2] and y[2] > x[2] + 2 * DAY)
    a, b = split_by_date(a, b, ["s", "m"], F.date_add("d", 2), "d", F.col("n"), pairs)
    a, b = a.alias("a"), b.alias("b")
    met = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("s", "m", SLOT)] + [F.col("b.d") > F.date_add("a.d", 2)])
    assert Counter((r[0], r[1]) for r in met.select("a.n", "b.n").collect()) == want and want


def test_split_join_replicates_to_later_slots_only(spark):
    left, right, a, b = two_sides(spark)
    dealt, held = split_by_date(a, b, ["s", "m"], F.col("d"), "d", F.col("n"), 4000)
    slots = {r[0]: r[1] for r in held.where("s = 1 and m = 'a' and d is not null").groupBy(SLOT).agg(F.max("d")).collect()}
    assert len(slots) > 20
    most = max(r["count"] for r in held.where("s = 1 and m = 'a' and d is not null").groupBy(SLOT).count().collect())
    hot = sum(x[:2] == (1, "a") for x in left)
    assert most * hot <= 2 * 4000  # rows of one date are dealt by a hash, so slots differ a little
    for r in dealt.where("s = 1 and m = 'a' and d is not null").collect():
        assert slots[r[SLOT]] > r["d"]


def hot_lines(spark, n=240):
    """One (sold-to, material) with every line: a third asks, the rest holds."""
    return make_lines(spark, *[
        dict(SalesOrderId=i, SoldTo=5, Material="m", Allocation=True if i % 3 == 0 else None, CsConfirmed=0.0 if i % 3 == 0 else 2.0,
             OrderCreationDate=D(2000, 12, 1) + (i % 7) * DAY, FactPlanBillingDate=D(2001, 1, 10) + (i % 50) * DAY) for i in range(n)])


def test_a_hot_key_of_the_later_order_alert_runs_in_several_tasks(spark):
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = lambda pairs: (later_order_pairs(hot_lines(spark), "2000-12-31", pairs=pairs)
                               .groupBy(F.spark_partition_id()).count().collect())
        whole, split = tasks(10 ** 9), tasks(500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(whole) == 1 and len(split) >= 6  # of the 8 partitions
    assert sum(r["count"] for r in whole) == sum(r["count"] for r in split) > 3000


@pytest.mark.parametrize("pairs", [3, 200])
def test_later_order_texts_do_not_depend_on_the_split(spark, pairs):
    lines = hot_lines(spark, 90).union(make_lines(spark, dict(SalesOrderId=900, SoldTo=6)))
    texts = lambda **k: {r["A_SalesOrderId"]: r["Alert"] for r in quota_in_later_order(lines, "2000-12-31", **k).collect()}
    assert texts(pairs=pairs) == texts() and len(texts()) > 20


def test_windowed_distinct_like_the_plain_version(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, "a", "b", "c"]), i) for i in range(200)] + [(9, None, 200)]
    df = spark.createDataFrame(data, "k int, v string, i int")
    of = defaultdict(list)
    for k, v, _ in data:
        of[k].append(v)
    want = sorted((i, len(set(of[k]) - {None}), sum(v is not None for v in of[k])) for k, _, i in data)
    out = count_distinct_over(df, ["k"], "v", "kinds", "n")
    assert sorted((r.i, r.kinds, r.n) for r in out.collect()) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_" not in plan  # no window over the key's rows, no set in a row


def test_windowed_distinct_without_null_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 3), (2, None, 4)], "k int, v string, i int")
    out = count_distinct_over(df, ["k"], "v", "kinds", "n", null_keys=False)
    assert sorted((r.i, r.kinds, r.n) for r in out.collect()) == [(1, 1, 2), (2, 1, 2), (3, 1, 2), (4, 0, 0)]
    null = df.union(spark.createDataFrame([(None, "a", 5)], df.schema))
    with pytest.raises(Exception, match="key of count_distinct_over is NULL"):
        count_distinct_over(null, ["k"], "v", "kinds", null_keys=False).collect()


def test_most_frequent_keeps_ties(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "b"), (1, "c"), (2, None)], "k int, v string")
    assert sorted(tuple(r) for r in most_frequent(df, ["k"], ["v"], "n").collect()) == [(1, "a", 2), (1, "b", 2), (2, None, 1)]


def test_write_once_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None, D(2001, 1, 1)), (None, 2.5, None)], "a int, b double, c date")
    back = write_once(df, "kept")
    assert back.dtypes == df.dtypes and sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert "Scan parquet" in back._jdf.queryExecution().executedPlan().toString()


STOCK_DDL = "WAREHOUSE int, MATERIAL_CODE string, DAY date, TMS double, FREE_STOCK double"
FC_DDL = "PLANT int, MATERIAL_CODE string, MARS_WEEK string, F_STARTDATE date, F_ENDDATE date, FORECAST_CASES double"


def demand(spark, pairs=None, years=1, **kw):
    cal = generate_calendar(spark.createDataFrame([(D(2000, 1, 1), D(2000 + years, 12, 31))], "start date, end date"))
    stock = spark.createDataFrame([(w, m, D(2000, 6, 1), 1.0, 10.0) for w in (0, 1) for m in "abc"], STOCK_DDL)
    fc = spark.createDataFrame([(w, m, "2000P06W1", D(2000, 1, 1), D(2001, 1, 1), 7.0) for w in (0, 1) for m in "abc"], FC_DDL)
    return project_demand(stock, fc, cal, pairs=pairs, **kw)


def test_demand_of_asked_pairs_is_that_part_of_the_whole(spark):
    pairs = spark.createDataFrame([(0, "a"), (1, "c"), (7, "a")], "WAREHOUSE int, MATERIAL_CODE string")
    whole = {(r.WAREHOUSE, r.MATERIAL_CODE): r for r in demand(spark).collect()}
    part = {(r.WAREHOUSE, r.MATERIAL_CODE): r for r in demand(spark, pairs).collect()}
    assert len(whole) == 6 and part == {k: whole[k] for k in ((0, "a"), (1, "c"))}


def test_calendar_longer_than_said_fails_and_none_shuffles(spark):
    with pytest.raises(Exception, match="spans over 300 days"):
        demand(spark, calendar_days=300).collect()
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(demand(spark)) and not hinted(demand(spark, calendar_days=None)) and not hinted(demand(spark, calendar_days=10 ** 7))
    assert sorted(demand(spark).collect(), key=repr) == sorted(demand(spark, calendar_days=None).collect(), key=repr)


tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@tables
def test_demand_runs_no_job_before_the_action(spark):
    br = queries.branches(spark, SF)
    assert br.inp.stock and br.inp.forecast and br.inp.calendar  # reading the files' footers takes jobs
    context = spark.sparkContext
    context.setJobGroup("early", "plan only")
    try:
        br.demand()._jdf.queryExecution().executedPlan()
    finally:
        jobs = context.statusTracker().getJobIdsForGroup("early")
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


@tables
def test_donor_chain_projects_only_asked_pairs(spark):
    br = queries.branches(spark, SF)
    whole = br.demand().count()
    asked = br.asked().where("DonorPlant is not null").select("DonorPlant", "Material").distinct()
    part = br._project(asked.select(F.col("DonorPlant").alias("WAREHOUSE"), F.col("Material").alias("MATERIAL_CODE")))
    assert 0 < part.count() <= asked.count() and part.count() < whole


@tables
def test_scans_and_shuffles_of_the_donor_chain(spark):
    from tools.executed_scans import executed

    for name in ("feasible_orders", "best_donor"):
        n = executed(lambda q=name: queries.QUERIES[q](spark, SF))
        assert n["scan lineitem"] <= 6 and n["shuffles"] <= 19 and n["written"] == 2


@tables
def test_change_logs_are_windowed_once(spark):
    from tools.executed_scans import executed

    n = executed(lambda: queries.QUERIES["shipped_materials"](spark, SF))
    assert n["scan events"] <= 2 and n["written"] == 1  # one scan for each of the two logs
