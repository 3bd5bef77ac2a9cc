"""End-to-end jobs with their writes; properties across operators."""

import os
import tempfile

from pyspark.sql import functions as F

from quayside import operators as op
from quayside.plans import binding as b
from quayside.plans import params as P
from quayside.plans.jobs import material_dimension_job, run_material_dimension, run_open_order_decisions
from quayside.plans.queries import branches, dimension_inputs, open_order_inputs, open_order_params

SF = "/root/testdata/sf0.001"


def test_decision_job_writes_one_row_per_line_with_checkpoint(spark):
    out = tempfile.mkdtemp(prefix="quayside-job-", dir="/tmp")
    inp = open_order_inputs(spark, SF)
    run_open_order_decisions(inp, open_order_params(), os.path.join(out, "main_page"), checkpoint=True)
    res = spark.read.parquet(os.path.join(out, "main_page"))
    assert len(res.columns) == 60
    assert res.count() == inp.lines.count()                      # C19 keeps the line count
    assert res.where(~F.col("Decision").isin(0, 1, 2, 3, 4, 5)).count() == 0


def test_material_dimension_job_bounded_files(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quayside-dim-", dir="/tmp"), "d_material")
    run_material_dimension(dimension_inputs(spark, SF), out, files=2, prefixes=P.SITE_PREFIXES,
                           created_from=P.CREATED_FROM, issued_from=P.ISSUED_FROM)
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) <= 2
    res = spark.read.parquet(out)
    assert "_Update_DTTM" in res.columns
    assert res.count() == res.select("Material_Code__PK").distinct().count()


def test_feasible_orders_are_cut_orders(spark):
    br = branches(spark, SF)
    feas = br.feasible().select("SalesOrderId").distinct()
    cut = br.targets().select("SalesOrderId").distinct()
    assert feas.join(cut, "SalesOrderId", "left_anti").count() == 0


def test_latest_is_one_row_per_key(spark):
    e = b.table(spark, SF, "events")
    latest = op.latest_per_key(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    assert latest.count() == e.select("user_id").distinct().count()


def test_validity_intervals_chain(spark):
    o = b.table(spark, SF, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    v = op.validity_interval(o, ["o_custkey"], "d", tie_break=["o_orderkey"]).collect()
    by_key = {}
    for r in v:
        by_key.setdefault(r["o_custkey"], []).append(r)
    for rs in by_key.values():
        rs.sort(key=lambda r: (r["d"], r["o_orderkey"]))
        assert str(rs[0]["StartDate"]) == "2000-01-01" and str(rs[-1]["EndDate"]) == "9999-12-31"
        for a, c in zip(rs, rs[1:]):
            assert c["StartDate"] == c["d"]
            assert (c["d"] - a["EndDate"]).days == 1              # next version starts the day after


def test_horizon_covers_57_days(spark):
    cal = op.fiscal_labels(b.calendar(spark, SF)).select("OriginalDate", "MARS_WEEK_FOR_DEMAND")
    hw = op.temporal.horizon_weeks(cal, 56)
    lo, hi = cal.agg(F.min("OriginalDate"), F.max("OriginalDate")).collect()[0]
    full = hw.where((F.col("DAY") >= F.lit(lo)) & (F.date_add("DAY", 56) <= F.lit(hi)))
    per_day = full.groupBy("DAY").agg(F.sum("__days").alias("n")).select("n").distinct().collect()
    assert [r["n"] for r in per_day] == [57]


def test_files_of_the_dimension_grow_with_the_inputs(spark, monkeypatch):
    from quayside.plans import jobs, queries
    sf = "/root/testdata/sf0.01"
    few = queries.QUERIES["dimension_from_files"](spark, sf)
    monkeypatch.setattr(queries, "files_for", lambda s, paths: min(jobs.files_for(s, paths, 1 << 12), 8))
    many = queries.QUERIES["dimension_from_files"](spark, sf)
    assert len(few.inputFiles()) == 1 and len(many.inputFiles()) > 2
    assert few.count() == many.count() > 8


def test_dimension_files_are_not_bounded_by_default():
    from inspect import signature

    from quayside.plans import jobs
    assert all(signature(f).parameters["files"].default is None
               for f in (jobs.run_material_dimension, jobs.material_dimension_job_from))
