"""The job from files reads the whole lines for the merge alone; its alerts read columns that are written once (F2, F3 of round 4)."""

import functools
import os

import pytest
from pyspark.sql import functions as F

from quayside.plans import jobs, queries
from quayside.plans import params as P

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("partition", [None, P.PARTITION])
def test_the_merge_alone_reads_whole_lines(spark, monkeypatch, partition):
    paths, root = queries._open_order_files(spark, SF, partition and partition[0])
    merged, typed = [], jobs.op.typed_output
    monkeypatch.setattr(jobs.op, "typed_output", lambda df, **kw: merged.append(df) or typed(df, **kw))
    monkeypatch.setattr(jobs, "run_open_order_decisions", functools.partial(jobs.run_open_order_decisions, checkpoint=True))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # whole paths in plans
    try:
        got = jobs.open_order_job(spark, paths, queries.open_order_params(), P.DONOR_PAIRS, f"{root}/result", warehouse_type="int",
                                  partition=partition)
        plan = merged[0]._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"[file:{paths.lines}]") == 1
        lines = spark.read.parquet(paths.lines)
        inp = jobs.read_open_order_inputs(spark, paths, P.DONOR_PAIRS, "int", partition)
        plain = jobs.open_order_decisions(inp, queries.open_order_params())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert got.count() == lines.count()
    total = F.sum(F.xxhash64(*plain.columns).cast("decimal(38,0)"))
    assert got.select(*plain.columns).agg(total).first() == plain.agg(total).first()
    assert all(".zstd." in f for f in os.listdir(paths.lines) if f.startswith("part-"))
