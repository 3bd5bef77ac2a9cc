"""Staged writes (S10, S11), one partition of a run (S9), checks in the job's own pass."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quayside.operators import merge_decisions, typed_output
from quayside.plans import params as P
from quayside.plans.checks import JobReport
from quayside.plans.jobs import DimensionPaths, material_dimension_job_from, run_material_dimension
from quayside.plans.queries import _files, _open_order_files, dimension_inputs, open_order_params
from quayside.plans.jobs import open_order_job
from quayside.sources import (read_csv, read_parquet, read_partition, restore, write_bounded, write_overwrite, write_partition,
                              write_partitions, write_staged)
from tests.conftest import rows

SF, WITH_SITES = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quayside-test-", dir="/tmp")


def failing(spark):
    """Rows of which the last task fails after the others have written theirs."""
    return spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("killed midway"))).cast(
        "long").alias("id"))


@pytest.mark.parametrize("write", [write_overwrite, lambda df, p: write_bounded(df, p, 2), lambda df, p: write_bounded(df, p, 2, shuffle=False)])
def test_a_write_that_fails_midway_leaves_the_old_rows(spark, scratch, write):
    path = os.path.join(scratch, "t")
    write(spark.range(5).toDF("id"), path)
    with pytest.raises(Exception, match="killed midway"):
        write(failing(spark), path)
    assert rows(read_parquet(spark, path)) == [(i,) for i in range(5)]
    assert os.listdir(scratch) == ["t"]  # nothing is left beside it
    write(spark.range(7).toDF("id"), path)
    assert read_parquet(spark, path).count() == 7 and os.listdir(scratch) == ["t"]


def test_a_partition_write_that_fails_leaves_the_old_partitions(spark, scratch):
    path = os.path.join(scratch, "p")
    write_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "g string, id long"), path, ["g"])
    with pytest.raises(Exception, match="killed midway"):
        write_partitions(failing(spark).withColumn("g", F.lit("a")), path, ["g"])
    with pytest.raises(Exception, match="killed midway"):
        write_partition(failing(spark), path, "g", "a")
    assert rows(read_parquet(spark, path), "g", "id") == [("a", 1), ("b", 2)]


def test_a_check_that_fails_leaves_the_old_rows(spark, scratch):
    path = os.path.join(scratch, "t")
    write_staged(spark.range(3).toDF("id"), path)

    def check():
        raise ValueError("not these")

    with pytest.raises(ValueError, match="not these"):
        write_staged(spark.range(9).toDF("id"), path, check)
    assert read_parquet(spark, path).count() == 3 and os.listdir(scratch) == ["t"]


def test_rows_set_aside_by_a_killed_driver_come_back(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.range(3).toDF("id")
    write_overwrite(df, path)
    os.rename(path, os.path.join(scratch, ".previous-t-0123"))  # as between the two renames
    assert restore(df, path) and read_parquet(spark, path).count() == 3
    assert not restore(df, path)
    os.rename(path, os.path.join(scratch, ".previous-t-0123"))
    write_overwrite(spark.range(4).toDF("id"), path)
    assert read_parquet(spark, path).count() == 4 and os.listdir(scratch) == ["t"]


def test_one_partition_is_replaced_even_by_no_rows(spark, scratch):
    path = os.path.join(scratch, "p")
    write_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "g string, id long"), path, ["g"])
    write_partition(spark.createDataFrame([("a", 3), ("a", 4)], "g string, id long"), path, "g", "a")
    assert rows(read_parquet(spark, path), "g", "id") == [("a", 3), ("a", 4), ("b", 2)]
    write_partition(spark.range(0).toDF("id"), path, "g", "a")
    assert rows(read_parquet(spark, path), "g", "id") == [("b", 2)]


@tables
def test_a_run_reads_and_replaces_its_partition_only(spark):
    column, value = P.PARTITION
    paths, root = _open_order_files(spark, SF, column)
    target = f"{root}/result"
    write_partitions(spark.createDataFrame([("odd", "as it was"), (value, "old")], f"{column} string, CurrentStatus string"), target, [column])
    out = open_order_job(spark, paths, open_order_params(), P.DONOR_PAIRS, target, warehouse_type="int", partition=P.PARTITION)
    other = spark.read.parquet(f"{target}/{column}=odd")
    assert [r.CurrentStatus for r in other.collect()] == ["as it was"]
    assert out.count() == spark.read.parquet(paths.lines).count()
    scan = read_partition(spark, paths.quotas, *P.PARTITION)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({column}" in plan
    assert 0 < scan.count() < spark.read.parquet(paths.quotas).count()


# -- checks in the job's own pass -----------------------------------------------------

def dimension_files(spark, **changed):
    """Files of the dimension's inputs; the smallest tables have no active site that shipped."""
    inp = dimension_inputs(spark, WITH_SITES)
    paths = _files(spark, "dimension", {n: changed.get(n, getattr(inp, n)) for n in DimensionPaths.__dataclass_fields__})
    root = paths.pop("root")
    return DimensionPaths(**paths), f"{root}/result"


KW = dict(prefixes=P.SITE_PREFIXES, created_from=P.CREATED_FROM, issued_from=P.ISSUED_FROM)


@tables
def test_counts_come_with_the_write(spark):
    paths, target = dimension_files(spark)
    inp = dimension_inputs(spark, WITH_SITES)
    report = run_material_dimension(inp, target, **KW)
    n = spark.read.parquet(target).count()
    assert n > 0 and set(report.rows.values()) == {n} and report.dirty == {"Material_PC2Case": 0, "Material_ShowBox__UOM": 0}


@tables
def test_values_that_do_not_convert_are_counted(spark):
    inp = dimension_inputs(spark, WITH_SITES)
    inp.units = inp.units.withColumn("UMREN", F.when(F.col("MEINH") == "ST", F.lit("dirty")).otherwise(F.col("UMREN")))
    target = f"{tempfile.mkdtemp(prefix='quayside-test-', dir='/tmp')}/d"
    report = run_material_dimension(inp, target, **KW)
    out = spark.read.parquet(target)
    assert report.dirty["Material_PC2Case"] > 0 and out.where("Material_PC2Case is not null").count() == 0
    assert report.dirty["Material_ShowBox__UOM"] == 0


@tables
def test_a_repeated_lookup_key_raises_before_the_swap(spark):
    inp = dimension_inputs(spark, WITH_SITES)
    twice = inp.brand_text.union(inp.brand_text.limit(1))
    good, target = dimension_files(spark)
    was = material_dimension_job_from(spark, good, target, **KW).count()
    bad, _ = dimension_files(spark, brand_text=twice)
    with pytest.raises(ValueError, match="brand_text.*repeats"):
        material_dimension_job_from(spark, bad, target, **KW)
    assert spark.read.parquet(target).count() == was


@tables
def test_a_repeat_that_multiplies_nothing_passes(spark):
    inp = dimension_inputs(spark, WITH_SITES)
    unused = spark.createDataFrame([("nobody", "x"), ("nobody", "y")], "CHRCOD_PK string, VTEXT string")
    paths, target = dimension_files(spark, brand_text=inp.brand_text.union(unused))
    assert material_dimension_job_from(spark, paths, target, **KW).count() > 0


@tables
def test_no_job_checks_uniqueness_before_the_write(spark, monkeypatch):
    from quayside.plans import checks, jobs

    asked = []
    for module in (checks, jobs):
        monkeypatch.setattr(module, "assert_unique", lambda df, keys, where="": asked.append(where))
    paths, target = dimension_files(spark)
    material_dimension_job_from(spark, paths, target, **KW)
    assert asked == []


def test_a_repeated_alert_raises(spark):
    from tests.lines_fixture import make_lines

    lines = make_lines(spark, dict(SalesOrderId=1, Material="p"))
    src = lines.columns
    lines = lines.withColumns({"FlagPriceDisagreement": F.lit(None).cast("int"), "AlertPriceDisagreement": F.lit(""),
                               "DiscontinueAlertPriority": F.lit(None).cast("int"), "DiscontinueAlert": F.lit("")})
    stock = spark.createDataFrame([(1, "p", 1, 0, "S", 5)] * 2, "SalesOrderId bigint, Material string, PositionNumber int, MarsDc int, "
                                  "Alert string, AlertPriority int")
    later = spark.createDataFrame([], "A_SalesOrderId bigint, A_Material string, A_SoldTo int, Alert string, AlertPriority int")
    quota = spark.createDataFrame([], "Alert4_Material string, Alert4_Customer bigint, Alert string, AlertPriority int")
    mats = spark.createDataFrame([("p", "B")], "MATERIAL string, Brand string")
    report = JobReport()
    merge_decisions(lines, stock, later, quota, mats, src, report=report).collect()
    with pytest.raises(ValueError, match="restock alert"):
        report.verify()
    assert report.rows["lines"] == 1 and report.rows["restock alert"] == 2


def test_csv_and_output_count_dirty_values(spark, scratch):
    path = os.path.join(scratch, "x.csv")
    with open(path, "w") as f:
        f.write("a,b,c\n1,x,2020-01-01\nno,y,never\n,z,\n")
    report = JobReport()
    contract = [("a", "int", None), ("b", "string", 5), ("c", "date", None)]
    df = read_csv(spark, path, "a int, b string, c date", report=report)
    typed_output(df.withColumn("c", F.lit("2020-13-01")), contract, report=report).collect()
    report.verify()
    assert report.dirty == {"a": 1, "c": 1 + 3}


@tables
def test_audit_column_is_one_timestamp_a_run(spark):
    paths, target = dimension_files(spark)
    out = material_dimension_job_from(spark, paths, target, **KW)
    assert dict(out.dtypes)["_Update_DTTM"] == "timestamp"
    assert out.select("_Update_DTTM").distinct().count() == 1 and out.where("_Update_DTTM is null").count() == 0
