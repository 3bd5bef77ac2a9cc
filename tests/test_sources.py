"""Readers and sinks (S1-S12): round trips in a scratch folder."""

import datetime as dt
import os
import tempfile

from quayside.operators import broadcast_if_small
from quayside.session import checkpoint_dir
from quayside.sources import (assert_columns, assert_types, assert_unique, inline_relation, read_csv, read_format, read_parquet,
                              read_partition, write_bounded, write_overwrite, write_partitions)
from tests.conftest import rows

import pytest


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="quayside-test-", dir="/tmp")


def test_overwrite_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = os.path.join(scratch, "t")
    write_overwrite(df, path)
    write_overwrite(df.where("k = 1"), path)          # replaces
    assert rows(read_parquet(spark, path)) == [(1, "a")]
    assert rows(read_format(spark, path, "parquet")) == [(1, "a")]


def test_partition_overwrite_keeps_other_partitions(spark, scratch):
    path = os.path.join(scratch, "p")
    df = spark.createDataFrame([("petcare", 1), ("food", 2)], "division string, v int")
    write_partitions(df, path, ["division"])
    write_partitions(spark.createDataFrame([("petcare", 3)], "division string, v int"), path, ["division"])
    assert rows(read_parquet(spark, path), "division", "v") == [("food", 2), ("petcare", 3)]
    part = read_partition(spark, path, "division", "petcare")
    assert rows(part, "v") == [(3,)]
    assert "PartitionFilters: [isnotnull(division" in part._jdf.queryExecution().executedPlan().toString()


def test_bounded_files(spark, scratch):
    path = os.path.join(scratch, "b")
    write_bounded(spark.range(1000).repartition(8), path, files=2)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 2
    assert read_parquet(spark, path).count() == 1000


def test_csv_with_explicit_schema(spark, scratch):
    path = os.path.join(scratch, "transit.csv")
    with open(path, "w") as f:
        f.write("from2,to4,Tech,TransitQIdays\nP1,W1,DRY,3\nP1,W1,WET,x\n")
    df = read_csv(spark, path, "from2 string, to4 string, Tech string, TransitQIdays string")
    assert rows(df) == [("P1", "W1", "DRY", "3"), ("P1", "W1", "WET", "x")]


def test_inline_relation_and_contract(spark):
    pairs = inline_relation(spark, [("W1", "W3"), ("W2", "W1")], "SourcePlant string, DonorPlant string")
    assert pairs.count() == 2
    assert_columns(pairs, ["SourcePlant"])
    with pytest.raises(ValueError):
        assert_columns(pairs, ["Missing"])


def test_filter_reaches_the_scan(spark, scratch):
    path = os.path.join(scratch, "one")
    spark.range(100).write.parquet(path)
    df = read_parquet(spark, path, where="id >= 50")
    assert df.count() == 50
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,50)]" in df._jdf.queryExecution().executedPlan().toString()


def test_csv_columns_go_by_name(spark, scratch):
    path = os.path.join(scratch, "swapped.csv")
    with open(path, "w") as f:
        f.write("to4,note,from2,TransitQIdays\nW1,x,P1,3\nW2,y,P2,dirty\n")
    df = read_csv(spark, path, "from2 string, to4 string, TransitQIdays int")
    assert df.columns == ["from2", "to4", "TransitQIdays"]
    assert rows(df) == [("P1", "W1", 3), ("P2", "W2", None)]
    with pytest.raises(ValueError):
        read_csv(spark, path, "from2 string, missing string")


def test_contract_checks(spark):
    df = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-01-02")], "k int, d string")
    assert assert_types(df, {"k": "int"}) is df
    with pytest.raises(TypeError):
        assert_types(df, {"d": "date"})
    assert assert_unique(df, ["k", "d"]) is df
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])


def test_broadcast_only_within_the_bytes(spark):
    small = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k int, v string")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(small, 10_000))
    assert not hinted(broadcast_if_small(small, 5_000))
    assert not hinted(broadcast_if_small(small, 500))


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf: dict = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
