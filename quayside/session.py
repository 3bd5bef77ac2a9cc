"""Session helpers.

The library never creates a session inside an operator; callers pass one.
``local_session`` exists for tests and the bench only.  ``apply_job_conf``
sets the session options the jobs rely on (UTC session time zone, AQE with
skew-join splitting) on a session the caller owns.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows dealt by order stay where they are for joins on the order and other columns
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def apply_job_conf(spark: SparkSession) -> SparkSession:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of a bare scan, which is that of its files: no job, and never stale."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def tasks_for(spark: SparkSession, size: int, task_bytes: int) -> int:
    """Tasks for ``size`` bytes.  Never fewer than ``spark.sql.shuffle.partitions``: joins would deal the rows again."""
    return max(-(-size // task_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))


def dealt_by(df: DataFrame, column: str, size: int, task_bytes: int) -> DataFrame:
    """``df`` dealt by ``column`` to a number of tasks that grows with ``size`` (bytes); small ones are left to Spark.

    Spark joins shuffle partitions by their compressed size, which says little of the memory that
    sorting them takes.  Never fewer than ``spark.sql.shuffle.partitions``: joins would deal the rows again.
    """
    least, tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // task_bytes)
    return df.repartition(max(tasks, least), column) if tasks * 16 > least else df


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quayside",
                  driver_memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is; if it
    is unset there, this raises, as executors cannot share the driver's disk.
    In local mode (tests), where driver and executors are one process, a scratch
    folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="quayside-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path
