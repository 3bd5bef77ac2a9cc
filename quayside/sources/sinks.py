"""Sinks (inventory S9-S11).

Writes go through Spark's committer: a lost executor re-runs its task and
only committed task output becomes visible.  A dataset is replaced only when the
new one is complete and checked (``write_staged``), so a failed rerun leaves the old rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


COMPRESSION = "zstd"  # of all files that are written: about two thirds of what Spark's default takes for wide rows


def write_once(df: DataFrame, name: str) -> DataFrame:
    """A sub-result that several branches read: written to the shared checkpoint folder and read back.

    Its inputs are read once however many branches there are, a lost executor costs
    a re-read, and the planner sees the real size.  Runs a job; columns keep their types.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid4().hex}"
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_once_by(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """As ``write_once``, as a table in ``buckets`` by ``column``: joins and groups by it find the rows in place.

    ``df`` is dealt by ``column`` to as many tasks, so each writes one file.
    """
    spark, table = df.sparkSession, f"{name}_{uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{table}"
    (df.repartition(buckets, column).write.format("parquet").option("compression", COMPRESSION).option("path", path)
     .bucketBy(buckets, column).saveAsTable(table))
    return spark.table(table)


def _files(df: DataFrame, path: str):
    """The file system of ``path`` and a function from names to its paths."""
    spark = df.sparkSession
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


def write_staged(df: DataFrame, path: str, check: Callable[[], None] | None = None) -> None:
    """Replace the dataset at ``path``, which keeps its old rows until the new ones are complete.

    The rows go to a hidden folder beside ``path``; if the write or ``check`` fails, that folder is
    deleted and ``path`` is as it was.  Then the old folder is renamed, the new one takes its
    name, and the old one is deleted.  A driver that dies between the two renames leaves the old rows
    under a hidden name: ``restore``, which every staged write begins with, puts them back.
    A staging folder that a killed driver leaves is never read (its name begins with a dot).
    """
    path = path.rstrip("/")
    restore(df, path)
    fs, to_path = _files(df, path)
    run = uuid4().hex
    staging, previous = _beside(path, "staging") + run, _beside(path, "previous") + run
    try:
        df.write.parquet(staging, compression=COMPRESSION)
        if check is not None:
            check()
    except BaseException:
        fs.delete(to_path(staging), True)
        raise
    if fs.exists(to_path(path)) and not fs.rename(to_path(path), to_path(previous)):
        raise OSError(f"{path} could not be renamed; its new rows are in {staging}")
    if not fs.rename(to_path(staging), to_path(path)):
        fs.rename(to_path(previous), to_path(path))
        raise OSError(f"{staging} could not be renamed; {path} is as it was")
    fs.delete(to_path(previous), True)


def _beside(path: str, what: str) -> str:
    folder, _, name = path.rpartition("/")
    return f"{folder}/.{what}-{name}-" if folder else f".{what}-{name}-"


def restore(df: DataFrame, path: str) -> bool:
    """Put back the rows that an interrupted ``write_staged`` had set aside, if ``path`` is missing; True if it did."""
    fs, to_path = _files(df, path)
    if fs.exists(to_path(path)):
        return False
    left = fs.globStatus(to_path(_beside(path, "previous") + "*")) or []
    if len(left) > 1:
        raise OSError(f"{path} is missing, and {len(left)} earlier versions lie beside it")
    return bool(left) and fs.rename(left[0].getPath(), to_path(path))


def write_overwrite(df: DataFrame, path: str, check: Callable[[], None] | None = None) -> None:
    """Replace the dataset at ``path`` (``write_staged``)."""
    write_staged(df, path, check)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    The original jobs address one ``partition_x=value/`` folder by path; here the
    dataset root is written with ``partitionBy`` and dynamic partition overwrite,
    so other partitions stay untouched.  Spark stages the files and moves them when the
    whole job is committed: a job that fails leaves the old partitions.
    """
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by)
       .parquet(path, compression=COMPRESSION))


def write_partition(df: DataFrame, path: str, column: str, value, check: Callable[[], None] | None = None) -> None:
    """Replace the one partition ``column=value`` of the dataset at ``path`` by the rows of ``df`` (``write_staged``).

    An empty result replaces the partition too, which dynamic overwrite would leave as it was.
    """
    write_staged(df.drop(column), f"{path.rstrip('/')}/{column}={value}", check)


def write_bounded(df: DataFrame, path: str, files: int = 2, shuffle: bool = True, check: Callable[[], None] | None = None) -> None:
    """Write at most ``files`` files (``write_staged``).

    ``coalesce(n)`` would also narrow every stage back to the last shuffle to
    ``n`` tasks (joins included); ``repartition(n)`` adds one exchange but keeps
    the upstream work fully parallel, which is what a large job needs.
    """
    write_staged(df.repartition(files) if shuffle else df.coalesce(files), path, check)
