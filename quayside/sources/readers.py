"""Readers (inventory S1-S9, S12).

All readers return lazy DataFrames; filters applied by callers reach the
Parquet scan as ``PushedFilters`` and unused columns are pruned by Catalyst.
The three dataset flavours of the original jobs are expressed as:

* snapshot  — the latest state of a table: a plain scan;
* change log (delta) — every version of every key; the caller keeps the
  latest version per key with :func:`quayside.operators.latest.latest_per_key`
  and drops deleted keys *after* that step;
* history   — every load kept; same treatment as the change log.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None,
                 where: Column | str | None = None) -> DataFrame:
    """Parquet scan; an optional filter is pushed to the scan by Catalyst."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    return df.where(where) if where is not None else df


def read_format(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
                **options: str) -> DataFrame:
    """Format-named scan (``spark.read.format(fmt).load(path)``)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", report=None) -> DataFrame:
    """S3: CSV with a header and an explicit schema, matched by column **name**.

    Columns are read as text under the names in the header (no inference job),
    then picked by name and converted; a value that does not convert is NULL,
    a column that the header lacks is an error, others are left out.  A ``report``
    (``plans.checks.JobReport``) counts the values that don't convert.
    """
    raw = spark.read.option("header", "true").option("sep", sep).csv(path)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    assert_columns(raw, wanted.names, path)
    values = {f.name: (F.col(f"`{f.name}`"), F.col(f"`{f.name}`").try_cast(f.dataType)) for f in wanted.fields}
    if report is not None:
        raw = report.casts(raw, {f.name: values[f.name] for f in wanted.fields if f.dataType.typeName() != "string"})
    return raw.select(*[cast.alias(name) for name, (_, cast) in values.items()])


def read_snapshot(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Latest state of a dataset."""
    return read_parquet(spark, path, schema)


def read_delta(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Change log — all versions; deduplicate with ``latest_per_key``."""
    return read_parquet(spark, path, schema)


def read_history(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """History — all loads; deduplicate with ``latest_per_key`` if needed."""
    return read_parquet(spark, path, schema)


def read_partition(spark: SparkSession, base_path: str, column: str, value) -> DataFrame:
    """One ``column=value`` partition of a partitioned dataset.

    Reads the dataset root and filters on the partition column, so Spark
    prunes directories (``PartitionFilters``) and keeps the column typed.
    """
    return spark.read.parquet(base_path).where(F.col(column) == F.lit(value))


def inline_relation(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """A small relation given as parameters, e.g. (source, donor) pairs."""
    return spark.createDataFrame(list(rows), ddl)


def assert_columns(df: DataFrame, required: Iterable[str], where: str = "input") -> DataFrame:
    """Check an input contract at the edge (analysis time, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing columns {missing}; have {df.columns}")
    return df


def assert_types(df: DataFrame, types: dict[str, str], where: str = "input") -> DataFrame:
    """Check the types that an input contract names (Q13, Q16; analysis time, no job)."""
    have = dict(assert_columns(df, types, where).dtypes)
    wrong = {c: have[c] for c, t in types.items() if have[c] != t}
    if wrong:
        raise TypeError(f"{where}: {wrong}, expected {({c: types[c] for c in wrong})}")
    return df


def assert_unique(df: DataFrame, keys: Sequence[str], where: str = "lookup") -> DataFrame:
    """Check that ``keys`` name at most one row (Q15): one aggregation, which stops at the first repeat."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{where}: {keys} repeats: {twice[0].asDict()}")
    return df


