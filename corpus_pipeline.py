"""A training-data pipeline: each stage is one operator of ``quayside.llm`` over all that the one before kept.

Stages but the last return the columns of ``documents``.  The first two leave
documents out, the third rewrites texts, the fourth repeats documents of
sources that are to weigh more, and the last encodes what there is.

All stages take null texts as empty, and rows with nulls in any column; repeated rows are rows of their
own, but near-dedup keeps one of a group.  Texts of any length are whole in the memory of their row or task.  Extra columns go
along through the first four stages, whatever their names.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, common, host_rules, mixing, secret_scan, simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that fail the base rules, or on a bad host a soft rule."""
    return host_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: that with the least id, ties by digest of the text, then all columns.

    Shingle length and bit distance are those of the operator's contract (3 words, 2 bits).
    """
    return simhash.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark."""
    return secret_scan.redact(docs, common.scratch(spark, "ledger"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that the sources meet their weights; every document stays at least once."""
    return mixing.upsample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document: id, number, and digests of ids and decoded text."""
    return bpe.round_trip(docs)


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_duplicates), ("secret scans", secrets),
          ("mixing sources", mix), ("BPE encoding", encode)]
#: SQL can't express fingerprints, components and byte-pair merges; a plain version is in tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.materialise(docs, "stage")
    return docs
