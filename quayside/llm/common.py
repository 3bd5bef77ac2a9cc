"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]+"
#: spans are placed in blocks of this many, so that a text with m matches costs m * BLOCK, not m * m
BLOCK = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not the work before.
    The planner also sees the real size, so Spark itself decides on a broadcast.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def words_of(c: Column) -> Column:
    """The maximal runs of characters other than space and \\x09-\\x0D."""
    return F.filter(F.split(c, SPACE), lambda w: w != "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named: a lambda's argument is bound."""
    return F.transform(F.array(value), use)[0]


SPAN = "struct<start:int,end:int,hit:string,before:string,after:string>"


def place_spans(hits: Column, gaps: Column, context: int = 0) -> Column:
    """Code-point spans of regex matches.

    ``hits`` are a text's matches and ``gaps`` the pieces between them
    (``split`` by the same pattern, one more than the hits), both in order.
    ``context`` characters of the gaps before and after go along.
    """
    n = F.size(hits)
    pairs = F.zip_with(
        hits, F.arrays_zip(F.slice(gaps, 1, n).alias("l"), F.slice(gaps, 2, n).alias("r")),
        lambda h, g: F.struct(
            F.length(g["l"]).alias("gap"), F.length(h).alias("len"), h.alias("hit"),
            (F.right(g["l"], F.lit(context)) if context else F.lit("")).alias("before"),
            (F.left(g["r"], F.lit(context)) if context else F.lit("")).alias("after")))
    cut = F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))
    none = F.expr(f"cast(array() as array<{SPAN}>)")

    def put(acc, x):
        start = acc["pos"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["len"]).alias("end"), x["hit"].alias("hit"),
                        x["before"].alias("before"), x["after"].alias("after"))
        return F.struct((start + x["len"]).alias("pos"), F.concat(acc["xs"], F.array(span)).alias("xs"))

    def first(acc, block):
        total = F.aggregate(block, F.lit(0), lambda s, x: s + x["gap"] + x["len"])
        return F.struct((acc["pos"] + total).alias("pos"), F.concat(acc["xs"], F.array(acc["pos"])).alias("xs"))

    blocks = once(pairs, lambda ps: F.transform(cut, lambda b: F.slice(ps, b * BLOCK + 1, BLOCK)))
    whole = once(blocks, lambda bs: F.flatten(F.zip_with(
        bs, F.aggregate(bs, F.struct(F.lit(0).alias("pos"), F.expr("cast(array() as array<int>)").alias("xs")),
                        first)["xs"],
        lambda block, at: F.aggregate(block, F.struct(at.alias("pos"), none.alias("xs")), put)["xs"])))
    return F.when(n > 0, whole).otherwise(none)


def with_spans(df: DataFrame, text: str, rules: dict[str, str], context: int = 0,
               asked: dict[str, Column] | None = None) -> DataFrame:
    """Add a column ``span_<kind>`` with the placed matches of each pattern.

    The text is searched once by each pattern, and split only if it matched.
    A pattern with a condition in ``asked`` is run on the rows where it holds; elsewhere it has no spans.
    """
    kept, asked = df.columns, asked or {}

    def hits(k: str, p: str) -> Column:
        found = F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0))
        return F.when(asked[k], found) if k in asked else found

    df = df.select("*", *[hits(k, p).alias(f"_hit_{k}") for k, p in rules.items()])
    df = df.select("*", *[F.when(F.size(f"_hit_{k}") > 0, F.split(F.col(text), p, -1)).alias(f"_gap_{k}")
                          for k, p in rules.items()])
    return df.select(*[F.col(c) for c in kept], *[
        place_spans(F.col(f"_hit_{k}"), F.col(f"_gap_{k}"), context).alias(f"span_{k}") for k in rules])


def span_text(kind_spans: Column) -> Column:
    """``kind:start:end`` joined by commas, for spans already in order."""
    return F.concat_ws(",", F.transform(kind_spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
