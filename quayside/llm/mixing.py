r"""Operator 2: mixing sources to target weights.

Temperature mixing: source i with token share p has weight w ~ p ** a.  The
exponent a in [0, 1] is the largest (nearest to the natural mix) whose weights
reach the target entropy, given as a share of the greatest possible, unless the
repetition limit asks for more: no source may be repeated over ``max_epochs`` times.
Both conditions are monotone in a and are bisected, many grid points a pass; a pass
aggregates the source table to one row a grid point, so the table may be large.

The budget of tokens defaults to the least that gives every source one whole
epoch, so no document is lost.  Weights become blocks: each whole epoch of a
source is one block with every document, in an order permuted by a hash of
seed, block and id; the last block takes documents in its own order until the
source's budget is met.  The cut is found by hash buckets: sums by bucket give
the bucket where the budget ends, and only its documents are put in order.

Null texts count as empty.  Documents without words cost nothing: they come once.
A null source is a source.  Repeated rows are documents of their own; ties in
the order are broken by id.  An empty table gives an empty mix.  Very long texts are
words to be counted like any other, row by row.  Extra columns go along, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

ENTROPY, MAX_EPOCHS, SEED = 0.97, 4.0, 17
GRID, PASSES, BUCKET_DOCS = 32, 7, 4096


def n_tokens(text: str = "text") -> Column:
    return F.size(C.words_of(C.whole_text(text))).cast("long")


def source_tokens(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, tokens, docs): one row a source, counted before the shuffle."""
    return C.materialise(docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(n_tokens(text)).alias("tokens"), F.count("*").alias("docs")), "sources")


def _at(shares: DataFrame, points: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent: the entropy of its weights, and the most epochs if every source gets one at least."""
    rows = shares.select("p", F.explode(F.array(*map(F.lit, points))).alias("a"))
    rows = rows.withColumn("x", F.pow("p", "a"))
    got = rows.groupBy("a").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.ln("x")).alias("t"),
                                F.max(F.col("x") / F.col("p")).alias("hi"), F.min(F.col("x") / F.col("p")).alias("lo"))
    return {r["a"]: (math.log(r["s"]) - r["t"] / r["s"], r["hi"] / r["lo"]) for r in got.collect()}


def _bisect(shares: DataFrame, holds) -> float:
    """The border between the exponents for which ``holds(entropy, epochs)`` and the larger ones; 0 if for none."""
    low, high = 0.0, 1.0
    if holds(*_at(shares, [1.0])[1.0]):
        return 1.0
    for _ in range(PASSES):
        points = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        found = _at(shares, points)
        last = max((i for i, a in enumerate(points) if holds(*found[a])), default=0)
        low, high = points[last], points[min(last + 1, GRID)]
    return low


def exponent(sources: DataFrame, entropy: float | None = ENTROPY, max_epochs: float | None = MAX_EPOCHS) -> float:
    """The exponent for ``sources`` (source, tokens); 1 if there is nothing to mix."""
    x = sources.filter("tokens > 0").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if x["n"] < 2:
        return 1.0
    shares = sources.filter("tokens > 0").select((F.col("tokens") / x["t"]).alias("p"))
    a = 1.0
    if entropy is not None:
        a = _bisect(shares, lambda h, _: h >= entropy * math.log(x["n"]) - 1e-12)
    if max_epochs is not None:
        # epochs fall as the exponent rises: the border of "too many"
        a = max(a, 0.0 if _at(shares, [0.0])[0.0][1] <= max_epochs else _bisect(shares, lambda _, e: e > max_epochs))
    return a


def plan(sources: DataFrame, entropy: float | None = ENTROPY, max_epochs: float | None = MAX_EPOCHS,
         budget: int | None = None) -> DataFrame:
    """(source, tokens, docs, weight, epochs): weights of all sources, and how often each is to be read."""
    a = exponent(sources, entropy, max_epochs)
    x = sources.filter("tokens > 0").agg(F.sum("tokens").alias("t"), F.sum(F.pow("tokens", F.lit(a))).alias("s")).first()
    weight = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(a)) / (x["s"] or 1.0)).otherwise(0.0)
    rows = sources.withColumn("weight", weight)
    if budget is None:
        least = rows.filter("tokens > 0").agg(F.max(F.col("tokens") / F.col("weight")).alias("b")).first()["b"]
        budget = least or 0.0
    epochs = F.when(F.col("tokens") > 0, F.round(F.col("weight") * budget / F.col("tokens"), 9)).otherwise(1.0)
    return C.materialise(rows.withColumn("epochs", epochs).withColumn("exponent", F.lit(a)), "mix")


def mix(docs: DataFrame, source: str = "source", text: str = "text", entropy: float | None = ENTROPY,
        max_epochs: float | None = MAX_EPOCHS, budget: int | None = None, seed: int = SEED,
        carry: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (as ``row``, the columns in ``carry`` or all), one for each time a document is read, with
    source, tokens, block, place (its order key in the block), weight and exponent."""
    sources = plan(source_tokens(docs, source, text), entropy, max_epochs, budget)
    part = F.col("epochs") - F.floor("epochs")
    mixed = sources.select(
        F.col("source").alias("_s"), "weight", "exponent", F.floor("epochs").cast("int").alias("whole"),
        F.round(part * F.col("tokens")).cast("long").alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_DOCS)).cast("long").alias("buckets"))
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), F.col("doc_id").alias("_id"), F.col(source).alias("source"),
                       n_tokens(text).alias("tokens"))
    rows = rows.join(mixed, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    place = lambda block: F.xxhash64(F.lit(seed), block, F.col("_id"))
    bucket = F.floor((F.col("place").cast("double") + 2.0 ** 63) / 2.0 ** 64 * F.col("buckets")).cast("long")
    tail = (docs.select(F.col("doc_id").alias("_id"), F.col(source).alias("source"), n_tokens(text).alias("tokens"))
            .join(mixed.filter("rest > 0"), F.col("source").eqNullSafe(F.col("_s"))).filter("tokens > 0")
            .withColumn("place", place(F.col("whole"))).withColumn("bucket", bucket)
            .select("source", "_id", "tokens", "place", "bucket", "rest"))
    tail = C.materialise(tail, "tail")
    sums = tail.groupBy("source", "rest", "bucket").agg(F.sum("tokens").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    cut = (sums.withColumn("before", F.coalesce(before, F.lit(0)))
           .filter("before < rest and before + sum >= rest").select(F.col("source").alias("_c"), "bucket", "before"))
    cut = C.materialise(cut, "cut")  # one bucket a source
    # in the cut bucket documents are taken until the budget is met: the order key of the last one taken
    inside = tail.join(cut, (F.col("source").eqNullSafe(F.col("_c"))) & (tail["bucket"] == cut["bucket"]))
    run = F.sum("tokens").over(Window.partitionBy("source").orderBy("place", "_id").rowsBetween(Window.unboundedPreceding, -1))
    last = (inside.withColumn("run", F.col("before") + F.coalesce(run, F.lit(0))).filter("run < rest")
            .groupBy("source").agg(F.max(F.struct("place", "_id")).alias("last")).select(F.col("source").alias("_l"), "last"))
    last = C.materialise(last, "last")
    rows = rows.join(last, F.col("source").eqNullSafe(F.col("_l")), "left").drop("_l")
    key = F.struct(place(F.col("whole")).alias("place"), F.col("_id").alias("_id"))
    more = (F.col("tokens") > 0) & F.col("last").isNotNull() & (key <= F.col("last"))
    blocks = F.when(F.col("tokens") == 0, 1).otherwise(F.col("whole") + more.cast("int"))
    rows = rows.withColumn("n", blocks).filter("n > 0").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return rows.select("row", "source", "tokens", "block", place(F.col("block")).alias("place"), "weight", "exponent")


def upsample(docs: DataFrame) -> DataFrame:
    """The mix with the columns of ``docs``; documents read more than once are repeated."""
    return mix(docs).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of every document in the mix: id, source, block, order key, tokens, weight and exponent."""
    mixed = mix(C.table(spark, sf_dir, "documents").select("doc_id", "source", "text"), carry=["doc_id"])
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "source", "block", "place", "tokens", "weight", "exponent")
