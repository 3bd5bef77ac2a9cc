"""Connected components as Spark jobs: alternating large-star and small-star rounds.

Each round joins the links with the least neighbour of each node; hot nodes are
pre-aggregated (``min``) and their links meet that minimum in a plain equi-join
that adaptive execution can split.  Every round is written to the shared
checkpoint folder, so a lost executor costs one round at most.  Only two
numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (itself included)."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return (both.join(least, both["u"] == least["k"]).filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k")).filter("v != m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node u that isn't the least of its component, with that least node v.

    ``links`` has two integer columns u and v; loops, repeats and nulls are dropped.
    """
    links = links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = C.materialise(links, "links")
    was = _state(links)
    while was[0]:
        links = C.materialise(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == was:
            break
        was = now
    return links
