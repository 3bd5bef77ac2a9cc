r"""Operator 10: near-duplicates by SimHash and covering locality-sensitive hashing.

A document's 64-bit fingerprint has the majority bit of the XXH64 values (seed
42) of its word shingles.  Documents link when their fingerprints differ in at
most ``radius`` bits, and components of links are the groups.

Candidates come from covering masks.  Every bit position i gets a nonzero
vector m(i) of radius + 1 bits, dealt in turn; table v, for each nonzero vector v,
keeps the positions with an odd number of common ones in m(i) and v.  The vectors
of any ``radius`` differing positions leave some v that is orthogonal to them
all, so every pair within the radius collides in that table, which masks those
positions out: no link is missed.

Copies fall together first: only distinct fingerprints are keyed.  In a bucket
of at most ``LIGHT`` fingerprints the pairs are compared.  In a larger one no
pairs are made: two members are within an even radius exactly if they share a
point at half of it or less from both, so each emits its neighbours up to there
(for radius 2 itself and one bit away) among the positions that the table masks
out, and those who meet at a point (29 at most for radius 2, by geometry) are
linked to the least of them; linked or not, their components are the same as
from all pairs.  For an odd radius each also emits its neighbours one bit
further, and all who meet are linked to the least of those who are near, if any
is.  A member's points grow as the masked positions (about 30) to the power of
half the radius, and the tables double with each bit of it: up to 29 points in
each of 7 tables for radius 2, up to 529 in each of 15 for radius 3.

Null and empty texts have fingerprint zero and link like any other.  Rows that
repeat an id get a row each.  Rows without an id have the least id of their
component too, and null if it has none.  A bit set in exactly half the hashes is 0.  Very long
texts are hashed piece by piece.  Extra columns are left out of ``groups`` and go along in
``keep_first``, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .components import components

SHINGLE, RADIUS, SEED, LIGHT = 3, 2, 42, 64
PIECE = 1 << 16  # shingles counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    a, b = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(a), PIECE):
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(a[at:at + PIECE], b[at:at + PIECE])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    major = np.packbits(2 * ones > len(a), bitorder="little")
    return int(major.view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], fp], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """For each table, the bits that it keeps, as a signed 64-bit integer."""
    if radius < 0:
        raise ValueError(f"radius {radius} is negative")
    width = (1 << (radius + 1)) - 1
    dealt = [i % width + 1 for i in range(64)]
    kept = [sum(1 << i for i, m in enumerate(dealt) if (m & v).bit_count() % 2 == 1) for v in range(1, width + 1)]
    return [k - (1 << 64) if k >> 63 else k for k in kept]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, radius: int = RADIUS, light: int = LIGHT) -> DataFrame:
    """(u, v) from rows (fp, node): links whose components are those of all pairs within the radius."""
    kept = masks(radius)
    keyed = distinct.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(kept)])).alias("k"))
    keyed = keyed.select("k.t", "k.key", "fp", "node")
    sizes = keyed.groupBy("t", "key").count().filter("count > 1")
    full = C.materialise(keyed.join(sizes, ["t", "key"]), "buckets")
    few = full.filter(F.col("count") <= light)
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.fp") < F.col("b.fp")) & (_distance(F.col("a.fp"), F.col("b.fp")) <= radius))
    pairs = pairs.select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
    many = full.filter(F.col("count") > light)
    signed = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    flips = F.array(*[F.array(*[F.lit(s).cast("long") for i, s in enumerate(signed) if not m >> i & 1]) for m in kept])
    many = many.select("t", "key", "node", F.explode(_around(F.col("fp"), F.get(flips, F.col("t")), radius)).alias("p"))
    near = F.when(F.col("p.bits") <= radius // 2, F.col("node"))
    met = many.select("t", "key", F.col("p.x").alias("point"), "node", near.alias("near")).groupBy("t", "key", "point").agg(
        F.collect_set("node").alias("nodes"), F.min("near").alias("least")).filter("least is not null and size(nodes) > 1")
    return pairs.union(met.select(F.explode("nodes").alias("u"), F.col("least").alias("v")))


def _around(fp: Column, flips: Column, radius: int) -> Column:
    """Array of (x, bits): ``fp`` with up to half the radius, rounded up, of the bits in ``flips`` turned."""
    def further(one: Column) -> Column:  # each set of bits once: those turned next come after the last
        rest = F.slice(flips, one["next"] + 1, F.size(flips))
        return F.transform(rest, lambda bit, j: F.struct(
            one["x"].bitwiseXOR(bit).alias("x"), (one["next"] + j + 1).alias("next")))

    level = F.array(F.struct(fp.alias("x"), F.lit(0).alias("next")))
    levels = []
    for bits in range((radius + 1) // 2 + 1):
        if bits:
            level = F.flatten(F.transform(level, further))
        n = F.lit(bits).alias("bits")
        levels.append(F.transform(level, lambda one: F.struct(one["x"].alias("x"), n)))
    return F.concat(*levels)


def groups(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    rows = C.materialise(fingerprints(docs, text, shingle), "fingerprints")
    # a fingerprint's node is its least id; one without any id is named by itself, below all ids
    own = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies"))
    order = F.struct(F.col("least").isNull().alias("none"), F.coalesce("least", "fp").alias("id"))
    own = own.select("fp", "least", order.alias("o"), "n_copies")
    nodes = C.materialise(own.select("fp", "least", F.col("o.none").alias("none"), F.col("o.id").alias("id")), "nodes")
    if nodes.filter("none").limit(1).count():  # rows without an id: number the fingerprints instead
        return _groups_by_fp(rows, nodes, radius)
    roots = components(links(nodes.select("fp", F.col("id").alias("node")), radius)).select(
        F.col("u").alias("id"), F.col("v").alias("root"))
    named = nodes.join(roots, "id", "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _groups_by_fp(rows: DataFrame, nodes: DataFrame, radius: int) -> DataFrame:
    """As ``groups``, with the fingerprint itself as node, then the least id of each component."""
    roots = components(links(nodes.select("fp", F.col("fp").alias("node")), radius)).select(
        F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, text: str = "text") -> DataFrame:
    """One document of each group: that with the least id (rows without an id come last), of these the one
    with the least digest of its text, of equal ones the least by all columns.

    Rows that share an id are documents of their own: unrelated ones all stay.
    """
    digest = F.unhex(F.md5(C.whole_text(text).cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t) for t in b["text"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b["id"], b["mark"], fp], ["id", "mark", "fp"])

    given = docs.select(F.col("doc_id").cast("long").alias("id"), digest.alias("mark"), F.col(text).alias("text"))
    rows = C.materialise(given.mapInArrow(run, "id long, mark binary, fp long"), "fingerprints")
    roots = components(links(rows.select("fp", F.col("fp").alias("node")).distinct()))
    placed = rows.join(roots, rows["fp"] == roots["u"], "left").select("id", "mark", F.coalesce("v", "fp").alias("root"))
    counted = placed.groupBy("root", "id", "mark").agg(F.count("*").alias("n"))
    firsts = C.materialise(counted.groupBy("root").agg(F.min(F.struct(
        F.col("id").isNull().alias("none"), "id", "mark", "n")).alias("first")).select("first.id", "first.mark", "first.n"), "firsts")
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("at"), digest.alias("is"))
    same = F.col("at").eqNullSafe(F.col("id")) & (F.col("is") == F.col("mark"))
    single = whole.join(firsts.filter("n = 1"), same, "left_semi").select("row.*")
    several = whole.join(firsts.filter("n > 1"), same, "left_semi").groupBy("at", "is").agg(
        F.min_by("row", F.to_json("row")).alias("row"))
    return single.unionByName(several.select("row.*"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: fingerprint and component of every document."""
    found = groups(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
