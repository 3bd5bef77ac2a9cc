r"""Operator 7: exact top-k search by inner product over a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance from it; each
pivot's vectors are cut into annuli of similar distance.  For a query q and an
annulus around pivot p with distances in [lo, hi] and norms up to m, the
triangle inequality bounds every inner product q.x:

    |q - x| >= max(|q - p| - hi, lo - |q - p|, 0)   so   q.x <= (|q|^2 + m^2 - |q - x|^2) / 2
    q.x = q.p + q.(x - p)                           so   q.x <= q.p + |q| * hi
    q.x <= |q| * m

The origin is a second pivot: |x| and |x - p| fix how far x - p goes along the line through the origin and p, and how far
it is off that line, so with a the part of q along the line

    q.x = q.p + a * along + (rest of q).(rest of x - p)   so   q.x <= q.p + max(a * along) + |rest of q| * off

A query first searches its own pivot's vectors, which gives it a k-th best score, and then the pivots of which some
annulus has a bound that reaches that score: one request, with one copy of its vector, a pivot.  A pivot's vectors
lie in order of distance in blocks with their own bounds; blocks are visited from the
best bound down, and the search stops where no bound reaches the k-th best.

Pivots are fitted on a bounded sample (``SAMPLE`` rows with the least hash of
their id), and annulus borders on quantiles of it; every row is indexed.  There is a pivot for each ``PIVOTS`` times the
square root of the rows, from ``PIVOTS`` to ``MOST_PIVOTS`` of them, so the
statistics sent to tasks have ``MOST_PIVOTS * RINGS`` rows at most for each vector
length.  Pivots with many rows are split by a hash of the id, so a task holds at
most about ``PART_ROWS`` vectors; queries are streamed past them.

Components become floor(256 * x) first.  Vectors that are null or hold a null or
non-finite component take no part.  Vectors of different lengths don't meet;
empty ones score 0 with each other.
A repeated candidate row is a candidate each time; a query id that repeats asks
once, with its least vector.  Rows with the query's own id are never its results.
Extra columns are left out, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

K, EVERY, SCALE = 5, 50, 256
PIVOTS, MOST_PIVOTS, RINGS, SAMPLE, PART_ROWS, BLOCK_ROWS = 16, 256, 8, 4096, 65536, 512
FOUND = "query_id long, vec_id long, score long"


def whole_numbers(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, v): valid vectors, components as floor(scale * x)."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.filter(x.isNotNull() & ~bad & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size(v).alias("dim"), v.alias("v"))


def fit(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each vector length: pivots, and each pivot's inner annulus borders, from a bounded sample."""
    most = min(MOST_PIVOTS, max(PIVOTS, isqrt(rows.count()) // PIVOTS))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).collect()
    found = {}
    for dim in {r["dim"] for r in sample}:
        v = [r["v"] for r in sample if r["dim"] == dim]
        x = np.unique(np.array(v, np.float64).reshape(len(v), dim), axis=0)
        chosen, far = [0], np.linalg.norm(x - x[0], axis=1)
        while len(chosen) < min(most, len(x)):  # the farthest from those chosen
            chosen.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(x - x[chosen[-1]], axis=1))
        p = x[chosen]
        for _ in range(8):
            near = distances(x, p).argmin(1)
            p = np.array([x[near == i].mean(0) if (near == i).any() else p[i] for i in range(len(p))])
        d = distances(x, p)
        near, least = d.argmin(1), d.min(1)
        cuts = np.linspace(0, 1, RINGS + 1)[1:-1]
        found[dim] = (p, np.array([np.quantile(least[near == i], cuts) if (near == i).any() else np.zeros(RINGS - 1)
                                   for i in range(len(p))]))
    return found


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * x @ p.T, 0))


def place(rows: DataFrame, model: dict) -> DataFrame:
    """``rows`` with nearest pivot, distance from it, annulus and norm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, pivot, ring = b["dim"].to_numpy(), np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int32)
            dist, norm, low, high, off = np.zeros((5, b.num_rows))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = matrix(b["v"], at, dim).astype(np.float64)
                norm[at] = np.linalg.norm(x, axis=1)
                if dim in model:  # a length that the sample lacks has one annulus of all its vectors
                    p, cuts = model[dim]
                    d = distances(x, p)
                    pivot[at], dist[at] = d.argmin(1), d.min(1)
                    ring[at] = (dist[at][:, None] > cuts[pivot[at]]).sum(1)
                    far = np.linalg.norm(p, axis=1)[pivot[at]]
                else:
                    dist[at], far = norm[at], np.zeros(len(at))
                low[at], high[at], off[at] = line(dist[at], norm[at], far)
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["dim"], b["v"], *map(pa.array, (pivot, ring, dist, norm, low, high, off))],
                ["vec_id", "dim", "v", "pivot", "ring", "dist", "norm", "low", "high", "off"])

    return rows.mapInArrow(run, "vec_id long, dim int, v array<long>, pivot int, ring int, dist double, norm double, "
                                "low double, high double, off double")


def matrix(v: pa.ListArray, at: np.ndarray, dim: int) -> np.ndarray:
    """The vectors at places ``at``, all of length ``dim``, as rows."""
    sizes = v.value_lengths().to_numpy()
    return v.flatten().to_numpy()[(np.cumsum(sizes) - sizes)[at][:, None] + np.arange(dim)]


def line(dist: np.ndarray, norm: np.ndarray, far: np.ndarray | float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How far x - p goes along the line through the origin and p (least, greatest), and off it (at most).

    From |x - p|, |x| and |p|; where p is so near the origin that rounding would tell, only |x - p| is used.
    """
    sure = far > 1e-3 * norm
    along = np.clip((norm ** 2 - far ** 2 - dist ** 2) / np.where(sure, 2 * far, 1), -dist, dist)
    off = np.sqrt(np.maximum(dist ** 2 - along ** 2, 0) + 1e-12 * norm ** 2)  # raised by more than rounding takes
    return np.where(sure, along, -dist), np.where(sure, along, dist), np.where(sure, off, dist)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """For each row of ``scores``, places of the k highest, ties to the smaller id; in that order."""
    if scores.shape[1] > 4 * k:
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        keep = (scores >= kth[:, None]).any(0)
        cols = np.flatnonzero(keep)
    else:
        cols = np.arange(scores.shape[1])
    order = [np.lexsort((ids[cols], -row)) for row in scores[:, cols]]
    return np.array([cols[o[:k]] for o in order], np.int64).reshape(len(scores), -1)


NONE = -(1 << 62)  # below every score; its negative is still an integer of 64 bits


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point where every sum fits, else in integers."""
    if q.shape[1] * max(1.0, float(np.abs(q).max(initial=0))) * max(1.0, float(np.abs(x).max(initial=0))) < 2.0 ** 52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def bounds(q: np.ndarray, p: np.ndarray, lo, hi, m, low, high, off) -> np.ndarray:
    """Upper bounds of q.x for (queries, annuli); p has each annulus' pivot, or one for all.  Slightly raised."""
    qn = np.linalg.norm(q, axis=1)[:, None]
    qp, qd, far = q @ p.T, distances(q, p), np.linalg.norm(p, axis=1)
    gap = np.maximum(np.maximum(qd - hi, lo - qd), 0)
    a = qp / np.where(far > 0, far, 1)
    rest = np.sqrt(np.maximum(qn * qn - a * a, 0) + 1e-12 * qn * qn)
    b = np.minimum(np.minimum((qn * qn + m * m - gap * gap) / 2, qp + qn * hi), qn * m)
    b = np.minimum(b, qp + np.maximum(a * low, a * high) + rest * off)
    return b + 4e-6 * (np.abs(b) + qn * m) + 1


def search(ids: np.ndarray, x: np.ndarray, dist: np.ndarray, norm: np.ndarray, pivot: np.ndarray,
           qids: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best of the pivot's part (ids, x, ...), in order of distance, for each query, leaving out scores under ``kth``."""
    starts = np.arange(0, len(ids), BLOCK_ROWS)
    low, high, off = line(dist, norm, np.linalg.norm(pivot))
    reach = bounds(q.astype(np.float64), pivot[None], *(f.reduceat(a, starts) for f, a in (
        (np.minimum, dist), (np.maximum, dist), (np.maximum, norm), (np.minimum, low), (np.maximum, high), (np.maximum, off))))
    top_s, top_i = np.full((len(q), k), NONE), np.full((len(q), k), np.iinfo(np.int64).max)
    kth = kth.copy()
    for j in np.argsort(-reach.max(0), kind="stable"):
        live = np.flatnonzero(reach[:, j] >= kth)
        if not len(live):
            if (reach.max(0)[j] < kth).all():
                break
            continue
        i = j * BLOCK_ROWS
        bid = ids[i:i + BLOCK_ROWS]
        s = products(q[live], x[i:i + BLOCK_ROWS])
        s[bid[None] == qids[live][:, None]] = NONE
        new = np.flatnonzero((s >= kth[live][:, None]).any(1))  # the others keep what they have
        if not len(new):
            continue
        live, s = live[new], s[new]
        cols = best_of(s, bid, k)
        s2 = np.concatenate([top_s[live], np.take_along_axis(s, cols, 1)], 1)
        i2 = np.concatenate([top_i[live], bid[cols]], 1)
        o = np.array([np.lexsort((b, -a))[:k] for a, b in zip(s2, i2)])
        top_s[live], top_i[live] = np.take_along_axis(s2, o, 1), np.take_along_axis(i2, o, 1)
        kth[live] = np.maximum(kth[live], top_s[live, -1])
    return [(int(qid), int(b), int(a)) for qid, ss, ii, t in zip(qids, top_s, top_i, kth)
            for a, b in zip(ss, ii) if a != NONE and a >= t]


KEY = ["dim", "pivot", "part"]


def probe(index: DataFrame, asked: DataFrame, model: dict, k: int) -> DataFrame:
    """(query_id, vec_id, score): for each request (KEY, query_id, v, kth) the best of that pivot's part.

    Both sides are dealt by pivot and part; the part's rows sort before its requests, which stream past them.
    """
    side = index.select(*KEY, F.lit(0).alias("kind"), "vec_id", "v", "dist", "norm", F.lit(0).cast("long").alias("kth"))
    ask = asked.select(*KEY, F.lit(1).alias("kind"), F.col("query_id").alias("vec_id"), "v", F.lit(0.0).alias("dist"),
                       F.lit(0.0).alias("norm"), "kth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        rows: list[tuple] = []
        for b in batches:
            if not b.num_rows:
                continue
            at = np.array([b[c].to_numpy() for c in [*KEY, "kind"]])
            cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
            out: list[tuple] = []
            for i, j in zip(cuts, cuts[1:]):
                here, kind = tuple(at[:-1, i].tolist()), at[-1, i]
                if here != key:
                    key, held, rows = here, None, []
                part = b.slice(i, j - i)
                ids, v = part["vec_id"].to_numpy(), matrix(part["v"], np.arange(j - i), here[0])
                if kind == 0:
                    rows.append((ids, v, part["dist"].to_numpy(), part["norm"].to_numpy()))
                elif rows or held:
                    if held is None:
                        held, rows = [np.concatenate(x) for x in zip(*rows)], []
                    p = model[here[0]][0][here[1]] if here[0] in model else np.zeros(here[0])
                    out += search(*held, p, ids, v, part["kth"].to_numpy(), k)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["query_id", "vec_id", "score"])

    both = side.union(ask).repartition(*KEY).sortWithinPartitions(*KEY, "kind", "dist", "vec_id")
    return both.mapInArrow(run, FOUND)


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` against ``rows``, both (vec_id, dim, v)."""
    model = fit(rows)
    index = C.materialise(place(rows, model), "index")
    stats = index.groupBy("dim", "pivot", "ring").agg(
        F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.max("norm").alias("m"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("off").alias("off"), F.count("*").alias("n"))
    stats = C.materialise(stats, "annuli")
    split = stats.groupBy("dim", "pivot").agg(F.ceil(F.sum("n") / PART_ROWS).cast("int").alias("parts"))
    index = index.join(split, ["dim", "pivot"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int"))
    asked = place(queries.groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q")).select("vec_id", "q.dim", "q.v"), model)
    asked = C.materialise(asked.withColumnRenamed("vec_id", "query_id").select("query_id", "dim", "v", "pivot"), "queries")
    home = asked.join(split, ["dim", "pivot"]).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(NONE).alias("kth"))
    first = C.materialise(probe(index, home, model, k), "own")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (first.withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") == k)
           .select("query_id", F.col("score").alias("kth")))
    annuli: dict[int, list] = {}
    for r in stats.collect():  # MOST_PIVOTS * RINGS rows a vector length, however many vectors
        annuli.setdefault(r["dim"], []).append(r)
    boxes = {d: tuple(np.array([r[c] for r in rs]) for c in ("pivot", "lo", "hi", "m", "low", "high", "off")) for d, rs in annuli.items()}

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, own, kth = (b[c].to_numpy() for c in ("dim", "pivot", "kth"))
            for dim in np.unique(dims):
                if dim not in boxes:
                    continue
                at = np.flatnonzero(dims == dim)
                pivot, *box = boxes[dim]
                q = matrix(b["v"], at, dim).astype(np.float64)
                p = model[dim][0][pivot] if dim in model else np.zeros((len(pivot), dim))
                row, box_at = np.nonzero((bounds(q, p, *box) >= kth[at][:, None]) & (pivot != own[at][:, None]))
                row, to = np.unique(np.stack([row, pivot[box_at]]), axis=1)  # one request a pivot
                take = pa.array(at[row])
                yield pa.RecordBatch.from_arrays(
                    [b["dim"].take(take), pa.array(to, pa.int32()), b["query_id"].take(take), b["v"].take(take), b["kth"].take(take)],
                    ["dim", "pivot", "query_id", "v", "kth"])

    rest = asked.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(NONE)))
    rest = rest.select("query_id", "dim", "v", "pivot", "kth").mapInArrow(
        reach, "dim int, pivot int, query_id long, v array<long>, kth long")
    rest = rest.join(split, ["dim", "pivot"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = first.union(probe(index, rest, model, k))
    return found.withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: the 5 best of every vec_id divisible by 50."""
    rows = whole_numbers(C.table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.filter(F.col("vec_id") % EVERY == 0))
