r"""Operator 11: hard-negative mining by a vertical scan of columns (BOND).

An anchor's positives are its ``POSITIVES`` best other rows of its label by integer
inner product; a positive of score p has for negatives the best ``NEGATIVES`` rows of other
labels with scores from ``LOW`` to ``HIGH`` percent of p.  Ties go to the smaller id.

Rows are dealt to cells, which hold their vectors by dimension.  An anchor reads a
cell's dimensions in descending order of its own magnitudes, in the parts that
``CUTS`` gives.  Of what remains, each column's least and greatest value bound the
contribution; with their sums every candidate's score so far becomes an
interval, and a bitmap keeps the candidates whose interval still matters:

* positives: it reaches the k-th best lower end;
* negatives: it meets the windows of the anchor's positives, and reaches the least of their k-th best
  lower ends among candidates that are sure to be in that window.

What is left when all dimensions are read has its exact score.  The best of each cell
are ranked by anchor.  Anchors meet only the cells of their own label for positives,
and every cell once for the negatives of all their positives: a stated set of queries against all
rows, in blocks, whose work is anchors times rows.  A label or vector
length of any size is cut into cells of about ``CELL_ROWS`` rows by a hash of the row, and
anchors stream past a cell.

Rows with a null label, a null vector, or a null or non-finite component take no
part, as anchors or candidates; neither do rows without an id.  Vectors of different lengths
don't meet; empty ones score 0 with each other.  A row that repeats is a candidate each time; an anchor
id that repeats asks once, with its least (length, label, vector), and rows with
the anchor's own id are never its results.  Scores are 64-bit integers.  Extra
columns are left out.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

EVERY, SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 50, 256, 5, 3, 50, 95
NOISE, LABELS = 7, 10
CELL_ROWS, LEAST_ROWS, SPREAD = 65536, 8192, 32
CUTS = (4, 6, 7, 8)  # eighths of the dimensions after which candidates are left out
FOUND = "anchor_id long, place int, vec_id long, score long"


def whole_numbers(rows: DataFrame, label: Column, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, dim, v): rows that take part, components as floor(scale * x)."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.filter(x.isNotNull() & ~bad & F.col("vec_id").isNotNull() & label.isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.size(v).alias("dim"), v.alias("v"))


class Cell:
    """A block of rows by dimension: ``x[d]`` holds component d of all its rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.labels = ids, labels
        self.x = np.ascontiguousarray(v.T)
        self.wide = max(1.0, float(np.abs(v).max(initial=0)))
        self.low, self.high = self.x.min(1, initial=0), self.x.max(1, initial=0)
        if len(ids):
            self.low, self.high = self.x.min(1), self.x.max(1)
        self.kinds: dict[type, np.ndarray] = {np.int64: self.x}
        self.read = 0  # components read so far

    def of(self, kind: type) -> np.ndarray:
        if kind not in self.kinds:
            self.kinds[kind] = self.x.astype(kind)
        return self.kinds[kind]

    def scan(self, q: np.ndarray, mask: np.ndarray, interval) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the rows of ``mask`` whose score can be in an interval to the end.

        ``interval(scores, least, most)`` gives its ends from the candidates' scores so far and the bounds of what remains.
        """
        order = np.argsort(-np.abs(q), kind="stable")
        bound = len(q) * max(1.0, float(np.abs(q).max(initial=0))) * self.wide  # sums of integers are exact well below the mantissa
        kind = np.float32 if bound < 2.0 ** 22 else np.float64 if bound < 2.0 ** 50 else np.int64
        x, qs = self.of(kind), q.astype(kind)
        ends = np.stack([q * self.low, q * self.high])[:, order]
        least, most = ends.min(0, initial=1 << 62), ends.max(0, initial=-(1 << 62))
        rows, bitmap = None, mask
        score = np.zeros(len(self.ids), kind)
        at = 0
        for to in sorted({-(-len(q) * c // 8) for c in CUTS}):
            dims = order[at:to]
            part = x[dims] if rows is None else x[dims][:, rows]
            self.read += part.size
            score = score + qs[dims] @ part
            at = to
            if to < len(q):
                rest = int(least[to:].sum()), int(most[to:].sum())
                low, high = interval(score[bitmap], *rest)
                bitmap = bitmap & (score >= low - rest[1]) & (score <= high - rest[0])
                left = int(bitmap.sum())
                if 2 * left < len(bitmap):  # so few that the others are worth leaving out
                    rows = np.flatnonzero(bitmap) if rows is None else rows[bitmap]
                    score, bitmap = score[bitmap], np.ones(left, bool)
                if not left:
                    break
        rows = np.flatnonzero(bitmap) if rows is None else rows[bitmap]
        return rows, score[bitmap].astype(np.int64)

    def best(self, rows: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, int]]:
        if len(rows) > 8 * k:
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[keep], score[keep]
        order = np.lexsort((self.ids[rows], -score))[:k]
        return [*zip(self.ids[rows[order]].tolist(), score[order].tolist())]

    def positives(self, anchor: int, label: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best other rows of the label."""
        def interval(score: np.ndarray, least: int, most: int) -> tuple[float, float]:
            return kth(score, k) + least if len(score) >= k else -np.inf, np.inf

        return self.best(*self.scan(q, (self.labels == label) & (self.ids != anchor), interval), k)

    def negatives(self, anchor: int, label: int, q: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """For each window of scores, (id, score) of the k best rows of other labels in it."""
        def interval(score: np.ndarray, least: int, most: int) -> tuple[float, float]:
            lows = []
            for a, b in windows:
                sure = score[(score >= a - least) & (score <= b - most)] if a - least <= b - most else score[:0]
                lows.append(max(a, kth(sure, k) + least) if len(sure) >= k else a)
            return min(lows), max(b for _, b in windows)

        if not any(a <= b for a, b in windows):
            return [[] for _ in windows]
        rows, score = self.scan(q, (self.labels != label) & (self.ids != anchor), interval)
        return [self.best(rows[at], score[at], k) for a, b in windows for at in [(score >= a) & (score <= b)]]


def kth(score: np.ndarray, k: int) -> int:
    return int(np.partition(score, len(score) - k)[len(score) - k])


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The least and greatest integer from low to high percent of a score."""
    return -(-low * score // 100), high * score // 100


def past_cells(index: DataFrame, asked: DataFrame, key: list[str], work) -> DataFrame:
    """``FOUND`` rows: ``work(cell, anchor_id, label, q, scores)`` for every anchor of ``asked`` at each cell that it names.

    Both sides are dealt by cell; a cell's rows sort before its anchors, which stream past them.
    """
    cols = [*key, "kind", "vec_id", *({"label"} - {*key}), "v", "scores"]
    sides = index.withColumns({"kind": F.lit(0), "scores": F.lit(None).cast("array<long>")}).select(*cols).union(
        asked.withColumn("kind", F.lit(1)).select(*cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cell, rows = None, None, []
        for b in batches:
            names = [*zip(*[b[c].to_pylist() for c in key])]
            kinds, ids, labels, scores = (b[c].to_pylist() for c in ("kind", "vec_id", "label", "scores"))
            vs, out, i = b["v"], [], 0
            while i < len(names):
                j = i
                while j < len(names) and names[j] == names[i] and kinds[j] == kinds[i]:
                    j += 1
                if names[i] != here:
                    here, cell, rows = names[i], None, []
                v = vs.slice(i, j - i).flatten().to_numpy().reshape(j - i, here[0])
                if kinds[i] == 0:
                    rows.append((np.array(ids[i:j]), np.array(labels[i:j]), v))
                elif rows or cell:
                    if cell is None:
                        cell, rows = Cell(*[np.concatenate(x) for x in zip(*rows)]), []
                    for n in range(i, j):
                        out += work(cell, ids[n], labels[n], v[n - i], scores[n])
                i = j
            if out:
                kinds_ = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds_)], ["anchor_id", "place", "vec_id", "score"])

    return sides.repartition(*key).sortWithinPartitions(*key, "kind", "vec_id").mapInArrow(run, FOUND)


def _celled(index: DataFrame, asked: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows with the cell that they are in, and anchors with each cell of their group, cells by the sizes of the groups."""
    cells = F.greatest(F.ceil(F.col("rows") / CELL_ROWS), F.least(F.lit(SPREAD), F.ceil(F.col("rows") / LEAST_ROWS)))
    sizes = C.materialise(index.groupBy(*by).agg(F.count("*").alias("rows")).select(*by, cells.cast("int").alias("cells")), "sizes")
    placed = index.join(sizes, by).withColumn("cell", F.pmod(F.xxhash64("vec_id", "v"), F.col("cells")).cast("int"))
    asking = asked.join(sizes, by).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    return placed, asking, [*by, "cell"]


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_rank, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors``: (vec_id, label, dim, v).
    """
    rows = C.materialise(rows, "vectors")
    one = anchors.groupBy("vec_id").agg(F.min(F.struct("dim", "label", "v")).alias("q"))
    one = C.materialise(one.select("vec_id", "q.dim", "q.label", "q.v", F.lit(None).cast("array<long>").alias("scores")), "anchors")

    def near(cell: Cell, anchor: int, label: int, q: np.ndarray, _) -> list[tuple]:
        return [(anchor, 0, i, s) for i, s in cell.positives(anchor, label, q, positives)]

    placed, asking, key = _celled(rows, one, ["dim", "label"])
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    found = past_cells(placed, asking, key, near).withColumn("place", F.row_number().over(best))
    found = C.materialise(found.filter(F.col("place") <= positives), "positives")

    def hard(cell: Cell, anchor: int, label: int, q: np.ndarray, scores: list[int]) -> list[tuple]:
        got = cell.negatives(anchor, label, q, [window(s, low, high) for s in scores], negatives)
        return [(anchor, n + 1, i, s) for n, xs in enumerate(got) for i, s in xs]

    scores = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("xs"))  # few for each anchor
    asked = one.drop("scores").join(scores.select(F.col("anchor_id").alias("vec_id"), F.col("xs.score").alias("scores")), "vec_id")
    placed, asking, key = _celled(rows, asked, ["dim"])
    inside = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    hard_ = past_cells(placed, asking, key, hard).withColumn("rank", F.row_number().over(inside)).filter(F.col("rank") <= negatives)
    return found.select("anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(
        hard_.select("anchor_id", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")),
        ["anchor_id", "place"]).select("anchor_id", F.col("place").alias("positive_rank"), "positive_id", "rank", "negative_id",
                                       "positive_score", "negative_score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: hard negatives of every vec_id divisible by 50; every seventh label is moved on by one first."""
    label = F.when(F.col("vec_id") % NOISE == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = whole_numbers(C.table(spark, sf_dir, "embeddings"), label)
    return mine(rows, rows.filter(F.col("vec_id") % EVERY == 0))
