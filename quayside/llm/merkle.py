r"""Operator 12: a Merkle manifest of a dataset, kept as an append log in postorder.

Every row is a leaf.  The leaves of a source, in order of id, are the lowest level of
its tree; each run of ``FANOUT`` consecutive nodes, the last one shorter, makes
a node of the next level until one is left: the source's subroot.  The subroots, in
order of source, make a tree in the same way; its root stands for the dataset.

1. Places.  Leaves are dealt by ranges of (source, id), so that a source of any
   size is spread; a leaf's place is its rank within its range plus the
   counts of the ranges before.
2. Log.  Aligned builders take ``FANOUT ** HEIGHT`` consecutive leaves each and
   write a node when its last child is written, which is postorder: every
   builder writes one stretch of the log, and knows where it lies.  Their tops are
   the leaves of the next round of builders, so rounds grow with the
   logarithm of the largest source.
3. Addresses.  The node of level l whose last leaf is q comes after q earlier
   leaves, q // FANOUT + q // FANOUT ** 2 + ... finished nodes and its own chain of l
   nodes from leaf q: its position is the sum (``position``).  Nothing is searched.
4. Proofs.  From the top round down, each builder's stretch meets the path above it
   and hands one to each builder below; the lowest round folds every leaf.

A task holds one builder's stretch (``FANOUT ** HEIGHT`` leaves).  Digests are 32
bytes in tables, and lowercase hex where they are hashed.

Null fields count as ``-``; an empty text is ``0:``.  A null source is before all
others and a null id before all ids; rows of one source and id are ordered by leaf,
and equal rows are leaves of their own.  A null id is never tampered with.
Very long texts are hashed in the JVM, row by row.  Extra columns are left out.
An empty table gives no rows, and no root.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

FANOUT, HEIGHT = 16, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
LOG = "tree string, n long, level int, i long, at long, digest binary"
PATHS = "tree string, n long, i long, above binary"


def field(c: Column) -> Column:
    """A value with the number of its bytes, so that no two rows spell the same leaf."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


def depth(n: int) -> int:
    """Levels above the leaves of a tree with n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def depth_of(n: Column) -> Column:
    powers = [FANOUT ** k for k in range(64) if FANOUT ** k < 1 << 63]
    return sum(((n > p).cast("int") for p in powers), F.lit(0))


def position(level: int, i: int, n: int) -> int:
    """Where the log of a tree with n leaves holds node i of a level."""
    last = min((i + 1) * FANOUT ** level, n) - 1
    at, done = last + level, last // FANOUT
    while done:
        at, done = at + done, done // FANOUT
    return at


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, the rank within its ``tree`` by ``order``, and ``n``, the tree's rows.

    ``order`` must make the order total but for equal rows.
    """
    keys = ["tree", *order]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, i = None, 0
        for b in batches:
            ranks = []
            for t in b["tree"].to_pylist():
                i, tree = (i + 1 if t == tree else 0), t
                ranks.append(i)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ranks, pa.int64())], [*b.schema.names, "rank"])

    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"{c} {t}" for c, t in [*dealt.dtypes, ("rank", "long")])
    ranked = C.materialise(dealt.mapInArrow(number, schema), "ranked")
    parts = ranked.groupBy("tree", "part").agg(F.count("*").alias("m")).groupBy("tree").agg(
        F.sum("m").alias("n"), F.sort_array(F.collect_list(F.struct("part", "m"))).alias("ms"))  # one for each range
    before = F.aggregate("ms", F.struct(F.lit(0).cast("long").alias("sum"), F.expr("cast(array() as array<long>)").alias("xs")),
                         lambda acc, x: F.struct((acc["sum"] + x["m"]).alias("sum"), F.concat(acc["xs"], F.array(acc["sum"])).alias("xs")))
    starts = parts.select("tree", "n", F.explode(F.arrays_zip("ms", before["xs"].alias("start"))).alias("p")).select(
        "tree", "n", F.col("p.ms.part").alias("part"), F.col("p.start").alias("start"))
    return ranked.join(C.materialise(starts, "starts"), ["tree", "part"]).withColumn("i", F.col("start") + F.col("rank")).drop(
        "part", "rank", "start")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(tree, block, rows) of consecutive rows with one tree and block; rows are dicts."""
    key, rows = None, []
    for b in batches:
        for r in b.to_pylist():
            here = (r["tree"], r["block"])
            if here != key:
                if rows:
                    yield (*key, rows)
                key, rows = here, []
            rows.append(r)
    if rows:
        yield (*key, rows)


def _node(children: list[bytes]) -> bytes:
    return sha256("".join([c.hex() for c in children]).encode()).digest()


def _builder(base: int):
    """A task's work: nodes in the order in which they are complete, from aligned runs of nodes of level ``base``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, block, rows in _stretches(batches):
            n = rows[0]["n"]
            top = min(HEIGHT, depth(n) - base)
            out, children, count = [], [[] for _ in range(HEIGHT + 1)], [block * FANOUT ** (HEIGHT - j) for j in range(HEIGHT + 1)]

            def close(j: int) -> None:
                d = _node(children[j])
                children[j].clear()
                out.append((tree, n, base + j + 1, count[j + 1], position(base + j + 1, count[j + 1], n), d))
                count[j + 1] += 1
                children[j + 1].append(d)

            for r in rows:
                if base == 0:
                    out.append((tree, n, 0, r["i"], position(0, r["i"], n), r["digest"]))
                children[0].append(r["digest"])
                for j in range(top):
                    if len(children[j]) == FANOUT:
                        close(j)
            for j in range(top):  # the end of the tree, if it isn't that of a run
                if children[j]:
                    close(j)
            yield _batch(out, LOG)

    return run


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in ddl.split(", ")]
    cols = [*zip(*rows)] or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields)], [f for f, _ in fields])


def _block(level: Column | int, base: int) -> Column:
    """The builder, of those from level ``base`` on, that a node of ``level`` falls to."""
    width = F.lit(FANOUT ** HEIGHT) if isinstance(level, int) else F.pow(F.lit(FANOUT), F.lit(HEIGHT) - level + base).cast("long")
    return F.floor(F.col("i") / width).cast("long")


def append_log(leaves: DataFrame) -> DataFrame:
    """(tree, n, level, i, at, digest): all nodes of the trees over ``leaves`` (tree, n, i, digest)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    logs: list[DataFrame] = []
    given = leaves.select("tree", "n", "i", "digest")
    for base in range(0, max(1, depth(most)), HEIGHT):
        if base:
            given = logs[-1].filter((F.col("level") == base) & (depth_of(F.col("n")) > base)).select("tree", "n", "i", "digest")
        dealt = given.withColumn("block", F.floor(F.col("i") / FANOUT ** HEIGHT)).repartition("tree", "block")
        logs.append(C.materialise(dealt.sortWithinPartitions("tree", "block", "i").mapInArrow(_builder(base), LOG), "log"))
    return reduce(DataFrame.union, logs)


def roots(log: DataFrame) -> DataFrame:
    """(tree, n, digest) of the last node of each tree."""
    return log.filter(F.col("level") == depth_of(F.col("n"))).select("tree", "n", "digest")


def _climber(base: int, ends: bool):
    """A task's work: extends the path above its stretch to each node of level ``base``.

    A path is a row of runs, lowest first: the number of nodes, the place of the one's own, and the nodes.
    Its first 64 bytes are the digests of the tree's and the dataset's root.
    With ``ends`` the nodes are leaves with a payload, which are folded instead.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, block, rows in _stretches(batches):
            above = next(r["more"] for r in rows if r["kind"] == 0)
            n = rows[0]["n"]
            held = {position(r["level"], r["i"], n): r["digest"] for r in rows if r["kind"] == 1}
            top = min(HEIGHT, depth(n) - base)
            runs: dict[tuple[int, int], list[bytes]] = {}

            def path(i: int) -> list[tuple[int, list[bytes], tuple[int, int]]]:
                out = []
                for level in range(base, base + top):
                    start, wide = i // FANOUT * FANOUT, -(-n // FANOUT ** level)
                    if (level, start) not in runs:
                        runs[level, start] = [held[position(level, j, n)] for j in range(start, min(start + FANOUT, wide))]
                    out.append((i - start, runs[level, start], (level, start)))
                    i //= FANOUT
                return out

            if not ends:
                yield _batch([(tree, n, i, above[:64] + b"".join(bytes([len(ds), own]) + b"".join(ds) for own, ds, _ in path(i)) + above[64:])
                              for i in sorted({r["i"] for r in rows if r["kind"] == 1 and r["level"] == base})], PATHS)
                continue
            higher = unpack(above[64:])
            hexed: dict = {}
            made: dict = {}
            out = []
            for r in rows:
                if r["kind"] != 2:
                    continue
                steps = path(r["i"]) + higher
                proof, now = sha256(), r["more"] or r["digest"]
                for own, ds, name in steps:
                    if name not in hexed:
                        hexed[name] = [d.hex() for d in ds]
                        made[name] = _node(ds)
                    hs = hexed[name]
                    proof.update("".join(hs[:own] + hs[own + 1:]).encode())
                    now = made[name] if now == ds[own] else _node([*ds[:own], now, *ds[own + 1:]])
                out.append((r["doc_id"], r["digest"].hex(), above[:32].hex(), above[32:64].hex(), proof.hexdigest(), now.hex(),
                            now == above[32:64]))
            yield _batch(out, PROOFS)

    return run


def unpack(path: bytes) -> list[tuple[int, list[bytes], tuple[int, int]]]:
    """Runs of a packed path: own place, digests, and a name that no other run of the path has."""
    out, at = [], 0
    while at < len(path):
        n, own = path[at], path[at + 1]
        out.append((own, [path[at + 2 + 32 * j:at + 34 + 32 * j] for j in range(n)], (-1, at)))
        at += 2 + 32 * n
    return out


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
SIDES = ["tree", "block", "kind", "level", "i", "n", "digest", "more", "doc_id"]


def climb(log: DataFrame, tops: DataFrame, payload: DataFrame | None = None) -> DataFrame:
    """Paths from the top of each tree, (tree, n, above) in ``tops``, to its leaves: (tree, i, above).

    With ``payload`` (tree, n, i, digest, changed, doc_id) the leaves are folded: rows as ``PROOFS``.
    """
    most = depth(tops.agg(F.max("n")).first()[0] or 0)
    null = {"digest": F.lit(None).cast("binary"), "more": F.lit(None).cast("binary"), "doc_id": F.lit(None).cast("long")}
    found = None
    for base in reversed(range(0, max(1, most), HEIGHT)):
        d = depth_of(F.col("n"))
        first = tops.filter((d <= base + HEIGHT) & ((d > base) if base else F.lit(True))).select("tree", "n", F.lit(0).cast("long").alias("block"), "above")
        if found is not None:  # tops of builders of this round
            first = first.union(found.select("tree", "n", F.col("i").alias("block"), "above"))
        heads = first.select("tree", "block", F.lit(0).alias("kind"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("i"), "n",
                             null["digest"].alias("digest"), F.col("above").alias("more"), null["doc_id"].alias("doc_id"))
        inner = log.filter((F.col("level") >= base) & (F.col("level") < base + HEIGHT) & ((d > base) if base else F.lit(True)))
        nodes = inner.select("tree", _block(F.col("level"), base).alias("block"), F.lit(1).alias("kind"), "level", "i", "n", "digest",
                             null["more"].alias("more"), null["doc_id"].alias("doc_id"))
        sides = heads.union(nodes)
        ends = base == 0 and payload is not None
        if ends:
            sides = sides.union(payload.select("tree", _block(0, 0).alias("block"), F.lit(2).alias("kind"), F.lit(0).alias("level"), "i", "n",
                                               "digest", F.col("changed").alias("more"), "doc_id"))
        dealt = sides.select(*SIDES).repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "level", "i")
        found = dealt.mapInArrow(_climber(base, ends), PROOFS if ends else PATHS)
        if not ends:
            found = C.materialise(found, "paths")
    return found


@dataclass
class Manifest:
    """Leaves with their places, and the logs of the sources' trees and of the tree over them."""

    leaves: DataFrame
    log: DataFrame
    sources: DataFrame
    top: DataFrame


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, source: str = "source", doc_id: str = "doc_id",
             changed: Column | None = None) -> Manifest:
    """Builds both logs.  ``changed``: a digest that stands for a leaf when it is folded, or null."""
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # null before all
    leaves = docs.select(named.alias("tree"), F.col(doc_id).cast("long").alias("doc_id"), digest([F.col(f) for f in fields]).alias("digest"),
                         (F.lit(None).cast("binary") if changed is None else changed).alias("changed"))
    leaves = C.materialise(leaves, "digests")  # texts are read once; the ranges below sample and deal digests
    leaves = C.materialise(placed(leaves, ["doc_id", "digest"]), "leaves")
    log = append_log(leaves)
    subroots = roots(log).select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    sources = C.materialise(placed(subroots, ["source"]), "sources")
    return Manifest(leaves, log, sources, append_log(sources))


def prove(m: Manifest) -> DataFrame:
    """Rows as ``PROOFS``: every leaf's proof by its digest, and the root that its (changed) leaf folds to."""
    root = roots(m.top).select("tree", "n", F.col("digest").alias("root"))
    start = root.select("tree", "n", F.concat("root", "root").alias("above"))
    paths = climb(m.top, start).drop("n").join(root.select("tree", "root"), "tree").join(
        m.sources.select("tree", "i", "source", F.col("digest").alias("subroot")), ["tree", "i"])
    tops = paths.select(F.col("source").alias("tree"), F.concat("subroot", "root", F.expr("substring(above, 65)")).alias("above"))
    sizes = roots(m.log).select("tree", "n")
    return climb(m.log, C.materialise(tops.join(sizes, "tree").select("tree", "n", "above"), "tops"), m.leaves)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows of every document; the tampered ones have their text in lower case."""
    docs = C.table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    low = digest([C.ascii_lower(F.col(f)) if f == "text" else F.col(f) for f in FIELDS])
    return prove(manifest(docs, changed=F.when(tampered, low)))
