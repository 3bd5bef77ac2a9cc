r"""Operator 13: near-duplicates by bottom-k sketches from one hash function.

A document's set has its distinct word shingles, each as one 64-bit hash; the
``K`` least hashes are its sketch.  Documents link when their sets share at least
``PERCENT`` percent of their union.

1. Classes.  Equal sets (by 128 bits of digest) are one node; copies cost nothing more.
2. Inverted lists.  The lists are keyed by ``RUN`` retained values that are next to each
   other in the sketch.  Of the K least values of two linked sets' union each is
   shared with a chance of 0.8 or more, so a shared run is missing once in 7 * 10^9 links
   at worst, and never where the sketches hold whole sets.  (By
   pigeonhole: at most a fifth of the union is not shared, and cuts the rest into
   pieces, one of which has three values.  Sets of five or fewer differ by one, and
   runs of two are listed for them as well; of three or fewer, by none.)
3. Overlaps.  In a list of at most ``LIGHT`` nodes all meet.  In a longer one each meets the least
   of them; tasks settle long lists among their own nodes first, so that few of a hot
   list's entries are shuffled.
4. Estimate.  Of the K least values of both sketches together, ``LEAST`` or more must be in
   both: at the limit, there are fewer less than once in 10^9 pairs; never where the
   sketches hold whole sets, as these are counted out.
5. Verification on full sets, then components of the links.
6. The rest of the long lists.  Those whose nodes are one component by now are
   done.  The nodes of the others meet again by prefixes of their full
   sets: linked sets share one of the rarest fifth of either's values.  Nodes
   that meet in long lists there as well are families, whose members are compared in
   tiles of bounded size, a pair of tiles a task, if their sizes allow a link and they are not
   of one component.  Only the links are sent on.  This is the one step whose work grows
   with the square of a group: of texts that share four fifths of their
   shingles with many others and are linked with few of them.

Sets are fetched only for the nodes that pass the estimate or are in long lists.

Null and empty texts have empty sets and are linked with nothing.  With fewer words
than a shingle, the whole sequence is one.  Rows that repeat an id get a row each; rows
without an id have the least id of their component too, and null if it has none.  A
row is kept if its id is the component's, null included.  Very long texts have
sketches like any other; their sets are rows of 8 bytes a shingle.  Extra columns are left out.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.joins import broadcast_if_small

from . import common as C
from .bpe import batches
from .components import components
from .merkle import placed

SHINGLE, K, RUN, PERCENT, LEAST, LIGHT = 2, 64, 3, 80, 29, 32
WORDS = 200_000  # words that a task knows
CHUNK = 1 << 18  # entries of inverted lists that a task settles at a time
TILE, TILE_VALUES = 512, 1 << 22  # nodes of a tile, and values at most
BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)  # odd multipliers of the one hash


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * STEP
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingles:
    """Sets of shingle hashes; words are numbered, so distinct shingles of a text are told apart exactly."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.place: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.uint64)

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """For each text, its sorted hashes as signed integers."""
        import xxhash

        split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]  # bytes: ASCII only
        if len(self.place) > WORDS:
            self.place, self.hashes = {}, np.zeros(0, np.uint64)
        new = {w for ws in split for w in ws}.difference(self.place)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.hashes = np.concatenate([self.hashes, np.array([xxhash.xxh64_intdigest(w) for w in new], np.uint64)])
        for ws in split:
            ids = np.fromiter(map(self.place.__getitem__, ws), np.int64, len(ws))
            k = min(self.size, len(ids))
            if not k:
                yield np.zeros(0, np.int64)
                continue
            grams = ids[:len(ids) - k + 1]
            for j in range(1, k):  # grams of equal beginnings are numbered, so that the next word fits in
                if j > 1:
                    grams = np.unique(grams, return_inverse=True)[1].astype(np.int64)
                grams = (grams << np.int64(32)) | ids[j:len(ids) - k + 1 + j]
            first = np.unique(grams, return_index=True)[1]
            h = np.full(len(first), np.uint64(k))
            with np.errstate(over="ignore"):
                for j in range(k):
                    h = mixed(h * BASE + self.hashes[ids[first + j]])
            yield np.sort(h.view(np.int64))


def _long_lists(x: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, x)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *x])))


def sketches(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """(doc_id, mark, n, key, sketch) of every row: size and digest of its set, its least values; ``mark`` hashes the text."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for p in parts:
            texts, sets = p["text"].to_pylist(), []
            for a, b in batches(texts):
                sets += [(len(s), blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None, s[:k]) for s in shingles.sets(texts[a:b])]
            n, key, least = zip(*sets) if sets else ((), (), ())
            yield pa.RecordBatch.from_arrays([p["doc_id"], p["mark"], pa.array(n, pa.int64()), pa.array(key, pa.binary()), _long_lists([*least])],
                                             ["doc_id", "mark", "n", "key", "sketch"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(text).alias("mark"), F.col(text).alias("text"))
    return given.mapInArrow(run, "doc_id long, mark long, n long, key binary, sketch array<long>")


def _mark(text: str) -> Column:
    return F.xxhash64(F.col(text))


def full_sets(docs: DataFrame, wanted: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(node, values) for ``wanted`` (node, key, doc_id, mark): each row's text is read once more."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for p in parts:
            texts, keys, nodes = (p[c].to_pylist() for c in ("text", "key", "node"))
            out = []
            for a, b in batches(texts):
                for node, key, s in zip(nodes[a:b], keys[a:b], shingles.sets(texts[a:b])):
                    if blake2b(s.tobytes(), digest_size=16).digest() == key:  # rows may share id and mark
                        out.append((node, s))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), _long_lists([x[1] for x in out])], ["node", "values"])

    given = docs.select(F.col("doc_id").cast("long").alias("id"), _mark(text).alias("m"), F.col(text).alias("text"))
    small = broadcast_if_small(wanted)
    rows = given.join(small, given["id"].eqNullSafe(wanted["doc_id"]) & (given["m"] == wanted["mark"]))
    return rows.select("node", "key", "text").mapInArrow(run, "node long, values array<long>").groupBy("node").agg(F.first("values").alias("values"))


ENTRY, STAR, LONG = 0, 1, 2
MET = "kind int, key long, u long, v long"


def run_keys(nodes: DataFrame, run_length: int = RUN) -> DataFrame:
    """(key, node): a hash of each row of ``run_length`` neighbours in a sketch, and for small sets of pairs."""
    def runs(k: int) -> Column:
        at = F.sequence(F.lit(1), F.size("sketch") - k + 1)
        return F.when(F.size("sketch") >= k, F.transform(at, lambda i: F.xxhash64(F.lit(k), F.slice("sketch", i, k)))).otherwise(
            F.expr("cast(array() as array<long>)"))

    small = F.when(F.size("sketch") <= 5, runs(2)).otherwise(F.expr("cast(array() as array<long>)"))
    return nodes.select(F.explode(F.concat(runs(run_length), small)).alias("key"), "node")


def meet(entries: DataFrame, light: int = LIGHT) -> tuple[DataFrame, DataFrame]:
    """From (key, node), nodes that meet: (u, v, whether in a long list), and the entries (key, node) of long lists."""
    def settle(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Before the shuffle: long lists among a task's own entries; the least of each goes on."""
        keys, nodes, held = [], [], 0

        def send() -> pa.RecordBatch:
            k, v = np.concatenate(keys), np.concatenate(nodes)
            order = np.lexsort((v, k))
            k, v = k[order], v[order]
            first = np.concatenate([[True], k[1:] != k[:-1]])
            start = np.flatnonzero(first)
            size = np.diff(np.append(start, len(k)))
            of = np.repeat(np.arange(len(start)), size)
            many, least = (size > light)[of], v[start][of]
            kind = np.where(many, np.where(first, LONG, STAR), ENTRY).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(k), pa.array(np.where(kind == STAR, least, v)), pa.array(v)], ["kind", "key", "u", "v"])

        for p in parts:
            keys.append(p["key"].to_numpy())
            nodes.append(p["node"].to_numpy())
            held += p.num_rows
            if held >= CHUNK:
                yield send()
                keys, nodes, held = [], [], 0
        if held:
            yield send()

    def lists(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """After it: stars pass through, lists come in order; at most ``light`` nodes are held."""
        key, members, long_, least = None, [], False, None
        out: list[tuple] = []

        def end() -> None:
            if not long_:
                out.extend((ENTRY, None, a, b) for i, b in enumerate(members) for a in members[:i])

        for p in parts:
            for kind, k, u, v in zip(*[p[c].to_pylist() for c in ("kind", "key", "u", "v")]):
                if kind == STAR:
                    out += [(STAR, None, u, v), (LONG, k, v, None)]
                    continue
                if k != key:
                    end()
                    key, members, long_, least = k, [], False, u
                if not long_ and (kind == LONG or len(members) == light):
                    long_ = True
                    for m in members:
                        out += [(STAR, None, least, m), (LONG, k, m, None)]
                    members = []
                if long_:
                    out += [(STAR, None, least, u), (LONG, k, u, None)]
                else:
                    members.append(u)
            if len(out) > 100_000:
                yield _met(out)
                out = []
        end()
        yield _met(out)

    dealt = entries.mapInArrow(settle, MET)
    dealt = dealt.withColumn("to", F.when(F.col("kind") == STAR, F.xxhash64("v")).otherwise(F.col("key")))
    dealt = dealt.repartition("to").sortWithinPartitions("to", "key", "u").select("kind", "key", "u", "v")
    met = C.materialise(dealt.mapInArrow(lists, MET).distinct(), "met")
    pairs = met.filter((F.col("kind") != LONG) & (F.col("u") != F.col("v"))).groupBy(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg((F.max("kind") == STAR).alias("long"))
    return pairs, met.filter(F.col("kind") == LONG).select("key", F.col("u").alias("node"))


def _met(rows: list[tuple]) -> pa.RecordBatch:
    cols = [*zip(*rows)] or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["kind", "key", "u", "v"])


def _with_both(pairs: DataFrame, what: DataFrame, cols: list[str]) -> DataFrame:
    """``pairs`` (u, v, ...) with ``cols`` of both nodes as <col>_u and <col>_v."""
    for side in "uv":
        pairs = pairs.join(what.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in cols]), side)
    return pairs


def likely(pairs: DataFrame, nodes: DataFrame, k: int = K, least: int = LEAST, percent: int = PERCENT) -> DataFrame:
    """Pairs (u, v) whose sketches allow a link."""
    x = _with_both(pairs.select("u", "v"), nodes, ["n", "sketch"])
    x = x.filter((100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")))  # sizes alone rule it out
    union = F.slice(F.array_sort(F.array_union("sketch_u", "sketch_v")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect(union, F.col("sketch_u")), F.col("sketch_v")))
    whole = (F.col("n_u") <= k) & (F.col("n_v") <= k)
    shared = F.size(F.array_intersect("sketch_u", "sketch_v"))
    return x.filter(F.when(whole, 100 * shared >= percent * (F.col("n_u") + F.col("n_v") - shared)).otherwise(both >= least)).select("u", "v")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (u, v) that are links, by their full sets."""
    x = _with_both(pairs.select("u", "v"), sets, ["values"])
    x = x.withColumn("shared", F.size(F.array_intersect("values_u", "values_v")))
    return x.filter(100 * F.col("shared") >= percent * (F.size("values_u") + F.size("values_v") - F.col("shared"))).select("u", "v")


def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for every node."""
    found = components(links).select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.select("node").join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def prefixes(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, node): of each set the rarest values, one of which every linked set shares; those that no other set has are left out."""
    flat = sets.select("node", F.size("values").alias("n"), F.explode("values").alias("key"))
    times = C.materialise(flat.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1"), "times")
    shared = flat.join(times, "key").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("times", "key"))).alias("xs"))  # a set at most
    wanted = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("xs"))
    return shared.filter(wanted > 0).select(F.explode(F.slice("xs", F.lit(1), wanted.cast("int"))).alias("x"), "node").select("x.key", "node")


def families(long_: DataFrame, stars: DataFrame, sets: DataFrame, roots: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (u, v) between components among nodes that long lists join, tile by tile."""
    members = _roots(long_.select("node").distinct(), stars.select("u", "v")).withColumnRenamed("root", "tree")
    members = members.join(roots, "node").join(sets.select("node", F.size("values").cast("long").alias("size")), "node")
    mixed_ = members.groupBy("tree").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b").select("tree")
    members = members.join(mixed_, "tree").select("tree", "size", "node", "root")
    ranked = placed(members, ["size", "node"])
    wide = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_VALUES) / F.greatest("size", F.lit(1)))))
    wide = F.pow(F.lit(2), F.floor(F.log2(wide))).cast("long")
    tiled = C.materialise(ranked.withColumn("tile", F.struct(wide.alias("wide"), F.floor(F.col("i") / wide).alias("at"))).drop("n", "i"), "tiles")
    tiles = tiled.groupBy("tree", "tile").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    a, b = tiles.alias("a"), tiles.alias("b")
    # the larger sizes come later; two tiles meet if sizes in them allow a link
    asked = a.join(b, (F.col("a.tree") == F.col("b.tree")) & (F.struct("a.low", "a.high", "a.tile") <= F.struct("b.low", "b.high", "b.tile"))
                   & (100 * F.col("a.high") >= percent * F.col("b.low")))
    asked = C.materialise(asked.select(F.col("a.tree").alias("tree"), F.col("a.tile").alias("first"), F.col("b.tile").alias("second")), "tile-pairs")
    full = tiled.join(sets, "node").select("tree", "tile", "node", "root", "values")
    left = full.withColumnRenamed("tile", "first").join(asked, ["tree", "first"]).select("tree", "first", "second", F.lit(0).alias("side"), "node", "root", "values")
    right = full.withColumnRenamed("tile", "second").join(asked, ["tree", "second"]).select("tree", "first", "second", F.lit(1).alias("side"), "node", "root", "values")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rows, index = None, [], None
        for p in parts:
            out: set[tuple[int, int]] = set()
            done: set[tuple[int, int]] = set()
            names = [*zip(p["tree"].to_pylist(), map(str, p["first"].to_pylist()), map(str, p["second"].to_pylist()))]
            sides, nodes, roots_, values = (p["side"].to_pylist(), p["node"].to_pylist(), p["root"].to_pylist(), p["values"])
            for i, name in enumerate(names):
                if name != here:
                    here, rows, index = name, [], None
                v = values[i].values.to_numpy()
                if sides[i] == 0:
                    rows.append((nodes[i], roots_[i], v))
                    continue
                if index is None:  # postings of the first tile's values
                    flat = np.concatenate([r[2] for r in rows])
                    owner = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
                    order = np.argsort(flat, kind="stable")
                    index = (flat[order], owner[order], np.array([len(r[2]) for r in rows]))
                keys, owner, sizes = index
                lo, hi = np.searchsorted(keys, v), np.searchsorted(keys, v, "right")
                n = hi - lo
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                shared = np.bincount(owner[at], minlength=len(rows))
                for j in np.flatnonzero(100 * shared >= percent * (sizes + len(v) - shared)):
                    pair = (rows[j][1], roots_[i])
                    if pair[0] != pair[1] and pair not in done:  # one link joins two components
                        done.add(pair)
                        out.add((rows[j][0], nodes[i]))
            u, v = zip(*sorted(out)) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    dealt = left.union(right).repartition("tree", "first", "second").sortWithinPartitions("tree", "first", "second", "side")
    return dealt.mapInArrow(compare, "u long, v long")


def groups(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, k: int = K, least: int = LEAST,
           light: int = LIGHT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``least`` of ``k`` belongs to ``percent``; lower it with them.
    """
    rows = C.materialise(sketches(docs, text, shingle, k), "sketches")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("row")
    nodes = rows.filter("n > 0").groupBy("key").agg(one, F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = C.materialise(nodes.select(F.monotonically_increasing_id().alias("node"), "key", "n", "row.doc_id", "row.mark", "sketch"), "nodes")
    pairs, long_ = meet(run_keys(nodes), light)
    pairs = C.materialise(likely(pairs, nodes, k, least, percent), "pairs")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).union(long_.select("node")).distinct()
    wanted = C.materialise(nodes.join(wanted, "node").select("node", "key", "doc_id", "mark"), "wanted")
    sets = C.materialise(full_sets(docs, wanted, text, shingle), "sets")
    links = C.materialise(verified(pairs, sets, percent), "links")
    roots = C.materialise(_roots(nodes, links), "roots")
    # long lists that hold more than one component
    lists = long_.join(roots, "node")
    open_ = C.materialise(lists.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b").select("key"), "open")
    left = C.materialise(lists.join(open_, "key").select("node").distinct(), "left")
    if left.limit(1).count():
        again = C.materialise(_rest(sets.join(left, "node"), roots, percent, light), "links")
        if again.limit(1).count():
            roots = C.materialise(_roots(nodes, links.union(again)), "roots")
    named = nodes.select("node", "key", "doc_id").join(roots, "node")
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = C.materialise(named.join(ids, "root").select("key", "component_id"), "named")
    whole = rows.join(named, "key", "left")
    return whole.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _rest(sets: DataFrame, roots: DataFrame, percent: int, light: int) -> DataFrame:
    """Links between components among the nodes of long lists."""
    pairs, long_ = meet(prefixes(sets, percent), light)
    apart = _with_both(pairs, roots, ["root"]).filter("root_u != root_v").select("u", "v")
    stars = pairs.filter("long")
    return verified(apart, sets, percent).union(families(long_, stars, sets, roots, percent))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows of every document; the one with the component's id is kept."""
    found = groups(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
