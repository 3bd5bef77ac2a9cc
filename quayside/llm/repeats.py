r"""Operator 3: removal of repeated passages by a run-length index.

A byte goes if a ``length``-byte string that covers it also starts earlier.

1. Phrases.  Each window of ``length`` bytes has one anchor, its 16-byte gram of
   least hash (the leftmost), so equal windows have equal anchors at equal
   places.  A maximal row of windows with one anchor is a phrase: a text is cut
   into phrases by its content alone, about one in 43 bytes.
2. Copies.  Phrases meet by anchor.  Every phrase that equals an earlier one is
   repeated whole.  Tasks first settle copies among their own phrases, so a
   passage that a third of the rows share sends few of them on.
3. Index.  Only differing phrases of one anchor can hide more.  A window they share
   reaches half of what it has beside the anchor to the left of it or more than that to the
   right, so they agree in a hash of one of these sides (``sides``): the others, which a frequent
   word or two bring together and whose number grows faster than the input, end here.  One copy of each
   phrase that is left is fetched.  A task gathers whole anchors to a few MB and
   builds a run-compressed Burrows-Wheeler transform of them, keeping at each
   run's start the text position, that of the previous run's end and the length
   that both share.  Streaming through the text, the matching statistic of any
   position and the place of its match follow from the last sample before it.
   Matches of ``length`` or more link windows; all but a group's first go.
   An anchor with more than ``MANY`` phrases left is settled by digests of its windows
   instead, counted before the shuffle, so that no task gets it whole.
4. Marks are gathered by document and joined back.

Memory: a task holds one slice of a text or one index.  Equality of phrases is
by 128 bits of hash (the anchor's and the phrase's), that of windows of crowded
anchors by MD5; the index compares bytes.

Null texts count as empty.  A null id is before all others.  Rows that repeat an id and
its text count as one document and get equal rows; rows of one id with
different texts are ordered by 128 bits of hash of the text.  An empty table gives no rows.
Of equal passages the one in the smaller id, or earlier in its text, stays.  Extra columns are left out,
whatever their names.
A lost task is run again on the same rows in the same order when the documents
come from files, as here; give documents that come out of a shuffle through a
written table first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

LENGTH, GRAM = 100, 16
SLICE = 1 << 20  # bytes hashed at a time
HELD = 400_000  # phrases among which a task settles copies by itself
INDEXED = 1 << 19  # bytes of an index
MANY = 4096
PLACE = np.uint64((1 << 22) - 1)
NULL_ID = -(1 << 63)
END = 0xFF  # ends a phrase in an index; no byte of UTF-8


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in order."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def grams(buf: np.ndarray, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hashes of all substrings of the sizes, powers of two, by doubling."""
    h, size, out = mix(buf.astype(np.uint64), np.uint64(7)), 1, {}
    while True:
        if size in sizes:
            out[size] = h
        if size >= max(sizes):
            return out
        h = mix(h[:-size], h[size:]) if len(h) > size else h[:0]
        size *= 2


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def sides(h: np.ndarray, a: np.ndarray, start: np.ndarray, n: np.ndarray, length: int, gram: int) -> np.ndarray:
    """32 bits of hash of the anchor with what is left of it, and 32 with what is right; a side without the bytes is 0.

    A window has ``length - gram`` bytes beside its anchor: half of them are left of it, or more than the other half right.
    So phrases of one anchor that share a window have a side in common that is not 0.  ``h``: hashes of strings of a
    power of two, of which two cover a side.
    """
    left = (length - gram + 1) // 2
    right = length - gram - left + 1
    part = power(gram + min(left, right))

    def side(at: np.ndarray, size: int, has: np.ndarray) -> np.ndarray:
        at = np.where(has, at, 0)
        both = mix(h[at], h[at + size - part]) >> np.uint64(32)
        return np.where(has, both | np.uint64(1), np.uint64(0))

    lefts = side(a - left, left + gram, a - start >= left)
    rights = side(a, right + gram, start + n - 1 + length >= a + gram + right)
    return (lefts << np.uint64(32)) | rights


def power(size: int) -> int:
    """The greatest power of two up to ``size``."""
    return 1 << (size.bit_length() - 1)


def phrases(buf: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Start, windows, anchor hash, phrase hash and sides of each phrase, for windows that start in any [first, last)."""
    gram = GRAM if length >= 2 * GRAM else 1 << max(0, (length // 2).bit_length() - 1)
    wide, part = power(length), power(gram + (length - gram + 1) // 2)
    if not len(first) or len(buf) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(2)) + tuple(np.zeros(0, np.uint64) for _ in range(3))
    h = grams(buf, (gram, wide, part))
    key = (h[gram] & ~PLACE) | np.arange(len(h[gram]), dtype=np.uint64)
    anchor = (window_min(key, length - gram + 1) & PLACE).astype(np.int64)
    step = np.zeros(len(anchor) + 1, np.int8)
    np.add.at(step, first, 1)
    np.add.at(step, last, -1)
    at = np.flatnonzero(np.cumsum(step[:-1]))
    a = anchor[at]
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(a) != 0)))
    new[np.isin(at, first)] = True
    cut = np.flatnonzero(new)
    start, n, a = at[cut], np.diff(np.append(cut, len(at))), a[cut]
    room = n + length - 1 - wide  # four strings of ``wide`` bytes cover the phrase
    digest = mix(n.astype(np.uint64), (a - start).astype(np.uint64))
    for k in range(4):
        digest = mix(digest, h[wide][start + room * k // 3])
    return start, n, h[gram][a], digest, sides(h[part], a, start, n, length, gram)


#: ``sides`` is 0 of copies only; ``span``: start and number of windows, 32 bits each
PHRASE = ["anchor", "phrase", "sides", "doc", "h", "g", "span"]


def settle(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Of a task's phrases (anchor, phrase, sides, doc, h, g, start, n): copies of an earlier one are marked and joined up."""
    anchor, phrase, side, doc, h, g, start, n = cols
    o = np.lexsort((start, g, h, doc, phrase, anchor))
    anchor, phrase, side, doc, h, g, start, n = (x[o] for x in (anchor, phrase, side, doc, h, g, start, n))
    new = np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(phrase) != 0)))
    lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    copy = (doc != doc[lead]) | (h != h[lead]) | (g != g[lead]) | (start != start[lead])
    c = np.flatnonzero(copy)
    c = c[np.lexsort((start[c], g[c], h[c], doc[c]))]
    if len(c):  # copies side by side become one row
        joint = (np.diff(doc[c]) == 0) & (np.diff(h[c]) == 0) & (np.diff(g[c]) == 0) & (start[c][1:] <= (start[c] + n[c])[:-1])
        head = np.flatnonzero(np.concatenate(([True], ~joint)))
        stop = np.maximum.reduceat(start[c] + n[c], head)
        c = c[head]
        n = n.copy()
        n[c] = stop - start[c]
        anchor = anchor.copy()  # spreads them: they need meet no one
        anchor[c] = mix(doc[c].astype(np.uint64), start[c].astype(np.uint64)).view(np.int64)
    k = np.concatenate((np.flatnonzero(~copy), c))
    return [anchor[k], phrase[k], np.where(copy, 0, side)[k], doc[k], h[k], g[k], (start[k] << 32) | n[k]]


def cut_phrases(docs: DataFrame, length: int) -> DataFrame:
    """Phrases of (doc, h, g, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def add(parts: list[tuple[int, int, int, bytes, int]]) -> None:
            # each part: doc, h, g, bytes, offset in the document; windows start in all but the last length - 1 bytes
            sizes = np.array([len(p[3]) for p in parts], np.int64)
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            buf = np.frombuffer(b"".join([p[3] for p in parts]), np.uint8)
            start, n, anchor, phrase, side = phrases(buf, first, first + sizes - length + 1, length)
            own = np.searchsorted(first, start, side="right") - 1
            doc, h, g, off = (np.array([p[i] for p in parts], np.int64)[own] for i in (0, 1, 2, 4))
            held.append([*(x.view(np.int64) for x in (anchor, phrase, side)), doc, h, g, start - first[own] + off, n])

        def send() -> pa.RecordBatch:
            cols = settle([np.concatenate(x) for x in zip(*held)])
            held.clear()
            return pa.RecordBatch.from_arrays([*map(pa.array, cols)], PHRASE)

        for b in batches:
            parts, size = [], 0
            for doc, h, g, t in zip(*[b[c].to_pylist() for c in ("doc", "h", "g", "text")]):
                raw = (t or "").encode("utf-8", "surrogatepass")
                for at in range(0, max(0, len(raw) - length + 1), SLICE):
                    parts.append((doc, h, g, raw[at:at + SLICE + length - 1], at))
                    size += len(parts[-1][3])
                    if size >= SLICE:
                        add(parts)
                        parts, size = [], 0
                        if sum(len(x[0]) for x in held) >= HELD:
                            yield send()
            if parts:
                add(parts)
        if held:
            yield send()

    return docs.select("doc", "h", "g", "text").mapInArrow(
        run, ", ".join(f"{x} long" for x in PHRASE))


def dense(key: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct keys."""
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], np.diff(key[order]) != 0)))
    return rank


def run_length_index(text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
    """Run samples of the Burrows-Wheeler transform of phrases that each end in END.

    ``left``: bytes from each position to its phrase's end.  Ends are distinct
    symbols, in order of place.  Returns, by text position of the samples: the
    position, that of the suffix before it in order (the previous run's end),
    and how many bytes both share.
    """
    n = len(text)
    grown = np.concatenate((text, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | np.where(i <= left, grown[i:n + i], 0).astype(np.uint64)
    ranks, size = [], 8
    rank = dense(key)
    longest = int(left.max(initial=0)) + 1
    while True:
        ranks.append((size, rank))
        if size >= longest:
            break
        bits = int(rank.max() + 2).bit_length()
        key, many = rank.astype(np.uint64) + np.uint64(1), max(2, min(4, 63 // bits))
        for i in range(1, many):  # as many ranks side by side as a key can hold; a phrase that ended has nothing after
            after = np.zeros(n, np.uint64)
            after[:max(0, n - i * size)] = rank[i * size:]
            key = (key << np.uint64(bits)) | np.where(left >= i * size, after + np.uint64(1), np.uint64(0))
        rank, size = dense(key), size * many
    order = np.argsort(rank.astype(np.int64) * n + np.arange(n))  # phrases that are alike to their ends: by place
    before = np.where(order > 0, text[order - 1], END)
    head = np.concatenate(([True], (before[1:] != before[:-1]) | (before[1:] == END)))
    k = np.flatnonzero(head)
    place, prior = order[k], np.where(k > 0, order[k - 1], 0)
    x, y, shared = place.copy(), prior.copy(), np.zeros(len(k), np.int64)
    for (size, rank), up in zip(reversed(ranks), [2 * ranks[-1][0], *(r[0] for r in reversed(ranks))]):
        for _ in range(up // size - 1):
            same = (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)]) & (x < n) & (y < n)
            for v in (x, y, shared):
                v[same] += size
    for _ in range(7):
        same = (x < n) & (y < n) & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])
        for v in (x, y, shared):
            v[same] += 1
        if not same.any():
            break
    shared = np.where(k > 0, np.minimum(shared, np.minimum(left[place], left[prior])), 0)
    o = np.argsort(place)
    return place[o], prior[o], shared[o]


def repeated_windows(text: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Positions whose ``length`` bytes also start earlier in ``text``."""
    place, prior, shared = run_length_index(text, left)
    at = np.arange(len(text))
    sample = np.searchsorted(place, at, side="right") - 1
    ahead = at - place[sample]
    match = prior[sample] + ahead
    statistic = shared[sample] - ahead
    to = np.where(statistic >= length, match, at)
    while True:
        far = to[to]
        if (far == to).all():
            break
        to = far
    least = np.full(len(text), len(text))
    np.minimum.at(least, to, at)
    return np.flatnonzero(least[to] != at)


MARK = ["doc", "h", "g", "start", "stop", "bytes"]


def index_marks(cut: DataFrame, length: int) -> DataFrame:
    """Marks (doc, h, g, start, stop, no bytes) in phrases (key, doc, h, g, start, n, crowded, bytes), by one index for each few
    MB of whole keys.  Phrases without bytes are copies and marked whole; crowded ones come back with their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(rows: list[tuple]) -> pa.RecordBatch:
            rows = sorted({r[1:5]: r for r in rows}.values(), key=lambda r: r[1:5])  # rows that repeat bring a phrase twice
            doc, h, g, start = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3, 4))
            sizes = np.array([len(r[5]) + 1 for r in rows], np.int64)
            stop = np.cumsum(sizes)
            text = np.frombuffer(bytes([END]).join([r[5] for r in rows]) + bytes([END]), np.uint8)
            left = np.repeat(stop, sizes) - 1 - np.arange(len(text))
            at = repeated_windows(text, left, length)
            own = np.searchsorted(stop, at, side="right")
            new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(own) != 0))) if len(at) else np.zeros(0, bool)
            a = np.flatnonzero(new)
            z = np.append(a[1:], len(at)) - 1 if len(a) else a
            o = own[a]
            shift = start[o] - (stop - sizes)[o]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[o], h[o], g[o], at[a] + shift, at[z] + shift + length)]
                                              + [pa.nulls(len(o), pa.binary())], MARK)

        rows: list[tuple] = []
        size, key = 0, None
        for b in batches:
            past = pc.or_(pc.is_null(b["bytes"]), b["crowded"])
            done = b.filter(past)
            if len(done):
                stop = pc.add(pc.add(done["start"], done["n"]), length - 1)
                yield pa.RecordBatch.from_arrays([*(done[c] for c in MARK[:4]), stop, done["bytes"].cast(pa.binary())], MARK)
            b = b.filter(pc.invert(past))
            for r in zip(*[b[c].to_pylist() for c in ("key", "doc", "h", "g", "start", "bytes")]):
                if r[0] != key and size >= INDEXED:
                    yield work(rows)
                    rows, size = [], 0
                key = r[0]
                rows.append(r)
                size += len(r[5]) + 1
        if rows:
            yield work(rows)

    dealt = cut.repartition("key").sortWithinPartitions("key")
    return dealt.select("key", "doc", "h", "g", "start", "n", "crowded", "bytes").mapInArrow(
        run, "doc long, h long, g long, start long, stop long, bytes binary")


def crowded_marks(cut: DataFrame, length: int) -> DataFrame:
    """Marks (doc, h, g, start, stop) in phrases (doc, h, g, start, bytes) of anchors with many: every window by its digest."""
    windows = F.transform(F.sequence(F.lit(0), F.length("bytes") - length), lambda i: F.struct(
        F.md5(F.substring(F.col("bytes"), i + 1, F.lit(length))).alias("digest"), (F.col("start") + i).alias("at")))
    rows = cut.select("doc", "h", "g", F.explode(windows).alias("w")).select("w.digest", F.struct("doc", "h", "g", "w.at").alias("p"))
    first = rows.groupBy("digest").agg(F.min("p").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return rows.join(first.select("digest", "first"), "digest").filter("p != first").select(
        "p.doc", "p.h", "p.g", F.col("p.at").alias("start"), (F.col("p.at") + length).alias("stop"))


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """A row's key: its id and 128 bits of hash of its text."""
    return docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
                             "_h": F.xxhash64(C.whole_text(text)), "_g": F.xxhash64(F.lit("second half"), C.whole_text(text))})


def marks(docs: DataFrame, length: int = LENGTH, text: str = "text", many: int = MANY) -> DataFrame:
    """(doc, h, g, start, stop): byte ranges to remove, which may overlap."""
    rows = keyed(docs.select("doc_id", text), text).select(
        F.col("_doc").alias("doc"), F.col("_h").alias("h"), F.col("_g").alias("g"), F.col(text).alias("text"))
    asked = C.materialise(asked_phrases(cut_phrases(rows, length), many), "phrases")  # its shuffle can go before texts are dealt
    cut = asked.join(
        rows.select("doc", "h", "g", F.col("text").cast("binary").alias("raw")), ["doc", "h", "g"])
    alone = F.xxhash64("doc", "h", "start")  # copies and phrases of crowded anchors need meet no one
    cut = cut.select(
        F.when(F.col("copy") | F.col("crowded"), alone).otherwise(F.col("anchor")).alias("key"), "doc", "h", "g", "start", "n", "crowded",
        F.when(~F.col("copy"), F.substring("raw", F.col("start").cast("int") + 1, F.col("n").cast("int") + length - 1)).alias("bytes"))
    found = C.materialise(index_marks(cut, length), "marks")
    return found.filter("bytes is null").drop("bytes").union(crowded_marks(found.filter("bytes is not null"), length))


def asked_phrases(cut: DataFrame, many: int) -> DataFrame:
    """(copy, crowded, anchor, doc, h, g, start, n) of phrases: all that repeat an earlier one, and of the others, one for each
    phrase, those with a side in common with another of their anchor; crowded: beyond ``many`` of the anchor.

    One shuffle: all is by anchor, and rows sorted for one step serve the next where they can.
    """
    near, same = Window.partitionBy("anchor"), Window.partitionBy("anchor", "phrase").orderBy("doc", "h", "g", "span")
    low = F.lit((1 << 32) - 1)
    others = F.sum(F.when(F.col("copy"), 0).otherwise(1))
    met = (cut.repartition("anchor").withColumns({"rank": F.rank().over(same), "row": F.row_number().over(same)})
           .withColumn("copy", (F.col("sides") == 0) | (F.col("rank") > 1))
           .filter("copy or row = 1")  # rows that repeat bring a phrase twice
           .withColumn("others", others.over(near)).filter("copy or others > 1")
           .withColumns({"left": F.shiftrightunsigned("sides", 32), "right": F.col("sides").bitwiseAND(low)})
           .withColumn("lefts", others.over(Window.partitionBy("anchor", "left")))
           .withColumn("rights", others.over(Window.partitionBy("anchor", "right")))
           .filter("copy or left != 0 and lefts > 1 or right != 0 and rights > 1")
           .withColumn("others", others.over(near)))
    return met.select("copy", (~F.col("copy") & (F.col("others") > many)).alias("crowded"), "anchor", "doc", "h", "g",
                      F.shiftrightunsigned("span", 32).alias("start"), F.col("span").bitwiseAND(low).alias("n"))


def with_marks(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """``docs`` with ``gone``: the byte ranges (start, stop) to remove, unordered; null if none."""
    found = marks(docs, length, text).groupBy(F.col("doc").alias("_doc"), F.col("h").alias("_h"), F.col("g").alias("_g")).agg(
        F.collect_set(F.struct("start", "stop")).alias("gone"))
    return keyed(docs, text).join(found, ["_doc", "_h", "_g"], "left").drop("_doc", "_h", "_g")


def removed(raw: bytes, gone: list | None) -> tuple[bytes, int, int]:
    """What is left of ``raw``, how many bytes went, and in how many maximal runs."""
    kept, at, n, runs = [], 0, 0, 0
    last = -1
    for r in sorted((g["start"], g["stop"]) for g in gone or ()):
        a, b = max(r[0], at), r[1]
        if b <= a:
            continue
        if a > last:
            runs += 1
        kept.append(raw[at:a])
        n += b - a
        at = last = b
    kept.append(raw[at:])
    return b"".join(kept), n, runs


def remove(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the bytes that stay, which may split a character, in ``kept``."""
    return _removed(docs, length, text, lambda kept: kept, pa.binary(), "kept binary")


def _removed(docs: DataFrame, length: int, text: str, made, kind: pa.DataType, sql: str) -> DataFrame:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", sql.split()[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t, gone in zip(b["text"].to_pylist(), b["gone"].to_pylist()):
                raw = (t or "").encode("utf-8", "surrogatepass")
                kept, n, runs = removed(raw, gone)
                rows.append((len(raw), n, runs, made(kept)))
            cols = [*zip(*rows)] or [[]] * 4
            yield pa.RecordBatch.from_arrays([b["doc_id"], *map(pa.array, cols, (pa.int64(),) * 3 + (kind,))], names)

    marked = with_marks(docs.select("doc_id", F.col(text).alias("text")), length)
    return marked.select("doc_id", "text", "gone").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, {sql}")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows of every document."""
    return _removed(C.table(spark, sf_dir, "documents"), LENGTH, "text", lambda kept: hashlib.sha256(kept).hexdigest(),
                    pa.string(), "kept_sha256 string")
