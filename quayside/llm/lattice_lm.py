r"""Operator 9: language-model scoring by the likelihood of subword lattices.

A text's probability is that of its words and of one end; a word's is the sum
over all its segmentations into pieces of the product of piece probabilities,
by forward recursion in log space over the word's bytes.  Pieces are those of an
existing vocabulary; its scores, which are ranks there, give first weights by
Zipf's law, and expectation-maximisation over every word of the training
texts, weighted by its count, replaces them (``ROUNDS`` rounds; the vocabulary's
weights stay as ``PRIOR`` pseudo-counts).  Bytes that no piece spells have byte pieces.

Words are counted in tasks before they are shuffled.  To score, a document
sends its distinct words to shards by a hash of the word, packed into one row a
shard; a shard has the counts of its words and computes each word's lattice
once; sums by document come back.  A shard is split by documents, so that a split has about
``SPLIT_TOKENS`` tokens of training text however many documents there are; each split gets the
shard's counts.  A frequent word is one entry of a row, so no
key is hot; the end, which every document has, is sent to a shard by the document, and its count to all.
Only the piece table (bounded by the vocabulary) and totals reach the driver.
A row is known by its id and 128 bits of its text's digest.

Null texts count as empty: one end.  A null id counts as the empty string when
texts are split into training and held out.  Rows that repeat give a row each,
with the same scores.  An empty table gives no rows.  Very long texts, and words of any length, are scored
whole.  Extra columns are left out, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

VOCABULARY = "piece_bpe_32k.model"
ROUNDS, PRIOR, ZIPF = 1, 1000.0, 2.7
FOLDS, HELD = 7, 2
SHARDS, SHARD_WORDS, SPLIT_TOKENS = 16, 1 << 18, 1 << 22
COUNTED = 400_000  # distinct words that a task counts before it sends them on
PACKED = 200_000  # distinct words of documents that a task packs at a time
CELLS = 1 << 21  # lattice cells computed at a time
BASE = np.uint64(0x9E3779B97F4A7C15)
END = b""  # the end of a text: no word is empty


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD


def words(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case; both byte methods know ASCII only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Pieces:
    """A vocabulary's pieces as byte strings: word starts are marked by a leading space; bytes 0-255 come first."""

    def __init__(self, spelt: list[bytes], rank: list[float]):
        self.n = 256 + len(spelt)
        weight = np.concatenate([np.full(256, min([1.0, *(1 / (ZIPF + r) for r in rank)])), [1 / (ZIPF + r) for r in rank]])
        self.start = np.log(weight / weight.sum())
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by: dict[int, list[tuple[int, int]]] = {}
        for i, p in enumerate(spelt):
            by.setdefault(len(p), []).append((int(prefix_hash(np.frombuffer(p, np.uint8)[None])[0, -1]), 256 + i))
        for size, rows in by.items():
            rows.sort()
            self.tables[size] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64))
        self.longest = max(self.tables, default=1)

    def edges(self, x: np.ndarray) -> np.ndarray:
        """For words of one length (rows of bytes): [end, size - 1, word] -> piece or -1."""
        n, size = x.shape
        top = min(size, self.longest)
        out = np.full((size + 1, top, n), -1, np.int32)
        h = prefix_hash(x)
        powers = np.cumprod(np.full(top, BASE))
        for k in range(1, top + 1):
            if k in self.tables:
                keys, ids = self.tables[k]
                part = h[:, k:] - h[:, :-k] * powers[k - 1]
                at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
                out[k:, k - 1] = np.where(keys[at] == part, ids[at], -1).T
        single = out[1:, 0]
        out[1:, 0] = np.where(single < 0, x.T, single)
        return out


def prefix_hash(x: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of each row, the empty one first, modulo 2 ** 64."""
    h = np.zeros((x.shape[0], x.shape[1] + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(x.shape[1]):
            h[:, j + 1] = h[:, j] * BASE + x[:, j] + np.uint64(1)
    return h


def forward(edges: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """[end, word]: log probability of all segmentations of the first ``end`` bytes."""
    size, top, n = edges.shape[0] - 1, edges.shape[1], edges.shape[2]
    alpha = np.zeros((size + 1, n))
    for j in range(1, size + 1):
        m = min(j, top)
        e = edges[j, :m]
        t = np.where(e >= 0, logp[e] + alpha[j - m:j][::-1], -np.inf)
        most = t.max(0)
        alpha[j] = most + np.log(np.exp(t - most).sum(0))
    return alpha


def expected(edges: np.ndarray, logp: np.ndarray, alpha: np.ndarray, count: np.ndarray, total: np.ndarray) -> None:
    """Adds to ``total`` the expected uses of each piece in words that occur ``count`` times."""
    size, top, n = edges.shape[0] - 1, edges.shape[1], edges.shape[2]
    beta = np.full((size + 1, n), -np.inf)
    beta[size] = 0.0
    for j in range(size, 0, -1):  # beta[j] is final: all that starts at j has been taken back
        m = min(j, top)
        e = edges[j, :m]
        t = np.where(e >= 0, logp[e] + beta[j], -np.inf)
        before = alpha[j - m:j][::-1]
        use = np.exp(t + before - alpha[size]) * count
        there = e >= 0
        total += np.bincount(e[there], use[there], minlength=len(total))
        back = beta[j - m:j][::-1]
        np.logaddexp(back, t, out=back)


def by_length(given: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words with a leading space, as matrices of one length each; with their places in ``given``."""
    sizes = np.fromiter(map(len, given), np.int64, len(given))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for part in np.split(order, cuts):
        if not len(part):
            continue
        size = int(sizes[part[0]]) + 1
        step = max(1, CELLS // (size * min(size, 16)))
        for i in range(0, len(part), step):
            at = part[i:i + step]
            x = np.frombuffer(b"".join([b" " + given[k] for k in at]), np.uint8).reshape(len(at), size)
            yield at, x


def read_pieces(path: str) -> Pieces:
    """The pieces of a sentencepiece model that can occur in a word, with their ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelt, rank = [], []
    for i in range(model.get_piece_size()):
        p, score = model.id_to_piece(i), model.get_score(i)
        raw = p.replace("▁", " ").encode()
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) or score < -1e8 or b" " in raw[1:]:
            continue
        spelt.append(raw)
        rank.append(max(0.0, -score))
    return Pieces(spelt, rank)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each word, and the end, occurs in ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([*found], pa.binary()), pa.array([*found.values()], pa.int64())], ["word", "n"])

        found: Counter = Counter()
        for b in batches:
            for t in b["text"].to_pylist():
                found.update(words(t))
                found[END] += 1
                if len(found) > COUNTED:
                    yield send()
                    found.clear()
        if found:
            yield send()

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train(counts: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces, and of the end, from word counts."""
    logp, end = pieces.start, 0.0
    ends = counts.filter(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0
    for _ in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], logp: np.ndarray = logp) -> Iterator[pa.RecordBatch]:
            total = np.zeros(pieces.n)
            for b in batches:
                given, n = b["word"].to_pylist(), np.array(b["n"].to_pylist(), np.float64)
                for at, x in by_length(given):
                    e = pieces.edges(x)
                    expected(e, logp, forward(e, logp), n[at], total)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.float64())], ["piece", "uses"])

        uses = counts.filter(F.length("word") > 0).mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
        total = np.zeros(pieces.n)
        for r in uses.orderBy("piece").collect():  # as many rows as pieces at most
            total[r["piece"]] = r["uses"]
        weight = total + PRIOR * np.exp(pieces.start)
        whole = weight.sum() + ends + 1
        logp, end = np.log(weight / whole), float(np.log((ends + 1) / whole))
    return logp, end


def _packed(docs: DataFrame, shards: int, splits: int, text: str) -> DataFrame:
    """Rows (shard, doc_id, h, words, n, tokens): a document's distinct words of each shard; tokens in one row of each.

    ``shard`` numbers the splits of all shards.
    """
    def send(ids: list, digests: list[bytes], sizes: list[int], flat: list[bytes], n: list[int], tokens: list[int]) -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(sizes)), sizes)
        shard = np.fromiter(map(crc32, flat), np.int64, len(flat)) % shards
        last = np.zeros(len(flat), bool)
        last[np.cumsum(sizes) - 1] = True  # a document's last entry is its end
        shard[last] = [crc32(h) % shards for h in digests]
        order = np.argsort(doc * shards + shard, kind="stable")
        key = (doc * shards + shard)[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        cuts = [*starts.tolist(), len(flat)]
        spelt = [flat[i] for i in order.tolist()]
        owner = key[starts] // shards
        split = np.array([crc32(h, 1) % splits for h in digests])
        return pa.RecordBatch.from_arrays([
            pa.array(key[starts] % shards * splits + split[owner], pa.int32()),
            pa.array(ids, pa.int64()).take(pa.array(owner)), pa.array(digests, pa.binary()).take(pa.array(owner)),
            pa.array([b" ".join(spelt[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary()),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.array(n, np.int32)[order])),
            pa.array(np.array(tokens, np.int64)[owner], mask=~np.logical_or.reduceat(last[order], starts))],
            ["shard", "doc_id", "h", "words", "n", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, ...] = ([], [], [], [], [], [])
        for b in batches:
            for doc, h, t in zip(*[b[c].to_pylist() for c in ("doc_id", "h", "text")]):
                found = Counter(words(t))
                found[END] = 1
                ids, digests, sizes, flat, n, tokens = held
                ids.append(doc)
                digests.append(h)
                sizes.append(len(found))
                flat.extend(found)
                n.extend(found.values())
                tokens.append(found.total())
                if len(flat) > PACKED:
                    yield send(*held)
                    held = ([], [], [], [], [], [])
        if held[0]:
            yield send(*held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.md5(C.whole_text(text).cast("binary"))).alias("h"), F.col(text).alias("text")).mapInArrow(
        run, "shard int, doc_id long, h binary, words binary, n array<int>, tokens long")


def _shard_sums(pieces: Pieces, logp: np.ndarray, end: float) -> Callable:
    """A task's work: a shard's counts come first, then the documents' words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place = None, {}
        base, lattice, known = np.zeros(0), np.zeros(0), np.zeros(0)
        for b in batches:
            shards = b["shard"].to_numpy().astype(np.int64)
            kinds = b["kind"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards * 2 + kinds)) + 1).tolist(), len(shards)]
            for i, j in zip(cuts, cuts[1:]):
                if shards[i] != shard:
                    shard, place = shards[i], {}
                    base, lattice, known = np.zeros(0), np.zeros(0), np.zeros(0)
                part = b.slice(i, j - i)
                spelt = part["words"].to_pylist()
                if kinds[i] == 0:
                    place.update(zip(spelt, range(len(place), len(place) + len(spelt))))
                    count = part["tokens"].to_numpy()
                    base = np.append(base, np.log10(count + 1.0))
                    known = np.append(known, count > 0)
                    continue
                flat = b" ".join(spelt).split(b" ")
                ids = np.fromiter(map(place.get, flat, repeat(-1)), np.int64, len(flat))
                for k in np.flatnonzero(ids < 0).tolist():  # words that training has not seen
                    ids[k] = place.setdefault(flat[k], len(place))
                if len(lattice) < len(place):
                    old = len(lattice)
                    fresh = [*islice(reversed(place), len(place) - old)][::-1]
                    lattice = np.append(lattice, np.zeros(len(fresh)))
                    for at, x in by_length(fresh):
                        lattice[old + at] = end if x.shape[1] == 1 else forward(pieces.edges(x), logp)[-1]
                    more = np.zeros(len(place) - len(base))  # their counts are 0
                    base, known = np.append(base, more), np.append(known, more)
                tf = part["n"].flatten().to_numpy().astype(np.float64)
                sizes = part["n"].value_lengths().to_numpy()
                starts = np.cumsum(sizes) - sizes
                sums = [np.add.reduceat(v, starts) for v in (base[ids] * tf, lattice[ids] * tf, known[ids] * tf)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["h"], pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2].astype(np.int64)), part["tokens"]],
                    ["doc_id", "h", "base", "lattice", "known", "tokens"])

    return run


def score(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    counts = C.materialise(count_words(docs.filter(~held_out()), text), "counts")
    x = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = x["n"] or 0, x["v"]
    pieces = read_pieces(path or vocabulary_path())
    logp, end = train(counts, pieces, rounds)
    shards = max(SHARDS, -(-distinct // SHARD_WORDS))
    splits = max(1, -(-total // (shards * SPLIT_TOKENS)))
    where = F.when(F.length("word") == 0, F.sequence(F.lit(0), F.lit(shards * splits - 1))).otherwise(F.transform(
        F.sequence(F.lit(0), F.lit(splits - 1)), lambda i: (F.pmod(F.crc32("word"), F.lit(shards)) * splits + i).cast("int")))
    known = counts.select(
        F.explode(where).alias("shard"), F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("h"), F.col("word").alias("words"),
        F.lit(None).cast("array<int>").alias("n"), F.col("n").alias("tokens"))
    asked = _packed(docs, shards, splits, text).select("shard", F.lit(1).alias("kind"), "doc_id", "h", "words", "n", "tokens")
    dealt = known.union(asked).repartition("shard").sortWithinPartitions("shard", "kind")
    sums = dealt.mapInArrow(_shard_sums(pieces, logp, end),
                            "doc_id long, h binary, base double, lattice double, known long, tokens long")
    # rows that repeat have one key: ``tokens`` is there once a row, so its count is that of the rows
    per = sums.groupBy("doc_id", "h").agg(F.sum("base").alias("base"), F.sum("lattice").alias("lattice"), F.sum("known").alias("known"),
                                          F.sum("tokens").alias("tokens"), F.count("tokens").alias("rows"))
    rows = per.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    n = (F.col("tokens") / F.col("rows")).cast("long")
    norm = float(np.log10(total + distinct + 1.0))
    return rows.select(
        F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]).alias("doc_id"), held_out().alias("held_out"), n.alias("n_tokens"),
        (F.col("known") / F.col("rows")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows") - n * norm).alias("base_score"),
        (F.col("lattice") / F.col("rows") / float(np.log(10.0))).alias("score"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows of every document."""
    return score(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
