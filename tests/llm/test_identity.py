"""Rows that share an id, or have none, are told apart by 128 bits; a ledger that repeats itself counts once."""

import itertools
import random
import zlib
from collections import Counter

import pytest

from quayside.llm import lattice_lm, repeats, secret_scan, simhash

from . import brute


def equal_checksums(n=220):
    """Two different texts of equal CRC32: bits are added to one until their effects on the checksum cancel."""
    rng = random.Random(8)
    base = bytearray("".join(rng.choice("abcdefgh ") for _ in range(n)).encode())
    # the CRC is affine: flipping bit i changes it by an amount that doesn't depend on the other bits
    places = list(range(0, n, 3))
    rows = {}
    for at in places:
        changed = bytearray(base)
        changed[at] ^= 1
        delta, used = zlib.crc32(base) ^ zlib.crc32(changed), frozenset([at])
        while delta:
            top = delta.bit_length()
            if top not in rows:
                rows[top] = (delta, used)
                break
            delta, used = delta ^ rows[top][0], used ^ rows[top][1]
        else:
            other = bytearray(base)
            for i in used:
                other[i] ^= 1
            return base.decode(), other.decode()


def test_texts_of_equal_checksum_without_an_id(spark):
    a, b = equal_checksums()
    assert a != b and zlib.crc32(a.encode()) == zlib.crc32(b.encode())
    passage = " ".join(f"word{i}" for i in range(60))
    rng = random.Random(1)
    tail = "".join(rng.choice("xyz ") for _ in range(300))
    # both texts keep their checksum behind equal beginnings; the passage repeats in the first only
    rows = [(1, passage), (None, a + tail), (None, b + tail), (None, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in repeats.remove(df).collect())
    removed = {n: x for n, x in got if n == len(passage)}
    assert removed  # one of the passages stays
    pair = sorted(x for n, x in got if n == len(a + tail))
    assert pair == [0, 300] or pair[0] == 0 and pair[1] >= 300  # the common end goes from one of the two only


def test_scores_of_texts_of_equal_checksum(spark):
    a, b = equal_checksums()
    df = spark.createDataFrame([(None, a), (None, b), (1, "some words to train on")], "doc_id long, text string")
    got = sorted(r.n_tokens for r in lattice_lm.score(df).collect() if r.doc_id is None)
    assert got == sorted(len(brute.WORD.findall(t)) + 1 for t in (a, b))


@pytest.mark.parametrize("tokens", [1 << 22, 5])
def test_scores_do_not_depend_on_the_splits(spark, monkeypatch, tokens):
    monkeypatch.setattr(lattice_lm, "SPLIT_TOKENS", tokens)
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["ein", "zwei", "drei", "Vier", f"n{i}"]) for _ in range(rng.randint(0, 400)))) for i in range(40)]
    docs.append((40, None))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.base_lm(docs)
    rows = lattice_lm.score(df).collect()
    for r in rows:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base)
    assert len(rows) == len(docs)


def plain_scores(docs):
    """The trained score by all segmentations of every word: one round of expectation-maximisation, then likelihoods."""
    import math

    pieces = lattice_lm.read_pieces(lattice_lm.vocabulary_path())
    spelt = {}

    def piece(b):
        if b not in spelt:
            import numpy as np
            e = pieces.edges(np.frombuffer(b, np.uint8)[None])[len(b), len(b) - 1, 0] if len(b) <= pieces.longest else -1
            spelt[b] = int(e)
        return spelt[b]

    def ways(w):
        for cuts in itertools.product([0, 1], repeat=len(w) - 1):
            ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(w)]
            parts = [piece(w[i:j]) for i, j in zip([0, *ends], ends)]
            if min(parts) >= 0:
                yield parts

    counts = Counter(w for d, t in docs if zlib.crc32(str(d).encode()) % 7 != 2 for w in lattice_lm.words(t))
    ends = sum(zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in docs)
    use = Counter()
    for w, n in counts.items():
        all_ = [(p, math.exp(sum(pieces.start[x] for x in p))) for p in ways(b" " + w)]
        whole = sum(x for _, x in all_)
        for p, x in all_:
            for one in p:
                use[one] += n * x / whole
    weight = [use[i] + lattice_lm.PRIOR * math.exp(pieces.start[i]) for i in range(pieces.n)]
    total = sum(weight) + ends + 1
    out = {}
    for d, t in docs:
        x = math.log((ends + 1) / total)
        for w in lattice_lm.words(t):
            x += math.log(sum(math.prod(weight[i] / total for i in p) for p in ways(b" " + w)))
        out[d] = x / math.log(10)
    return out


def test_trained_scores_by_all_segmentations(spark):
    docs = [(i, t) for i, t in enumerate(["the cat sat", "the the cats", "a satin", "cat naps", "sat at", "é at", "tea the", "", None, "that hat"])]
    want = plain_scores(docs)
    got = {r.doc_id: r.score for r in lattice_lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == pytest.approx(want)


def test_a_ledger_with_repeated_pairs_counts_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([(1, "token=abcdefgh"), (2, "plain")], "doc_id long, text string")
    once = [(r.row.doc_id, len(r.hits)) for r in secret_scan.scan(rows, path).collect()]
    copy = spark.read.parquet(path)
    spark.createDataFrame(copy.collect(), copy.schema).write.mode("append").parquet(path)  # the same scan recorded twice
    again = [(r.row.doc_id, len(r.hits)) for r in secret_scan.scan(rows, path).collect()]
    assert sorted(again) == sorted(once) == [(1, 1), (2, 0)]


def test_unrelated_texts_of_one_id_both_stay(spark):
    rng = random.Random(6)
    text = lambda: " ".join(f"t{rng.randint(0, 9999)}" for _ in range(80))
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, b), (2, c), (2, c), (3, a), (None, b), (None, None)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, a), (1, b), (2, c), (None, None)])


def test_a_scan_with_nothing_new_moves_no_text(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([(i, f"token=abcdefgh{i % 7}") for i in range(50)], "doc_id long, text string")
    fetched = []
    plain = secret_scan.texts_of
    monkeypatch.setattr(secret_scan, "texts_of", lambda blobs, todo: fetched.append(todo.count()) or plain(blobs, todo))
    assert secret_scan.update_ledger(rows, path).count() == secret_scan.update_ledger(rows, path).count() and fetched == [7]
    more = rows.union(spark.createDataFrame([(60, "new one")], rows.schema))
    secret_scan.update_ledger(more, path)
    assert fetched == [7, 1]
    pending = secret_scan.pending(rows.select(secret_scan.blob_of().alias("blob"), "text"), secret_scan.open_ledger(spark, path), secret_scan.RULES)
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Exchange" in x and "text" in x]


@pytest.mark.parametrize("few", [0, 10_000])
def test_few_and_many_new_blobs_give_the_same_ledger(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(secret_scan, "FEW", few)
    rows = spark.createDataFrame([(i, f"token=abcdefgh{i % 5}" if i % 3 else None) for i in range(60)], "doc_id long, text string")
    got = secret_scan.update_ledger(rows, str(tmp_path / "ledger"))
    assert got.select("blob").distinct().count() == 6 and got.count() == 6 * len(secret_scan.RULES)
