"""The dealt operators against plain versions, on whole small tables and on awkward rows."""

import itertools
import os
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import (bpe, chat, components, host_rules, lattice_lm, mixing, pii, queries, repeats, secret_scan,
                          simhash, topk)

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def awkward():
    """Texts that are null, empty, blank, repeated, very long, in other scripts, or full of patterns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("aeinrstlo") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    near = prose(80).split()
    texts = [
        None, "", " \t\n ", "word", "two words", "a b c", "A B c", passage, passage, prose(40) + passage + prose(30),
        passage[:150] + prose(50), "x" * 30_000, "ab" * 9_000 + " " + "1" * 9_000, prose(20_000), (prose(6) + "\n") * 80,
        " ".join(near), " ".join(near[:40] + ["changed"] + near[41:]), "日本語のテキスト🎉 Σας İstanbul ſecret", "a\x00b\x85c d",
        """password = "hunter2hunter" secret:abc token=token: abcdefgh API_KEY='Zx9/+=.-_' passwd:  "x y" apikey=ſ """,
        "AKIA" + "B" * 16 + " AKIAAKIAB AKIA" + "9" * 30 + " " + "0a" * 12 + " " + "f" * 23 + " xAKIA" + "Z" * 16,
        "a.b@c.de%f@g.hi, é@x.yz @a.b a@b 1.2.3.4.5.6.7.8 999.1.1.1 001.02.3.255 1.2.3",
        "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111111 4111--1111 +1 (555) 123-4567 +12 +1--- +49 30 901820",
        "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000 DE00370400440532013000", "tok:" * 500 + "=" * 600,
        "1 " * 3000, "9.9.9.9 " * 700, "+1234567 " * 300, "# * $ %\n# * $ %\n|<>\n" * 20, "<|endoftext|>x<|startoftext|>"]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """``documents`` of the awkward texts, with the first rows once more, a null in every column and clashing extra columns."""
    rows = [(i, t, None if i == 3 else "en", f"src{i % 3}" if i % 5 else None, len(t or "")) for i, t in awkward()]
    rows += rows[5:9] + [(None, "no id", None, None, None), (None, None, None, None, None), (None, "no id", "x", "s", 1)]
    d = str(tmp_path_factory.mktemp("odd"))
    df = spark.createDataFrame(rows, DOC)
    for c in ("row", "blob", "hits", "word", "fp", "kept", "host", "block", "place", "tokens", "spans", "n", "u", "_text", "_doc", "gone", "_first", "_id", "a.b"):
        df = df.withColumn(c, F.lit(1))
    df.coalesce(2).write.parquet(f"{d}/documents.parquet")
    return d


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], DOC).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d


PLAIN = {
    "op1_secret_scan": (("n_assign", "n_access", "n_hex", "base_sha256"), brute.secrets),
    "op6_pii": (("n_email", "n_ip", "n_card", "n_phone", "base_sha256"), brute.pii),
    "op4_host_rules": (("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), brute.quality),
}


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_row_contracts(spark, docs, odd, name):
    cols, plain = PLAIN[name]
    for d, texts in ((SF, docs), (odd, awkward())):
        texts = dict(texts) | {None: None}
        got = queries.QUERIES[name](spark, d).collect()
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in spark.read.parquet(f"{d}/documents.parquet").collect())
        for r in got:
            if r.doc_id is not None:
                assert tuple(r[c] for c in cols) == plain(texts[r.doc_id]), r.doc_id
    nameless = Counter(tuple(r[c] for c in cols) for r in got if r.doc_id is None)
    assert nameless == Counter([plain("no id")] * 2 + [plain(None)])


def test_clean_documents_are_kept_on_any_host(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "too short", "bad") for i in range(200)] + [(1000 + i, good, "bad") for i in range(5)]
    rows += [(2000 + i, good + " " + "#" * 30, "bad") for i in range(5)] + [(3000 + i, good + " " + "#" * 30, "good") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in host_rules.keep_good(df).collect()}
    assert kept >= set(range(1000, 1005)) and not kept & set(range(200)) and not kept & set(range(2000, 2005))


def test_pii_scores_validators_and_bank_accounts(spark):
    text = dict(awkward())[23]
    r = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    ibans = [s for s in r.spans if s.kind == "iban"]
    assert [text[s.start:s.end].replace(" ", "") for s in ibans] == ["GB82WEST12345698765432", "DE89370400440532013000"]
    assert ibans[0].score == 1.0


def test_rules_that_are_done_are_not_run(spark):
    rules = {"access": secret_scan.RULES["access"], "broken": "("}  # fails on any text it is run on
    todo = spark.createDataFrame([(b"x", "AKIA" + "B" * 16, [f"access:{secret_scan.version_of(rules['access'])}"])],
                                 "blob binary, text string, todo array<string>").repartition(1)
    got = secret_scan.scan_blobs(todo, rules).collect()
    assert [(r.rule, [tuple(x) for x in r.spans]) for r in got] == [("access", [(0, 20)])]
    with pytest.raises(Exception, match="REGEX|PATTERN|regex|pattern"):
        secret_scan.scan_blobs(todo.withColumn("todo", F.array(F.lit(f"broken:{secret_scan.version_of('(')}"))), rules).collect()


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([(1, "token=abcdefgh"), (2, "token=abcdefgh"), (3, "plain")], "doc_id long, text string")
    rules = {"assign": secret_scan.RULES["assign"]}
    assert secret_scan.update_ledger(rows, path, rules).count() == 2
    assert secret_scan.update_ledger(rows, path, rules).count() == 2  # nothing new
    more = rows.union(spark.createDataFrame([(4, "token=otherone")], rows.schema))
    assert secret_scan.update_ledger(more, path, rules).count() == 3  # one new blob
    assert secret_scan.update_ledger(more, path, secret_scan.RULES).count() == 15  # new rules for all blobs
    changed = {"assign": secret_scan.RULES["assign"] + "(?!z)"}
    assert secret_scan.update_ledger(more, path, changed).count() == 18
    found = {r.row.doc_id: [(h.kind, h.start, h.end) for h in r.hits] for r in secret_scan.scan(more, path).collect()}
    assert found == {1: [("assign", 0, 14)], 2: [("assign", 0, 14)], 3: [], 4: [("assign", 0, 14)]}


def test_redaction(spark, tmp_path):
    t = "é token=abcdefgh12345678 x AKIA" + "B" * 16 + " end " + "token=" + "0a" * 15
    out = secret_scan.redact(spark.createDataFrame([(1, t, len(t)), (2, None, None), (3, "ok", 99)], "doc_id long, text string, n_chars long"),
                             str(tmp_path / "ledger")).orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [(1, "é [SECRET] x [SECRET] end [SECRET]", 34), (2, None, None), (3, "ok", 99)]


def test_redaction_of_many_and_overlapping_spans(spark):
    rng = random.Random(9)
    rows = []
    for i in range(40):
        t = "".join(rng.choice("aé🎉 \n") for _ in range(rng.randint(1, 900)))
        spans = sorted((a, min(len(t), a + rng.choice((1, 2, 5, 60)))) for a in
                       (rng.randrange(len(t)) for _ in range(rng.choice((1, 3, 9, 200)))))
        out, at = "", 0
        for a, z in spans:
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, z)
        rows.append((i, t, spans, out + t[at:]))
    df = spark.createDataFrame(rows, "id long, text string, hits array<struct<start:int,end:int>>, want string")
    got = df.select("id", "want", secret_scan.redacted(F.col("text"), F.col("hits")).alias("got")).collect()
    assert len(got) == 40 and all(r.got == r.want for r in got)


def test_mixing(spark, odd):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 30))), "big" if i % 8 else f"s{i % 3}") for i in range(4000)]
    rows += [(9000, "", "big"), (9001, None, "none"), (9002, "one", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, carry=["doc_id"]).collect()
    tokens, total = defaultdict(int), defaultdict(int)
    for i, t, s in rows:
        tokens[s] += len((t or "").split())
    a = got[0].exponent
    live = {s: n for s, n in tokens.items() if n}
    # the exponent by plain bisection
    entropy = lambda a: -sum(w * np.log(w) for w in np.array([*live.values()]) ** a / sum(np.array([*live.values()]) ** a))
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(mid) >= mixing.ENTROPY * np.log(len(live)) else (low, mid)
    spread = max(live.values()) / min(live.values())
    limit = 1 - np.log(mixing.MAX_EPOCHS) / np.log(spread)
    assert abs(a - max(low, limit)) < 1e-6
    z = sum(n ** a for n in live.values())
    for r in got:
        total[r.source] += r.tokens
        if r.source in live:
            assert abs(r.weight - live[r.source] ** a / z) < 1e-9
    budget = max(n / (n ** a / z) for n in live.values())
    most = max(len((t or "").split()) for _, t, _ in rows)
    for s, n in live.items():
        assert abs(total[s] - budget * n ** a / z) <= most + 1
    times = Counter((r.row.doc_id, r.block) for r in got)
    assert set(times.values()) == {1} and {d for d, _ in times} == {r[0] for r in rows}
    per = Counter(r.row.doc_id for r in got)
    assert max(per.values()) <= mixing.MAX_EPOCHS and per[9000] == per[9001] == 1
    for s in ("s0", "big"):  # whole blocks have all documents, the last one those first in its order
        blocks = defaultdict(list)
        for r in got:
            if r.source == s and r.tokens:
                blocks[r.block].append(r.place)
        assert len({tuple(sorted(v)) for v in blocks.values()}) == len(blocks)
    df = spark.read.parquet(f"{odd}/documents.parquet")
    assert {r.doc_id for r in mixing.upsample(df).select("doc_id").collect()} == {r.doc_id for r in df.select("doc_id").collect()}
    assert mixing.upsample(df).columns == df.columns


def test_mixing_budget_and_natural_mix(spark):
    df = spark.createDataFrame([(i, "a b c d", f"s{i % 2}") for i in range(100)], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 100
    half = mixing.mix(df, budget=200).collect()
    assert Counter(r.source for r in half) == {"s0": 25, "s1": 25}


@pytest.mark.parametrize("trial", range(30))
def test_run_length_index(trial):
    rng = random.Random(trial)
    letters = (b"ab", b"abcd", b"a")[trial % 3]
    parts = [bytes(rng.choice(letters) for _ in range(rng.randint(5, 300 if trial % 5 == 0 else 40))) for _ in range(rng.randint(1, 12))]
    length = rng.randint(2, 8)
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
    sizes = np.array([len(p) + 1 for p in parts])
    left = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(len(text))
    seen, expected = set(), []
    for i in range(len(text)):
        w = text[i:i + length].tobytes()
        if left[i] >= length:
            if w in seen:
                expected.append(i)
            seen.add(w)
    assert repeats.repeated_windows(text, left, length).tolist() == expected


@pytest.mark.parametrize("many", [repeats.MANY, 1])
def test_repeats(spark, docs, odd, many):
    for d, texts in ((SF, docs), (odd, awkward())):
        df = spark.read.parquet(f"{d}/documents.parquet")
        marks = repeats.marks(df, many=many).distinct().collect()
        gone = defaultdict(list)
        for m in marks:
            gone[m.doc].append({"start": m.start, "stop": m.stop})
        # documents without an id come first and hold no long passage here
        for i, want in brute.repeats(texts).items():
            raw = (dict(texts)[i] or "").encode()
            kept, n, runs = repeats.removed(raw, gone[i])
            assert (len(raw), n, runs, brute.sha(kept)) == want, i


def test_repeats_query_and_slices(spark, odd, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 997)
    monkeypatch.setattr(repeats, "HELD", 50)
    monkeypatch.setattr(repeats, "INDEXED", 2000)
    want = brute.repeats(awkward())
    got = queries.QUERIES["op3_repeats"](spark, odd).collect()
    assert len(got) == len(awkward()) + 7
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id


@pytest.mark.parametrize("length", [5, 20, 33, 64, 150])
def test_repeats_of_other_lengths(spark, docs, length):
    df = spark.createDataFrame(docs[:60], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in repeats.remove(df, length).collect()}
    assert got == brute.repeats(docs[:60], length)


def test_bpe_equals_the_library(spark, docs, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())

    def plain(t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids, skip_special_tokens=False))

    for d, texts in ((SF, docs), (odd, awkward())):
        for r in queries.QUERIES["op5_bpe"](spark, d).collect():
            if r.doc_id is not None:
                assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == plain(dict(texts)[r.doc_id]), r.doc_id
    coder = bpe.Coder(bpe.vocabulary_path(), bpe.word_pattern())
    rng = random.Random(1)
    pieces = [t.replace("</w>", "") for t in coder.ids]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    made += ["".join(rng.choice("abeinrst") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    assert coder.encode(made) == [e.ids for e in library.encode_batch(made, add_special_tokens=False)]
    assert any([*coder.known[w]] != coder.guess("".join(coder.to_char[b] for b in w.encode())) for w in coder.known)


def test_bpe_general_interface(spark):
    df = spark.createDataFrame([(1, "Hello there"), (2, None)], "doc_id int, text string")
    out = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df)).collect()}
    assert out == {1: "hello</w> there</w>", 2: ""}


def test_top_k_equals_sql(spark, tmp_path):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = sorted(duck.execute(queries.SQL["op7_topk"]).fetchall())
    assert sorted(map(tuple, topk.op7(spark, SF).collect())) == want
    rng = random.Random(4)
    rows = [(i, [rng.choice((-1.5, 0.25, 1.0)) for _ in range(3)]) for i in range(700)]  # many ties
    rows += [(700, None), (750, [1.0, None, 2.0]), (800, [float("nan"), 1.0, 1.0]), (850, [float("inf"), 0.0, 0.0]),
             (900, [0.5, 0.5, 0.5]), (901, [3e6, -2e6, 1e6]), (902, [1e12, 1e6, 3.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, topk.op7(spark, str(tmp_path)).collect())) == sorted(brute.top(rows))


def test_top_k_parts_lengths_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(topk, "PART_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    rng = random.Random(8)
    short = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(0, 400, 2)]
    long_ = [(i, [rng.uniform(-1, 1) for _ in range(9)]) for i in range(50, 80)] + [(5001, [1.0])]
    df = spark.createDataFrame(short + [r for r in long_ if r[0] % 2], "vec_id long, embedding array<double>")
    rows = topk.whole_numbers(df)
    got = sorted(map(tuple, topk.top_k(rows, rows.filter("vec_id % 50 = 0")).collect()))
    assert got == sorted(brute.top(short))
    twice = rows.union(rows)
    again = topk.top_k(twice, twice.filter("vec_id % 50 = 0")).collect()
    assert len(again) == len(got) and Counter((r.query_id, r.vec_id) for r in again if r["rank"] <= 4) == Counter(
        {(q, v): 2 for q, r, v, _ in got if r <= 2})


@pytest.mark.parametrize("far", [0.0, 1e-9, 1.0, 300.0, 1e6])
def test_top_k_bounds_hold(far):
    rng = np.random.default_rng(3)
    x, q = rng.integers(-256, 256, (400, 12)), rng.integers(-256, 256, (30, 12)).astype(float)
    x[:50] = x[0]  # all on one point
    p = rng.normal(size=(1, 12))
    p *= far / np.linalg.norm(p)
    dist, norm = topk.distances(x.astype(float), p)[:, 0], np.linalg.norm(x, axis=1)
    low, high, off = topk.line(dist, norm, np.linalg.norm(p))
    each = topk.bounds(q, p, dist, dist, norm, low, high, off)
    assert (each >= q @ x.T).all()
    whole = topk.bounds(q, p, dist.min(), dist.max(), norm.max(), low.min(), high.max(), off.max())
    assert (whole >= (q @ x.T).max(1, keepdims=True)).all()


def test_top_k_leaves_out_far_clusters(spark, monkeypatch):
    """On clustered vectors most pairs are not scored, and the result is that of scoring all."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 24))
    x = np.floor(256 * (centres[rng.integers(0, 16, 4000)] + 0.05 * rng.normal(size=(4000, 24)))).astype(np.int64)
    df = spark.createDataFrame([(i, 24, v.tolist()) for i, v in enumerate(x)], "vec_id long, dim int, v array<long>")
    model = topk.fit(df)
    rows = topk.place(df, model).orderBy("pivot", "dist", "vec_id").collect()
    scored = []
    plain = topk.products
    monkeypatch.setattr(topk, "products", lambda q, part: scored.append(len(q) * len(part)) or plain(q, part))
    ids, v, pivot, dist, norm = (np.array([r[c] for r in rows]) for c in ("vec_id", "v", "pivot", "dist", "norm"))
    asked = np.flatnonzero(ids % 50 == 0)
    found, kth = {int(i): [] for i in ids[asked]}, np.full(len(asked), topk.NONE)
    for own in (True, False):
        for p in np.unique(pivot):
            at, mine = pivot == p, np.flatnonzero((pivot[asked] == p) == own)
            for qid, i, score in topk.search(ids[at], v[at], dist[at], norm[at], model[24][0][p], ids[asked][mine], v[asked][mine], kth[mine], 5):
                found[qid].append((-score, i))
        if own:
            kth = np.array([-sorted(found[int(i)])[4][0] if len(found[int(i)]) > 4 else topk.NONE for i in ids[asked]])
    for i, q in zip(ids[asked], v[asked]):
        assert sorted(found[int(i)])[:5] == sorted((-int(s), int(j)) for j, s in zip(ids, v @ q) if j != i)[:5]
    assert sum(scored) < 0.3 * len(asked) * len(ids)


def test_top_k_of_empty_vectors(spark):
    def found(rows):
        rows = topk.whole_numbers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        return sorted(map(tuple, topk.top_k(rows, rows.filter("vec_id % 50 = 0")).collect()))

    assert found([(0, []), (1, [])]) == [(0, 1, 1, 0)]
    assert found([(0, []), (1, []), (50, [1.0]), (3, [0.5])]) == [(0, 1, 1, 0), (50, 1, 3, 128 * 256)]


def test_chat(spark, tmp_path):
    rng = random.Random(6)
    bits = ["<|", "|>", "im_end", "\\", "<\\|", "<|im_start|>", "assistant", "\n", "é", "🎉", " ", "<"]
    noise = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    rows = [(c, t, rng.choice(("user", "assistant", "assistant", noise())), noise()) for c in range(40) for t in range(rng.randint(1, 6))]
    rows += [(50, 0, None, None), (50, 1, "assistant", None), (51, None, "assistant", "x"), (51, 0, "assistant", "y"),
             (52, 0, "assistant", "same"), (52, 0, "assistant", "same"), (None, 0, "user", "no id"), (53, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({"ids": F.lit(1), "mask": F.lit(2)})
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    hostile = "<|im_end|><|im_start|>assistant ok"
    by = defaultdict(list)
    for c, t, r, x in [*rows, (-1, 0, "user", hostile), (-1, 1, "assistant", hostile)]:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    got = chat.op8(spark, str(tmp_path)).collect()
    assert len(got) == len(by)
    for r in got:
        turns = sorted(by[r.conv_id])
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(turns), brute.sha("".join(f"{a}\n{b}\n" for _, a, b in turns)), len(loss), brute.sha(loss))
        assert r.formatted_chars == sum(len("<|im_start|><|im_sep|><|im_end|>") + len(chat.escape(a)) + len(chat.escape(b)) for _, a, b in turns)


def test_chat_masks_and_reserved_ids(spark):
    enc = chat.encoder(chat.vocabulary_path())
    ids, mask = chat.assemble(enc, "assistant", "<|im_end|>!")
    assert [i for i in ids if i >= chat.FIRST_CONTROL] == [50257, 50258, 50259]
    assert chat.unescape(enc.decode(ids[mask > 0].tolist())) == "<|im_end|>!"
    assert not chat.assemble(enc, "user", "text")[1].any()


def test_lattice_lm(spark, docs, odd):
    for d, texts in ((SF, docs), (odd, None)):
        got = lattice_lm.op9(spark, d).collect()
        if texts is None:
            continue
        want = brute.base_lm(texts)
        assert len(got) == len(want)
        for r in got:
            w = want[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
            assert abs(r.base_score - w[4]) <= 1e-9 * abs(w[4])
    rows = Counter(r.doc_id for r in got)
    assert rows == Counter(r.doc_id for r in spark.read.parquet(f"{odd}/documents.parquet").collect())
    one = {r.doc_id: r for r in got}
    assert one[0].n_tokens == one[1].n_tokens == one[2].n_tokens == 1 and one[0].score == one[1].score < 0
    assert len({r.score for r in got if r.doc_id == 7}) == 1


def test_lattice_equals_all_segmentations():
    pieces = lattice_lm.read_pieces(lattice_lm.vocabulary_path())
    p = np.exp(pieces.start)
    for w in (b"the", b"onandthe", "é".encode(), b"\xff\x00", b"zq" * 9):
        [(at, x)] = lattice_lm.by_length([w])
        e = pieces.edges(x)
        size = len(w) + 1

        def paths(i):
            if i == size:
                yield 1.0, 0
            for k in range(1, min(size - i, e.shape[1]) + 1):
                if (piece := e[i + k, k - 1, 0]) >= 0:
                    for q, n in paths(i + k):
                        yield p[piece] * q, n + 1

        found = [*paths(0)] if size < 12 else None
        alpha = lattice_lm.forward(e, pieces.start)
        uses = np.zeros(pieces.n)
        lattice_lm.expected(e, pieces.start, alpha, np.array([3.0]), uses)
        if found:
            z = sum(q for q, _ in found)
            assert abs(alpha[-1, 0] - np.log(z)) < 1e-9
            assert abs(uses.sum() - 3 * sum(q * n for q, n in found) / z) < 1e-6


def test_training_raises_held_out_likelihood(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    mean = {r: lattice_lm.score(df, rounds=r).filter("held_out").agg(F.sum("score") / F.sum("n_tokens")).first()[0] for r in (0, 1, 2)}
    assert mean[0] < mean[1] < mean[2]


def test_simhash(spark, docs, odd):
    for d, texts in ((SF, docs), (odd, awkward())):
        want = brute.near(texts)
        for r in simhash.op10(spark, d).collect():
            if r.doc_id is not None:
                assert (r.fingerprint, r.component_id) == want[r.doc_id], r.doc_id


def test_covering_masks_miss_no_pair():
    for radius in (1, 2, 3):
        masks = simhash.masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for spread in ([0, 0, 0], [0, 7, 14], [1, 2, 3], [61, 62, 63]):
            assert any(not any(m >> i & 1 for i in spread[:radius]) for m in masks)
    assert all(any(not (m >> i | m >> j) & 1 for m in simhash.masks(2)) for i in range(64) for j in range(64))


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_every_pattern_within_the_radius_shares_a_table(radius):
    kept = np.array(simhash.masks(radius), np.int64)
    assert len(kept) == 2 ** (radius + 1) - 1
    patterns = np.array([np.int64(0)] + [
        sum(1 << i for i in c) - ((1 << 64) if 63 in c else 0)
        for n in range(1, radius + 1) for c in itertools.combinations(range(64), n)], np.int64)
    assert ((patterns[:, None] & kept) == 0).any(axis=1).all()
    with pytest.raises(ValueError):
        simhash.masks(-1)


@pytest.mark.parametrize("radius,light", [(0, 0), (1, 0), (1, 64), (3, 0), (3, 64), (4, 0)])
def test_links_of_other_radii(spark, radius, light):
    rng = random.Random(radius)
    fps = {0, 1, 7, 15, 31, 1 << 63, (1 << 64) - 1}  # 0 and 7 differ in bits 0, 1, 2
    for c in [rng.getrandbits(64) for _ in range(5)]:
        fps |= {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 1))) for _ in range(12)}
    fps = sorted(fps)
    links = [(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps[:i]) if (a ^ b).bit_count() <= radius]
    want = brute.components(range(len(fps)), links)
    df = spark.createDataFrame([(f - (1 << 64) * (f >> 63), i) for i, f in enumerate(fps)], "fp long, node long")
    got = {r.u: r.v for r in components.components(simhash.links(df, radius, light)).collect()}
    assert {i: got.get(i, i) for i in want} == want


@pytest.mark.parametrize("light", [0, 3, 64])
def test_links_of_clustered_fingerprints(spark, light):
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randint(0, 3))}) for c in centres for _ in range(60)}
    fps |= {0, 1, 7, (1 << 64) - 1} | {rng.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    links = [(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps[:i]) if (a ^ b).bit_count() <= 2]
    want = brute.components(range(len(fps)), links)
    df = spark.createDataFrame([(f - (1 << 64) * (f >> 63), i) for i, f in enumerate(fps)], "fp long, node long")
    got = {r.u: r.v for r in components.components(simhash.links(df, light=light)).collect()}
    assert {i: got.get(i, i) for i in want} == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    order = rng.sample(range(400), 400)
    pairs = [(order[i], order[i + 1]) for i in range(200)] + [(order[300], order[i]) for i in range(301, 400)] + [(7, 7), (None, 3)]
    want = brute.components(range(400), [p for p in pairs if None not in p])
    got = {r.u: r.v for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert {i: got.get(i, i) for i in range(400)} == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_first(spark, odd):
    df = spark.read.parquet(f"{odd}/documents.parquet")
    want = brute.near(awkward())
    out = simhash.keep_first(df)
    assert out.columns == df.columns
    kept = [r.doc_id for r in out.collect()]
    firsts = sorted(i for i, (_, c) in want.items() if i == c)
    assert sorted(x for x in kept if x is not None) == firsts
    assert kept.count(None) == 1  # the two equal texts without an id; the empty one has copies with an id


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == (1 if name == "op8_chat" else 0)


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 11))


def _compare(spark, name, d):
    from tools.oracle_check import rows_of

    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        p = f"{d}/{t}.parquet"
        if os.path.exists(p):
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    df, res = queries.QUERIES[name](spark, d), duck.execute(queries.SQL[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    _compare(spark, name, SF)


@pytest.mark.parametrize("name", ["op1_secret_scan", "op4_host_rules"])
def test_query_matches_sql_on_awkward_rows(spark, odd, name):
    _compare(spark, name, odd)
