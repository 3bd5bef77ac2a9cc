"""Merkle manifest, hard negatives and bottom-k near-duplicates against plain versions, and on awkward rows."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import bottom_k, hard_negatives, merkle, queries

from . import brute
from .test_operators import DOC, SF, awkward, empty, odd  # noqa: F401

pytestmark = pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="test tables not present")


def contract(df, cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# -- manifest -----------------------------------------------------------------------

PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def doc_rows(spark, d):
    return [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest_of_the_tables_and_of_awkward_rows(spark, odd):  # noqa: F811
    for d in (SF, odd):
        assert contract(queries.QUERIES["op12_merkle"](spark, d), PROOF) == Counter(brute.merkle(doc_rows(spark, d)))


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (16, 17), (255, 256, 257), (4097, 1, 300)])
def test_manifest_of_trees_of_every_depth(spark, tmp_path, sizes):
    rows = [(10_000 * k + i, f"s{k}" if k else None, "en", i, f"Text {i}") for k, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_merkle"](spark, str(tmp_path))
    assert contract(got, PROOF) == Counter(brute.merkle(rows))
    tampered = got.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert not tampered.filter("verified").count() and got.filter("verified").count() == len(rows) - tampered.count()


def test_many_sources(spark, tmp_path):
    rows = [(i, f"host{i % 700}", None, None, None if i % 9 == 0 else "X" * (i % 5)) for i in range(2100)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert contract(queries.QUERIES["op12_merkle"](spark, str(tmp_path)), PROOF) == Counter(brute.merkle(rows))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 4096, 4097, 5000])
def test_positions_are_those_of_a_postorder_walk(n):
    order, wide = [], [n]
    while wide[-1] > 1:
        wide.append(-(-wide[-1] // merkle.FANOUT))

    def walk(level, i):
        if level:
            for j in range(i * merkle.FANOUT, min((i + 1) * merkle.FANOUT, wide[level - 1])):
                walk(level - 1, j)
        order.append((level, i))

    walk(len(wide) - 1, 0)
    assert [merkle.position(level, i, n) for level, i in order] == [*range(len(order))]
    assert merkle.depth(n) == len(wide) - 1


def test_log_holds_every_node_once_at_its_position(spark):
    rows = [(i, "a" if i % 3 else "b", None, None, str(i)) for i in range(1500)]
    m = merkle.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    by = defaultdict(list)
    for r in m.log.collect():
        by[r.tree].append((r["at"], r.level, r.i))
    for tree, n in (("=a", 1000), ("=b", 500)):
        assert sorted(at for at, _, _ in by[tree]) == [*range(len(by[tree]))]
        assert all(at == merkle.position(level, i, n) for at, level, i in by[tree])


# -- hard negatives -----------------------------------------------------------------

HARD = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def test_negatives_of_the_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert contract(queries.QUERIES["op11_hard_negatives"](spark, SF), HARD) == Counter(brute.negatives(rows))


def test_negatives_of_awkward_vectors(spark, tmp_path):
    rng = random.Random(2)
    centre = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(3)]
    rows = [(i, [round(c + rng.gauss(0, 0.1), 2) for c in centre[i % 3]], rng.choice([0, 0, 0, 1, 2])) for i in range(600)]
    rows += [(600, None, 1), (650, [0.1, None] * 3, 1), (700, [float("nan")] * 6, 1), (750, [float("inf")] * 6, 1), (800, [0.5] * 6, None),
             (None, [0.5] * 6, 1), (850, [], 1), (851, [], 1), (852, [], 2), (900, [1e6, 2e6], 3), (901, [1e6, 1e6], 3), (902, [9e5, 5e5], 4),
             (950, [0.0] * 6, 0), (1000, [-0.5] * 6, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for c in ("kind", "cell", "dim", "v", "rank", "a.b"):
        df = df.withColumn(c, F.lit(1))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert contract(queries.QUERIES["op11_hard_negatives"](spark, str(tmp_path)), HARD) == Counter(brute.negatives(rows))


def test_cells_of_any_size_give_the_same_negatives(spark, monkeypatch):
    want = contract(queries.QUERIES["op11_hard_negatives"](spark, SF), HARD)
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", 40)
    assert contract(queries.QUERIES["op11_hard_negatives"](spark, SF), HARD) == want


def test_repeated_rows_are_candidates_each_time_and_ask_once(spark):
    rows = [(50, 1, 2, [4, 0]), (50, 1, 2, [5, 0]), (1, 1, 2, [10, 0]), (1, 1, 2, [10, 0]), (2, 2, 2, [8, 0]), (2, 2, 2, [8, 0])]
    df = spark.createDataFrame(rows, "vec_id long, label long, dim int, v array<long>")
    got = hard_negatives.mine(df, df.filter("vec_id = 50")).collect()
    assert sorted((r.positive_rank, r.positive_id, r["rank"], r.negative_id, r.negative_score) for r in got) == [
        (p, 1, n, 2, 32) for p in (1, 2) for n in (1, 2)]


def test_clustered_rows_are_not_read_to_the_end():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(-3, 4, (4000, 64)) + c for c in (60, -60)]).astype(np.int64)
    cell = hard_negatives.Cell(np.arange(8000), np.zeros(8000), v)
    whole = sorted((-(v[0] @ v[i]), i) for i in range(1, 8000))[:5]
    assert cell.positives(0, 0, v[0], 5) == [(i, -s) for s, i in whole]
    assert cell.read < 0.9 * v.size  # the other side is ruled out after three quarters of the dimensions


# -- bottom-k near-duplicates -------------------------------------------------------

SETS = ("doc_id", "n_shingles", "component_id")


def test_near_duplicates_of_the_tables_and_of_awkward_rows(spark, odd):  # noqa: F811
    for d in (SF, odd):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
        got = queries.QUERIES["op13_bottom_k"](spark, d)
        assert contract(got, SETS) == Counter(brute.shingle_groups(rows))
        assert not got.filter("kept != (doc_id <=> component_id)").count()


def family(seed, n=260):
    """Texts around a few cores, from near copies to texts that share most of a passage without being near; short ones as well."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    cores = [[word() for _ in range(size)] for size in (150, 90, 40, 7, 6, 5, 4)]
    rows = []
    for i in range(n):
        text = list(rng.choice(cores[:3] * 4 + cores))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
            text[rng.randrange(len(text))] = word()
        rows.append((i, " ".join(text + [word() for _ in range(rng.choice([0, 0, 1, 12, 25]))])))
    return rows


@pytest.mark.parametrize("light", [2, 5, 32])
def test_long_lists_lose_no_link(spark, light, monkeypatch):
    rows = family(light)
    monkeypatch.setattr(bottom_k, "CHUNK", 1000)  # long lists are met in tasks and across them
    monkeypatch.setattr(bottom_k, "TILE", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = contract(bottom_k.groups(df, light=light), SETS)
    assert got == Counter(brute.shingle_groups(rows))
    assert 10 < len({c for _, _, c in got}) < len(rows)


def test_families_find_links_that_no_short_list_shows(spark):
    rng = random.Random(9)
    core = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(w for w in core if rng.random() > 0.03)) for i in range(60)]
    sets = [(i, bottom_k.Shingles().sets([t])) for i, t in rows]
    sets = spark.createDataFrame([(i, next(iter(s)).tolist()) for i, s in sets], "node long, values array<long>")
    roots = sets.select("node", F.col("node").alias("root"))
    links = {tuple(sorted(r)) for r in bottom_k._rest(sets, roots, 80, 2).collect()}
    want = brute.components(range(60), [(a, b) for a, b in links])
    assert Counter(want.values()) == Counter(c for _, _, c in brute.shingle_groups(rows))


def test_shingle_sets_are_exact():
    shingles = bottom_k.Shingles()
    texts = [t for _, t in awkward()] + ["x", "x y x y x", "A b a B"]
    for t, s in zip(texts, shingles.sets(texts)):
        assert len(s) == brute.shingle_groups([(1, t)])[0][1] and (s[1:] > s[:-1]).all()
    three = [len(s) for s in bottom_k.Shingles(3).sets(["a b c a b c a", "a b", ""])]
    assert three == [3, 1, 0]


def test_very_long_text_near_its_copy(spark):
    rng = random.Random(4)
    words = [f"v{rng.randint(0, 60_000)}" for _ in range(400_000)]
    other = words[:200_000] + ["changed"] * 5 + words[200_000:]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:200_000]))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in bottom_k.groups(df).collect()} == {1: 1, 2: 1, 3: 3}


# -- all three ----------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_merkle", "op13_bottom_k"])
def test_empty_tables(spark, empty, name):  # noqa: F811
    assert queries.QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_merkle"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.SQL[name])
    cols = [c[0] for c in want.description]
    assert contract(queries.QUERIES[name](spark, SF), cols) == Counter(want.fetchall())
