"""The pipeline against a plain version of each stage, and on awkward and empty tables."""

from collections import Counter

import corpus_pipeline as P
from quayside.llm import bpe, mixing

from . import brute
from .test_operators import SF, awkward, empty, odd  # noqa: F401


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    good = P.quality(spark, docs, SF)
    assert good.columns == docs.columns
    kept = {r.doc_id: r for r in good.collect()}
    assert set(kept) == {i for i, r in rows.items() if not brute.quality(r.text)[5]}  # no host is bad here
    near = brute.near([(i, r.text) for i, r in kept.items()])
    single = P.near_duplicates(spark, good, SF)
    alone = {r.doc_id: r for r in single.collect()}
    assert set(alone) == {i for i in kept if near[i][1] == i} and all(alone[i] == kept[i] for i in alone)
    clean = P.secrets(spark, single, SF)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert set(texts) == set(alone)
    for i, t in texts.items():
        found = brute.secrets(alone[i].text)
        assert brute.secrets(t)[:3] == (0, 0, 0) and (t == alone[i].text) == (found[:3] == (0, 0, 0))
    mixed = P.mix(spark, clean, SF)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) == set(texts) and max(times.values()) <= mixing.MAX_EPOCHS
    out = P.encode(spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in out) == times
    coder = bpe.Coder(bpe.vocabulary_path(), bpe.word_pattern())
    for r in out:
        [ids] = coder.encode([texts[r.doc_id]])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
    run = P.run(spark, SF).collect()
    assert sorted(map(repr, run)) == sorted(map(repr, out))


def test_awkward_and_empty(spark, odd, empty):  # noqa: F811
    assert {r.doc_id for r in P.run(spark, odd).collect()} <= {i for i, _ in awkward()}
    assert P.run(spark, empty).count() == 0


def test_stages_on_awkward_rows(spark, odd):  # noqa: F811
    df = spark.read.parquet(f"{odd}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, df, odd).columns == df.columns
        stage(spark, df, odd).count()
    assert P.encode(spark, df, odd).count() == df.count()
