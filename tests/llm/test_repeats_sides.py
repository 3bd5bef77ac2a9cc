"""Phrases that only share an anchor are not fetched; every shared window is (F1 of round 4, op3)."""

import random

import pytest

from quayside.llm import repeats

LETTERS = "abcdefghijklmnopqrstuvwxyz     "


def noise(rng, n):
    return "".join(rng.choice(LETTERS) for _ in range(n))


def test_a_frequent_word_fetches_no_text(spark, monkeypatch):
    rng = random.Random(4)
    word = " responsibilities of the governments "  # longer than an anchor, far shorter than a passage
    df = spark.createDataFrame([(i, noise(rng, 150) + word + noise(rng, 150)) for i in range(200)], "doc_id long, text string")
    fetched, index = [], repeats.index_marks
    monkeypatch.setattr(repeats, "index_marks", lambda cut, length: fetched.append(
        cut.filter("bytes is not null").count()) or index(cut, length))
    assert [r.n_removed for r in repeats.remove(df).collect()] == [0] * 200
    assert fetched == [0]


@pytest.mark.parametrize("size", [99, 100, 101, 130])
def test_every_shared_window_is_found(spark, size):
    rng = random.Random(size)
    rows = []
    for i in range(60):  # pairs with a passage in common, at other places and with other bytes around it
        passage = noise(rng, size)
        rows += [(2 * i, noise(rng, rng.randint(0, 120)) + "X" + passage + "X" + noise(rng, rng.randint(0, 120))),
                 (2 * i + 1, noise(rng, rng.randint(0, 120)) + "Y" + passage + "Y" + noise(rng, rng.randint(0, 120)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in repeats.remove(df).collect()}
    assert got == {i: size if i % 2 and size >= 100 else 0 for i in range(120)}
