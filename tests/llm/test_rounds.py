"""Rounds over growing edges."""

import random

from capturemill.llm import jaccard


def test_each_round_of_components_is_released(spark, monkeypatch):
    rounds, released = [], jaccard.released
    monkeypatch.setattr(jaccard, "released", lambda df: rounds.append(1) or released(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(8)], "a long, b long")
    assert {tuple(r) for r in jaccard.components(edges).collect()} == {(i, 0) for i in range(9)} and len(rounds) > 1


def test_frequent_shingles_come_as_arrays_in_unsigned_order(spark):
    often = spark.createDataFrame([(-1, 5), (3, 7), (2, 7)], "token long, c long")
    tokens, counts = jaccard._by_token(often)
    assert tokens.tolist() == [2, 3, 2**64 - 1] and counts.tolist() == [7, 7, 5]
    assert [len(x) for x in jaccard._by_token(often.limit(0))] == [0, 0]


def test_counting_links_releases_its_steps(spark, monkeypatch):
    steps, released = [], jaccard.released
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i // 2}") for i in range(6)], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "released", lambda df: steps.append(set(df.columns)) or released(df))
    assert {r.n_links for r in jaccard.similar_components(docs, percent=50).collect()} == {5}
    assert [s for s in steps if "rank" in s] and {"sid", "links"} in steps and {"sid", "comp", "n_links"} in steps


def test_stars_take_no_round(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(jaccard, "released", lambda df: rounds.append(1) or df)
    edges = spark.createDataFrame([(0, i) for i in range(1, 6)] + [(9, 7)], "a long, b long")
    assert {tuple(r) for r in jaccard.components(edges).collect()} == {(i, 0) for i in range(6)} | {(7, 7), (9, 7)} and not rounds


def test_more_links_join_known_components(spark):
    rng = random.Random(5)
    for first, more in ((0, 9), (30, 0), (25, 12), (12, 40)):
        known, new = ([tuple(rng.sample(range(60), 2)) for _ in range(n)] for n in (first, more))
        frames = [spark.createDataFrame(x, "a long, b long") for x in (known, new, known + new)]
        got = jaccard.more_components(jaccard.components(frames[0]), frames[1])
        assert sorted(got.collect()) == sorted(jaccard.components(frames[2]).collect())
