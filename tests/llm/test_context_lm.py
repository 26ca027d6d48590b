"""The suffix tree over running text against its definition."""

import collections
import math
import zlib

import pytest

from capturemill.llm import context_lm, queries

WORDS = "the of and to in is that river stone light walks under blue open gate".split()


def _text(seed, n):
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


ROWS = [(i, _text(i, 20 + 7 * i) + " Über") for i in range(24)] + [(100, None), (101, ""), (102, " \n"), (103, "stone blue river"), (104, "river blue stone"), (None, "no id")]


def _symbols(text):
    return context_lm.normal((text or "").encode().lower().split())


def _model(texts, min_count, min_nats):
    """Retained contexts and log10 probabilities by definition."""
    counts = collections.defaultdict(collections.Counter)
    for t in texts:
        for i in range(context_lm.DEPTH, len(t)):
            for d in range(context_lm.DEPTH + 1):
                counts[t[i - d : i]][t[i]] += 1
    memo = {}

    def dist(c, s):
        if (c, s) not in memo:
            n = counts.get(c)
            if not c:
                memo[c, s] = ((n[s] if n else 0) + 1) / ((n.total() if n else 0) + 256)
            else:
                memo[c, s] = (n[s] + len(n) * dist(c[1:], s)) / (n.total() + len(n)) if n else dist(c[1:], s)
        return memo[c, s]

    kept = set()
    for c, n in counts.items():
        size = n.total()
        if len(c) > 2 and size >= min_count and sum(k * math.log(k / size / dist(c[1:], s)) for s, k in n.items()) >= min_nats:
            kept |= {c[i:] for i in range(len(c))}

    def score(t):
        total = 0.0
        for i in range(context_lm.DEPTH, len(t)):
            d = context_lm.DEPTH
            while d > 2 and t[i - d : i] not in kept:
                d -= 1
            total += math.log10(dist(t[i - d : i], t[i]))
        return total

    return kept, score


def _train():
    return [_symbols(t) for i, t in ROWS if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]


@pytest.mark.parametrize("part", [64_000_000, 20_000])
def test_scores_by_definition_in_one_part_and_in_several(spark, monkeypatch, part):
    monkeypatch.setattr(context_lm, "PART", part)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    _, score = _model(_train(), 3, 2.0)
    got = context_lm.score_running_text(docs, min_count=3, min_nats=2.0, common=5).collect()
    assert collections.Counter((r.doc_id, round(r.score, 3)) for r in got) == collections.Counter((i, round(score(_symbols(t)), 3)) for i, t in ROWS)
    # The same words in another order are another text.
    by = {r.doc_id: r for r in got}
    assert by[103].n_tokens == by[104].n_tokens == 4 and abs(by[103].score - by[104].score) > 0.01
    # The base by definition, for words that are broadcast and words that are joined.
    c = collections.Counter(w for t in _train() for w in [*t[7:-1].split(), b""])
    n, v = c.total(), len(c)
    for i, t in ROWS:
        words = [*(t or "").encode().lower().split(), b""]
        assert by[i].n_known == sum(w in c for w in words) and by[i].train_tokens == n
        assert math.isclose(by[i].base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)


def test_order_of_words_counts_in_the_query(spark, tmp_path):
    spark.createDataFrame([(i, "one two three four five six " * 9) for i in range(40)] + [(100, "one two three four"), (101, "four two one three")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in queries.op6_suffix_tree_scoring(spark, str(tmp_path)).collect()}
    assert got[100] > got[101] + 1


def test_every_context_is_tested_and_all_that_pass_are_kept(spark):
    """A rare context of strong divergence stays among any number of more frequent ones."""
    docs = spark.createDataFrame([(t,) for i, t in ROWS if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2], "text string")
    for min_count, min_nats in ((3, 2.0), (4, 10.0)):
        kept, _ = _model(_train(), min_count, min_nats)
        _, tree = context_lm.fit(docs, min_count=min_count, min_nats=min_nats)
        found = set()
        for part in context_lm.parts(tree):
            for d, (contexts, _, _, _) in part.value.items():
                found |= {k.to_bytes(8, "big")[:d][::-1] for k in contexts.tolist()}
        assert found == {c for c in kept if len(c) > 2} and found


def test_the_tree_grows_with_the_corpus(spark):
    sizes = []
    for n in (30, 300):
        docs = spark.createDataFrame([(" ".join(f"w{zlib.crc32(f'{i // 10} {k}'.encode())}" for k in range(30)),) for i in range(n)], "text string")
        sizes.append(sum(len(x[0]) for part in context_lm.parts(context_lm.fit(docs)[1]) for x in part.value.values()))
    assert sizes[1] > 5 * sizes[0] > 0
