"""Each stage of the pipeline against a brute-force version, on rows with nulls, repeats, clashing columns and none at all."""

import collections
import zlib

import corpus_pipeline
import pytest

from capturemill.llm import decontaminate, jaccard, langid, mixing, sharding

WORDS = "the of and to in is that river stone light walks under blue open gate morning quiet field over small ships carry salt north".split()


def _text(seed, n):
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, shard int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "k", 7) for i, t, lang, source in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    near = _text(5, 200).split()
    near[50] = "changed"
    out = [(i, _text(i, 40 + 13 * i), "en", f"src{i % 4}") for i in range(12)]
    out += [(20, _text(5, 200), "en", "src2"), (21, " ".join(near), "en", "src2"), (None, _text(5, 200), "en", None)]
    out += [(30, None, "en", "src0"), (31, "", None, "src1"), (32, "12 34 !", "en", "src1"), (32, "12 34 !", "en", "src1"), (33, "alone here", "en", "src0"), (33, _text(77, 60), "en", "src0")]
    out += [(40, "x " + _text(500, 30) + " y", "en", "src1"), (None, _text(901, 50), "en", "src3"), (None, _text(901, 50), "en", "src3")]
    return out


def _plain(df):
    return collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_language_stage_keeps_rows_with_letters(spark, rows):
    d = _frame(spark, rows)
    got = corpus_pipeline.language_id(spark, d, "")
    assert got.columns == d.columns
    # One language: its share is 1 for every text with a letter.
    assert _plain(got) == collections.Counter(r for r in rows if r[1] and any(c.isalpha() for c in r[1]))
    assert corpus_pipeline.language_id(spark, d.limit(0), "").count() == 0


def _sets(t):
    w = (t or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicate_stage_keeps_one_of_each_group(spark, rows):
    d = _frame(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, d, "")
    assert got.columns == d.columns
    sets = [_sets(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    want = collections.Counter(r for r, s in zip(rows, sets, strict=True) if not s)
    for g in set(group):
        own = [r for r, s, k in zip(rows, sets, group, strict=True) if k == g and s]
        if own:
            want[min(own, key=lambda r: (r[0] is None, r[0] or 0))] += 1
    assert _plain(got) == want
    assert corpus_pipeline.near_duplicates(spark, d.limit(0), "").count() == 0


def test_decontamination_stage_drops_rows_not_ids(spark, rows, tmp_path):
    spark.createDataFrame([(7, _text(500, 30)), (8, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = _frame(spark, [*rows, (40, "clean words of the same id", "en", "src1")])
    got = corpus_pipeline.decontamination(spark, d, str(tmp_path))
    assert got.columns == d.columns
    assert _plain(got) == collections.Counter([*(r for r in rows if _text(500, 30) not in (r[1] or "")), (40, "clean words of the same id", "en", "src1")])


def test_mixing_stage_repeats_rows_as_the_mix_says(spark, rows):
    d = _frame(spark, rows)
    got = corpus_pipeline.source_mixing(spark, d, "")
    assert got.columns == d.columns
    want = collections.Counter()
    for r in mixing.mix_documents(d).collect():
        want[r.doc_id, r.source, r["size"]] += r.copies
    have = collections.Counter()
    for (i, t, _, s), n in _plain(got).items():
        have[i, s, len((t or "").split())] += n
    assert have == +want
    assert corpus_pipeline.source_mixing(spark, d.limit(0), "").count() == 0


def _hilbert(x, bits):
    """The published transform, on integers."""
    x, n = list(x), len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    h = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            h = h * 2 + ((v ^ t) >> b & 1)
    return h


def test_sharding_stage_orders_rows_by_the_curve(spark, rows):
    d = _frame(spark, rows)
    out = corpus_pipeline.hilbert_sharding(spark, d, "")
    assert out.columns == [c for c in d.columns if c != "shard"] + ["shard", "slot"]
    assert _plain(out) == collections.Counter(rows)
    at = sharding.hilbert_shards(d, n_shards=5, bits=2)
    got = sorted(at.collect(), key=lambda r: (r.shard, r.slot))
    assert [r.h for r in got] == sorted(r.h for r in got)

    # Cells by definition: classes of strings by how many rows are below the value, and of sizes by their percentiles.
    def code(values, v):
        below = sum(x is None or (v is not None and x.encode() < v.encode()) for x in values) if v is not None else 0
        return below * 4 // len(values)

    langs, sources = [r[2] for r in rows], [r[3] for r in rows]
    size = {(r[0], zlib.crc32((r[1] or "").encode())): (r[2], r[3], len((r[1] or "").encode()) + 16) for r in rows}
    borders = spark.createDataFrame([(float(v[2]),) for v in [(0, 0, len((r[1] or "").encode()) + 16) for r in rows]], "s double").selectExpr("percentile_approx(s, array(0.25, 0.5, 0.75), 2000)").first()[0]
    for r in got:
        lang, source, n = size[r.doc_id, r.text_crc32]
        assert r.h == _hilbert((code(langs, lang), code(sources, source), sum(n > b for b in sorted(set(borders)))), 2)


def test_string_dimensions_use_whole_strings(spark):
    d = spark.createDataFrame([(i, "t", f"source-{i % 5}") for i in range(50)], "doc_id long, text string, source string")
    got = sharding.hilbert_shards(d, 5).collect()
    assert len({r.h for r in got}) == 5
    assert all(len({r.d_source for r in got if r.shard == s}) == 1 for s in range(5))
    index = sharding.file_index(sharding.hilbert_shards(d, 5)).collect()
    assert all(r.min_source == r.max_source and r.rows == 10 for r in index)
    assert sharding.hilbert_shards(d.limit(0), 5).count() == 0 and sharding.shard_documents(d.limit(0), 5).count() == 0


def test_whole_pipeline(spark, rows, tmp_path):
    _frame(spark, rows).drop("shard").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, _text(500, 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.shard, r.slot) for r in got} and len({(r.shard, r.slot) for r in got}) == len(got)
    texts = {r.text for r in got}
    assert all(r.doc_id not in (21, 30, 31, 32, 40) for r in got) and texts <= {r[1] for r in rows} and texts


def test_tiling_of_texts_that_repeat_themselves(spark, monkeypatch):
    import random

    draw = random.Random(3)
    for _ in range(60):
        doc, item = ([draw.randrange(3) for _ in range(draw.randrange(1, n))] for n in (50, 25))
        least = min(3, len(item))
        t, u = (decontaminate.tokens(" ".join(f"t{x}" for x in w).encode()) for w in (doc, item))
        free_d, free_i, want = [True] * len(doc), [True] * len(item), []
        while True:
            best = None
            for i in range(len(doc)):
                for j in range(len(item)):
                    k = 0
                    while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and free_d[i + k] and free_i[j + k]:
                        k += 1
                    if k >= least and (best is None or (-k, i, j) < best):
                        best = -k, i, j
            if best is None:
                break
            k, i, j = -best[0], best[1], best[2]
            want.append((i, j, k))
            free_d[i : i + k], free_i[j : j + k] = [False] * k, [False] * k
        seeds = [(i, j) for i in range(len(doc) - least + 1) for j in range(len(item) - least + 1) if doc[i : i + least] == item[j : j + least]]
        assert (decontaminate.tiles(t, u, seeds, least) if seeds else []) == want == decontaminate.tiles_by_length(t, u, least)
    d = spark.createDataFrame([(1, "la " * 3000), (2, "other words than those")], "doc_id long, text string")
    b = spark.createDataFrame([("a", "la " * 500), ("b", "x y z q r s t")], "item_id string, text string")
    assert [(r.doc_id, r.item_id, r.covered) for r in decontaminate.tiled_matches(d, b).collect()] == [(1, "a", 500)]
    assert [(r.doc_id, r.item_id) for r in decontaminate.tiled_matches(d, b, block_chars=10).collect()] == [(1, "a")]
    assert decontaminate.tiled_matches(d, b.limit(0)).count() == 0 and decontaminate.tiled_matches(d.limit(0), b).count() == 0


def test_jaccard_split_lists(spark, monkeypatch):
    """Lists that are split by their sets lose no link, whether in one piece or several."""
    import numpy as np

    keys = jaccard.split_keys(np.array([1, 2, 3], dtype=np.uint64), -5, np.array([2], dtype=np.uint64), np.array([4]))
    assert keys[0] == 1 and keys[2] == 3 and keys[1] != 2
    base, rows = _text(3, 120).split(), []
    for i in range(300):
        t = list(base)
        t[i % 120], t[(7 * i + 1) % 120] = f"edit{i}", f"more{i}"
        rows.append((i, " ".join(t)))
    rows += [(1000 + i, _text(3, 30) + f" v{i} w{i} x{i} " + _text(700 + i // 2, 40)) for i in range(20)]
    parts = jaccard.split_keys(np.arange(10, dtype=np.uint64), 3, np.arange(10, dtype=np.uint64), np.ones(10, dtype=np.int64))
    assert (parts == np.arange(10)).all()
    sets = {i: _sets(t) for i, t in rows}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                lo, hi = sorted((root[i], root[j]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    for split in (20_000, 40):
        got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), sample=1, split=split).collect()
        assert {r.doc_id: r.component_id for r in got} == root


def test_language_id_of_long_words(spark):
    import numpy as np

    pieces = sorted({b"ab", b"abc", b" a", b"bca", b"c" * 33, *(bytes([i]) for i in range(256))})
    m = langid.PieceModel(pieces, ["x", "y"])
    p = np.random.default_rng(2).random((len(m.hashes), 2))
    m.set(p / p.sum(axis=0))
    prob = {}
    for s in pieces:
        h = np.zeros(1, dtype=np.uint64)
        for c in s:
            h = (h ^ np.uint64(c)) * langid._K
        prob[s] = np.exp(m.logp[m.find(m._named(h, len(s)))[1][0]])
    for w in (b"abcab", b"abc" * 40, b"c" * 90, b"c" * 39, b"c" * 40):
        f = [np.ones(2)]
        for i in range(1, len(w) + 2):
            f.append(sum((f[i - k] * prob[s] for k in range(1, min(33, i) + 1) if (s := (b" " + w)[i - k : i]) in prob), np.zeros(2)))
        assert np.allclose(m.score_words([w])[0], np.log(f[-1]), rtol=1e-9)
    assert len(langid.load_pieces()) > 50_000
    with pytest.raises(FileNotFoundError):
        langid.load_pieces("/nowhere")
