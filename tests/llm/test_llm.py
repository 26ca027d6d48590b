"""Each operator against a brute-force version or an exact property, with the awkward rows."""

import base64
import collections
import gzip
import hashlib
import math
import zlib
from fractions import Fraction
from urllib.parse import quote

import pytest

from capturemill.llm import chat, context_lm, decontaminate, html_text, jaccard, langid, mixing, quality, secrets, sharding

WORDS = "the of and to in is that river stone light walks under blue open gate morning quiet field over small ships carry salt north".split()


def _text(seed, n):
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="module")
def docs(spark):
    long = _text(99, 3000)
    near = _text(5, 200).split()
    near[50] = "changed"
    rows = [(i, _text(i, 40 + 13 * i), ["en", "fr", None][i % 3], f"src{i % 4}") for i in range(30)]
    rows += [(100, None, "en", None), (101, "", "fr", "src1"), (102, "   \n\t", None, "src1"), (103, long, "en", "src0"), (104, long, "en", "src0"), (105, _text(5, 200), "en", "src2"), (106, " ".join(near), "en", "src2"), (107, "ok", "en", "src3"), (107, "ok", "en", "src3"), (None, "no id here", None, "src3")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def _words(t):
    return (t or "").encode().lower().split()


def test_jaccard_components(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()) for w in (_words(t) for _, t in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    want = collections.Counter((rows[i][0], len(sets[i]), min((rows[k][0] for k in range(len(rows)) if group[k] == group[i] and rows[k][0] is not None), default=None)) for i in range(len(rows)))
    got = jaccard.similar_components(docs).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    links = [sum(1 for j in range(len(rows)) if i != j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])) for i in range(len(rows))]
    assert collections.Counter((r.doc_id, r.n_links) for r in got) == collections.Counter((rows[i][0], k) for i, k in enumerate(links))


def test_jaccard_of_a_large_group_of_copies(spark):
    base = _text(3, 120).split()
    rows = []
    for i in range(40):
        t = list(base)
        t[(3 * i) % 120] = f"edit{i}"
        rows.append((i, " ".join(t)))
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


@pytest.mark.parametrize("most, shingles", [(2048, 2_000_000), (7, 2_000_000), (2048, 900)])
def test_jaccard_links_within_groups(spark, monkeypatch, most, shingles):
    """Near copies at all distances, some of them with exact copies: every link is counted, in one block and in several."""
    monkeypatch.setattr(jaccard, "LINK_SETS", most)
    monkeypatch.setattr(jaccard, "LINK_SHINGLES", shingles)
    rows = []
    for g in range(3):
        base = _text(30 + g, 110).split()
        for i in range(30):
            t = list(base)
            for k in range(i % 7):
                t[(17 * i + 31 * k) % 110] = f"e{g}x{i % 4}x{k}"
            rows += [(len(rows), " ".join(t))] * (1 + (i % 11 == 0))
    rows += [(1000 + i, _text(400 + i, 60)) for i in range(5)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (_words(t) for _, t in rows)]
    want = collections.Counter((rows[i][0], sum(1 for j in range(len(rows)) if i != j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]))) for i in range(len(rows)))
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.n_links) for r in got) == want
    assert len({k for _, k in want}) > 5  # neither all pairs nor none


def test_jaccard_lists_in_blocks(spark, monkeypatch):
    """Many unlike texts with one passage: their long lists are dealt to blocks, and near copies among them are found."""
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    passage = _text(3, 30)
    texts = {i: passage + " " + " ".join(f"w{i}x{k}" for k in range(i % 9)) for i in range(60)}
    texts |= {100 + i: passage + " " + " ".join(f"v{i // 2}x{k}" for k in range(40 if i % 2 else 43)) for i in range(40)}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, _words(t)) for i, t in texts.items())}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and root[i] != root[j]:
                lo, hi = sorted((root[i], root[j]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    got = jaccard.similar_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == root


def test_jaccard_bitmaps_bound_the_difference():
    import numpy as np

    draw = np.random.default_rng(5)
    for a, b in ((40, 44), (200, 300), (900, 1100), (5000, 6000)):
        x, y = (np.unique(np.concatenate((np.arange(k // 2, dtype=np.uint64) * np.uint64(7919), draw.integers(0, 1 << 60, k - k // 2).astype(np.uint64)))) for k in (a, b))
        low, high = jaccard._bitmaps(np.array([jaccard.bitmap(x), jaccard.bitmap(y)], dtype=object))
        for of in (low, high) if len(x) > 256 else (low,):
            assert np.bitwise_count(of[0] ^ of[1]).sum() <= len(np.setxor1d(x, y))


def test_jaccard_empty_table(spark):
    assert jaccard.similar_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tiling_finds_reordered_passages(spark):
    item = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(["x"] * 5 + item[15:] + ["y"] + item[:15])), (2, " ".join(item[:10])), (3, None), (4, "")]
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item)), (8, None)], "item_id long, text string")
    got = decontaminate.tiled_matches(d, b).collect()
    assert [(r.doc_id, r.item_id, r.covered, r.n_tiles) for r in got] == [(1, 7, 30, 2)]
    assert decontaminate.drop_contaminated(d, b).count() == 3


def test_shards_follow_the_curve(spark, docs):
    cells = sorted((r.h, r.cell) for r in sharding.curve_cells(spark, 2, 3).collect())
    assert [h for h, _ in cells] == list(range(64))
    xy = [(c >> 3, c & 7) for _, c in cells]
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(xy, xy[1:], strict=False))
    got = sharding.hilbert_shards(docs, n_shards=7).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(len(v) for v in by.values())[0] >= len(got) // 7 and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert sharding.shard_documents(docs, 5).count() == docs.count()


@pytest.mark.parametrize("text", ["plain", "\\### Assistant: </turn> ok", "</turn>\n### user: x</turn>\n", "\\s\\t\\m", "a\\", "", None, "###", "</turn", ": "])
def test_chat_round_trip(spark, text):
    t = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", text), (1, 2, "odd: role\n", text), (1, 3, "assistant", "end")], "conv_id long, turn long, role string, text string")
    r = chat.digests(chat.format_conversations(t)).first()
    loss = (text or "") + "end"
    whole = f"user\nq\nassistant\n{text or ''}\nodd: role\n\n{text or ''}\nassistant\nend\n"
    assert r.round_trip and r.n_turns == 4 and r.loss_chars == len(loss)
    assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()


def test_base_score_is_exact(docs):
    rows = docs.collect()
    train = [r for r in rows if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 != 2]
    c = collections.Counter(w for r in train for w in [*_words(r.text), b""])
    n, v = sum(c.values()), len(c)
    want = collections.Counter((r.doc_id, len(_words(r.text)) + 1, sum(c[w] > 0 for w in [*_words(r.text), b""]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*_words(r.text), b""]), 6)) for r in rows)
    for common in (200_000, 3):  # words that are broadcast, and words that are joined
        got = context_lm.score_running_text(docs, common=common).collect()
        assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(r.score < 0 for r in got)
    nothing = context_lm.score_running_text(docs.limit(0))
    assert nothing.count() == 0
    alone = context_lm.score_running_text(docs.filter("doc_id = 0")).collect()
    assert len(alone) == 1 and alone[0].score < 0


def test_frequent_words_by_a_threshold(spark):
    d = spark.createDataFrame([(bytearray(f"w{i}".encode()), i * i) for i in range(1, 400)], "word binary, n long")
    got = sorted(r.n for r in context_lm.often(d, 50).collect())
    assert 40 <= len(got) <= 50 and got == [i * i for i in range(400 - len(got), 400)]
    assert context_lm.often(d, 0).count() == 0 and context_lm.often(d.limit(0), 5).count() == 0 and context_lm.often(d, 1000).count() == 399


def _levels(sizes, weights, share=1.5, most=2):
    total, capped = sum(sizes.values()) * Fraction(share), set()
    while True:
        rest = {k: w for k, w in weights.items() if k not in capped}
        left = total - sum(most * sizes[k] for k in capped)
        over = {k for k in rest if rest and left * w_(rest, k) > most * sizes[k]}
        if not over:
            return {k: most * sizes[k] if k in capped else left * w_(rest, k) for k in sizes}
        capped |= over


def w_(rest, k):
    return Fraction(rest[k], sum(rest.values()))


def test_mixing_targets_and_taken(docs):
    got = mixing.mix_documents(docs).collect()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(_words(r.text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = _levels(sizes, {s: [5, 2, 1][i % 3] for i, s in enumerate(order)})
    taken = collections.Counter()
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    top = max(r.size for r in got)
    assert all(abs(taken[s] - want[s]) <= top for s in want) and len(got) == docs.count()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_documents(docs.repartition(3)).collect()))
    assert mixing.apply_mix(docs).count() == sum(r.copies for r in got)


def test_mixing_of_many_sources_is_the_same(docs, monkeypatch):
    want = sorted(map(str, mixing.mix_documents(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix_documents(docs).collect())) == want


def test_secret_layers_map_back():
    key = 'password = "hunter2hunter2"'
    b64 = base64.b64encode(key.encode()).decode()
    for wrapped in (quote(key), b64, base64.b64encode(b64.encode()).decode(), base64.b64encode(gzip.compress((key * 3).encode())).decode(), "".join(f"\\u{ord(c):04x}" for c in key)):
        text = f"before {wrapped} after"
        spans = secrets.all_spans(text)
        assert spans and all(7 <= a < b <= len(text) - 6 for a, _, b in spans), wrapped
        assert "[secret]" in secrets.redact(text)
    assert secrets.all_spans("") == [] and secrets.all_spans("clean words only") == []
    assert secrets.base_spans("token: abc") == [] and secrets.base_spans("ToKeN:abcdef") == [(0, 0, 12)]


def test_secret_base_spans_by_definition(spark):
    t = "x AKIA" + "A" * 16 + " " + "0f" * 12 + " api_key='abcdef12' \U0001f600 secret:zzzzzz"
    r = secrets.scan_documents(spark.createDataFrame([(1, t), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert (r[0].n_assign, r[0].n_access, r[0].n_hex) == (2, 1, 1) and r[0].base_sha256 == hashlib.sha256(r[0].spans.encode()).hexdigest()
    assert r[1].spans == "" and r[1].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_forward_sums_all_segmentations():
    import numpy as np

    m = langid.PieceModel(langid.load_pieces()[:400] + [b" ab", b"ab", b"b", b"a", b" "], ["x"])
    p = {bytes_: 0.0 for bytes_ in ()}
    prob = np.random.default_rng(1).random((len(m.hashes), 1))
    m.set(prob / prob.sum())
    pieces = {}
    for w in (b" ab", b"ab", b"b", b"a", b" ", b" a"):
        found = [x for x in m.lattice(np.frombuffer(w, dtype=np.uint8).reshape(1, -1))[len(w)] if x[0] == len(w)]
        pieces[w] = m.prob[found[0][2][0], 0] * math.exp(-langid._SCALE * len(w)) if found else 0.0
    want = pieces[b" ab"] + pieces[b" "] * pieces[b"ab"] + pieces[b" a"] * pieces[b"b"] + pieces[b" "] * pieces[b"a"] * pieces[b"b"]
    assert math.isclose(m.score_words([b"ab"])[0, 0], math.log(want), rel_tol=1e-9) and not p


def test_language_id_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = langid.identify(d, docs_per_lang=30).filter("held_out").join(d.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None, "en", "s"), (2, "123 !", "en", "s")], "doc_id long, text string, lang string, source string")
    assert {r.lang_pred for r in langid.identify(odd, learn=d, docs_per_lang=10).collect()} == {"und"}


def test_quality_base_counts(docs):
    for r in quality.divergence_rules(docs.filter("doc_id is not null").dropDuplicates(["doc_id"])).collect():
        t = {x.doc_id: x.text for x in docs.collect()}[r.doc_id] or ""
        w = [x.decode() for x in t.encode().split()]
        lines = [x for x in t.split("\n") if x.encode().split()]
        wins = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        cover = {i + k for i in range(len(w) - 2) if wins[tuple(w[i : i + 3])] > 1 for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (r.kept and r.base_failed)


def test_html_main_text(spark):
    nav = "<nav>Home About</nav><div class='cookie-notice'>We use cookies</div>"
    plain = "<div>Read all our other pages here now please today</div>"
    rows = [(1, "http://a.b/1", f"<html><head><title>T</title></head><body>{nav}<article><h1>Big &amp; <i>t</i>rue</h1><p>One<br>two&nbsp;three<script>x='<p>'</script></p><aside>Ad</aside><section class=comments><p>Nice!</p></section></article><footer>F</footer>"), (2, "u", None), (3, "u", "")]
    rows += [(10 + i, "http://h.c/x", f"<body>{plain}<div>{_text(i, 20)}</div></body>") for i in range(4)]
    got = {r.page_id: r.text for r in html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "Big & true One two three" and got[2] == got[3] == ""
    assert all(got[10 + i] == _text(i, 20) for i in range(4))


def test_native_operators_have_no_python_stage(spark):
    for q in (quality.features(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")), chat.format_conversations(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
