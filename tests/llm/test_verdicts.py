"""The verdict of the quality rules against a brute-force version, and the grammar round trip on drawn control strings."""

import collections
import hashlib
import math
import random
import unicodedata

from capturemill.llm import chat, quality, sharding

COLUMNS = "doc_id long, text string, lang string"


def _words(t):
    return [w.decode() for w in (t or "").encode().split()]


def _classes(t):
    n = collections.Counter()
    for c in t:
        cat = unicodedata.category(c)
        n["lower" if cat == "Ll" else "upper" if cat == "Lu" else "digit" if cat == "Nd" else "stop" if c in ".,;:!?'\"" else "symbol" if c in "#*$%&|<>@+=~^_{}[]\\/()-" else "none"] += 1
    return [n[k] for k in (*quality.CLASSES, "none")]


def _common(w, lang):
    n = collections.Counter(x.rstrip(".,").lower() for x in w)
    own = [n[x] for x in quality.COMMON[lang]]
    return [*own, len(w) - sum(own)]


def _distance(a, b):
    p, q = ([x / max(sum(v), 1) for x in v] for v in (a, b))
    return math.sqrt(max(0.0, sum(x * math.log2(2 * x / (x + y)) for u, v in zip(p, q, strict=True) for x, y in ((u, v), (v, u)) if x > 0) / 2))


def _failed(w):
    at = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {i + k for i in range(len(w) - 2) if at[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w) < 50 or 100 * len(cover) > 50 * len(w)


def test_quality_verdict_by_definition(spark):
    draw = random.Random(3)
    rows = []
    for i in range(24):
        lang = ["en", "fr", None][i % 3]
        some = quality.COMMON[lang or "en"]
        w = [draw.choice(some) if draw.random() < 0.5 else f"w{'abcdefghij'[draw.randrange(10)]}{'abcdefghij'[draw.randrange(10)]}{draw.choice(['', '.', ','])}" for _ in range(60 + 10 * i)]
        rows.append((i, " ".join(w), lang))
    rows += [(50, " ".join(str(10**6 + k) for k in range(80)), "en"), (51, " ".join(f"<{'x' * (k % 9)}|{k}>" for k in range(120)), None), (52, " ".join(f"zz{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)), "en"), (53, None, "en"), (54, "", None), (55, "same three words " * 40, "fr"), (56, "# * $ % & | < >", None), (None, rows[0][1], "en")]
    rows += [rows[1], rows[1]]
    base = [r for r in rows if r[2] in quality.COMMON and not _failed(_words(r[1]))]
    refs = {lang: ([sum(x) for x in zip(*(_classes(r[1]) for r in base if r[2] == lang), strict=True)], [sum(x) for x in zip(*(_common(_words(r[1]), lang) for r in base if r[2] == lang), strict=True)]) for lang in {r[2] for r in base}}
    want = []
    for i, t, _ in rows:
        w, t = _words(t), t or ""
        a = min(_distance(_classes(t), c) for c, _ in refs.values())
        b = min(_distance(_common(w, lang), c) for lang, (_, c) in refs.items())
        odd = (sum(map(len, w)) >= 200 and a > 0.25) or (len(w) >= 50 and b > 0.3 + 0.7 / math.sqrt(len(w)))
        want.append((i, sum(c in "#*$%&|<>" for c in t), not _failed(w) and not odd, round(a, 6), round(b, 6)))
    docs = spark.createDataFrame([(*r, "clash") for r in rows], COLUMNS + ", n_words string")
    got = quality.divergence_rules(docs).collect()
    assert collections.Counter((r.doc_id, r.n_symbols, r.kept, round(r.class_jsd, 6), round(r.common_jsd, 6)) for r in got) == collections.Counter(want)
    kept = {i for i, _, k, _, _ in want if k}
    assert kept >= set(range(24)) and not kept & {50, 51, 52, 53, 54, 55, 56}


def test_quality_without_rows_or_references(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(60)), None), (2, None, None)], COLUMNS)
    assert {r.doc_id: r.kept for r in quality.divergence_rules(docs).collect()} == {1: True, 2: False}
    assert quality.divergence_rules(docs.limit(0)).count() == 0


def test_chat_round_trip_of_drawn_control_strings(spark):
    """One pass of escapes is enough: whatever is put together of control strings, escapes and their parts comes back identical."""
    draw = random.Random(11)
    parts = ["\\", "\\s", "\\t", "\\m", "\\c", "\\n", "</turn>", "</turn", ">", "\n", "###", "##", "#", " ", ": ", ":", "a", "\U0001f600", "\\\\", "### user: "]
    rows = []
    for c in range(300):
        for turn in range(draw.randrange(1, 5)):
            role = draw.choice(["user", "assistant", "".join(draw.choices(parts, k=draw.randrange(4)))])
            rows.append((c, turn, role, "".join(draw.choices(parts, k=draw.randrange(9)))))
    got = chat.digests(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert len(got) == 300
    for r in got:
        mine = [(role, text) for c, _, role, text in rows if c == r.conv_id]
        loss = "".join(text for role, text in mine if role == "assistant")
        assert r.round_trip and r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(None, None, None, None, "x"), (None, 1, "user", "q", "x"), (1, 2, "user", "b", "x"), (1, 2, "user", "b", "x"), (1, None, "assistant", "last", "x")]
    t = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in chat.format_conversations(t).collect()}
    assert [(x.role, x.text) for x in got[1].turns] == [("user", "b"), ("user", "b"), ("assistant", "last")]
    assert [(x.role, x.text) for x in got[None].turns] == [("user", "q"), ("", "")] and all(r.round_trip for r in got.values())
    assert chat.digests(chat.format_conversations(t.limit(0))).count() == 0


def test_sharding_has_no_python_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = sharding.hilbert_shards(docs, n_shards=40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
