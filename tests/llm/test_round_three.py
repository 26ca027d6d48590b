"""Delta clustering, fill-in-the-middle and removal of repeats, each against a brute-force version."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from capturemill.llm import delta_lloyd, fill_middle, queries, repeats


def _sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# --- delta clustering -----------------------------------------------------------------------------------


def _lloyd(rows, k, rounds, dims):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, _sha(f"3:{r[0]}"), r[1]))
    at = [list(q) for _, q in kept[:k]]

    def owners():
        out = []
        for _, q in kept:
            d = [sum((a - b) ** 2 for a, b in zip(q, c, strict=True)) for c in at]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = owners()
        for c in range(len(at)):
            members = [q for (_, q), (o, _) in zip(kept, own, strict=True) if o == c]
            if members:
                at[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = owners()
    inertia = Counter()
    for o, d in own:
        inertia[o] += d
    return sorted(((i, o, d, inertia[o], sum(inertia.values()), _sha(",".join(map(str, at[o])))) for (i, _), (o, d) in zip(kept, own, strict=True)), key=str)


def _clustered(df, **how):
    return sorted(map(tuple, delta_lloyd.cluster(df, **how).drop("centroid").collect()), key=str)


def test_lloyd_equals_brute_force_with_odd_vectors(spark):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(rng.choice([-1, 0, 2]), 0.4) for _ in range(4)]) for i in range(300)]
    rows += [(7, rows[7][1]), (None, [0.1, 0.2, 0.3, 0.4]), (400, None), (401, []), (402, [1.0] * 3), (403, [1.0, None, 1.0, 1.0]), (404, [float("nan")] * 4), (405, [float("inf")] * 4)]
    rows += [(500 + i, [0.5] * 4) for i in range(100)]  # one vector over and over
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, owner int").repartition(5)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert _clustered(df, k=5, rounds=6, dims=4) == _lloyd(rows, 5, 6, 4)
    assert _clustered(df, k=5, rounds=40, dims=4) == _lloyd(rows, 5, 40, 4)  # stops at rest


def test_lloyd_with_few_equal_or_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    equal = [(i, [1.5, -2.25]) for i in range(6)]
    assert _clustered(spark.createDataFrame(equal, kind), k=4, dims=2) == _lloyd(equal, 4, 10, 2)
    assert {r[1] for r in _clustered(spark.createDataFrame(equal, kind), k=4, dims=2)} == {0}
    assert _clustered(spark.createDataFrame(equal[:2], kind), k=8, dims=2) == _lloyd(equal[:2], 8, 10, 2)
    assert _clustered(spark.createDataFrame([], kind)) == []
    assert _clustered(spark.createDataFrame([(1, [3e38, -3e38])], kind), dims=2)[0][2] == 0


def test_lloyd_compares_what_moved_alone():
    """Rows of an owner that stayed are compared with changed centroids only, with the outcome of a full comparison."""
    rng = np.random.default_rng(3)
    x, old = rng.integers(-50, 50, (400, 3)), rng.integers(-50, 50, (5, 3))
    owner, distance = delta_lloyd.reassign(x, np.full(400, -1), np.zeros(400, np.int64), old, np.ones(5, bool))
    new, changed = old.copy(), np.array([False, True, False, True, False])
    new[changed] += rng.integers(-9, 9, (2, 3))
    got = delta_lloyd.reassign(x, owner, distance, new, changed)
    want = delta_lloyd.reassign(x, np.full(400, -1), np.zeros(400, np.int64), new, np.ones(5, bool))
    assert all((a == b).all() for a, b in zip(got, want, strict=True))
    poisoned = new.copy()
    poisoned[0] = 10**6  # never looked at by rows of owners that stayed
    kept = ~changed[owner]
    assert (delta_lloyd.reassign(x[kept], owner[kept], distance[kept], poisoned, changed)[0] == want[0][kept]).all()


# --- fill in the middle ---------------------------------------------------------------------------------

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def _fim(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    d = _sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(u), "plain", None, None, _sha(text), _sha(text))
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return (doc_id, len(u), form, len(prefix), len(middle), _sha(out), _sha(text))


def test_fill_middle_equals_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("aZ é日😀\n<PS>M.1") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "a" * 300_000, "a<P>b", "x<M>", "😀" * 70_000, ("word " * 40_000) + "é", "z" * 70_000 + " end"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, texts[3]), (3, "another text of one id")]
    df = spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id long, text string, form string, n int").repartition(3)
    for every in (1, 7, 1024):
        got = sorted(map(tuple, fill_middle.digests(fill_middle.fill_middle(df, every=every)).collect()), key=str)
        assert got == sorted((_fim(*r) for r in rows), key=str)
    assert fill_middle.fill_middle(df.limit(0)).count() == 0


def test_checkpoints_seek_every_unit():
    rng = random.Random(9)
    for _ in range(60):
        text = "".join(rng.choice("ab é日-") * rng.randint(1, 30) for _ in range(rng.randint(0, 30)))
        units = UNIT.findall(text)
        index = fill_middle.Checkpoints(text.encode(), every=rng.choice([1, 2, 5, 64]))
        assert (index.n, index.n_points) == (len(units), len(text))
        for u in range(len(units) + 1):
            head = "".join(units[:u])
            assert index.seek(u) == (len(head.encode()), len(head))
        assert len(index.unit_at) == -(-len(units) // index.every)  # sparse


# --- repeats --------------------------------------------------------------------------------------------


def _covered(texts, length):
    n = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if n[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        out.append(gone)
    return out


def _without(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    return sorted(((i, len(t), sum(g), bytes(g).count(b"\x00\x01") + (g[:1] == b"\x01"), _sha(bytes(x for x, f in zip(t, g, strict=True) if not f))) for (i, _), t, g in zip(rows, texts, _covered(texts, length), strict=True)), key=str)


def test_expansion_equals_brute_force_on_drawn_texts():
    rng = random.Random(2)
    for _ in range(150):
        length, letters = rng.choice([4, 8, 20]), rng.choice(["a", "ab", "abcd", "abcdefghij"])
        gram, block = rng.randint(1, length), rng.choice([1, 60, 10_000])
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(length, 80))).encode() for _ in range(rng.randint(1, 7))]
        texts += [rng.choice(texts) for _ in range(rng.randint(0, 2))]
        group = [(seed, t[at : at + n + length - 1], 1, [(i, at)]) for i, t in enumerate(texts) for at, n, seed, _ in zip(*(x.tolist() for x in repeats.seed_runs(t, length, gram)), strict=True)]
        got = [bytearray(len(t)) for t in texts]
        for places, a, b in repeats.judged(sorted(group, key=lambda r: r[0]), length, gram, block):
            for i, at in places:
                for s in range(at + a, at + b):
                    got[i][s : s + length] = b"\x01" * length
        assert got == _covered(texts, length)


def test_expansion_gives_common_prefixes_by_value():
    """What stays open after ``k`` levels are the neighbours that share ``k`` symbols or more."""
    rng = random.Random(4)
    for _ in range(40):
        codes = np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 300))] + [0], dtype=np.uint16)
        order = repeats.bounded_suffixes(codes, 16)
        suffix = [codes[i:].tolist() for i in order]
        assert [s[:16] for s in suffix] == sorted(s[:16] for s in suffix)
        for k in (1, 2, 5, 16):
            assert repeats.long_neighbours(codes, order, k).tolist() == [i > 0 and suffix[i][:k] == suffix[i - 1][:k] and len(suffix[i]) >= k for i in range(len(suffix))]


@pytest.mark.parametrize("how", [{}, {"hot": 1}, {"hot": 1, "block": 300}, {"gram": 9}])
def test_repeats_equal_brute_force_on_a_table(spark, how):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line, passage, near = prose(4), prose(20), prose(120).split(" ")
    texts = [prose(20) + " " + line + " " + prose(20) for _ in range(60)]  # a frequent line in changing text
    texts += [prose(rng.randint(0, 20)) + passage + prose(rng.randint(0, 20)) for _ in range(60)]  # a shared passage
    for _ in range(40):  # near copies
        own = list(near)
        own[rng.randrange(len(own))] = word()
        texts.append(" ".join(own))
    texts += [texts[70]] * 30 + ["short"] * 5 + [None, "", "q" * 3_000, "xy" * 400, passage + line + passage]
    rows = [(i % 200, t) for i, t in enumerate(texts)] + [(None, texts[0])]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, k1 int, seed string").repartition(4)
    assert sorted(map(tuple, repeats.digests(df, length=64, **({"gram": 20} | how)).collect()), key=str) == _without(rows, 64)


def test_remove_repeats_keeps_rows_and_columns(spark):
    twice = "the same passage of more than forty bytes, twice"
    df = spark.createDataFrame([(1, "one " + twice, "a"), (2, twice + " two", "b"), (2, None, None)], "doc_id long, text string, kept_bytes string")
    got = {r.text: r for r in repeats.remove_repeats(df, length=40, gram=10).collect()}
    assert len(got) == 3 and set(df.columns) < set(got[None].__fields__)
    assert bytes(got["one " + twice].kept_bytes) == b"one " and bytes(got[twice + " two"].kept_bytes) == b" two"
    assert got[None].kept_bytes is None and got[None].removed_spans == []
    assert repeats.digests(df.limit(0)).count() == 0
    assert repeats.remove_repeats(df.where(F.col("text").isNull()), length=40, gram=10).count() == 1


@pytest.mark.parametrize("name", ["op11_delta_lloyd", "op12_fill_middle", "op13_suffix_array_dedup"])
def test_queries_equal_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    rel = con.sql(queries.ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    assert sorted(map(str, (tuple(r) for r in df.select(cols).collect()))) == sorted(map(str, rel.select(*cols).fetchall()))
