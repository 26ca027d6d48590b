"""Language-model scoring with a probabilistic suffix tree over running text.

The symbols are the bytes of a text's lower-cased words, a space after each word, and the text's end. What stands before the
first word is a space and the text's beginning. A context is a run of up to ``DEPTH`` symbols, of several words too. A context is retained
when it occurs ``min_count`` times or more and its occurrences times the Kullback-Leibler divergence of its next-symbol distribution
from that of its suffix are ``min_nats`` or more; the suffixes of a retained context are retained too, and so are all contexts of up to
two symbols. Distributions are smoothed towards the suffix's by the number of different symbols seen (Witten and Bell). A text's
score is the sum over all of its symbols, each given the longest retained suffix of all that stands before it.

All is learned from all training texts with their counts. A window is a symbol with the ``DEPTH`` before it, packed into 64 bits, nearest
symbol first, so that contexts with a common suffix are neighbours. Windows are summed in tasks, dealt by their last three context symbols,
and summed again; there all longer contexts are at hand with their suffixes, and every one is tested. So the tree grows with
the corpus. It is measured, and broadcast in parts of about ``PART`` bytes, of which a task holds one at a time if there are more than one;
each batch looks up its distinct windows in the part that has their context.

Defined cases: a null text is empty and has one symbol, its end. Every row is scored for itself, equal rows alike. With
no training text every symbol has the same probability.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc_mod, mix, released, small_batches, text_bytes, trimmed, written

DEPTH, SYMBOLS = 7, 256
#: Bytes that UTF-8 doesn't have.
BEGINNING, END = b"\xfe", b"\xff"
_HEAD = BEGINNING * (DEPTH - 1) + b" "
BUCKETS, CHUNK, PART = 1024, 500_000, 32_000_000
#: Windows of a task that are summed at once; bytes of texts whose windows are looked up together, and windows in one step of it.
GATHERED, TOGETHER, STEP = 2_500_000, 4_000_000, 200_000
_U = np.uint64


def normal(words: list[bytes]) -> bytes:
    """The symbols of a text with what stands before them."""
    return _HEAD + b" ".join([*words, END])


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of normal texts in order, and each text's number of them."""
    flat = b"".join(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ok = np.ones(len(flat) - DEPTH, dtype=bool)  # by the first of a window's bytes, of which the last is highest
    ok[((np.cumsum(sizes)[:-1] - DEPTH)[:, None] + np.arange(DEPTH)).ravel()] = False
    key = np.ndarray(len(ok), dtype="<u8", buffer=flat, strides=(1,))[ok]
    return (key << _U(8)) | (key >> _U(56)), sizes - DEPTH


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, n = k[order], n[order]
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), dtype=bool), k[1:] != k[:-1])))
    return k[at], np.add.reduceat(n, at) if len(at) else n


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences, which compress well."""
    return np.diff(keys, prepend=_U(0)).tobytes()


def unpacked(scalar) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(np.frombuffer(scalar.as_buffer(), dtype=np.uint64), dtype=np.uint64)


def bucket(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys >> _U(40)) % _U(BUCKETS)).astype(np.int16)


def _chunks(texts: list[bytes], most: int = CHUNK):
    """Places of texts, about ``most`` bytes at a time."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + DEPTH + 1
        if size > most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _counted(batches):
    """``bucket, keys, counts`` of each task's windows, passed on whenever many have gathered."""
    import pyarrow as pa

    def out():
        k = np.concatenate(gathered)
        gathered.clear()
        k.sort()
        at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        n, k = np.diff(np.append(at, len(k))), k[at]
        own = bucket(k)
        order = np.argsort(own, kind="stable")
        own, k, n = own[order], k[order], n[order]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1, [len(own)]))
        part = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(own[edges[:-1]].astype(np.int32)), pa.array([packed(k[i:j]) for i, j in part], pa.binary()), pa.array([n[i:j].tobytes() for i, j in part], pa.binary())], names=["bucket", "keys", "counts"])

    gathered: list[np.ndarray] = []
    for b in batches:
        texts = text_bytes(b.column(0))
        for i, j in _chunks(texts):
            gathered.append(windows([normal(t.lower().split()) for t in texts[i:j]])[0])
            if sum(map(len, gathered)) > GATHERED:
                yield out()
    if gathered:
        yield out()


def _merged(batches):
    """The rows of each bucket made one, from a partition sorted by bucket."""
    import pyarrow as pa

    def out():
        k, n = summed(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([packed(k)], pa.binary()), pa.array([n.tobytes()], pa.binary())], names=["bucket", "keys", "counts"])

    own, keys, counts, waiting = None, [], [], 0
    for b in batches:
        for x, k, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
            if x != own:
                if keys:
                    yield out()
                own, keys, counts, waiting = x, [], [], 0
            keys.append(unpacked(k))
            counts.append(np.frombuffer(n.as_buffer(), dtype=np.int64))
            waiting += len(keys[-1])
            if waiting > 1_500_000:
                k, n = summed(keys, counts)
                keys, counts, waiting = [k], [n], 0
    if keys:
        yield out()


def _low(batches):
    """Counts of symbols after each two."""
    import pyarrow as pa

    for b in batches:
        for k, n in zip(b.column(0), b.column(1), strict=True):
            k = unpacked(k)
            k, n = summed([(k >> _U(48) << _U(8)) | (k & _U(255))], [np.frombuffer(n.as_buffer(), dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(n)], names=["k", "n"])


class Low:
    """Distributions after two symbols: ``dist[row[two symbols]]``; the rows after those seen are for what follows a symbol, or none."""

    def __init__(self, k: np.ndarray, n: np.ndarray):
        pairs = np.unique(k >> 8)
        table = np.zeros((len(pairs), SYMBOLS))
        table[np.searchsorted(pairs, k >> 8), k & 255] = n
        one = np.zeros((256, SYMBOLS))
        np.add.at(one, pairs >> 8, table)
        root = (one.sum(axis=0) + 1) / (one.sum() + SYMBOLS)
        first = self.smoothed(one, root)
        self.row = len(pairs) + (np.arange(65536) >> 8)
        self.row[pairs] = np.arange(len(pairs))
        self.dist = np.concatenate((self.smoothed(table, first[pairs >> 8]), first))

    @staticmethod
    def smoothed(n: np.ndarray, up: np.ndarray) -> np.ndarray:
        w = np.maximum((n > 0).sum(axis=1, keepdims=True), 1)
        return (n + w * up) / (n.sum(axis=1, keepdims=True) + w)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return self.dist[self.row[(keys >> _U(48)).astype(np.int64)], (keys & _U(255)).astype(np.int64)]


def _mask(d: int) -> np.uint64:
    """The nearest ``d`` context symbols of a window."""
    return _U(((1 << 64) - 1) ^ ((1 << (8 * (8 - d))) - 1))


def retained(keys: np.ndarray, counts: np.ndarray, low: Low, min_count: int, min_nats: float) -> dict[int, tuple]:
    """By depth from 3: the retained contexts of a bucket and their weights (log10) for their suffixes, their windows and the log10 probabilities of these."""
    levels = {DEPTH: (keys, counts, None)}
    for d in range(DEPTH - 1, 2, -1):
        k = (levels[d + 1][0] & _mask(d)) | (levels[d + 1][0] & _U(255))
        own, at = np.unique(k, return_inverse=True)
        levels[d] = own, np.bincount(at, weights=levels[d + 1][1]).astype(np.int64), None
        levels[d + 1] = (*levels[d + 1][:2], at)
    out, dist = {}, None
    for d in range(3, DEPTH + 1):
        k, n, at = levels[d]
        up = low.of(k) if d == 3 else dist[at]
        contexts, of = np.unique(k & _mask(d), return_inverse=True)
        size, w = np.bincount(of, weights=n), np.bincount(of)
        dist = (n + w[of] * up) / (size + w)[of]
        gain = np.bincount(of, weights=n * np.log(n / size[of] / up))
        out[d] = [(size >= min_count) & (gain >= min_nats), contexts, of, np.log10(w / (size + w)), k, np.log10(dist)]
    for d in range(DEPTH, 3, -1):  # suffixes of retained contexts
        out[d - 1][0][np.searchsorted(out[d - 1][1], out[d][1][out[d][0]] & _mask(d - 1))] = True
    return {d: (c[keep], weight[keep], k[keep[of]], logp[keep[of]]) for d, (keep, c, of, weight, k, logp) in out.items()}


_TREE = ("contexts", "weights", "windows", "logp")
_KINDS = (np.uint64, np.float32, np.uint64, np.float32)


def _tested(held, min_count: int, min_nats: float):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for own, k, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                found = retained(unpacked(k), np.frombuffer(n.as_buffer(), dtype=np.int64), held.value, min_count, min_nats)
                ds = [d for d in found if len(found[d][0])]
                cols = [pa.array([found[d][i].astype(t).tobytes() for d in ds], pa.binary()) for i, t in enumerate(_KINDS)]
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(ds), pa.int32()), pa.array(ds, pa.int32()), *cols], names=["bucket", "depth", *_TREE])

    return run


def fit(texts: DataFrame, min_count: int = 8, min_nats: float = 16.0) -> tuple[Low, DataFrame]:
    """The distributions after two symbols, and the tree's longer contexts by bucket and depth, from all texts (one column)."""
    kind = "bucket int, keys binary, counts binary"
    counts = written(texts.mapInArrow(trimmed(_counted), kind).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(trimmed(_merged), kind))
    low = counts.select("keys", "counts").mapInArrow(trimmed(_low), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    low = Low(low.column(0).to_numpy(), low.column(1).to_numpy())
    held = texts.sparkSession.sparkContext.broadcast(low)
    tree = counts.mapInArrow(trimmed(_tested(held, min_count, min_nats)), "bucket int, depth int, " + ", ".join(f"{c} binary" for c in _TREE))
    return low, released(written(tree))


def parts(tree: DataFrame) -> list:
    """The tree as broadcast parts: by depth, sorted contexts with weights and windows with probabilities."""
    sc, size = tree.sparkSession.sparkContext, sum((F.length(c) for c in _TREE), F.lit(0))
    n = max(1, math.ceil((tree.agg(F.sum(size)).first()[0] or 0) / PART))
    out = []
    for p in range(n):
        rows = tree.filter(F.col("bucket") % n == p).toArrow()
        depth, part = np.array(rows.column("depth").to_pylist(), dtype=np.int64), {}
        for d in np.unique(depth).tolist():
            some = rows.take(np.flatnonzero(depth == d))
            c, w, k, v = (np.concatenate([np.frombuffer(x.as_buffer(), dtype=t) for x in some.column(name)]) for name, t in zip(_TREE, _KINDS, strict=True))
            i, j = np.argsort(c), np.argsort(k)
            part[d] = c[i], w[i], k[j], v[j]
        out.append(sc.broadcast(part))
    return out


def _places(sorted_: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
    return at, sorted_[at] == keys


def look_up(keys: np.ndarray, low: Low, part: dict[int, tuple]) -> np.ndarray:
    """log10 probabilities of sorted windows: from each one's longest retained context, with weights on the way to where its symbol was seen."""
    out, open_ = np.log10(low.of(keys)), np.arange(len(keys))
    for d in range(3, DEPTH + 1):
        if d not in part or not len(open_):
            break
        contexts, weights, ks, logp = part[d]
        k = keys[open_]
        c = k & _mask(d)
        first = np.concatenate(([True], c[1:] != c[:-1]))
        at, ok = _places(contexts, c[first])
        of = np.cumsum(first) - 1
        mine = ok[of]
        open_, k, c = open_[mine], k[mine], c[mine]
        out[open_] += weights[at[of[mine]]]
        at, ok = _places(ks, c | (k & _U(255)))
        out[open_[ok]] = logp[at[ok]]
    return out


def _part(held, only: bool):
    """A broadcast part's value; of several, a task keeps none."""
    return held.value if only or not getattr(held, "_path", None) else held.load_from_path(held._path)


def score_texts(texts: list[bytes], low: Low, tree: list) -> np.ndarray:
    """log10 probability of each normal text. The distinct windows of all of them are looked up together."""
    chunks = list(_chunks(texts))
    own = np.zeros(0, dtype=np.uint64)
    for i, j in chunks:
        own = np.concatenate((own, windows(texts[i:j])[0]))
        own.sort()
        own = own[np.concatenate(([True], own[1:] != own[:-1]))]
    logp, of = np.zeros(len(own)), bucket(own) % len(tree)
    for p, held in enumerate(tree):
        mine = np.flatnonzero(of == p)
        if len(mine):
            part = _part(held, len(tree) == 1)
            for i in range(0, len(mine), STEP):
                logp[mine[i : i + STEP]] = look_up(own[mine[i : i + STEP]], low, part)
            del part
    out = []
    for i, j in chunks:
        keys, sizes = windows(texts[i:j])
        order = np.argsort(keys)
        k = keys[order]
        first = np.concatenate(([True], k[1:] != k[:-1]))
        keys = np.empty(len(k))
        keys[order] = logp[np.searchsorted(own, k[first])][np.cumsum(first) - 1]
        out.append(np.add.reduceat(keys, np.cumsum(sizes) - sizes))
    return np.concatenate(out)


def _words_counted(batches):
    """Counts of the lower-cased words of each task's texts, passed on whenever many have gathered; the empty word counts texts."""
    import pyarrow as pa

    def out(c):
        return pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    c: Counter = Counter()
    for b in batches:
        for t in text_bytes(b.column(0)):
            c.update(t.lower().split())
            c[b""] += 1
            if len(c) > 100_000:
                yield out(c)
                c = Counter()
    if c:
        yield out(c)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all texts (one column); the empty word's count is the number of texts."""
    return texts.mapInArrow(trimmed(_words_counted), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def often(counts: DataFrame, most: int) -> DataFrame:
    """The words of the largest counts, about ``most`` of them and no more: by a threshold from a histogram of counts by their logarithms, so that no task orders all words."""
    size = F.floor(16 * F.log2("n"))
    hist = {r.b: r["count"] for r in counts.groupBy(size.alias("b")).count().collect()}  # some hundreds of rows
    least, held = None, 0
    for b in sorted(hist, reverse=True):
        held += hist[b]
        if held > most:
            break
        least = b
    return counts.filter(size >= least) if least is not None else counts.limit(0)


def _scored(low, tree, common, train_tokens: int, vocabulary: int):
    def run(batches):
        import pyarrow as pa

        words_held, base_held = common.value
        place = {w: i for i, w in enumerate(words_held)}
        floor = math.log10(train_tokens + vocabulary + 1)
        for whole in batches:
            texts = text_bytes(whole.column(1))
            for begin, end in _chunks(texts, TOGETHER):
                b, n, base, known, rare, times, plain = whole.slice(begin, end - begin), [], [], [], [], [], []
                for t in texts[begin:end]:
                    words = t.lower().split()
                    plain.append(normal(words))
                    words.append(b"")  # the text's end
                    at = np.array([place.get(w, -1) for w in words])
                    at = at[at >= 0]
                    c = Counter(w for w in words if w not in place) if len(at) < len(words) else {}
                    n.append(len(words))
                    base.append(base_held[at].sum() - len(words) * floor)
                    known.append(len(at))
                    rare.append(list(c))
                    times.append(list(c.values()))
                lm = score_texts(plain, low.value, tree)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(lm, pa.float64()), pa.array(base, pa.float64()), pa.array(known, pa.int64())]
                    + [pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                    names=["doc_id", "held_out", "n_tokens", "score", "base", "known", "rare", "times"],
                )

    return run


def score_running_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held_out: int = 2, common: int = 200_000, **tree) -> DataFrame:
    """Fit on the rows whose id isn't held out, then score every row with the tree and with the add-one unigram of words."""
    sc = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), (crc_mod(F.col(id_col), modulus) == held_out).alias("held_out"))
    train = rows.filter(~F.col("held_out")).select("text")
    low, found = fit(train, **tree)
    held = sc.broadcast(low), parts(found)
    counts = checkpointed(word_counts(train))
    zero = F.lit(0)
    tokens, vocabulary = counts.agg(F.coalesce(F.sum("n"), zero), F.count(zero)).first()
    top = often(counts, common).toArrow()
    words = top.column("word").to_pylist(), np.log10(top.column("n").to_numpy() + 1.0)
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, score double, base double, known long, rare array<binary>, times array<long>"
    out = rows.select("doc_id", "text", "held_out").mapInArrow(trimmed(_scored(*held, sc.broadcast(words), tokens, vocabulary)), kind)
    out = checkpointed(out.withColumn("row", F.monotonically_increasing_id()))
    rare = out.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("k"))
    seen, k = F.col("n"), F.col("k")
    more = rare.join(counts, "word").groupBy("row").agg(F.sum(k * F.log10(seen + 1)).alias("more"), F.sum(k).alias("seen"))
    whole = out.drop("rare", "times").join(more, "row", "left")
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("seen", zero)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", zero)).alias("base_score"), "score")
