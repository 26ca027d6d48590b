"""Removal of passages that occur elsewhere, by interval expansion on a Burrows-Wheeler transform bounded by the passage length.

A byte goes when it lies in a ``length``-byte string that also starts at another place, in the same text or another. Strings are
judged on the input; matches never cross texts.

The corpus is dealt so that equal strings meet. Each ``length``-byte window has a *seed*, the least hash of its ``gram``-byte runs:
equal windows have equal seeds wherever they stand, and neighbouring windows mostly share one. Texts give their runs of windows of one
seed; runs whose seed is met once in the corpus are done. The bytes of the others move to their seed's task, which sorts their suffixes
by the first ``length`` bytes or more, transforms them, and derives common prefixes by value: intervals are extended backwards,
breadth first, level by level, and each interval end that is new at level ``l`` has a common prefix of ``l`` with what follows. Ends that
no level below ``length`` reaches stand between two places of one string.

What bounds a task: equal texts are one row; equal runs in one batch are one row that lists their places, and a batch sends a seed once
when seeds are counted. A seed of more than ``HOT`` runs (a frequent line within changing text) first has its windows counted by 128-bit
hashes, and only windows found twice go on; in its task, a seed of more than ``BLOCK`` bytes is dealt again by seeds of longer runs.

Defined cases: a null or empty text, or one under ``length`` bytes, keeps all (``n_bytes`` 0 for null); copies of a text of ``length``
bytes or more lose everything, with equal, repeated and null ids alike; a very long text is worked by pieces, a text of one repeated
character like any other; an empty table gives an empty result; other columns, whatever their names, pass through ``remove_repeats``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import _BYTE, _U, _powers, mix, released, shared_folder, small_batches, trimmed, written

LENGTH = 200
#: Bytes whose hash can be a seed. Longer ones are shared by chance less often; shorter ones make fewer runs.
GRAM = 48
#: A seed with more runs than this has its windows counted before their bytes move.
HOT = 20_000
#: Bytes that are transformed at once.
BLOCK = 500_000
_PIECE = 1 << 18
_WIDE = 64


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of every run of ``k`` bytes."""
    n = len(b) - k + 1
    up, down = _powers(len(b) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[b] * up[: len(b)], out=sums[1:])
        return mix((sums[k:] - sums[:n]) * down[:n])


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (w - size)], h[w - size :]) if size < w else h


def seed_runs(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and seed of each run of windows with one seed, and whether the seed stands in it twice, as it must if a window does."""
    at, n, seed, again, w = [], [], [], [], length - gram + 1
    for begin in range(0, len(data) - length + 1, _PIECE):
        b = np.frombuffer(data, np.uint8, min(_PIECE + length - 1, len(data) - begin), begin)
        h = gram_hashes(b, gram)
        m = window_minima(h, w)
        edge = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
        long = np.diff(np.append(edge, len(m)))
        around = np.lib.stride_tricks.sliding_window_view(np.append(h, np.zeros(2 * w, np.uint64)), 2 * w - 1)[edge] == m[edge, None]
        around &= np.arange(2 * w - 1) < (long + w - 1)[:, None]
        at.append(edge + begin)
        n.append(long)
        seed.append(m[edge].view(np.int64))
        again.append((around.sum(axis=1) > 1) | (long > w))
    if not at:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, bool),)
    return np.concatenate(at), np.concatenate(n), np.concatenate(seed), np.concatenate(again)


# --- one block: transform and expansion ---------------------------------------------------------------


def bounded_suffixes(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more. The last symbol is the least and stands there alone."""
    n = len(codes)
    bits = max(1, int(codes.max()).bit_length())
    h = min(63 // bits, depth, n)
    key = np.zeros(n, dtype=np.int64)
    for j in range(h):
        key <<= bits
        key[: n - j] |= codes[j:]
    suffixes = np.argsort(key).astype(np.int32)
    key = key[suffixes]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    rank = np.empty(n, dtype=np.int32)
    size = np.diff(np.append(head, n))
    rank[suffixes] = np.repeat(head, size)
    tied = np.flatnonzero(np.repeat(size > 1, size))
    while len(tied) and h < depth:
        sub = suffixes[tied]
        key = rank[sub].astype(np.int64) * n + rank[sub + h]
        order = np.argsort(key)
        sub, key = sub[order], key[order]
        suffixes[tied] = sub
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(head, len(tied)))
        rank[sub] = np.repeat(tied[head], size)
        tied = tied[np.repeat(size > 1, size)]
        h *= 2
    return suffixes


def long_neighbours(codes: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """For each place of the suffix order, whether it and the place before share ``length`` symbols or more."""
    n = len(codes)
    bwt = codes[suffixes - 1]
    order = np.argsort(bwt, kind="stable")
    where = bwt[order].astype(np.int64) * n + order
    back = np.empty(n, dtype=np.int32)
    back[order] = np.arange(n, dtype=np.int32)
    same = np.cumsum(np.concatenate(([False], bwt[1:] != bwt[:-1])), dtype=np.int32)
    symbols = np.unique(codes).astype(np.int64) * n
    open_ = np.ones(n + 1, dtype=bool)
    open_[[0, n]] = False
    low, high = np.zeros(1, dtype=np.int32), np.full(1, n, dtype=np.int32)
    for _ in range(length):
        # An interval with one symbol before it has one extension, whose ends are those of the interval; most are of this kind.
        last = high - 1
        one = same[low] == same[last]
        lows, highs = [back[low[one]]], [back[last[one]] + 1]
        low, high = low[~one], high[~one]
        wide = high - low > _WIDE
        if wide.any():
            a = np.searchsorted(where, (symbols[None, :] + low[wide, None]).ravel())
            b = np.searchsorted(where, (symbols[None, :] + high[wide, None]).ravel())
            lows.append(a[b > a].astype(np.int32))
            highs.append(b[b > a].astype(np.int32))
        first, size = low[~wide], (high - low)[~wide]
        if len(size):
            owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
            at = np.arange(len(owner), dtype=np.int32) + np.repeat(first - (np.cumsum(size, dtype=np.int32) - size), size)
            to = back[at]
            by = np.argsort(to)
            to, owner, symbol = to[by], owner[by], bwt[at[by]]
            new = np.concatenate(([True], (to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])))
            lows.append(to[new])
            highs.append(to[np.append(new[1:], True)] + 1)
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = open_[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        open_[high] = False
    return open_[:n]


def repeated_starts(runs: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """For each run (its bytes, how often it occurs), which of its windows start at two places or more among all runs.

    An equal run is in the transform once, so each of its places in the order counts as often as the run occurs.
    """
    sizes = np.array([len(data) + 1 for data, _ in runs])
    ends = np.cumsum(sizes)
    codes = np.zeros(ends[-1] + 1, dtype=np.uint16)
    codes[:-1] = np.frombuffer(b"\0".join([*(data for data, _ in runs), b""]), np.uint8)
    codes[:-1] += 2
    codes[ends - 1] = 1  # a separator after each run, and the end after all
    used = np.zeros(258, dtype=np.uint16)
    used[np.unique(codes)] = 1
    codes = (np.cumsum(used, dtype=np.uint16) - used)[codes]
    suffixes = bounded_suffixes(codes, length)
    shared = long_neighbours(codes, suffixes, length)
    twice = np.repeat([times > 1 for _, times in runs] + [False], np.append(sizes, 1))
    twice[suffixes] |= shared | np.append(shared[1:], False)
    return [twice[end - size : end - length] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]


def edges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    e = np.flatnonzero(np.diff(flags.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return e[0::2], e[1::2]


def judged(group: list[tuple[int, bytes, int, list]], length: int, gram: int, block: int) -> Iterator[tuple[list, int, int]]:
    """Places and range of repeated windows of runs (seed, bytes, times, places), block by block; a seed of more bytes is dealt by longer seeds."""
    held, size = [], 0
    for _, same in groupby(group, key=lambda r: r[0]):
        merged: dict[bytes, list] = {}
        for _, data, times, places in same:
            run = merged.setdefault(data, [0, []])
            run[0] += times
            run[1].append((0, places))
        new = sum(map(len, merged))
        if new > block:
            yield from _seed(merged, length, gram, block)
        else:
            held += merged.items()
            size += new
            if size > block:
                yield from _block(held, length)
                held, size = [], 0
    yield from _block(held, length)


def _seed(runs: dict[bytes, list], length: int, gram: int, block: int) -> Iterator[tuple[list, int, int]]:
    gram = min(length, (gram + length + 1) // 2)
    dealt: dict[int, dict[bytes, list]] = {}
    for data, (times, places, *_) in runs.items():
        for at, n, seed, again in zip(*(x.tolist() for x in seed_runs(data, length, gram)), strict=True):
            run = dealt.setdefault(seed, {}).setdefault(data[at : at + n + length - 1], [0, [], False])
            run[0] += times
            run[2] = again
            run[1] += [(at + o, p) for o, p in places]
    held, size = [], 0
    for part in dealt.values():
        if sum(map(len, part)) > block and gram < length and len(part) > 1:
            yield from _seed(part, length, gram, block)
        elif len(part) > 1 or any(times > 1 or again for times, _, again in part.values()):
            held += part.items()
            size += sum(map(len, part))
            if size > block:
                yield from _block(held, length)
                held, size = [], 0
    yield from _block(held, length)


def _block(runs: list, length: int) -> Iterator[tuple[list, int, int]]:
    if not runs:
        return
    found = repeated_starts([(data, run[0]) for data, run in runs], length)
    for flags, (_, run) in zip(found, runs, strict=True):
        for a, b in zip(*(x.tolist() for x in edges(flags)), strict=True):
            for shift, own in run[1]:
                yield own, a + shift, b + shift


# --- the corpus ---------------------------------------------------------------------------------------

_KEY = ["k1", "k2"]


def _columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return df.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"))


def _first(keys: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """At the first place of each key, the weight of all its places; elsewhere 0."""
    _, first, of = np.unique(keys, return_index=True, return_inverse=True)
    out = np.zeros(len(keys), dtype=np.int64)
    out[first] = np.bincount(of, weights=weight).astype(np.int64)
    return out


def _seeds(length: int, gram: int):
    """Runs of every text; a batch's first run of a seed counts for all of the batch, the others count 0 and go on unless the seed is met nowhere else."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            k1, k2, copies = (batch.column(c).to_numpy() for c in ("k1", "k2", "copies"))
            texts = batch.column("text").cast(pa.binary())
            own, parts = [], []
            for i in range(batch.num_rows):
                parts.append(seed_runs(texts[i].as_py(), length, gram))
                own.append(np.full(len(parts[-1][0]), i))
            if not own:
                continue
            own = np.concatenate(own)
            at, n, seed, again = (np.concatenate(x) for x in zip(*parts, strict=True))
            times = _first(seed, np.minimum(copies, 2)[own] + again)
            yield pa.RecordBatch.from_arrays([pa.array(k1[own]), pa.array(k2[own]), pa.array(at.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(seed), pa.array(times)], ["k1", "k2", "at", "n", "seed", "times"])

    return trimmed(run)


def _windows(length: int):
    """The windows of hot runs, by hashes of their bytes, counted as seeds are."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, marks = batch.column("text").cast(pa.binary()), batch.column("marks")
            for i in range(batch.num_rows):
                data, k1, k2, copies = texts[i].as_py(), batch.column("k1")[i].as_py(), batch.column("k2")[i].as_py(), batch.column("copies")[i].as_py()
                at, seed, h1, h2 = [], [], [], []
                for m in marks[i].as_py():
                    b = np.frombuffer(data, np.uint8, m["n"] + length - 1, m["at"])
                    h = gram_hashes(b, length)
                    at.append(np.arange(m["at"], m["at"] + m["n"]))
                    seed.append(np.full(m["n"], m["seed"]))
                    h1.append(h)
                    h2.append(gram_hashes(np.bitwise_xor(b, np.uint8(0xA5)), length))
                at, seed, h1, h2 = (np.concatenate(x) for x in (at, seed, h1, h2))
                with np.errstate(over="ignore"):
                    times = _first(h1 ^ (h2 * _U(0x9E3779B97F4A7C15)), np.full(len(at), min(copies, 2)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k1)), pa.array(np.full(len(at), k2)), pa.array(at.astype(np.int64)), pa.array(np.ones(len(at), np.int32)), pa.array(seed.astype(np.int64)), pa.array(times), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], ["k1", "k2", "at", "n", "seed", "times", "h1", "h2"])

    return trimmed(run)


def _bytes(length: int):
    """The bytes of marked runs, equal ones of a batch as one row with all their places."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, rows = batch.column("text").cast(pa.binary()), {}
            for i in range(batch.num_rows):
                data, k1, k2, copies = texts[i].as_py(), batch.column("k1")[i].as_py(), batch.column("k2")[i].as_py(), batch.column("copies")[i].as_py()
                last = None
                for m in sorted(batch.column("marks")[i].as_py(), key=lambda m: m["at"]):
                    if last and last["seed"] == m["seed"] and last["at"] + last["n"] == m["at"] and last["n"] < _PIECE:
                        last["n"] += m["n"]  # single windows of a hot seed
                        continue
                    if last:
                        _put(rows, last, data, k1, k2, copies, length)
                    last = m
                if last:
                    _put(rows, last, data, k1, k2, copies, length)
            names = ["seed", "run", "times", "places"]
            place = pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in rows], pa.int64()), pa.array([k[1] for k in rows], pa.binary()), pa.array([v[0] for v in rows.values()], pa.int64()), pa.array([v[1] for v in rows.values()], place)], names)

    return trimmed(run)


def _put(rows: dict, mark: dict, data: bytes, k1: int, k2: int, copies: int, length: int) -> None:
    row = rows.setdefault((mark["seed"], data[mark["at"] : mark["at"] + mark["n"] + length - 1]), [0, []])
    row[0] += min(copies, 2)
    row[1].append({"k1": k1, "k2": k2, "at": mark["at"]})


def _expand(length: int, gram: int, block: int):
    """Batches in the order of seeds to ranges of repeated windows. A batch's last seed waits for the next batch."""

    def run(batches):
        import pyarrow as pa

        def out(group):
            k1, k2, start, stop = [], [], [], []
            for places, a, b in judged(group, length, gram, block):
                for p in places:
                    k1.append(p["k1"])
                    k2.append(p["k2"])
                    start.append(p["at"] + a)
                    stop.append(p["at"] + b)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k1, k2, start, stop)], ["k1", "k2", "start", "stop"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("seed", "run", "times", "places")), strict=True):
                if size > block and row[0] != held[-1][0]:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            yield out(held)

    return trimmed(run)


def _cut(length: int):
    """Texts and their ranges of repeated windows to removed spans and the bytes left."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, ranges = batch.column("text").cast(pa.binary()), batch.column("ranges")
            spans, kept = [], []
            for i in range(batch.num_rows):
                data, own = texts[i].as_py(), []
                for r in sorted(ranges[i].as_py(), key=lambda r: r["start"]):
                    a, b = r["start"], r["stop"] + length - 1
                    if own and a <= own[-1]["stop"]:
                        own[-1]["stop"] = max(own[-1]["stop"], b)
                    else:
                        own.append({"start": a, "stop": b})
                at = 0
                left = []
                for s in own:
                    left.append(data[at : s["start"]])
                    at = s["stop"]
                spans.append(own)
                kept.append(b"".join([*left, data[at:]]))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(spans, kind), pa.array(kept, pa.binary())], ["k1", "k2", "spans", "kept"])

    return trimmed(run)


def _repeated(df: DataFrame, *by: str) -> DataFrame:
    """Rows whose key is met twice or more. Rows that count 0 repeat a row of their batch: they are dealt evenly and stay."""
    key = [F.when(F.col("times") > 0, F.col(c)).otherwise(F.xxhash64("k1", "at", F.lit(i))) for i, c in enumerate(by)]
    total = F.sum("times").over(Window.partitionBy(*[f"slot{i}" for i in range(len(by))]))
    return df.withColumns({f"slot{i}": k for i, k in enumerate(key)}).withColumn("met", total).where("met >= 2 OR times = 0").drop(*[f"slot{i}" for i in range(len(by))])


def repeats_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """``k1, k2, spans, kept`` of each different text that loses bytes: removed byte ranges in order, and the bytes left."""
    spark = df.sparkSession
    small_batches(spark)
    gram = min(gram, length)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"repeats_{uuid.uuid4().hex}"
    path = os.path.join(shared_folder(spark), name)
    # Different texts, laid in the buckets that later joins need, so that texts move once.
    texts = _columns(df, id_col, text_col).where(F.octet_length("text") >= length).groupBy(*_KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts.write.option("path", path).bucketBy(n, *_KEY).saveAsTable(name)
    texts = spark.table(name)
    released(texts)

    runs = texts.select(*_KEY, "text", "copies").mapInArrow(_seeds(length, gram), "k1 long, k2 long, at long, n int, seed long, times long")
    marks = written(_repeated(runs, "seed").select(*_KEY, "at", "n", "seed", "met"))
    busy = marks.where(F.col("met") > hot).select("seed").distinct()
    marked = marks.drop("met")
    if not busy.isEmpty():
        own = _by_text(marked.join(busy, "seed", "left_semi"))
        windows = _with(texts, own).mapInArrow(_windows(length), "k1 long, k2 long, at long, n int, seed long, times long, h1 long, h2 long")
        found = written(_repeated(windows, "h1", "h2").select(*_KEY, "at", "n", "seed"))
        marked = marked.join(busy, "seed", "left_anti").unionByName(found)
    pieces = _with(texts, _by_text(marked)).mapInArrow(_bytes(length), "seed long, run binary, times long, places array<struct<k1: long, k2: long, at: long>>")
    ranges = pieces.repartition("seed").sortWithinPartitions("seed").mapInArrow(_expand(length, gram, block), "k1 long, k2 long, start long, stop long")
    ranges = ranges.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    cut = texts.join(ranges.hint("shuffle_hash"), _KEY).select(*_KEY, "text", "ranges").mapInArrow(_cut(length), "k1 long, k2 long, spans array<struct<start: long, stop: long>>, kept binary")
    out = written(cut)
    spark.sql(f"DROP TABLE {name}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return released(out)


def _by_text(marks: DataFrame) -> DataFrame:
    return marks.groupBy(*_KEY).agg(F.collect_list(F.struct("at", "n", "seed")).alias("marks"))


def _with(texts: DataFrame, marks: DataFrame) -> DataFrame:
    return texts.join(marks.hint("shuffle_hash"), _KEY).select(*_KEY, "text", "copies", "marks")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``df`` with ``removed_spans`` (byte ranges) and ``kept_bytes`` (null for a null text); columns of these names are replaced."""
    found = repeats_of(df, id_col, text_col, **how).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("spans").alias("__spans"), F.col("kept").alias("__kept"))
    text = F.col(text_col)
    keyed = df.withColumns({"__k1": F.xxhash64(text), "__k2": F.xxhash64(F.lit(7), text)}).join(found, ["__k1", "__k2"], "left")
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    return keyed.withColumns({"removed_spans": F.coalesce("__spans", none), "kept_bytes": F.coalesce("__kept", text.cast("binary"))}).drop("__k1", "__k2", "__spans", "__kept")


def digests(df: DataFrame, **how) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row of ``df`` (``doc_id, text``)."""
    sizes = F.transform("spans", lambda s: s["stop"] - s["start"])
    found = repeats_of(df, **how).select(*_KEY, F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x).alias("removed"), F.size("spans").cast("long").alias("spans"), F.sha2("kept", 256).alias("digest"))
    rows = _columns(df, "doc_id", "text").select("doc_id", *_KEY, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return rows.join(found, _KEY, "left").select("doc_id", "n_bytes", F.coalesce("removed", zero).alias("n_removed"), F.coalesce("spans", zero).alias("n_spans"), F.coalesce("digest", "whole").alias("kept_sha256"))
