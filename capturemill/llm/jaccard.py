"""Exact n-gram Jaccard join by set relations, with skipping in the index lists.

A text's set is its distinct ``n``-word shingles as 64-bit hashes. Texts of one set are one class, and one class stands for
all its texts from there on. Candidates come from a prefix index: with any one order of shingles, two sets of
similarity ``t`` share one among the first ``|x| - ceil(t |x|) + 1`` of each. The order puts shingles that a sample found
frequent last (the sample affects the cost alone; the result is exact for any order). Index lists are kept by size and then
place, so that whole blocks whose size or place rules a match out are skipped.

The prefix is longer by ``SHARED - 1`` places, so a match shares ``SHARED`` places of it (fewer if the set is that
small). A pair whose shared places, with all that lies beyond the prefixes, can't make a match is not compared.

Set relations save the rest. Lists of up to ``SHORT`` sets are joined at once. In a longer list each member is first
compared with one leader of its size block, the member with the fewest rarer shingles before the list's. A set that is
similar to its leader takes over the leader's answer, the component; to find components, no pair within one is compared any
more. Lists whose members are of one component by then are done. The others are gone through again: first with the most linked
members as leaders, then all pairs of different components, without exception. So no link between components is missed.
The last step deals a list of more than ``BLOCK`` sets out to pairs of blocks, so that no list is worked in one task; puts lists
with one most linked component side by side, as they have mostly the same pairs, which are then summed at once; and leaves out pairs whose bitmaps (parities of the shingles by place) differ in more bits than the sets may differ in shingles.

Links are then counted within each component, where all links are. Each set is put as its difference from the component's most linked
set, which is small for near copies, and two sets differ in what their differences don't share. So a set's answers follow from the leader's
and the few shingles of two differences. Components of more than ``LINK_SETS`` sets are dealt out to pairs of blocks. A document's links
are those of its class: the documents of all similar sets, and the others of its own.

Sizes of what moves: a quarter of the shingles go into the index, once. The frequent shingles that are broadcast are
``most_frequent`` at most; the ids of texts to be compared are broadcast up to ``BROADCAST_IDS`` and joined by a shuffle beyond.

Defined cases: null and empty texts have an empty set and link with nothing: they are components of their own. Fewer
than ``n`` words: the whole sequence is the one shingle. Equal rows link and are counted one by one. A component of rows that all lack an id has a null id.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, give_back, gram_hashes, mix, released, small_batches, text_bytes, trimmed, word_hashes, written

BROADCAST_IDS = 2_000_000
#: Sets in a list whose pairs are all made at once, and prefix places that a match must share.
SHORT, SHARED = 8, 5
#: Bits of the bitmap of a set of up to as many shingles, and of larger sets; sets in a block of a list.
SMALL_BITS, BITS, BLOCK = 256, 1024, 4096
#: Rows of the lists that one key of the last step has, about.
KEY_ROWS = 200_000
#: Sets, and about the shingles, of one block in which links are counted.
LINK_SETS, LINK_SHINGLES = 2048, 2_000_000
#: Sets by which a list is split in the first pass, as the sample has it.
SPLIT = 20_000


def shingles(text: bytes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's ``n``-word shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    if len(w) >= n:
        return np.unique(gram_hashes(w, n))
    return gram_hashes(w, len(w)) ^ np.uint64(len(w))


def _key(s: np.ndarray) -> int:
    """A set's own 64-bit hash."""
    with np.errstate(over="ignore"):
        return int((mix(s).sum() ^ mix(np.bitwise_xor.reduce(s) + np.uint64(len(s)))).astype(np.int64)) if len(s) else 0


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the numbers of a set's shingles by place. Two sets differ in as many shingles at least as their bitmaps do in bits."""
    width = SMALL_BITS if len(s) <= SMALL_BITS else BITS
    odd = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _bitmaps(column) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps as rows of 64-bit numbers: of all sets folded to the small width, and the wide ones (zero for small sets)."""
    small, big = SMALL_BITS // 8, BITS // 8
    wide = np.array([len(v) > small for v in column], dtype=bool)
    raw = np.zeros((len(column), big), dtype=np.uint8)
    raw[wide] = np.frombuffer(b"".join(v for v in column if len(v) > small), dtype=np.uint8).reshape(-1, big)
    low = np.bitwise_xor.reduce(raw.reshape(len(column), -1, small), axis=1)
    low[~wide] = np.frombuffer(b"".join(v for v in column if len(v) <= small), dtype=np.uint8).reshape(-1, small)
    return np.ascontiguousarray(low).view(np.uint64), raw.view(np.uint64)


def _classes(n: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            sets = [shingles(t, n) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_key(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary()), b.column(2)], names=["doc_id", "n", "sid", "bits", "row"])

    return run


def _sampled(n: int):
    def run(batches):
        import pyarrow as pa

        seen: set[int] = set()
        for b in batches:
            for t in text_bytes(b.column(0)):
                s = shingles(t, n)
                if len(s) and (k := _key(s)) not in seen:
                    seen.add(k)
                    yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["token"])

    return run


def _by_token(often: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in their order, and their counts, as two arrays; no row of them is an object on the driver."""
    got = often.toArrow()
    token, c = (np.asarray(got.column(x)).astype(np.int64) for x in ("token", "c"))
    token = token.view(np.uint64)
    order = np.argsort(token)
    return token[order], c[order]


def prefix_order(s: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The set with rare shingles first; ``frequent`` has sorted hashes and their counts."""
    tokens, counts = frequent
    if not len(tokens):
        return s
    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
    n = np.where(tokens[at] == s, counts[at], 0)
    return s[np.lexsort((s, n))]


def _index(held, n: int, percent: int, sample: int, split: int):
    """Index rows ``key, token, sid, n, pos`` of each set's prefix, once for a set and task.

    A list that by the sample has many sets is split by them: its rows have different keys, so that no task has all of it. The key of
    other lists is the token.
    """

    def run(batches):
        import pyarrow as pa

        frequent = held.value
        parts = np.maximum(1, frequent[1] * sample // split)
        seen: set[int] = set()
        for b in batches:
            texts = text_bytes(b.column(0))
            for i in range(0, len(texts), 500):
                cols: list[list[np.ndarray]] = [[], [], [], [], []]
                for t in texts[i : i + 500]:
                    s = shingles(t, n)
                    if not len(s) or (k := _key(s)) in seen:
                        continue
                    seen.add(k)
                    least = (percent * len(s) + 99) // 100
                    m = len(s) - least + min(SHARED, least)
                    token = prefix_order(s, frequent)[:m]
                    for c, v in zip(cols, (split_keys(token, k, frequent[0], parts).view(np.int64), token.view(np.int64), np.full(m, k), np.full(m, len(s), np.int32), np.arange(m, dtype=np.int32)), strict=True):
                        c.append(v)
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["key", "token", "sid", "n", "pos"])

    return run


def split_keys(token: np.ndarray, sid: int, frequent: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Tokens, but for those of split lists: a hash of the token and the set's part of the list."""
    if not len(frequent) or not (parts > 1).any():
        return token
    at = np.minimum(np.searchsorted(frequent, token), len(frequent) - 1)
    k = np.where(frequent[at] == token, parts[at], 1).astype(np.uint64)
    part = np.uint64(sid & ((1 << 64) - 1)) % k + np.uint64(1)
    with np.errstate(over="ignore"):
        return np.where(k > 1, mix(token ^ (part * np.uint64(0x9E3779B97F4A7C15))), token)


def _runs(batches, width: int):
    """Whole lists of equal keys (the first column) from a partition sorted by key, as arrays of columns with the lists' edges. A list that isn't at its end waits in pieces."""

    def whole(pieces):
        cols = [np.concatenate(c) for c in zip(*pieces, strict=True)]
        return cols, np.concatenate(([0], np.flatnonzero(np.diff(cols[0])) + 1, [len(cols[0])]))

    rest: list[list[np.ndarray]] = []
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
        if not len(cols[0]):
            continue
        edges = np.flatnonzero(np.diff(cols[0])) + 1
        if rest and not len(edges) and cols[0][0] == rest[0][0][0]:
            rest.append(cols)
            continue
        cut = int(edges[-1]) if len(edges) else 0
        if done := [*rest, *([[c[:cut] for c in cols]] if cut else [])]:
            yield whole(done)
        rest = [[c[cut:] for c in cols]]
    if rest:
        yield whole(rest)


KIND = "kind byte, x long, y long, n1 int, n2 int, p1 int, p2 int, c long"


def _batch(kind: int, x, y, n1, n2, p1, p2, c):
    import pyarrow as pa

    cols = [(np.full(len(x), kind), pa.int8()), (x, pa.int64()), (y, pa.int64()), (n1, pa.int32()), (n2, pa.int32()), (p1, pa.int32()), (p2, pa.int32()), (c, pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(v), k) for v, k in cols], names=["kind", "x", "y", "n1", "n2", "p1", "p2", "c"])


def _summed_pairs(rows: list[tuple]):
    """Pairs with equal ends as one: least places and the number of shared ones."""
    a, b, na, nb, pa_, pb = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.lexsort((pa_, b, a))
    a, b, na, nb, pa_, pb = (v[order] for v in (a, b, na, nb, pa_, pb))
    first = np.ones(len(a), dtype=bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(first)
    return a[at], b[at], na[at], nb[at], pa_[at], pb[at], np.diff(np.append(at, len(a)))


def _merged(rows: list[tuple]) -> tuple:
    """Pairs with sums, of which equal ones are made one: least places and summed counts."""
    a, b, na, nb, pa_, pb, c = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((pa_, b, a))
    a, b, na, nb, pa_, pb, c = (v[order] for v in (a, b, na, nb, pa_, pb, c))
    at = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return a[at], b[at], na[at], nb[at], pa_[at], np.minimum.reduceat(pb, at), np.add.reduceat(c, at)


def _ordered(a, b, na, nb, pa_, pb):
    swap = a > b
    return np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb), np.where(swap, pb, pa_), np.where(swap, pa_, pb)


def _lists(percent: int):
    """Kind 1: pairs from short lists, with shared counts. Kind 0: rows of longer lists. Kind 2: their pairs with leaders. A set that several tasks sent is listed once."""

    def run(batches):
        pairs: list[tuple] = []
        waiting = 0
        for cols, edges in _runs(batches, 5):
            key, sid = cols[0], cols[2]
            first = np.ones(len(key), dtype=bool)  # rows are sorted by key, then size and set
            first[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
            sums = np.concatenate(([0], np.cumsum(first)))
            starts, sizes = sums[edges[:-1]], sums[edges[1:]] - sums[edges[:-1]]
            key, token, sid, n, pos = (c[first] for c in cols)
            split = key[starts] != token[starts]
            for size in range(2, SHORT + 1):
                s = starts[(sizes == size) & ~split]
                if not len(s):
                    continue
                for i in range(size):
                    for j in range(i + 1, size):
                        x, y = s + i, s + j
                        ok = 100 * n[x].astype(np.int64) >= percent * n[y].astype(np.int64)
                        x, y = x[ok], y[ok]
                        if len(x):
                            pairs.append(_ordered(sid[x], sid[y], n[x], n[y], pos[x], pos[y]))
                            waiting += len(x)
            long = (sizes > SHORT) | split
            if long.any():
                own = np.concatenate([np.arange(a, a + k) for a, k in zip(starts[long], sizes[long], strict=True)])
                zero = np.zeros(len(own))
                yield _batch(0, token[own], sid[own], n[own], zero, pos[own], zero, zero + 1)
                led: list[tuple[int, int]] = []
                for a, k in zip(starts[long].tolist(), sizes[long].tolist(), strict=True):
                    led += _led(n[a : a + k], pos[a : a + k], -pos[a : a + k], percent, a)
                if led:
                    x, y = np.array(led).T
                    p = _ordered(sid[x], sid[y], n[x], n[y], pos[x], pos[y])
                    yield _batch(2, *p, np.ones(len(x)))
            if waiting > 500_000:
                yield _batch(1, *_summed_pairs(pairs))
                pairs, waiting = [], 0
        if pairs:
            yield _batch(1, *_summed_pairs(pairs))

    return run


def _led(n, pos, rank, percent: int, offset: int = 0) -> list[tuple[int, int]]:
    """Members of one list (sorted by size) with the leader of their block of comparable sizes, where a match is possible."""
    out, i, e = [], 0, len(n)
    while i < e:
        j = int(np.searchsorted(n, 100 * int(n[i]) // percent, side="right"))
        top = i + int(np.argmax(rank[i:j]))
        room = 1 + np.minimum(n[i:j] - pos[i:j] - 1, n[top] - pos[top] - 1).astype(np.int64)
        ok = (100 + percent) * room >= percent * (n[i:j].astype(np.int64) + int(n[top]))
        ok[top - i] = False
        out += [(offset + i + k, offset + top) for k in np.flatnonzero(ok).tolist()]
        i = j
    return out


def _leader_pairs(percent: int):
    """Pairs of different components with their leaders, from lists ``list, sid, n, pos, comp, rank`` sorted by list, size and set."""

    def run(batches):
        for cols, edges in _runs(batches, 6):
            _, sid, n, pos, comp, rank = cols
            found = []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if (comp[s:e] == comp[s]).all():
                    continue
                x = np.array(_led(n[s:e], pos[s:e], rank[s:e], percent, s), dtype=np.int64).reshape(-1, 2)
                x = x[comp[x[:, 0]] != comp[x[:, 1]]]
                found.append(_ordered(*(c[x[:, k]] for c in (sid, n, pos) for k in (0, 1))))
            if found:
                yield _batch(1, *_summed_pairs(found))

    return run


def _all_pairs(percent: int):
    """Pairs of different components, from lists ``list, sid, n, pos, comp, block, other, bits`` sorted by list, size and set.

    A list has the sets of ``block`` and of ``other``; pairs within a block are made where the two are one. From a place on in the
    order of sizes no partner can be large enough, and the rest of the list is skipped. So are pairs whose bitmaps differ too much.
    """

    def run(batches):
        found, waiting = [], 0
        for cols, edges in _runs(batches, 8):
            _, sid, n, pos, comp, block, other, bits = cols
            low, high = _bitmaps(bits)
            n = n.astype(np.int64)
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if (comp[s:e] == comp[s]).all():
                    continue
                last = s + np.searchsorted(n[s:e], 100 * n[s:e] // percent, side="right")
                for i in range(s, e):
                    j = int(last[i - s])
                    y = i + 1 + np.flatnonzero((comp[i + 1 : j] != comp[i]) & ((block[i + 1 : j] != block[i]) | (block[i] == other[i])))
                    if not len(y):
                        continue
                    of = high if n[i] > SMALL_BITS else low
                    both = n[i] + n[y]
                    may = both - 2 * -(-percent * both // (100 + percent))
                    y = y[np.bitwise_count(of[y] ^ of[i]).sum(axis=1) <= may]
                    if len(y):
                        x = np.full(len(y), i)
                        found.append((*_ordered(*(c[k] for c in (sid, n, pos) for k in (x, y))), np.ones(len(y), dtype=np.int64)))
                        waiting += len(y)
                    if waiting > 500_000:
                        found = [_merged(found)]
                        waiting = len(found[0][0])
                        if waiting > 250_000:
                            yield _batch(1, *found[0])
                            found, waiting = [], 0
        if found:
            yield _batch(1, *_merged(found))

    return run


def _worth(pairs: DataFrame, percent: int, least: int | None = None) -> DataFrame:
    """Sums of pairs by their ends; of these the ones that can match.

    What two sets share is in both prefixes, or beyond the prefix of the one whose prefix ends first. So the shared places and the
    longer rest of the two are at least what a match needs, and there is room from the first shared place on. ``least`` replaces
    the first test by a number of shared places, for leaders, who aren't met in every list.
    """
    p = pairs.groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("c").alias("c"), F.min("n1").alias("na"), F.min("n2").alias("nb"), F.min("p1").alias("pa"), F.min("p2").alias("pb"))

    def kept(n: str):
        return F.ceil(F.col(n) * percent / 100)

    rest = F.greatest(*[kept(n) - F.least(F.lit(SHARED), kept(n)) for n in ("na", "nb")])
    enough = (100 + percent) * (F.col("c") + rest) >= percent * (F.col("na") + F.col("nb"))
    enough = enough & (F.col("c") >= F.least(F.lit(SHARED), kept("na"), kept("nb")))
    if least is not None:
        enough = F.col("c") >= F.least(F.lit(least), kept("na"), kept("nb"))
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return p.filter(enough & ((100 + percent) * room >= percent * (F.col("na") + F.col("nb")))).select("a", "b")


def _sets(n: int):
    def run(batches):
        import pyarrow as pa

        seen: set[int] = set()
        for b in batches:
            texts = text_bytes(b.column(0))
            for i in range(0, len(texts), 500):
                ids, sets = [], []
                for t in texts[i : i + 500]:
                    s = shingles(t, n)
                    if (k := _key(s)) not in seen:
                        seen.add(k)
                        ids.append(k)
                        sets.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["sid", "s"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` (least node of the component) of every node of ``edges`` (a, b), by alternating large and small stars until each component is one star."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = checkpointed(e)
    while not _stars(e):
        # Large star: a node's larger neighbours are joined to its least neighbour.
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        e = both.join(least, both["a"] == least["u"]).filter("b > u").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Small star: a node and its smaller neighbours are joined to the least of them.
        least = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        joined = e.join(least, e["a"] == least["u"])
        e = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        e = released(checkpointed(e))  # a round's plans and shuffles aren't needed in the next
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots)


def _stars(e: DataFrame) -> bool:
    """Whether each larger end of ``e`` (a > b) has one edge and is no smaller end: then the least nodes are the centres of stars, which rounds leave as they are."""
    ends = e.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.coalesce(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))), F.lit(False)).alias("bad")).first().bad


def more_components(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the edges behind ``comp`` and ``links`` together: whole components are the nodes that the new links join, so known ones aren't found again."""
    a, b = (comp.select(F.col("node").alias(f"_{x}"), F.col("comp").alias(f"_c{x}")) for x in "ab")
    ends = links.join(a, F.col("a") == F.col("_a"), "left").join(b, F.col("b") == F.col("_b"), "left")
    between = checkpointed(ends.select(F.coalesce("_ca", "a").alias("a"), F.coalesce("_cb", "b").alias("b")).filter("a <> b").distinct())
    if between.isEmpty():
        return comp
    over = components(between).select(F.col("node").alias("_of"), F.col("comp").alias("_least"))
    known = comp.join(over, comp["comp"] == over["_of"], "left").select("node", F.coalesce("_least", "comp").alias("comp"))
    new = over.join(comp, over["_of"] == comp["node"], "left_anti").select(F.col("_of").alias("node"), F.col("_least").alias("comp"))
    return known.unionByName(new)


def _difference_groups(batches):
    """Rows of equal keys (the first of six number columns) from a partition sorted by key: the other columns, and the differences' lengths and shingles."""

    def whole(pieces):
        cols, lengths, values = zip(*pieces, strict=True)
        return [np.concatenate(c) for c in zip(*cols, strict=True)], np.concatenate(lengths), np.concatenate(values)

    rest, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        key, *cols = (b.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        lengths, values = b.column(6).value_lengths().to_numpy(zero_copy_only=False), b.column(6).flatten().to_numpy()
        at = np.concatenate(([0], np.cumsum(lengths)))
        edges = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)])).tolist()
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if rest and key[s] != last:
                yield whole(rest)
                rest = []
            rest.append(([c[s:e] for c in cols], lengths[s:e], values[at[s] : at[e]]))
            last = key[s]
    if rest:
        yield whole(rest)


def group_links(n, w, block, apart: bool, lengths, values, percent: int) -> np.ndarray:
    """The documents linked with each set of a group: sets of ``n`` shingles and ``w`` documents, told by their differences from one set. With ``apart`` only pairs across blocks count."""
    _, token, times = np.unique(values, return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(n)), lengths)[np.argsort(token, kind="stable")]
    ends = np.cumsum(times)
    at = np.concatenate(([0], np.cumsum(lengths)))
    slack = (100 + percent) * lengths.astype(np.int64) - (100 - percent) * n.astype(np.int64)
    out = np.zeros(len(n), dtype=np.int64)
    for i in range(len(n)):
        of = block != block[i] if apart else np.ones(len(n), dtype=bool)
        of[i] = False
        if (slack[i] + slack[of] > 0).any():  # else all are similar, whatever the differences share
            lists = [rows[ends[t] - times[t] : ends[t]] for t in token[at[i] : at[i + 1]].tolist() if times[t] > 1]
            shared = np.bincount(np.concatenate(lists), minlength=len(n)) if lists else 0
            of &= slack[i] + slack <= 2 * (100 + percent) * shared
        out[i] = w[of].sum()
    return out


def _group_counts(percent: int):
    def run(batches):
        import pyarrow as pa

        sids, links, waiting = [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sids), pa.int64()), pa.array(np.concatenate(links), pa.int64())], names=["sid", "links"])

        for (sid, n, w, own, other), lengths, values in _difference_groups(batches):
            sids.append(sid)
            links.append(group_links(n, w, own, bool((own != other).any()), lengths, values, percent))
            waiting += len(sid)
            if waiting > 50_000:
                yield batch()
                sids, links, waiting = [], [], 0
        if sids:
            yield batch()

    return run


def _linked(classes: DataFrame, comp: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``sid, comp, n_links`` of every set: the number of documents that link with each of its documents."""
    own = checkpointed(classes.filter("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("w")))
    degree = links.select(F.col("a").alias("s")).union(links.select("b")).groupBy("s").agg(F.count(F.lit(1)).alias("rank"))
    nodes = released(checkpointed(comp.join(own, comp["node"] == own["sid"]).join(degree, comp["node"] == degree["s"]).select("sid", "comp", "n", "w", "rank")))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / LINK_SETS), F.ceil(F.sum("n") / LINK_SHINGLES)).cast("int")
    groups = nodes.groupBy("comp").agg(F.max_by("sid", F.struct("rank", "sid")).alias("lead"), blocks.alias("blocks"))
    nodes = nodes.join(groups, "comp").withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    members = released(written(sets.dropDuplicates(["sid"]).join(nodes, "sid").drop("rank")))
    # A leader meets each block of its component apart, so that a large component is no single key.
    leads = members.filter("sid = lead").select("comp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"), F.col("s").alias("r"))
    told = members.join(leads, ["comp", "own"]).withColumn("d", F.concat(F.array_except("s", "r"), F.array_except("r", "s")))
    told = told.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    told = told.select(F.xxhash64("comp", lo, hi).alias("key"), "sid", "n", "w", "own", "other", "d").repartition("key").sortWithinPartitions("key")
    counts = released(checkpointed(told.mapInArrow(trimmed(_group_counts(percent)), "sid long, links long").groupBy("sid").agg(F.sum("links").alias("links"))))
    found = own.join(comp, own["sid"] == comp["node"], "left").join(counts, "sid", "left")
    return released(checkpointed(found.select("sid", "comp", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))))


def _verified(pairs: DataFrame, rows: DataFrame, reps: DataFrame, n: int, percent: int, seen: list[DataFrame]) -> DataFrame:
    """The pairs whose sets are similar enough, by their exact intersection. The table of their sets goes to ``seen``."""
    nodes = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    wanted = checkpointed(nodes.join(reps, "sid").select("sid", F.col("rep").alias("_rep")))
    count = wanted.count()
    ids = wanted.select("_rep").distinct()
    texts = rows.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, rows["doc_id"].eqNullSafe(ids["_rep"]), "left_semi")
    # One text stands for each set; should its id be repeated, a set or a link is listed twice, which changes nothing.
    sets = written(texts.select("text").mapInArrow(trimmed(_sets(n)), "sid long, s array<long>"))
    seen.append(sets)
    x, y = sets.select(F.col("sid").alias("a"), F.col("s").alias("x")), sets.select(F.col("sid").alias("b"), F.col("s").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    hit = both * 100 >= percent * (F.size("x") + F.size("y") - both)
    return pairs.join(x, "a").join(y, "b").filter(hit).select("a", "b")


def similar_components(docs: DataFrame, n: int = 5, percent: int = 75, sample: int = 32, most_frequent: int = 200_000, split: int = SPLIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``docs``; ``n_links`` counts the other rows that it links with."""
    whole = _grouped(docs, n, percent, sample, most_frequent, split, id_col, text_col, count_links=True)
    least = whole.filter("n > 0").groupBy("group").agg(F.min("doc_id").alias("least"))
    out = whole.join(least, (whole["group"] == least["group"]) & (whole["n"] > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "n_links")


def _row_hash(docs: DataFrame):
    """A hash of all of a row's columns, so that equal rows alone have the same id and hash."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def _grouped(docs: DataFrame, n: int = 5, percent: int = 75, sample: int = 32, most_frequent: int = 200_000, split: int = SPLIT, id_col: str = "doc_id", text_col: str = "text", count_links: bool = False) -> DataFrame:
    """``doc_id, n, group, row`` for every row of ``docs``: the number of its shingles, its component by set, and the hash of the row; with ``count_links`` also ``n_links``."""
    spark = docs.sparkSession
    small_batches(spark, 2_000_000)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), _row_hash(docs).alias("row"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    classes = checkpointed(rows.mapInArrow(trimmed(_classes(n)), f"doc_id {kind}, n long, sid long, bits binary, row long"))
    reps = classes.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("rep"))
    # The order of shingles: what a sample of texts has often comes last.
    some = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0).select("text")
    often = some.mapInArrow(trimmed(_sampled(n)), "token long").groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c >= 3").orderBy(F.desc("c"), "token").limit(most_frequent)
    frequent = _by_token(often)
    del often
    give_back()
    index = rows.select("text").mapInArrow(trimmed(_index(spark.sparkContext.broadcast(frequent), n, percent, sample, split)), "key long, token long, sid long, n int, pos int")
    lists = released(written(index.repartition("key").sortWithinPartitions("key", "n", "sid").mapInArrow(trimmed(_lists(percent)), KIND)))
    del index
    short = lists.filter("kind = 1")
    long = lists.filter("kind = 0").select(F.col("x").alias("token"), F.col("y").alias("sid"), F.col("n1").alias("n"), F.col("p1").alias("pos"))
    pairs = checkpointed(_worth(short, percent).unionByName(_worth(lists.filter("kind = 2"), percent, 3)).distinct())
    sets: list[DataFrame] = []
    done, links = pairs, checkpointed(_verified(pairs, rows, reps, n, percent, sets))
    comp = checkpointed(components(links))
    for step in () if long.isEmpty() else ("linked leaders", "all"):
        degree = links.select(F.col("a").alias("s")).union(links.select("b")).groupBy("s").agg(F.count(F.lit(1)).cast("double").alias("rank"))
        known = checkpointed(comp.join(degree, comp["node"] == degree["s"]).select("node", "comp", "rank"))
        now = long.join(known, long["sid"] == known["node"], "left").select("token", "sid", "n", "pos", F.coalesce("comp", "sid").alias("comp"), F.coalesce("rank", F.lit(0.0)).alias("rank"))
        mixed = now.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("sets")).filter("lo <> hi").select("token", "sets", F.ceil(F.col("sets") / BLOCK).cast("int").alias("blocks"))
        if step == "all":
            # Lists are owned by the component of their most linked set.
            whose = now.groupBy("token").agg(F.max_by("comp", F.struct("rank", "comp")).alias("owner")).join(mixed, "token")
            parts = checkpointed(whose.groupBy("owner").agg(F.ceil(F.sum("sets") / KEY_ROWS).cast("int").alias("parts")))
            whose = whose.join(parts, "owner").select("token", "owner", "blocks", F.pmod(F.xxhash64("token"), F.col("parts")).alias("part"))
            now = now.join(whose, "token").drop("rank").withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
            now = now.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            ends = [F.least("own", "with"), F.greatest("own", "with")]
            now = now.withColumn("key", F.xxhash64("owner", "part", *ends)).withColumn("list", F.xxhash64("token", *ends))
            # Equal numbers of different lists would only add pairs, and these are compared in full.
            now = now.join(classes.filter("n > 0").groupBy("sid").agg(F.first("bits").alias("bits")), "sid")
            now = now.repartition("key").sortWithinPartitions("key", "list", "n", "sid").select("list", "sid", "n", "pos", "comp", F.col("own").alias("block"), F.col("with").alias("other"), "bits")
            found = written(now.mapInArrow(trimmed(_all_pairs(percent)), KIND))
            # A pair may share places in short lists too.
            both = found.select("x", "y").distinct()
            found = _worth(found.unionByName(short.join(both, ["x", "y"], "left_semi").select(*found.columns)), percent)
        else:
            # A list of many sets has a leader in each block of them.
            now = now.join(mixed, "token").withColumn("list", F.xxhash64("token", F.pmod(F.xxhash64("sid"), F.col("blocks"))))
            now = now.select("list", "sid", "n", "pos", "comp", "rank").repartition("list").sortWithinPartitions("list", "n", "sid")
            found = _worth(now.mapInArrow(trimmed(_leader_pairs(percent)), KIND), percent, 3)
        pairs = checkpointed(found.join(done, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            done = done.unionByName(pairs)
            new = checkpointed(_verified(pairs, rows, reps, n, percent, sets))
            links, comp = links.unionByName(new), released(checkpointed(more_components(comp, new)))
    if not count_links:
        return classes.join(comp, classes["sid"] == comp["node"], "left").select("doc_id", "n", F.coalesce("comp", "sid").alias("group"), "row")
    told = _linked(classes, comp, links, reduce(DataFrame.union, sets), percent)
    whole = classes.join(told.withColumnRenamed("sid", "node"), classes["sid"] == F.col("node"), "left")
    return whole.select("doc_id", "n", F.coalesce("comp", "sid").alias("group"), "row", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def min_keep(docs: DataFrame, **kw) -> DataFrame:
    """One row of each component: that of the least id (null ids last), of equal ids the one with the least hash of all columns. Rows without shingles all stay."""
    group = checkpointed(_grouped(docs, **kw))
    first = group.filter("n > 0").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("first"))
    told = group.filter("n > 0").join(first, "group")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row") == F.col("first.row"))
    # Rows are told by id and hash. Equal rows have one fate, but for all but one of several that stay.
    gone = told.filter(~stays).select(F.struct("doc_id", "row").alias("_of")).distinct()
    several = told.filter(stays).groupBy(F.struct("doc_id", "row").alias("_of")).count().filter("count > 1").select("_of")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"), F.struct(F.col(kw.get("id_col", "doc_id")).alias("doc_id"), _row_hash(docs).alias("row")).alias("key"))
    kept = rows.join(gone, rows["key"] == gone["_of"], "left_anti")
    if several.isEmpty():
        return kept.select("all.*")
    one = kept.join(several, kept["key"] == several["_of"], "left_anti").select("all")
    # Equal rows are summed to one before they meet.
    once = kept.join(several, kept["key"] == several["_of"], "left_semi").groupBy("key").agg(F.any_value("all").alias("all")).select("all")
    return one.unionByName(once).select("all.*")
