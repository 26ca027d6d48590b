"""Benchmark decontamination by greedy string tiling.

Tokens are lower-cased runs of letters and digits. A text and a benchmark item that share a seed (a run of
``min_match`` tokens, found by rolling Karp-Rabin hashes) are tiled: the longest common run not yet marked is marked as
a tile in both, again and again, down to ``min_match`` tokens; tiles never overlap, and may lie in any order. The item's
coverage is the share of its tokens under tiles. A pair counts as a match when the coverage is ``min_coverage`` or more.

The benchmark is the stated query set. It is read in blocks of bounded size (``block_chars``); each block is broadcast, all texts
pass by it, and it is let go before the next one. Texts are never moved between tasks. A text and an item that both repeat
themselves are tiled without pairs of places, so that their cost isn't a product of lengths.

Defined cases: null and empty texts match nothing. An item shorter than ``min_match`` tokens is compared as one
run. Equal texts and equal items each give their own rows; null ids stay null. Columns that aren't named are ignored. An empty table
on either side gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _PUNCT, _SPACE, _powers, gram_hashes, small_batches, text_bytes, trimmed, word_hashes, written

_SEPARATORS = _PUNCT | _SPACE
#: Seeds of a text and an item, by their tokens, from which on places are no longer paired.
MANY = 4


def tokens(text: bytes) -> np.ndarray:
    return word_hashes(text, _SEPARATORS)


def tiles(doc: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seed places (doc, item): tiles as (doc place, item place, length), longest first."""
    by: dict[int, list[int]] = {}
    for i, j in seeds:
        by.setdefault(i - j, []).append(i)
    heap = []
    for diagonal, places in by.items():
        places = sorted(set(places))
        start = last = places[0]
        for i in [*places[1:], None]:
            if i is None or i != last + 1:
                heap.append((-(last - start + min_match), start, start - diagonal))
                start = i
            last = i
    heapq.heapify(heap)
    in_doc, in_item, out = set(), np.zeros(len(item), dtype=bool), []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = [k for k in range(n) if i + k not in in_doc and not in_item[j + k]]
        if len(free) == n:
            out.append((i, j, n))
            in_doc.update(range(i, i + n))
            in_item[j : j + n] = True
        elif free:  # what is left of it comes back at its own length
            start = last = free[0]
            for k in [*free[1:], None]:
                if k is None or k != last + 1:
                    if last - start + 1 >= min_match:
                        heapq.heappush(heap, (-(last - start + 1), i + start, j + start))
                    start = k
                last = k
    return out


def windows(words: np.ndarray, n: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs of ``n`` tokens that are all free, and their rolling hashes."""
    up, down = _powers(len(words) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * up[: len(words)])))
        h = (sums[n:] - sums[:-n]) * down[: len(words) - n + 1]
    taken = np.concatenate(([0], np.cumsum(~free)))
    at = np.flatnonzero(taken[n:] == taken[:-n])
    return at, h[at]


def tiles_by_length(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """The same tiles as ``tiles``, for texts that repeat themselves: every longest free run is found by rolling hashes and a search over its length, without pairs of places."""
    free_doc, free_item = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    out, most = [], min(len(doc), len(item))

    def common(n: int):
        i, x = windows(doc, n, free_doc)
        j, y = windows(item, n, free_item)
        hit = np.flatnonzero(np.isin(x, y))
        return (int(i[hit[0]]), int(j[np.flatnonzero(y == x[hit[0]])[0]])) if len(hit) else None

    while most >= min_match and (best := common(min_match)):
        lo = min_match
        while lo < most:  # a run of some length has runs of every smaller one
            n = (lo + most + 1) // 2
            if got := common(n):
                lo, best = n, got
            else:
                most = n - 1
        i, j = best
        out.append((i, j, lo))
        free_doc[i : i + lo] = False
        free_item[j : j + lo] = False
        most = lo
    return out


def _search(held, min_match: int, min_coverage: float, item_type):
    def run(batches):
        import pyarrow as pa

        items = held.value
        grams: dict[int, list[tuple[int, int, int]]] = {}  # hash: (item, place, run length)
        for a, (_, t) in enumerate(items):
            n = min(min_match, len(t))
            for j, h in enumerate(gram_hashes(t, n).tolist() if n else ()):
                grams.setdefault(h, []).append((a, j, n))
        lengths = sorted({n for v in grams.values() for _, _, n in v})
        known = np.sort(np.array(list(grams), dtype=np.uint64))
        seen = np.zeros(1 << 22, dtype=bool)
        seen[known >> np.uint64(42)] = True
        for b in batches:
            rows = []
            ids = b.column(0).to_pylist()
            for row, text in enumerate(text_bytes(b.column(1))):
                if not text:
                    continue
                t = tokens(text)
                seeds: dict[int, list[tuple[int, int]]] = {}
                often: set[int] = set()  # items that share more places with the text than both have
                for n in lengths:
                    g = gram_hashes(t, n)
                    for i in np.flatnonzero(seen[g >> np.uint64(42)]).tolist():
                        for a, j, m in grams.get(int(g[i]), ()):
                            if m == n and a not in often:
                                places = seeds.setdefault(a, [])
                                places.append((i, j))
                                if len(places) > MANY * (len(t) + len(items[a][1])):
                                    often.add(a)
                                    places.clear()
                for a, places in seeds.items():
                    item_id, item = items[a]
                    least = min(min_match, len(item))
                    got = tiles_by_length(t, item, least) if a in often else tiles(t, item, places, least)
                    covered = sum(x[2] for x in got)
                    if covered >= min_coverage * len(item):
                        rows.append((ids[row], item_id, len(item), covered, len(got), got[0][2]))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.types[0]), pa.array(cols[1], item_type), *[pa.array(c, pa.int64()) for c in cols[2:]]], names=["doc_id", "item_id", "item_tokens", "covered", "n_tiles", "longest"])

    return run


def tiled_matches(docs: DataFrame, benchmark: DataFrame, min_match: int = 6, min_coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = 1_000_000) -> DataFrame:
    """One row per matching pair: ``doc_id, item_id, item_tokens, covered, n_tiles, longest, coverage``. Ids may be of any type."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_col).alias("id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("t"))
    id_type = items.schema["id"].dataType
    # An item belongs to the block in which its characters begin; sums run over sizes by a bounded number of buckets first.
    items = items.withColumn("k", F.pmod(F.xxhash64("id", "t"), F.lit(256)))
    sizes = items.groupBy("k").agg(F.sum(F.length("t")).alias("n"))
    before = sizes.withColumn("b", F.coalesce(F.sum("n").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("k", "b")
    own = F.coalesce(F.sum(F.length("t")).over(Window.partitionBy("k").orderBy("id", "t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocked = items.withColumn("own", own).join(F.broadcast(before), "k").withColumn("block", F.floor((F.col("own") + F.col("b")) / block_chars))
    blocks = sorted(r.block for r in blocked.select("block").distinct().collect())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id {id_type.simpleString()}, item_tokens long, covered long, n_tiles long, longest long"
    out = None
    for k in blocks:
        held = spark.sparkContext.broadcast([(r.id, tokens(r.t.encode())) for r in blocked.filter(F.col("block") == k).select("id", "t").collect() if r.t])
        found = rows.mapInArrow(trimmed(_search(held, min_match, min_coverage, to_arrow_type(id_type))), kind)
        if len(blocks) > 1:  # a block's items leave the workers before the next block's come
            found = written(found)
            held.destroy()
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], kind)
    return out.withColumn("coverage", F.col("covered") / F.col("item_tokens"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Rows are told by id and a hash of all their columns, so a row that shares its id with another stays if it is clean."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    key = F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(*cols).alias("row"))
    hits = tiled_matches(docs.select(key.alias("doc_id"), F.col(text_col).alias("text")), benchmark, **kw).select(F.col("doc_id").alias("hit")).distinct()
    rows = docs.select(F.struct(*cols).alias("all"), key.alias("key"))
    return rows.join(hits, rows["key"] == hits["hit"], "left_anti").select("all.*")
