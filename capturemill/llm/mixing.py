"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target comes from its weight; a source can't be taken more than ``most`` times, and what is above
that is shared again by weight. A document of a source is due ``target / source size`` copies. The whole part is
taken; the fractions are rounded by pivots: two fractional documents meet, and mass (in words) is moved from one to the
other, in a direction drawn with the odds that keep both expectations, until one is integral. The pair's words stay the
same, so a source's taken words differ from its target only by the last document's rounding.

The pairs form a reduction tree: leaves of about ``leaf`` documents of one source, chosen by a hash of the id, are
worked one after another, each leaves at most one fractional document, and these meet in the next level's groups,
until each source has one, which is rounded by its own odds. No group grows with the input and the draws depend on ids
and the seed alone, so reruns agree on any number of executors.

Defined cases: a null text has size 0. Documents of size 0 take no words and have no copies above the whole part. Null source is a
source, the last. Equal rows are rounded each for itself. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, n_words, small_batches, trimmed

_EPS = 1e-9
#: Sources that are broadcast at most, and the parts that a source's rows are joined in beyond that.
BROADCAST_SOURCES, PARTS = 10_000, 64


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target``. Sources are few next to documents (one row each meets in one task)."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("limit", F.col("source_size") * most)
    # In order of limit over weight, the sources before a place stop at their limits and the rest share what is left
    # by weight. The level is that of the first place from which on no limit is passed.
    one = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("w"), "source").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("goal", F.sum("source_size").over(one) * share)
    s = s.withColumn("level", (F.col("goal") - F.coalesce(F.sum("limit").over(order), F.lit(0.0))) / (F.sum("w").over(one) - F.coalesce(F.sum("w").over(order), F.lit(0.0))))
    s = s.withColumn("at", F.min(F.when(F.col("level") * F.col("w") <= F.col("limit") * (1 + 1e-12), F.struct((F.col("limit") / F.col("w")).alias("o"), F.col("level").alias("v")))).over(one))
    target = F.least(F.col("limit"), F.coalesce(F.col("at.v") * F.col("w"), F.col("limit")))
    return s.select("source", "source_size", target.cast("double").alias("target"))


def _draw(*of) -> float:
    return int.from_bytes(hashlib.blake2b(repr(of).encode(), digest_size=7).digest(), "big") / (1 << 56)


def _meet(a: list, b: list, seed: int, level: int) -> list[list]:
    """Move mass between two fractional rows (id, size, fraction, whole, ...); those that are still fractional come back."""
    fa, fb, sa, sb = a[2], b[2], a[1], b[1]
    up = min((1 - fa) * sa, fb * sb)  # words from b to a
    down = min(fa * sa, (1 - fb) * sb)  # words from a to b
    x = up if _draw(seed, level, a[0], sa, b[0], sb) * (up + down) < down else -down
    a[2], b[2] = fa + x / sa, fb - x / sb
    left = []
    for r in (a, b):
        if r[2] < _EPS or r[2] > 1 - _EPS:
            r[3] += round(r[2])
            r[2] = 0.0
        else:
            left.append(r)
    return left


def _reduce(seed: int, level: int, last: bool):
    """Work each group of a sorted partition; rows come back with their whole part and what fraction is left."""

    def run(batches):
        import pyarrow as pa

        names, kinds = None, None
        group, carry, done = None, None, []

        def close():
            nonlocal carry
            if carry is not None:
                if last:
                    carry[3] += int(_draw(seed, "last", carry[0], carry[1]) < carry[2])
                    carry[2] = 0.0
                done.append(carry)
            carry = None

        def flush():
            cols = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for b in batches:
            names, kinds = b.schema.names, b.schema.types
            for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)], strict=True):
                r = list(row)
                if (key := (r[4], r[5])) != group:
                    close()
                    group = key
                if r[2] <= _EPS:
                    done.append(r)
                elif carry is None:
                    carry = r
                else:
                    left = _meet(carry, r, seed, level)
                    done.extend(x for x in (carry, r) if all(x is not y for y in left))
                    carry = left[0] if left else None
                    if len(left) == 2:  # can't be but for rounding of sums: the second waits for the next level
                        done.append(left[1])
            if len(done) > 10_000:
                yield flush()
        close()
        if done:
            yield flush()

    return run


def _with_source(rows: DataFrame, per: DataFrame, few: bool) -> DataFrame:
    """Rows with what holds for their source (``_s``). Few sources are broadcast; of many, each is joined in ``PARTS`` parts, so that no source's rows meet in one task."""
    if few:
        return rows.join(F.broadcast(per), rows["source"].eqNullSafe(per["_s"]))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "size"), F.lit(PARTS)))
    parts = per.withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    return dealt.join(parts, dealt["source"].eqNullSafe(parts["_s"]) & (dealt["_part"] == parts["_p"])).drop("_part", "_p")


def mix_documents(docs: DataFrame, seed: int = 17, leaf: int = 128, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size: Column | None = None, **targets) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs``."""
    small_batches(docs.sparkSession)
    if size is None:
        size = n_words(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.cast("long").alias("size"))
    rows = checkpointed(rows)
    goal = checkpointed(source_targets(rows, **targets))
    n = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    per = goal.join(n, goal["source"].eqNullSafe(n["source"])).select(goal["source"].alias("_s"), "source_size", "target", F.ceil(F.col("n") / leaf).cast("long").alias("leaves"))
    per = checkpointed(per)
    most, sources = per.agg(F.max("leaves"), F.count(F.lit(1))).first()
    most, few = most or 1, sources <= BROADCAST_SOURCES
    p = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(p + _EPS)
    part = F.when(F.col("size") > 0, F.greatest(p - whole, F.lit(0.0))).otherwise(0.0)
    placed = _with_source(rows, per, few)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, size long, part double, copies long, source string, leaf long"
    now = placed.select("doc_id", "size", part.cast("double").alias("part"), whole.cast("long").alias("copies"), "source", F.pmod(F.xxhash64("doc_id", "size"), F.col("leaves")).cast("long").alias("leaf"))
    out, level = None, 0
    while True:
        last = most <= 1
        dealt = now.repartition("source", "leaf").sortWithinPartitions("source", "leaf", F.desc("size"), "doc_id")
        now = dealt.mapInArrow(trimmed(_reduce(seed, level, last)), schema)
        if not last:
            now = checkpointed(now)
        settled = now.filter(F.col("part") <= _EPS) if not last else now
        out = settled if out is None else out.unionByName(settled)
        if last:
            break
        now = now.filter(F.col("part") > _EPS).withColumn("leaf", F.floor(F.col("leaf") / leaf).cast("long"))
        most, level = -(-most // leaf), level + 1
    at = per.select("_s", "source_size", "target")
    out = _with_source(out, at, few)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows equal in id, source and size share their copies in the order of a hash of all their columns."""
    mixed = mix_documents(docs, **kw)
    # Structs are equal when their fields are equal or both null, so one exchange of the texts serves the join and the ranks.
    share = mixed.groupBy(F.struct("doc_id", "source", "size").alias("of")).agg(F.sum("copies").alias("every"), F.count(F.lit(1)).alias("n")).filter("every > 0")
    source, id_, text = kw.get("source_col", "source"), kw.get("id_col", "doc_id"), kw.get("text_col", "text")
    key = F.struct(F.col(id_).alias("doc_id"), F.col(source).cast("string").alias("source"), kw.get("size", n_words(F.col(text))).cast("long").alias("size"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    rows = rows.join(share, rows["key"] == share["of"])
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("of").orderBy("row")))
    times = F.floor(F.col("every") / F.col("n")) + (F.col("r") <= F.col("every") % F.col("n")).cast("long")
    rows = rows.withColumn("times", times).filter("times > 0")
    return rows.select("all", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("all.*")
