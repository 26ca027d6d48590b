"""Sharding by Hilbert-curve order, on DataFrame functions alone.

Several metadata dimensions are quantised to ``bits`` bits each at equal-frequency borders, the cell's index
on the Hilbert curve orders the rows, and the order is cut into runs. Near cells on the curve are near in all
dimensions, so each shard covers a small box of them and a reader can skip files by any of the dimensions.

Sizes of what moves: there are at most ``2 ** (bits * dims)`` cells (4,096 by default), so the table of cells is
bounded and broadcast. A cell with many rows is split into slices by a hash of the row, so that no task orders
more than about one ``slices``-th of the rows, and places follow from sums over slices within a cell and over cells.

A dimension of strings is quantised by the whole strings, one of numbers by its percentiles.

Law ``rows``: shard counts differ by one row at most. Defined cases: null ids, texts and dimensions are kept
(a null dimension is the lowest value; a null text has size 16); rows that are equal in id and text are
interchangeable; an empty table gives no rows; a table without ``lang`` or ``source`` is ordered by what it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, released


def hilbert_index(axes: Column, dims: int, bits: int) -> Column:
    """Index on the Hilbert curve of an array of ``dims`` coordinates of ``bits`` bits each (Skilling's transform)."""
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(dims)])

    def turn(x: Column, s: Column) -> Column:
        first, own, low = F.get(x, F.lit(0)), F.get(x, s["i"]), s["q"] - 1
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        up = own.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, k: F.when(k == 0, F.when(up, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))).when((k == s["i"]) & ~up, own.bitwiseXOR(swap)).otherwise(v))

    x = F.aggregate(steps, axes, turn) if bits > 1 else axes
    # Gray code: each coordinate takes in the one before it, then all take the carry of the last.
    x = F.aggregate(F.sequence(F.lit(1), F.lit(dims - 1)), x, lambda a, i: F.transform(a, lambda v, k: F.when(k == i, v.bitwiseXOR(F.get(a, i - 1))).otherwise(v))) if dims > 1 else x

    def carried(a: Column) -> Column:
        last = F.get(a, F.lit(dims - 1))
        t = F.aggregate(F.sequence(F.lit(1), F.lit(bits - 1)), F.lit(0), lambda t, b: F.when(F.getbit(last.cast("long"), b) == 1, t.bitwiseXOR(F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), b).cast("int") - 1)).otherwise(t)) if bits > 1 else F.lit(0)
        return F.transform(a, lambda v: v.bitwiseXOR(t))

    x = F.element_at(F.transform(F.array(x), carried), 1)
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(dims)])
    return F.aggregate(places, F.lit(0).cast("long"), lambda a, p: a * 2 + F.getbit(F.get(x, p["i"]).cast("long"), p["b"]).cast("long"))


def curve_cells(spark, dims: int, bits: int) -> DataFrame:
    """Every cell's packed coordinates and its index on the curve."""
    cells = spark.range(0, 1 << (bits * dims), 1, 1)
    axes = F.array(*[F.shiftright("id", bits * (dims - 1 - i)).bitwiseAND((1 << bits) - 1).cast("int") for i in range(dims)])
    return cells.select(F.col("id").cast("int").alias("cell"), axes.alias("x")).select("cell", hilbert_index(F.col("x"), dims, bits).alias("h"))


def string_borders(values: DataFrame, codes: int) -> dict[str, list[str]]:
    """By dimension, the least string of each of ``codes`` classes of about equal frequency, but for the lowest. Whole strings are compared, in binary order.

    Distinct values are counted before they meet, dealt out by range, and their counts are summed by range and within it, so
    no task has all values. ``codes`` strings a dimension reach the driver.
    """
    names = values.columns
    one = values.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in names])).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("n"))
    dealt = checkpointed(one.repartitionByRange("k", F.asc_nulls_first("v")).withColumn("p", F.spark_partition_id()))
    sums = {(r.k, r.p): r.n for r in dealt.groupBy("k", "p").agg(F.sum("n").alias("n")).collect()}
    total, start, run = {k: sum(n for (x, _), n in sums.items() if x == k) for k in names}, [], {}
    for (k, p), n in sorted(sums.items(), key=lambda x: x[0]):
        start += [F.lit(f"{k}/{p}"), F.lit(run.get(k, 0))]
        run[k] = run.get(k, 0) + n
    if not start:
        return {k: [] for k in names}
    own = F.coalesce(F.sum("n").over(Window.partitionBy("p", "k").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = own + F.element_at(F.create_map(*start), F.concat_ws("/", "k", F.col("p").cast("string")))
    all_of = F.element_at(F.create_map(*[x for k in names for x in (F.lit(k), F.lit(total[k]))]), F.col("k"))
    least = dealt.withColumn("c", F.floor(before * codes / all_of)).filter("v is not null and c > 0").groupBy("k", "c").agg(F.min("v").alias("v")).collect()
    return {k: sorted((r.v for r in least if r.k == k), key=lambda v: v.encode()) for k in names}


def default_dims(docs: DataFrame, size: Column) -> dict[str, Column]:
    """Language, source and size, as far as the table has them."""
    return {k: F.col(k).cast("string") for k in ("lang", "source") if k in docs.columns} | {"size": size.cast("double")}


class Layout:
    """Where rows go: their cell on the curve, their slice of the cell, and each slice's first place. Rows are counted once, on narrow columns."""

    def __init__(self, docs: DataFrame, n_shards: int, dims: dict[str, Column] | None, bits: int, slices: int, id_col: str, text_col: str):
        self.n_shards = n_shards
        self.size = (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 16).cast("long")
        self.crc = F.crc32(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))
        self.id = F.col(id_col)
        self.dims = default_dims(docs, self.size) if dims is None else dims
        self.slim = checkpointed(docs.select(self.id.alias("doc_id"), self.size.alias("size"), self.crc.alias("text_crc32"), *[v.alias(f"d_{k}") for k, v in self.dims.items()]))
        kinds = dict(self.slim.dtypes)
        texts = [k for k in self.dims if kinds[f"d_{k}"] == "string"]
        shares = [(i + 1) / (1 << bits) for i in range((1 << bits) - 1)]
        got = self.slim.agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(F.col(f"d_{k}").cast("double"), shares, 2000).alias(k) for k in self.dims if k not in texts]).first()
        borders = string_borders(self.slim.select(*[F.col(f"d_{k}").alias(k) for k in texts]), 1 << bits) if texts else {}
        self.total = got["n"]
        self.cell = F.lit(0)
        for k in self.dims:
            value = F.col(f"d_{k}")
            over = [value >= F.lit(x) for x in borders[k]] if k in texts else [value.cast("double") > x for x in sorted(set(got[k] or []))]
            self.cell = self.cell * (1 << bits) + sum((F.when(x, 1).otherwise(0) for x in over), F.lit(0))
        counts = self.slim.groupBy(self.cell.cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        k = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(max(slices, self.total // 1_000_000)) / F.lit(max(self.total, 1)))).cast("long")
        self.cells = checkpointed(counts.join(F.broadcast(curve_cells(docs.sparkSession, len(self.dims), bits)), "cell").select("cell", "h", k.alias("k")))
        parts = self.sliced(self.slim).groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        # At most 2 ** (bits * dims) rows meet in the one task of this sum.
        whole = parts.groupBy("h").agg(F.sum("n").alias("all")).withColumn("start", F.coalesce(F.sum("all").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("h", "start")
        self.starts = parts.join(F.broadcast(whole), "h").select("h", "part", (F.col("before") + F.col("start")).alias("start"))

    def sliced(self, rows: DataFrame) -> DataFrame:
        """Rows that have id, checksum and dimensions, with ``h`` and ``part``."""
        return rows.withColumn("cell", self.cell.cast("int")).join(F.broadcast(self.cells), "cell").withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("k")))

    def placed(self, rows: DataFrame, *ties: str) -> DataFrame:
        """The same rows with ``shard`` and ``slot``; ``ties`` orders rows of one id and checksum."""
        rank = F.row_number().over(Window.partitionBy("h", "part").orderBy("doc_id", "text_crc32", *ties))
        row = self.sliced(rows).withColumn("r", rank).join(F.broadcast(self.starts), ["h", "part"]).withColumn("g", F.col("r") + F.col("start") - 1)
        big, few = self.total % self.n_shards, self.total // self.n_shards
        # The first ``big`` shards hold few + 1 rows, the others few.
        edge = big * (few + 1)
        shard = F.when(F.col("g") < edge, F.floor(F.col("g") / (few + 1))).otherwise(big + F.floor((F.col("g") - edge) / max(few, 1)))
        row = row.withColumn("shard", shard.cast("int"))
        first = F.when(F.col("shard") < big, F.col("shard") * (few + 1)).otherwise(edge + (F.col("shard") - big) * few)
        return row.withColumn("slot", (F.col("g") - first).cast("long"))


def hilbert_shards(docs: DataFrame, n_shards: int = 40, dims: dict[str, Column] | None = None, bits: int = 4, slices: int = 2048, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, h, shard, slot`` and the dimensions (``d_`` and their name), one row per row of ``docs``."""
    at = Layout(docs, n_shards, dims, bits, slices, id_col, text_col)
    return at.placed(at.slim).select("doc_id", "size", "text_crc32", "h", "shard", "slot", *[f"d_{k}" for k in at.dims])


def file_index(sharded: DataFrame) -> DataFrame:
    """The least and greatest value of every dimension by shard: what a reader needs to skip files."""
    keys = [c for c in sharded.columns if c.startswith("d_")]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *[f(c).alias(f"{n}_{c[2:]}") for c in keys for n, f in (("min", F.min), ("max", F.max))])


def shard_documents(docs: DataFrame, n_shards: int = 40, dims: dict[str, Column] | None = None, bits: int = 4, slices: int = 2048, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot``, each shard in one file's worth of a partition, in slot order. Columns of these names are replaced.

    Rows take their places themselves, by the layout of narrow columns, and no join moves texts. Rows equal in id and text are ordered
    by the hash of all their columns, so a repeated task gives the same places.
    """
    at = Layout(docs, n_shards, dims, bits, slices, id_col, text_col)
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), at.id.alias("doc_id"), at.crc.alias("text_crc32"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"), *[v.alias(f"d_{k}") for k, v in at.dims.items()])
    out = at.placed(rows, "all").select("row.*", "shard", "slot")
    return released(out).repartitionByRange(n_shards, "shard").sortWithinPartitions("shard", "slot")
