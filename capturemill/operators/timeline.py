"""Time lines cut into slices, so that no task holds a whole key.

A key is *hot* if it has more than one in ``SHARE`` of all rows, and more than ``LEAST`` of them: there are ``SHARE`` hot keys at most. Each
hot key's time line is cut at its own quantiles into ``SLICES`` slices; every other key is one slice. Windows then run by key and slice. What
crosses a border (a last row, a running sum, a next opening) is one row for each hot key and slice, ``SHARE * SLICES`` at most, so that
a small prefix pass over slices carries it and its outcome is broadcast.

Rows of one key at one instant share a slice, whatever their number. Nulls in ``time`` come first, as in an ascending order.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARE = 64
SLICES = 64
#: A key of no more rows than this is never cut.
LEAST = 100_000
#: Inputs of no more bytes than this, by the statistics of their files, hold no key that a task can't, and aren't counted.
SMALL = 32_000_000


def input_bytes(df: DataFrame) -> int:
    """Bytes of what a plan reads, by the statistics of its leaves; what Spark knows no size of counts as very large."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def forget_counted(df: DataFrame) -> None:
    """Let the driver collect a finished count of ``df``, so that its shuffles leave the disks before the work itself begins."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


class Timeline:
    """``rows`` with the columns ``by`` to partition windows by; ``cut`` tells whether any key is hot.

    Building one counts rows by key, of which one row comes to the driver; small inputs aren't counted, unless ``least`` is below its default.
    ``share=0`` leaves out the count and cuts nothing.
    """

    def __init__(self, rows: DataFrame, keys: list[str], time: str, share: int = SHARE, least: int = LEAST):
        self.rows, self.keys, self.by, self.cut = rows, keys, keys, False
        if not share or least >= LEAST and input_bytes(rows) <= SMALL:
            return
        counts = rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        found = counts.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("most")).first()
        if input_bytes(rows) > SMALL:
            forget_counted(rows)
        if not found.total or found.most * share <= found.total or found.most <= least:
            return
        hot = counts.filter((F.col("_rows") > found.total / share) & (F.col("_rows") > least)).select(*keys)
        marks = [i / SLICES for i in range(1, SLICES)]
        bounds = rows.join(F.broadcast(hot), keys).groupBy(*keys).agg(F.percentile_approx(time, marks, 10 * SLICES).alias("_bounds"))
        steps = F.array(*[F.lit(SLICES >> i) for i in range(1, SLICES.bit_length())])
        # The number of bounds below the time, by binary search.
        place = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.col(time) > F.element_at("_bounds", at + step), step).otherwise(0))
        self.rows = rows.join(F.broadcast(bounds), keys, "left").withColumn("_slice", F.when(F.col("_bounds").isNull(), -1).otherwise(place)).drop("_bounds")
        self.by, self.cut = [*keys, "_slice"], True

    def window(self, *order) -> Window:
        return Window.partitionBy(*self.by).orderBy(*order)

    def carried(self, rows: DataFrame, each: Column, fold: Callable[[str], Column], back: bool = False) -> DataFrame:
        """``rows`` with ``_carried``: ``each`` of every slice of the row's key before its own (``back``: after it), folded in order; null in keys of one slice.

        ``fold`` is an aggregate of a column's name, such as a sum, or the last value.
        """
        if not self.cut:
            return rows.withColumn("_carried", F.lit(None))
        part = rows.filter("_slice >= 0").groupBy(*self.by).agg(each.alias("_each"))
        w = Window.partitionBy(*self.keys).orderBy(F.desc("_slice") if back else F.asc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
        border = part.select(*self.by, fold("_each").over(w).alias("_carried"))
        return rows.join(F.broadcast(border), self.by, "left")


def last_known(name: str) -> Column:
    return F.last(name, ignorenulls=True)
