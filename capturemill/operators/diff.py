"""Comparing two builds of a relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape_diff(a: DataFrame, b: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """Columns with a different type or on one side only."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    return [(c, x.get(c), y.get(c)) for c in sorted({*x, *y}) if x.get(c) != y.get(c)]


def row_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with their surplus on either side, copies counted: one pre-summed aggregate over both."""
    cols = a.columns
    both = a.withColumn("_d", F.lit(1)).unionByName(b.withColumn("_d", F.lit(-1)))
    d = both.groupBy(*cols).agg(F.sum("_d").alias("surplus")).filter("surplus <> 0")
    return d.withColumn("side", F.when(F.col("surplus") > 0, "left").otherwise("right")).withColumn("surplus", F.abs("surplus"))


def key_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only or with conflicting columns, whose names are listed."""
    rest = [c for c in a.columns if c not in keys]
    x = a.select(*keys, F.struct(*rest).alias("_a"))
    y = b.select(*keys, F.struct(*rest).alias("_b"))
    j = x.join(y, keys, "full")
    names = F.concat_ws(",", *[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in rest])
    status = F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").when(names != "", "conflict")
    return j.select(*keys, status.alias("status"), F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), names).alias("columns")).filter("status is not null")
