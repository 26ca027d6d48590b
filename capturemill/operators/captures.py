"""Resolving competing captures: admission, latest wins, preference with retraction, rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must be total within a key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def latest_group(df: DataFrame, group: list[str], capture: list[str]) -> DataFrame:
    """All rows of each group's newest capture; a capture is identified by the columns ``capture``, newest last.

    The newest capture comes from one pre-summed maximum for a group, not from a window over all rows.
    """
    newest = df.groupBy(*group).agg(F.max(F.struct(*capture)).alias("_newest"))
    same = F.struct(*capture).eqNullSafe(F.col("_newest"))
    return df.join(newest, group).filter(same).drop("_newest")


def first_reason(reasons: list[tuple[str, Column]]) -> Column:
    """The name of the first condition that holds; null if none does. A null condition doesn't hold."""
    out = F.lit(None).cast("string")
    for name, condition in reversed(reasons):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def admit(index: DataFrame, runs: DataFrame, seeds: DataFrame, main_ref: str = "refs/heads/main") -> DataFrame:
    """Mark each capture of the index with the first reason not to read it, and whether it is admitted; ``flagged_revalidation`` tells admitted ones whose shape failed when it was looked at again.

    ``index``: capture_key, run_id, usable, season, shape_ok, shape_source; ``runs``: run_id, origin_kind, origin_ref of finalised runs;
    ``seeds``: run_id, origin_kind of runs whose manifests don't say. Only a port of history may do without a finalised run, whatever
    its scope; only the CI of the main branch and seeded CI or history count as production.
    """
    r = runs.select("run_id", F.col("origin_kind").alias("_run_kind"), F.col("origin_ref").alias("_ref"), F.lit(True).alias("_finalized"))
    o = seeds.select("run_id", F.col("origin_kind").alias("_seed_kind"))
    j = index.join(r, "run_id", "left").join(o, "run_id", "left")
    of_main = (F.col("_run_kind") == "ci") & F.coalesce(F.col("_ref") == main_ref, F.lit(False))
    reason = first_reason([
        ("run_not_finalized", F.col("_finalized").isNull() & ~F.col("_seed_kind").eqNullSafe("history_port")),
        ("origin_unknown", F.coalesce("_run_kind", "_seed_kind").isNull()),
        ("not_production", F.col("_run_kind").isNotNull() & ~of_main),
        ("not_production", F.col("_run_kind").isNull() & ~F.col("_seed_kind").isin("ci", "history_port")),
        ("unusable", ~F.coalesce(F.col("usable"), F.lit(False))),
        ("null_season", F.col("season").isNull()),
    ])
    out = j.withColumn("unadmitted_reason", reason).withColumn("admitted", F.col("unadmitted_reason").isNull())
    again = F.col("shape_source").eqNullSafe("revalidated") & F.col("shape_ok").eqNullSafe(False)
    return out.withColumn("flagged_revalidation", F.col("admitted") & again).select(*index.columns, "admitted", "flagged_revalidation", "unadmitted_reason")


def retract(df: DataFrame, entity: list[str], key: list[str], capture: list[str]) -> DataFrame:
    """Rows whose key is in its entity's newest capture; keys gone from it are dropped with all their captures."""
    current = latest_group(df.select(*dict.fromkeys([*entity, *key, *capture])), entity, capture).select(*key).distinct()
    return df.join(current, key, "left_semi")


def prefer(df: DataFrame, key: list[str], preferred: Column, newest: list[Column]) -> DataFrame:
    """One row per key: preferred rows first, then newest first."""
    return latest(df.withColumn("_pref", F.coalesce(preferred, F.lit(False))), key, [F.desc("_pref"), *newest]).drop("_pref")


def all_then_any(df: DataFrame, outer: list[str], inner: list[str], good: Column, name: str) -> DataFrame:
    """True for an outer key when in any of its inner groups all rows are good; null counts as false at the end."""
    each = df.groupBy(*outer, *inner).agg(F.bool_and(good).alias("_all"))
    return each.groupBy(*outer).agg(F.coalesce(F.bool_or("_all"), F.lit(False)).alias(name))


def before_moment_else_earliest(df: DataFrame, keys: list[str], time: str, tie: str, moment: str, flag: str = "is_before") -> DataFrame:
    """The last row strictly before its moment, else the earliest; a null moment makes every row "before"."""
    before = F.col(moment).isNull() | (F.col(time) < F.col(moment))
    d = df.withColumn(flag, before)
    order = [F.desc(flag), F.when(F.col(flag), F.col(time)).desc_nulls_last(), F.when(F.col(flag), F.col(tie)).desc_nulls_last(), F.asc(time), F.asc(tie)]
    return latest(d, keys, order)
