"""Strict as-of join, with an optional greatest age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeline import LEAST, SHARE, Timeline, last_known


def as_of(requests: DataFrame, relation: DataFrame, moment: str, time: str, keys: list[str], columns: list[str], max_age: Column | None = None, share: int = SHARE, least: int = LEAST) -> DataFrame:
    """Each request with the columns of the relation's last row strictly before its moment; one row out per request.

    Both sides are unioned and one window over ``keys`` carries the last row forward, so the cost is linear in both sides and no
    request meets every earlier row. A hot key's time line is cut into slices, and the last row of each is carried over the borders
    (:mod:`.timeline`; ``share=0`` where no key can be hot). At equal times requests sort first, which makes the join strict; of relation
    rows at one instant the greatest by its columns counts. The looked-up row is one struct, so that columns of different rows never mix. With
    ``max_age`` the row is chosen first and nulled if it is older than the moment less ``max_age`` (the bound itself is kept).
    Requests with a null key or moment get nulls, and those with a null key are dealt evenly.
    """
    payload = F.struct(F.col(time).alias("_t"), *[F.col(c).alias(f"_c_{c}") for c in columns])
    names = [f"_k{i}" for i in range(len(keys))]
    kinds, theirs = dict(requests.dtypes), dict(relation.dtypes)
    held = {k: n for k, n in zip(keys, names, strict=True) if kinds[k] == theirs[k]} | ({moment: "_at"} if kinds[moment] == theirs[time] else {})  # not in the row a second time
    left = requests.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(moment).alias("_at"), F.lit(0).alias("_side"), F.struct(F.lit(0).alias("_n"), *[c for c in requests.columns if c not in held]).alias("_row"))
    right = relation.filter(F.col(time).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(time).alias("_at"), F.lit(1).alias("_side"), payload.alias("_hit")).dropna(subset=names)
    ok = F.col("_at").isNotNull()
    for n in names:
        ok = ok & F.col(n).isNotNull()
    line = Timeline(left.unionByName(right, allowMissingColumns=True), names, "_at", share, least)
    spread = F.when(ok, 0).otherwise(F.xxhash64("_row", "_at", *names))
    w = Window.partitionBy(*line.by, spread).orderBy(F.asc_nulls_first("_at"), "_side", "_hit").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last("_hit", ignorenulls=True).over(w)
    if line.cut:
        newest = F.max(F.when(F.col("_side") == 1, F.struct("_at", "_hit")))["_hit"]
        rows = line.carried(line.rows, newest, last_known)
        found = rows.withColumn("_last", F.coalesce(last, "_carried")).filter("_side = 0")
    else:
        found = line.rows.withColumn("_last", last).filter("_side = 0")
    if max_age is not None:
        ok = ok & (F.col("_last._t") >= F.col("_at") - max_age)
    return found.select(*[F.col(held.get(c, f"_row.`{c}`")).alias(c) for c in requests.columns], *[F.when(ok, F.col(f"_last._c_{c}")).alias(c) for c in columns])


def as_of_small(requests: DataFrame, relation: DataFrame, moment: str, time: str, keys: list[str], columns: list[str], request_key: list[str]) -> DataFrame:
    """The same for relations of few rows per key: range join, then the greatest time per request (``request_key`` must be unique)."""
    r = relation.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(F.col(time).alias("_t"), *[F.col(c).alias(f"_c_{c}") for c in columns]).alias("_hit"))
    cond = r["_hit"]["_t"] < requests[moment]
    for k in keys:
        cond = cond & (requests[k] == r[f"_k_{k}"])
    best = requests.join(r, cond).groupBy(*request_key).agg(F.max_by("_hit", "_hit._t").alias("_hit"))
    return requests.join(best, request_key, "left").select(*[requests[c] for c in requests.columns], *[F.col(f"_hit._c_{c}").alias(c) for c in columns])


# A status history's columns.
STATUS_COLUMNS = ["valid_from", "valid_to", "status", "chance_of_playing_this_round", "chance_of_playing_next_round", "news", "can_select", "removed", "team_fpl_id", "position_id"]


def player_status_as_of(requests: DataFrame, history: DataFrame) -> DataFrame:
    """The status in force strictly before each request's ``as_of_time``, by season and player; nulls before a player's first capture. A status that ended as it began was never in force."""
    lasting = history.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    return as_of(requests, lasting, "as_of_time", "valid_from", ["season", "fpl_id"], STATUS_COLUMNS)
