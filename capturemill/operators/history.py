"""Type-2 histories by change detection over ordered captures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import as_of
from .timeline import LEAST, SHARE, Timeline, last_known


def scd2(df: DataFrame, keys: list[str], order: list[str], tracked: list[str], carried: list[str] = (), time: str | None = None, share: int = SHARE, least: int = LEAST) -> DataFrame:
    """``keys, valid_from, valid_to, tracked, carried``: a row opens at a key's first capture and where a tracked field differs, null-safely, from the capture before.

    ``valid_to`` is the next opening's time, null for the open row. A hot key is worked by slices of its time line (:mod:`.timeline`): the last
    state of the slices before opens or continues a slice's first capture, and the first opening of the slices after closes its last one.
    """
    time = time or order[0]
    state = F.struct(F.struct(*tracked).alias("s"))  # never null itself
    line = Timeline(df, keys, order[0], share, least)
    w = line.window(*order)
    if line.cut:
        rows = line.carried(line.rows, F.max_by(state, F.struct(*order)), last_known)
        rows = rows.withColumn("_prev", F.coalesce(F.lag(state).over(w), "_carried")).drop("_carried")
    else:
        rows = line.rows.withColumn("_prev", F.lag(state).over(w))
    opened = rows.filter(F.col("_prev").isNull() | ~state["s"].eqNullSafe(F.col("_prev.s"))).drop("_prev")
    if line.cut:
        opened = line.carried(opened, F.min_by(time, F.struct(*order)), last_known, back=True)
        ends = F.coalesce(F.lead(time).over(w), "_carried")
    else:
        ends = F.lead(time).over(w)
    return opened.withColumn("valid_to", ends).select(*keys, F.col(time).alias("valid_from"), "valid_to", *tracked, *carried)


def in_force(requests: DataFrame, history: DataFrame, keys: list[str], moment: str, how: str = "left", share: int = SHARE, least: int = LEAST) -> DataFrame:
    """The history row in force at each request's moment: opened strictly before it and not closed before it.

    A history's intervals don't overlap within a key, so the row in force is the last one opened, if it isn't closed: one ordered pass over
    openings and requests, linear in both, in which no request meets the other openings of its key. An interval that closes as it opens is
    never in force.
    """
    rest = [c for c in history.columns if c not in keys]
    lasting = history.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))).withColumn("_row", F.struct(*rest))
    found = as_of(requests, lasting, moment, "valid_from", keys, ["_row"], share=share, least=least)
    holds = F.col("_row").isNotNull() & (F.col("_row.valid_to").isNull() | (F.col(moment) <= F.col("_row.valid_to")))
    if how == "inner":
        found = found.filter(holds)
    return found.select(*requests.columns, *[F.when(holds, F.col(f"_row.{c}")).alias(c) for c in rest])
