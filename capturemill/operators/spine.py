"""Complete key grids and aggregation by class of measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import as_of
from .timeline import LEAST, SHARE, SMALL, Timeline, forget_counted, input_bytes

#: Different requests for a count, up to so many, are counted once each and joined to all requests by broadcast.
FEW = 100_000


def spine(entities: DataFrame, periods: DataFrame, season: list[str]) -> DataFrame:
    """Every entity with every period of its season: an equi join on the season, never a whole cross product."""
    return entities.distinct().join(periods.distinct(), season)


def fill_spine(grid: DataFrame, facts: DataFrame, keys: list[str], fact_key: str, additive: dict[str, Column], last: dict[str, Column], order: list[str], flags: dict[str, Column] | None = None) -> DataFrame:
    """Left join of facts to the grid with one row per key: ``n_facts`` (0 for blanks), additive sums (null for blanks), each value of the last fact by ``order`` that has one, and all-of flags."""
    f = facts.groupBy(*keys).agg(
        F.count(fact_key).cast("int").alias("n_facts"),
        *[F.sum(c).alias(k) for k, c in additive.items()],
        *[F.max_by(c, F.when(c.isNotNull(), F.struct(*order))).alias(k) for k, c in last.items()],
        *[F.bool_and(c).alias(k) for k, c in (flags or {}).items()],
    )
    j = grid.join(f, keys, "left")
    return j.select(*grid.columns, F.coalesce("n_facts", F.lit(0)).alias("n_facts"), *additive, *last, *(flags or {}))


def count_at_moment(requests: DataFrame, groups: DataFrame, schedule: DataFrame, season: str, moment: str, entity: str, group: str, period: str, sides: list[str], share: int = SHARE, least: int = LEAST) -> DataFrame:
    """How many scheduled items an entity's group had in the requested period, as known at the moment.

    ``requests``: season, entity, period, moment. ``groups``: season, entity, group, valid_from, valid_to. ``schedule``: season, period, sides,
    valid_from, valid_to of each item's history. An opening adds one to each of its sides in its period, a closing takes it away, and one ordered
    pass by season, period and group sums them up to each request: linear in the history and the requests, which never meet item by item.
    What is asked is the same for all entities of a group; if large inputs ask for up to ``FEW`` different things (counted first), those alone are shuffled.
    Null where the entity's group wasn't known; 0 where the schedule was known but had no item for it; requests from before a
    season's first schedule are left out.
    """
    started = schedule.groupBy(season).agg(F.min("valid_from").alias("_first"))
    r = requests.join(started, season).filter(F.col("_first") < F.col(moment)).drop("_first")
    lasting = groups.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    mine = as_of(r, lasting, moment, "valid_from", [season, entity], [group], share=share, least=least)
    turns = F.array(F.struct(F.col("valid_from").alias("_at"), F.lit(1).alias("_by")), F.struct(F.col("valid_to").alias("_at"), F.lit(-1).alias("_by")))
    changes = schedule.select(season, period, F.explode(F.array(*sides)).alias(group), "valid_from", "valid_to").dropna(subset=[season, period, group])
    changes = changes.select(season, period, group, F.inline(turns)).dropna(subset="_at").withColumn("_side", F.lit(1))
    wanted = [season, period, group, moment]
    if share and input_bytes(mine) > SMALL:
        different = mine.select(*wanted).distinct()
        few = different.limit(FEW + 1).count() <= FEW
        forget_counted(mine)
        if few:
            each = _counted(different, changes, wanted, share, least).select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(wanted)], "n_at_moment")
            same = F.lit(True)
            for i, c in enumerate(wanted):
                same = same & F.col(c).eqNullSafe(F.col(f"_w{i}"))
            return mine.join(F.broadcast(each), same, "left").select(*mine.columns, "n_at_moment")
    return _counted(mine, changes, wanted, share, least)


def _counted(mine: DataFrame, changes: DataFrame, wanted: list[str], share: int, least: int) -> DataFrame:
    """Requests with the sum of the changes before their moment, by season, period and group."""
    season, period, group, moment = wanted
    asked = mine.select(season, period, group, F.col(moment).alias("_at"), F.lit(0).alias("_side"), F.struct(*mine.columns).alias("_row"))
    line = Timeline(asked.unionByName(changes, allowMissingColumns=True), [season, period, group], "_at", share, least)
    spread = F.when(F.col(group).isNull(), F.xxhash64("_row"))
    w = Window.partitionBy(*line.by, spread).orderBy(F.asc_nulls_first("_at"), "_side").rowsBetween(Window.unboundedPreceding, -1)
    n = F.coalesce(F.sum("_by").over(w), F.lit(0))
    if line.cut:
        found = line.carried(line.rows, F.sum("_by"), F.sum).withColumn("_n", n + F.coalesce("_carried", F.lit(0)))
    else:
        found = line.rows.withColumn("_n", n)
    return found.filter("_side = 0").select("_row.*", F.when(F.col(group).isNotNull(), F.col("_n")).cast("int").alias("n_at_moment"))


def grid_status(panel: DataFrame, periods: DataFrame, captured: DataFrame, season: list[str], keys: list[str], period: str, joined: str, capture: str) -> DataFrame:
    """Panel by period with ``status``: not_yet_joined (takes precedence), captured, or missing_after_join; the capture shows only when captured."""
    g = panel.join(periods, season).join(captured, [*keys, period], "left")
    early = F.col(joined).isNull() | (F.col(period) < F.col(joined))
    status = F.when(early, "not_yet_joined").when(F.col(capture).isNotNull(), "captured").otherwise("missing_after_join")
    return g.withColumn("status", status).withColumn(capture, F.when(F.col("status") == "captured", F.col(capture)))
