"""What each served table should hold by season, told from staging and not from the tables' parents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capturemill.operators.captures import latest_group

# A season's sizes, and how far below its expectation a table may be.
TEAMS, FIXTURES, GAMEWEEKS, PICKS = 20, 380, 38, 15
TOLERANCE = {
    "fct_player_fixture": 0.15, "fct_player_gameweek": 0.02, "dim_team": 0.0, "dim_player": 0.0, "dim_fixture": 0.0, "dim_player_status_history": 0.0,
    "fct_player_market_snapshot": 0.0, "dim_fixture_schedule_history": 0.0, "dim_gameweek": 0.0, "fct_manager_pick": 0.0, "fct_manager_gameweek": 0.0,
}
EXACT = {"dim_gameweek", "fct_manager_pick", "fct_manager_gameweek"}


def expected_rows(staged, live_season: str) -> DataFrame:
    """``table_name, season, expected`` for every staged season and table; of ``dim_gameweek`` for every season with an admitted capture of it.

    ``staged`` has the staged relations as attributes (see ``staging.Sources``). Only the periods that are finished count in the live season.
    """
    seen = [getattr(staged, n).select("season") for n in ("player_fixture", "player", "team", "position", "gameweek", "fixture", "gameweek_status")]
    seasons = reduce(DataFrame.union, seen).distinct()
    players = staged.player.groupBy("season").agg(F.count_distinct("fpl_id").alias("p"), F.count(F.lit(1)).alias("c"))
    newest = latest_group(staged.gameweek, ["season"], ["observed_at", "run_id"])
    weeks = newest.groupBy("season").agg(F.count_if((F.col("season") != live_season) | F.col("finished")).alias("w"))
    fixtures = staged.fixture.groupBy("season").agg(F.count_distinct("fixture_id").alias("f"))
    settled = staged.settlement.select("season", "gameweek")
    first = staged.entry_picks_capture.join(settled, ["season", "gameweek"]).groupBy("season", "entry_id").agg(F.min("gameweek").alias("first"))
    joined = staged.manager_panel.join(first, ["season", "entry_id"]).groupBy("season", "first").agg(F.count(F.lit(1)).alias("n"))  # summed before it meets the markers
    managers = settled.join(joined, "season").filter("first <= gameweek").groupBy("season").agg(F.sum("n").alias("m"))
    by = seasons.join(players, "season", "left").join(weeks, "season", "left").join(fixtures, "season", "left").join(managers, "season", "left").na.fill(0, ["p", "c", "w", "f", "m"])
    grid, m = F.col("p") * F.col("w"), F.col("m")
    each = {
        "fct_player_fixture": grid, "fct_player_gameweek": grid, "dim_team": F.lit(TEAMS), "dim_player": F.col("p"), "dim_fixture": F.lit(FIXTURES), "dim_player_status_history": F.col("p"),
        "fct_player_market_snapshot": F.col("c"), "dim_fixture_schedule_history": F.col("f"), "fct_manager_gameweek": m, "fct_manager_pick": m * PICKS,
    }
    out = by.select("season", F.explode(F.array(*[F.struct(F.lit(t).alias("table_name"), n.cast("long").alias("expected")) for t, n in each.items()])).alias("r")).select("r.table_name", "season", "r.expected")
    boot = staged.admitted.filter("endpoint = 'bootstrap-static'").select("season").distinct()
    return out.unionByName(boot.select(F.lit("dim_gameweek").alias("table_name"), "season", F.lit(GAMEWEEKS).cast("long").alias("expected")))


def as_floors(expected: DataFrame) -> dict[str, dict[str, int]]:
    """The same as a dictionary, a few numbers for each season, as ``publish`` takes it."""
    out: dict[str, dict[str, int]] = {}
    for r in expected.collect():
        out.setdefault(r.table_name, {})[r.season] = r.expected
    return out
