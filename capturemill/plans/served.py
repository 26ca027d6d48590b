"""The served relations, built from staged captures with this engine's operators.

``staged`` maps a staged relation's name to its DataFrame. All but the settlement markers and the panel carry season, run_id, observed_at
and capture_key. Every function declares one relation; ``build`` wires them together, so that Catalyst sees whole plans.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capturemill.functions.scalars import contains, second_boundaries
from capturemill.operators.asof import as_of
from capturemill.operators.captures import all_then_any, before_moment_else_earliest, latest, latest_group, prefer, retract
from capturemill.operators.history import scd2
from capturemill.operators.spine import count_at_moment, grid_status, spine

CAPTURE = ["observed_at", "run_id"]
INTS = ["minutes", "starts", "total_points", "bonus", "bps", "goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals", "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves", "clearances_blocks_interceptions", "recoveries", "tackles", "defensive_contribution"]
EXPECTED = ["expected_goals", "expected_assists", "expected_goal_involvements", "expected_goals_conceded"]
INDICES = ["influence", "creativity", "threat", "ict_index"]
MARKET = ["value", "selected", "transfers_in", "transfers_out", "transfers_balance"]
FIXTURE_COLUMNS = ["season", "extraction_date", "run_id", "extracted_at", "fpl_id", "fixture_id", "gameweek", "opponent_team_fpl_id", "was_home", "kickoff_time", "team_h_score", "team_a_score", *INTS, *EXPECTED, *INDICES, *MARKET, "modified"]
STATUS = ["status", "chance_of_playing_this_round", "chance_of_playing_next_round", "news", "can_select", "removed", "team_fpl_id", "position_id"]
SCHEDULE = ["gameweek", "kickoff_time", "team_h_fpl_id", "team_a_fpl_id", "team_h_difficulty", "team_a_difficulty"]


@dataclass(frozen=True)
class Settled:
    """When results count as final without a status capture."""

    closed_seasons: tuple[str, ...] = ()
    fallback_season: str | None = None
    fallback_before: datetime.datetime | None = None

    def fallback(self, moment: Column) -> Column:
        """The season's periods from before status captures began."""
        if self.fallback_season is None or self.fallback_before is None:
            return F.lit(False)
        return (F.col("season") == self.fallback_season) & (moment < F.lit(self.fallback_before).cast("timestamp_ntz"))


def newest() -> list[Column]:
    return [F.desc("observed_at"), F.desc("run_id")]


def gameweek_status(status: DataFrame) -> DataFrame:
    good = (F.col("points") == "r") & F.col("bonus_added")
    return all_then_any(status, ["season", "gameweek"], ["run_id"], good, "is_ratified")


def player_season(player: DataFrame) -> DataFrame:
    return latest(player, ["season", "fpl_id"], newest()).select("season", "fpl_id", "player_code", "web_name", "position_id", "run_id")


def dim_team(team: DataFrame) -> DataFrame:
    return latest_group(team, ["season"], CAPTURE).select("season", "team_fpl_id", "team_code", "team_name", "team_short_name")


def dim_player(roster: DataFrame, position: DataFrame) -> DataFrame:
    """The roster with the short name of the position in the same capture."""
    return roster.join(position.select("season", "run_id", "position_id", "position_short_name"), ["season", "run_id", "position_id"], "left").select("season", "fpl_id", "player_code", "web_name", "position_id", "position_short_name")


def dim_fixture(fixture: DataFrame) -> DataFrame:
    """Newest attributes, and the difficulty of the last capture before the newest kickoff, else of the earliest."""
    key = ["season", "fixture_id"]
    now = latest(fixture, key, newest()).select(*key, "gameweek", "kickoff_time", "team_h_fpl_id", "team_a_fpl_id", "team_h_score", "team_a_score", "finished")
    seen = fixture.select(*key, *CAPTURE, "team_h_difficulty", "team_a_difficulty").join(now.select(*key, F.col("kickoff_time").alias("_moment")), key)
    rated = before_moment_else_earliest(seen, key, "observed_at", "run_id", "_moment", "difficulty_is_pre_kickoff")
    return now.join(rated.select(*key, "team_h_difficulty", "team_a_difficulty", "difficulty_is_pre_kickoff"), key)


def fixture_schedule_history(fixture: DataFrame) -> DataFrame:
    return scd2(fixture, ["season", "fixture_id"], CAPTURE, SCHEDULE, ["capture_key"])


def player_status_history(player: DataFrame) -> DataFrame:
    return scd2(player, ["season", "fpl_id"], CAPTURE, STATUS, ["news_added", "player_code", "capture_key"])


def dim_gameweek(gameweek: DataFrame, status: DataFrame, settled: Settled) -> DataFrame:
    """The last capture before each newest deadline, null until a capture of the season has passed the deadline."""
    captures = gameweek.select("season", "observed_at").distinct()
    clock = captures.groupBy("season").agg(F.max("observed_at").alias("_clock"))
    due = latest(gameweek, ["season", "gameweek"], newest()).select("season", "gameweek", "deadline_time", "ranked_count")
    found = as_of(due, captures, "deadline_time", "observed_at", ["season"], ["observed_at"])
    j = found.join(clock, "season").join(status.withColumn("_known", F.lit(True)), ["season", "gameweek"], "left")
    passed = F.col("deadline_time") <= F.col("_clock")
    final = F.col("is_ratified") | (F.col("_known").isNull() & settled.fallback(F.col("deadline_time")))
    return j.select(
        "season", "gameweek", "deadline_time", F.when(passed, F.col("observed_at")).alias("last_capture_before_deadline_at"),
        F.when(passed, second_boundaries(F.col("observed_at"), F.col("deadline_time")).cast("int")).alias("state_age_seconds"), F.when(final, F.col("ranked_count")).alias("ranked_count"),
    )


def fct_player_fixture(facts: DataFrame, status: DataFrame, fixture: DataFrame, settled: Settled) -> DataFrame:
    """Keys of each player's newest capture, each by its scored and then newest capture; ratified by season, status or date."""
    key = ["season", "fpl_id", "fixture_id"]
    scored = F.col("team_h_score").isNotNull() & F.col("team_a_score").isNotNull()
    best = prefer(retract(facts, ["season", "fpl_id"], key, CAPTURE), key, scored, newest())
    final = F.coalesce(F.col("is_ratified"), settled.fallback(F.col("kickoff_time")) & scored)
    closed = F.col("season").isin(list(settled.closed_seasons)) if settled.closed_seasons else F.lit(False)
    sides = fixture.select("season", "fixture_id", F.col("team_h_fpl_id").alias("_h"), F.col("team_a_fpl_id").alias("_a"))
    j = best.join(status, ["season", "gameweek"], "left").join(sides, ["season", "fixture_id"], "left")
    return j.select(*FIXTURE_COLUMNS, F.when(closed, True).otherwise(final).alias("is_ratified"), F.when(F.col("was_home"), F.col("_h")).otherwise(F.col("_a")).alias("team_fpl_id"))


def player_gameweek_spine(roster: DataFrame, gameweek: DataFrame) -> DataFrame:
    """Players of any capture by the periods that the season's newest capture has as finished."""
    done = latest_group(gameweek, ["season"], CAPTURE).filter("finished").select("season", "gameweek")
    return spine(roster.select("season", "fpl_id", "web_name"), done, ["season"])


def fct_player_gameweek(grid: DataFrame, facts: DataFrame, gameweek: DataFrame, status_history: DataFrame, schedule: DataFrame) -> DataFrame:
    """Sums that stay null for blanks, values of the last fixture, and how many fixtures were known at the deadline."""
    key = ["season", "fpl_id", "gameweek"]
    sums = {c: F.sum(c).cast("int") for c in INTS}
    exact = {c: F.sum(F.col(c).cast("decimal(18,4)")) for c in [*EXPECTED, *INDICES]}
    sums |= {c: (F.round(v, 1) if c in INDICES else v).cast("double") for c, v in exact.items()}
    # Each value is that of the last fixture which has one.
    last = {c: F.max_by(c, F.when(F.col(c).isNotNull() & F.col("kickoff_time").isNotNull(), F.struct("kickoff_time", "fixture_id"))) for c in MARKET}
    f = facts.groupBy(*key).agg(
        F.count("fixture_id").cast("int").alias("fixture_count"), F.min("kickoff_time").alias("first_kickoff_time"), F.max("kickoff_time").alias("last_kickoff_time"), F.bool_and("is_ratified").alias("is_ratified"),
        *[v.alias(k) for k, v in {**sums, **last}.items()],
    )
    moments = gameweek.filter("last_capture_before_deadline_at is not null").select("season", "gameweek", "deadline_time")
    asked = grid.select(*key).join(moments, ["season", "gameweek"])
    teams = status_history.select("season", F.col("fpl_id").alias("entity"), F.col("team_fpl_id").alias("team"), "valid_from", "valid_to")
    known = count_at_moment(asked.withColumnRenamed("fpl_id", "entity"), teams, schedule, "season", "deadline_time", "entity", "team", "gameweek", ["team_h_fpl_id", "team_a_fpl_id"])
    known = known.select("season", F.col("entity").alias("fpl_id"), "gameweek", F.col("n_at_moment").alias("fixture_count_at_deadline"))
    j = grid.join(f, key, "left").join(known, key, "left")
    return j.select(*key, "web_name", F.coalesce("fixture_count", F.lit(0)).alias("fixture_count"), "first_kickoff_time", "last_kickoff_time", "is_ratified", *sums, *MARKET, "fixture_count_at_deadline")


def fct_player_market_snapshot(player: DataFrame) -> DataFrame:
    return player.select("season", "fpl_id", "capture_key", "observed_at", "now_cost", "selected_by_percent", "transfers_in_event", "transfers_out_event")


def manager_grid(panel: DataFrame, markers: DataFrame, captures: DataFrame) -> DataFrame:
    """Panel by settled period: not yet joined, captured or missing. A manager joins with the first captured settled period."""
    win = latest(captures, ["season", "entry_id", "gameweek"], newest()).select("season", "entry_id", "gameweek", "capture_key")
    joined = win.join(markers, ["season", "gameweek"]).groupBy("season", "entry_id").agg(F.min("gameweek").alias("joined"))
    return grid_status(panel.join(joined, ["season", "entry_id"], "left"), markers.select("season", "gameweek").distinct(), win, ["season"], ["season", "entry_id"], "gameweek", "joined", "capture_key")


def dim_manager_panel(panel: DataFrame, markers: DataFrame, captures: DataFrame) -> DataFrame:
    """The panel with the first settled period that each manager has a capture of."""
    first = captures.select("season", "entry_id", "gameweek").join(markers.select("season", "gameweek").distinct(), ["season", "gameweek"]).groupBy("season", "entry_id").agg(F.min("gameweek").alias("first_active_gw"))
    return panel.select("season", "entry_id", "cohort").join(first, ["season", "entry_id"], "left")


def manager_gameweek_points(grid: DataFrame, captures: DataFrame, picks: DataFrame, players: DataFrame) -> DataFrame:
    """The publisher's points of each captured period beside those rebuilt from picks and players; unknown players count 0."""
    c = captures.select("capture_key", "active_chip", F.col("points").alias("fpl_points"))
    g = grid.filter("status = 'captured'").select("season", "entry_id", "gameweek", "capture_key").join(c, "capture_key").join(picks.select("capture_key", "fpl_id", "multiplier"), "capture_key")
    j = g.join(players.select("season", "gameweek", "fpl_id", "total_points"), ["season", "gameweek", "fpl_id"], "left")
    return j.groupBy("season", "entry_id", "gameweek", "active_chip", "fpl_points").agg(F.sum(F.col("multiplier") * F.coalesce("total_points", F.lit(0))).alias("rebuilt_points"))


def history_mismatch(captures: DataFrame, facts: DataFrame) -> DataFrame:
    """Captures whose array's length isn't the number of their staged rows."""
    n = facts.groupBy("capture_key").agg(F.count(F.lit(1)).alias("_n"))
    j = captures.join(n, "capture_key", "left").withColumn("staged_rows", F.coalesce("_n", F.lit(0)))
    return j.filter(~F.col("history_count").eqNullSafe(F.col("staged_rows"))).select("season", "run_id", "capture_key", "observed_at", F.col("history_count").alias("expected_rows"), "staged_rows")


def fct_manager_gameweek(grid: DataFrame, captures: DataFrame) -> DataFrame:
    c = captures.select("capture_key", "active_chip", "event_transfers", "event_transfers_cost", "automatic_subs", F.nullif(F.col("overall_rank"), F.lit(0)).alias("overall_rank"))
    return grid.filter("status = 'captured'").join(c, "capture_key").select("season", "entry_id", "gameweek", "cohort", *c.columns[1:])


def fct_manager_pick(grid: DataFrame, captures: DataFrame, picks: DataFrame) -> DataFrame:
    """Captured picks with their part in the automatic substitutions; a null list gives nulls."""
    j = grid.filter("status = 'captured'").select("season", "entry_id", "gameweek", "capture_key").join(picks.select("capture_key", "slot", "fpl_id", "is_captain", "is_vice_captain"), "capture_key").join(captures.select("capture_key", "automatic_subs"), "capture_key")
    side = {f"is_auto_sub_{x}": contains(F.col(f"automatic_subs.fpl_id_{x}"), F.col("fpl_id")).alias(f"is_auto_sub_{x}") for x in ("in", "out")}
    return j.select("season", "entry_id", "gameweek", "slot", "fpl_id", "is_captain", "is_vice_captain", *side.values())


def build(staged: dict[str, DataFrame], settled: Settled = Settled()) -> dict[str, DataFrame]:
    """All served relations."""
    s = staged
    status, roster = gameweek_status(s["gameweek_status"]), player_season(s["player"])
    fixture, schedule, history = dim_fixture(s["fixture"]), fixture_schedule_history(s["fixture"]), player_status_history(s["player"])
    gameweek = dim_gameweek(s["gameweek"], status, settled)
    facts = fct_player_fixture(s["player_fixture"], status, fixture, settled)
    grid = manager_grid(s["manager_panel"], s["settlement"], s["entry_picks_capture"])
    return {
        "dim_team": dim_team(s["team"]), "dim_player": dim_player(roster, s["position"]), "dim_fixture": fixture, "dim_gameweek": gameweek,
        "dim_fixture_schedule_history": schedule, "dim_player_status_history": history, "fct_player_fixture": facts,
        "fct_player_gameweek": fct_player_gameweek(player_gameweek_spine(roster, s["gameweek"]), facts, gameweek, history, schedule),
        "fct_player_market_snapshot": fct_player_market_snapshot(s["player"]), "fct_manager_gameweek": fct_manager_gameweek(grid, s["entry_picks_capture"]), "fct_manager_pick": fct_manager_pick(grid, s["entry_picks_capture"], s["entry_picks"]),
    }
