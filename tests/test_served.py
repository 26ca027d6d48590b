"""The served relations on literal captures."""

import datetime as dt

import pytest

from capturemill.plans import served

T = dt.datetime
META = "season string, run_id string, observed_at timestamp_ntz, capture_key string, "
D1, D2, D3 = T(2024, 8, 1), T(2024, 8, 10), T(2024, 8, 20)


@pytest.fixture(scope="module")
def tables(spark):
    def rows(data, schema):
        return spark.createDataFrame(data, META + schema)

    def cap(r, d, k):
        return ("s1", r, d, f"{k}/{r}")

    numbers = [*served.INTS, *served.EXPECTED, *served.INDICES, *served.MARKET]
    kinds = {**dict.fromkeys(served.INTS + served.MARKET, "int"), **dict.fromkeys(served.EXPECTED + served.INDICES, "double")}

    def fact(r, d, fixture, week, home, score, points):
        vals = [points if n == "total_points" else None if n == "selected" and fixture == 2 else 100 + fixture if n in served.MARKET else 0.1 if kinds[n] == "double" else 0 for n in numbers]
        return (*cap(r, d, "f"), d.date(), d, 1, fixture, week, 9, home, T(2024, 8, 5 + fixture), score, score, *vals, False)

    facts = [fact("r1", D1, 1, 1, True, None, 0), fact("r1", D1, 3, 1, True, 1, 99), fact("r2", D2, 1, 1, True, 2, 5), fact("r2", D2, 2, 1, False, 3, 6), fact("r3", D3, 1, 1, True, None, 0), fact("r3", D3, 2, 1, False, 3, 7)]
    schema = "extraction_date date, extracted_at timestamp_ntz, fpl_id int, fixture_id int, gameweek int, opponent_team_fpl_id int, was_home boolean, kickoff_time timestamp_ntz, team_h_score int, team_a_score int, " + ", ".join(f"{n} {kinds[n]}" for n in numbers) + ", modified boolean"
    player = [(*cap(r, d, "b"), p, 70 + p, f"p{p}", 1, t, st, None, None, None, True, False, None, 50, 1, 2) for r, d, p, t, st in (("r1", D1, 1, 10, "a"), ("r1", D1, 2, 11, "a"), ("r2", D2, 1, 10, "d"), ("r3", D3, 1, 10, "a"))]
    staged = {
        "player_fixture": rows(facts, schema),
        "player": rows(player, "fpl_id int, player_code int, web_name string, position_id int, team_fpl_id int, status string, chance_of_playing_this_round int, chance_of_playing_next_round int, news string, can_select boolean, removed boolean, news_added timestamp_ntz, now_cost int, transfers_in_event int, transfers_out_event int").selectExpr("*", "cast(1.5 as decimal(4,1)) selected_by_percent"),
        "team": rows([(*cap("r1", D1, "b"), 10, 1, "old", "O"), (*cap("r3", D3, "b"), 11, 2, "new", "N")], "team_fpl_id int, team_code int, team_name string, team_short_name string"),
        "position": rows([(*cap("r3", D3, "b"), 1, "GK")], "position_id int, position_short_name string"),
        "fixture": rows([(*cap("r1", D1, "x"), f, 1, T(2024, 8, 5 + f), 10, 11, None, None, False, 2, 3) for f in (1, 2)] + [(*cap("r3", D3, "x"), 1, 1, T(2024, 8, 6), 10, 11, 2, 2, True, 4, 5)], "fixture_id int, gameweek int, kickoff_time timestamp_ntz, team_h_fpl_id int, team_a_fpl_id int, team_h_score int, team_a_score int, finished boolean, team_h_difficulty int, team_a_difficulty int"),
        "gameweek": rows([(*cap(r, d, "b"), g, T(2024, 8, 5) if g == 1 else T(2024, 9, 5), 7, g == 1 and r == "r3") for r, d in (("r1", D1), ("r3", D3)) for g in (1, 2)], "gameweek int, deadline_time timestamp_ntz, ranked_count int, finished boolean"),
        "gameweek_status": rows([(*cap("r2", D2, "e"), 1, "r", True), (*cap("r3", D3, "e"), 1, "p", True)], "gameweek int, points string, bonus_added boolean"),
        "manager_panel": spark.createDataFrame([("s1", 5, "top"), ("s1", 6, "self")], "season string, entry_id int, cohort string"),
        "settlement": spark.createDataFrame([("s1", 1), ("s1", 2)], "season string, gameweek int"),
        "entry_picks_capture": rows([(*cap("r2", D2, "p"), 5, 1, None, 0, 0, [(1, 2)], 0)], "entry_id int, gameweek int, active_chip string, event_transfers int, event_transfers_cost int, automatic_subs array<struct<fpl_id_out int, fpl_id_in int>>, overall_rank int"),
        "entry_picks": rows([(*cap("r2", D2, "p"), i, i, i == 1, False) for i in (1, 2, 3)], "slot int, fpl_id int, is_captain boolean, is_vice_captain boolean"),
    }
    return {k: [r.asDict(recursive=True) for r in v.collect()] for k, v in served.build(staged).items()}


def test_preference_retraction_and_ratification(tables):
    got = {r["fixture_id"]: r for r in tables["fct_player_fixture"]}
    assert set(got) == {1, 2} and (got[1]["total_points"], got[2]["total_points"]) == (5, 7)  # fixture 3 is retracted; scored captures win
    assert got[1]["team_fpl_id"] == 10 and got[2]["team_fpl_id"] == 11 and all(r["is_ratified"] for r in got.values())
    assert list(got[1]) == [*served.FIXTURE_COLUMNS, "is_ratified", "team_fpl_id"] and len(got[1]) == 47


def test_player_gameweek(tables):
    got = {r["fpl_id"]: r for r in tables["fct_player_gameweek"]}
    assert set(got) == {1, 2} and len(got[1]) == 41
    assert (got[1]["fixture_count"], got[1]["total_points"], got[1]["value"], got[1]["influence"], got[1]["fixture_count_at_deadline"]) == (2, 12, 102, 0.2, 2)
    assert got[1]["selected"] == 101 and got[1]["expected_goals"] == 0.2  # the last fixture has no such value
    assert (got[2]["fixture_count"], got[2]["total_points"], got[2]["is_ratified"], got[2]["fixture_count_at_deadline"]) == (0, None, None, 2)


def test_dimensions(tables):
    assert [r["team_name"] for r in tables["dim_team"]] == ["new"]
    assert {r["fpl_id"]: r["position_short_name"] for r in tables["dim_player"]} == {1: "GK", 2: None}
    f = {r["fixture_id"]: r for r in tables["dim_fixture"]}
    assert (f[1]["team_h_score"], f[1]["team_h_difficulty"], f[1]["difficulty_is_pre_kickoff"]) == (2, 2, True)
    g = {r["gameweek"]: r for r in tables["dim_gameweek"]}
    assert (g[1]["last_capture_before_deadline_at"], g[1]["state_age_seconds"], g[1]["ranked_count"]) == (D1, 4 * 86400, 7)
    assert g[2]["last_capture_before_deadline_at"] is None and g[2]["ranked_count"] is None
    assert [r["status"] for r in sorted(tables["dim_player_status_history"], key=lambda r: (r["fpl_id"], r["valid_from"]))] == ["a", "d", "a", "a"]
    assert len(tables["dim_fixture_schedule_history"]) == 3 and len(tables["fct_player_market_snapshot"]) == 4


def test_managers(tables):
    assert [(r["entry_id"], r["gameweek"], r["cohort"], r["overall_rank"]) for r in tables["fct_manager_gameweek"]] == [(5, 1, "top", None)]
    assert {r["slot"]: (r["is_auto_sub_in"], r["is_auto_sub_out"]) for r in tables["fct_manager_pick"]} == {1: (False, True), 2: (True, False), 3: (False, False)}
