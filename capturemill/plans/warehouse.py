"""The warehouse as a graph: every staged, admitted and served relation with what it is made of, and the checks that stop them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capturemill.operators import checks, presence
from capturemill.plans import served
from capturemill.plans.graph import Build, Check, Node
from capturemill.plans.staging import Sources, consumed

SERVED = ["dim_team", "dim_player", "dim_fixture", "dim_gameweek", "dim_fixture_schedule_history", "dim_player_status_history", "fct_player_fixture", "fct_player_gameweek", "fct_player_market_snapshot", "fct_manager_gameweek", "fct_manager_pick"]
#: The endpoint of each staged relation's payload, and the relations that hold all of an endpoint's captures.
STAGED_OF = {"bootstrap-static": ["team", "position"], "fixtures": ["fixture"], "event-status": ["gameweek_status"], "element-summary": ["player_history_capture"], "entry-picks": ["entry_picks_capture"]}
#: Relations read from a payload, by source.
FIRST = {"bootstrap_static": "bootstrap", "fixtures": "fixture", "event_status": "gameweek_status", "element_summary": "player_history_capture", "entry_picks": "entry_picks_capture"}


def nodes(s: Sources, settled: served.Settled = served.Settled()) -> dict[str, Node]:
    """All relations of a build over ``s``."""

    def of(name: str, *needs: str) -> Node:
        keys = [n.replace(":", "_") for n in needs]
        return Node(lambda *made: getattr(s.preset(**dict(zip(keys, made, strict=True))), name), needs)

    def several(node: Node) -> Node:
        """A table, as one relation reads it several times."""
        return replace(node, kept=True)

    # What is read of a source is made once; its payloads as texts are there for the look at keys.
    out = {f"payload:{source}": Node(lambda source=source: s.payloads[source]) for source in s.payloads}
    out |= {f"records:{source}": Node(lambda source=source: s.records[source]) for source in s.records}
    out |= {
        "index": of("index"), "run": of("run"), "admission": of("admission", "index", "run"), "admitted": of("admitted", "index", "run", "admission"),
        **{relation: of(relation, f"records:{source}" if source in s.records else f"payload:{source}", "admitted") for source, relation in FIRST.items()},
        **{n: of(n, "bootstrap") for n in ("player", "team", "position")}, "gameweek": several(of("gameweek", "bootstrap")), "player_fixture": several(of("player_fixture", "player_history_capture")),
        "entry_picks": of("entry_picks", "entry_picks_capture"), "settlement": of("settlement", "index"), "manager_panel": of("manager_panel"),
        "int_gameweek_status": Node(served.gameweek_status, ("gameweek_status",)), "int_player_season": Node(served.player_season, ("player",)),
        "dim_team": Node(served.dim_team, ("team",)), "dim_player": Node(served.dim_player, ("int_player_season", "position")), "dim_fixture": Node(served.dim_fixture, ("fixture",)),
        "dim_fixture_schedule_history": Node(served.fixture_schedule_history, ("fixture",)), "dim_player_status_history": Node(served.player_status_history, ("player",)),
        "dim_gameweek": Node(lambda g, r: served.dim_gameweek(g, r, settled), ("gameweek", "int_gameweek_status")),
        "fct_player_fixture": Node(lambda p, r, f: served.fct_player_fixture(p, r, f, settled), ("player_fixture", "int_gameweek_status", "dim_fixture")),
        "int_player_gameweek_spine": Node(served.player_gameweek_spine, ("int_player_season", "gameweek")),
        "fct_player_gameweek": Node(served.fct_player_gameweek, ("int_player_gameweek_spine", "fct_player_fixture", "dim_gameweek", "dim_player_status_history", "dim_fixture_schedule_history")),
        "fct_player_market_snapshot": Node(served.fct_player_market_snapshot, ("player",)),
        "int_manager_gameweek_status": Node(served.manager_grid, ("manager_panel", "settlement", "entry_picks_capture")), "dim_manager_panel": Node(served.dim_manager_panel, ("manager_panel", "settlement", "entry_picks_capture")),
        "fct_manager_gameweek": Node(served.fct_manager_gameweek, ("int_manager_gameweek_status", "entry_picks_capture")), "fct_manager_pick": Node(served.fct_manager_pick, ("int_manager_gameweek_status", "entry_picks_capture", "entry_picks")),
        "int_manager_gameweek_points": Node(served.manager_gameweek_points, ("int_manager_gameweek_status", "entry_picks_capture", "entry_picks", "fct_player_gameweek")),
        "int_player_fixture_history_mismatch": Node(served.history_mismatch, ("player_history_capture", "player_fixture")),
        "int_unstaged_admitted_capture": Node(_unstaged, ("admitted", *[r for rs in STAGED_OF.values() for r in rs])),
    }
    for source, (endpoint, columns) in consumed().items():
        out[f"presence:{source}"] = Node(_presence(source, endpoint, columns), (f"payload:{source}", "admitted"), kept=True)
    out["int_source_key_presence"] = Node(lambda first, *more: _all(first, more), tuple(f"presence:{source}" for source in consumed()))
    return out


def _all(first: DataFrame, more: tuple[DataFrame, ...]) -> DataFrame:
    for df in more:
        first = first.unionByName(df)
    return first


def _unstaged(admitted: DataFrame, *staged: DataFrame) -> DataFrame:
    by, left = {}, list(staged)
    for endpoint, relations in STAGED_OF.items():
        by[endpoint] = [left.pop(0) for _ in relations]
    return checks.unstaged_by_endpoint(admitted, by, {})


def _presence(source: str, endpoint: str, columns: dict[str, dict]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    specs = presence.consumed_key_specs(columns)
    return lambda payload, admitted: presence.source_presence(source, specs, admitted, endpoint, payload.withColumnRenamed("body", "json"))


def standing_checks() -> dict[str, Check]:
    """What every build is held to: a key gone from all records stops its payload's relations, an unstaged capture and a broken history or grain what is served."""
    out = {}
    for source, relation in FIRST.items():
        out[f"keys_removed:{source}"] = Check(lambda p: presence.source_findings(p, "removed"), (f"presence:{source}",), (relation,))
        out[f"keys_partial:{source}"] = Check(lambda p: presence.source_findings(p, "partial"), (f"presence:{source}",), warn=True)
    out["unstaged_captures"] = Check(lambda u: u.filter("severity = 'error'"), ("int_unstaged_admitted_capture",), tuple(SERVED))
    for name, keys, stops in (("dim_player_status_history", ["season", "fpl_id"], ("fct_player_gameweek",)), ("dim_fixture_schedule_history", ["season", "fixture_id"], ("fct_player_gameweek",))):
        out[f"intervals:{name}"] = Check(lambda h, keys=keys: checks.broken_intervals(h, keys), (name,), stops)
    out["grain:fct_player_fixture"] = Check(lambda f: checks.unique(f, ["season", "fpl_id", "fixture_id"]), ("fct_player_fixture",), ("fct_player_gameweek",))
    out["grain:fct_player_gameweek"] = Check(lambda f: checks.unique(f, ["season", "fpl_id", "gameweek"]), ("fct_player_gameweek",), ("int_manager_gameweek_points",))
    out["history_mismatch"] = Check(lambda m: m, ("int_player_fixture_history_mismatch",), ("fct_player_fixture",))
    return out


def report(s: Sources, settled: served.Settled = served.Settled(), wanted: list[str] | None = None) -> DataFrame:
    """A whole build: ``name, status, n_rows`` of each served relation and each check, findings of checks counted as no rows."""
    spark = s.manifests.sparkSession
    wanted = wanted or SERVED
    held = standing_checks()
    with Build(spark, nodes(s, settled), held) as build:
        made = build.run([*wanted, *held])
        counts = None
        for name, df in made.items():
            one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
            counts = one if counts is None else counts.unionAll(one)
        rows = {r.name: r.n for r in counts.collect()} if counts is not None else {}  # a row for each relation
        records = [(r.name, r.status, rows.get(r.name)) for r in build.records.values() if r.name in wanted or r.name in held]
    return spark.createDataFrame(records, "name string, status string, n_rows long")
