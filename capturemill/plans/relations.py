"""The warehouse's relations as queries: captures in JSON are made of the driver's tables, then staged, admitted and served by the engine.

``WORLD`` is SQL that both engines read; it says what the captures hold. The engine sees it as run manifests, a catalog and
JSON texts alone; the SQL beside each query reads the same rows without JSON, admission code or windows of the engine. A month of orders is a
run; customers are players and managers, nations teams, regions positions, suppliers fixtures, months periods and years seasons.

What grows with the tables within one capture, manifest, catalog or panel comes in parts of ``PART`` ids at most, so that no row grows with the tables.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capturemill.operators import asof, checks, presence
from capturemill.plans import expectations, graph, served, staging, warehouse
from capturemill.plans.catalogue import ORACLE_SQL, QUERIES, read

#: A part holds what has ids of one range of so many.
PART = 4096

WORLD = {
    "base": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, year(o_orderdate) AS y, month(o_orderdate) AS m, concat('r', cast(year(o_orderdate) * 100 + month(o_orderdate) AS string)) AS run_id FROM {orders}",
    "runs": "SELECT run_id, y, m, min(o_orderdate) + INTERVAL 1 HOUR AS started_at, CASE WHEN m = 6 THEN 'IN_PROGRESS' ELSE 'SUCCEEDED' END AS status, CASE WHEN m = 4 THEN NULL WHEN m = 5 THEN 'local' ELSE 'ci' END AS kind, CASE WHEN m = 7 THEN 'refs/heads/dev' WHEN m = 8 AND y = 1996 THEN NULL ELSE 'refs/heads/main' END AS ref FROM base GROUP BY run_id, y, m",
    "seeds": "SELECT run_id, CASE WHEN y % 2 = 0 THEN 'ci' ELSE 'local' END AS origin_kind FROM runs WHERE m = 4 AND y <> 1997 UNION ALL SELECT DISTINCT concat('h', cast(y AS string)), CASE WHEN y = 1999 THEN 'ci' ELSE 'history_port' END FROM base",
    "kinds": "SELECT 'bootstrap-static' AS endpoint UNION ALL SELECT 'fixtures' UNION ALL SELECT 'event-status'",
    "live": "SELECT concat('raw/fpl/', k.endpoint, '/', run_id) AS capture_key, run_id, k.endpoint AS endpoint, started_at + INTERVAL 10 MINUTE AS received_at, m <> 2 AS usable, m <> 11 AS shape_ok, CASE WHEN m = 9 THEN NULL ELSE cast(y AS string) END AS season FROM runs CROSS JOIN kinds k",
    "picked": "SELECT concat('raw/fpl/entry-picks/', run_id, '/', cast(o_custkey AS string)) AS capture_key, run_id, concat('entry-picks/entry/', cast(m AS string), '/', cast(o_custkey AS string)) AS endpoint, max(o_orderdate) AS received_at, m <> 2 AS usable, true AS shape_ok, CASE WHEN m = 9 THEN NULL ELSE cast(y AS string) END AS season, y, m, o_custkey FROM base GROUP BY run_id, y, m, o_custkey",
    "past": "SELECT concat('history/', cast(y AS string), '/fpl/element-summary/', cast(o_custkey AS string)) AS capture_key, concat('h', cast(y AS string)) AS run_id, concat('element-summary/', cast(o_custkey AS string)) AS endpoint, max(o_orderdate) AS received_at, o_custkey % 11 <> 3 AS usable, o_custkey % 7 <> 0 AS shape_ok, cast(y AS string) AS season, y, o_custkey FROM base GROUP BY y, o_custkey",
    "elements": "SELECT b.* FROM base b JOIN (SELECT run_id AS r, o_custkey AS c, max(o_orderkey) AS k FROM base GROUP BY run_id, o_custkey) l ON b.run_id = l.r AND b.o_custkey = l.c AND b.o_orderkey = l.k",
}

# What each payload's fields hold: name, SQL in both engines, type as staged.
_ELEMENT = [
    ("id", "fpl_id", "o_custkey", "int"), ("web_name", "web_name", "concat('c', cast(o_custkey AS string))", "string"), ("code", "player_code", "o_custkey + 1000", "int"), ("element_type", "position_id", "o_custkey % 5", "int"),
    ("total_points", "total_points", "floor(o_totalprice / 5000)", "int"), ("team", "team_fpl_id", "(o_custkey + y) % 25", "int"), ("status", "status", "o_orderstatus", "string"),
    ("chance_of_playing_this_round", "chance_of_playing_this_round", "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 75 END", "int"), ("chance_of_playing_next_round", "chance_of_playing_next_round", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 100 END", "int"),
    ("news", "news", "CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE o_orderpriority END", "string"), ("news_added", "news_added", "o_orderdate", "timestamp"), ("can_select", "can_select", "o_orderkey % 3 <> 0", "boolean"), ("removed", "removed", "o_orderkey % 17 = 0", "boolean"),
    ("now_cost", "now_cost", "floor(o_totalprice / 1000)", "int"), ("selected_by_percent", "selected_by_percent", "CASE WHEN o_custkey % 13 = 0 THEN '' ELSE concat(cast(o_custkey % 100 AS string), '.', cast(o_orderkey % 10 AS string)) END", "decimal(4,1)"),
    ("transfers_in_event", "transfers_in_event", "o_orderkey % 1000", "int"), ("transfers_out_event", "transfers_out_event", "o_orderkey % 777", "int"),
]
_TEAM = [("id", "team_fpl_id", "n_nationkey", "int"), ("code", "team_code", "n_nationkey + 100", "int"), ("name", "team_name", "n_name", "string"), ("short_name", "team_short_name", "substr(n_name, 1, 3)", "string"), ("strength", "strength", "CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_regionkey END", "int")]
_POSITION = [("id", "position_id", "r_regionkey", "int"), ("singular_name", "position_name", "r_name", "string"), ("singular_name_short", "position_short_name", "substr(r_name, 1, 2)", "string")]
_EVENT = [("id", "gameweek", "w.m", "int"), ("deadline_time", "deadline_time", "w.started_at + INTERVAL 9 DAY", "timestamp"), ("finished", "finished", "w.m < r.m", "boolean"), ("data_checked", "data_checked", "w.m + 1 < r.m", "boolean"), ("is_current", "is_current", "w.m = r.m", "boolean"), ("ranked_count", "ranked_count", "CASE WHEN w.m < r.m THEN w.m * 1000 ELSE NULL END", "int")]
_FIXTURE = [
    ("id", "fixture_id", "s_suppkey", "int"), ("event", "gameweek", "CASE WHEN s_suppkey % 19 = 0 AND r.m < 7 THEN NULL ELSE s_suppkey % 12 + 1 END", "int"), ("kickoff_time", "kickoff_time", "w.started_at + INTERVAL 12 DAY + (CASE WHEN s_suppkey % 5 = 0 AND r.m > 3 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END)", "timestamp"),
    ("team_h", "team_h_fpl_id", "s_nationkey", "int"), ("team_a", "team_a_fpl_id", "(s_nationkey + s_suppkey % 24 + 1) % 25", "int"), ("team_h_score", "team_h_score", "CASE WHEN w.m < r.m THEN s_suppkey % 4 ELSE NULL END", "int"), ("team_a_score", "team_a_score", "CASE WHEN w.m < r.m THEN s_suppkey % 3 ELSE NULL END", "int"),
    ("finished", "finished", "w.m < r.m", "boolean"), ("team_h_difficulty", "team_h_difficulty", "(s_suppkey + r.m) % 5 + 1", "int"), ("team_a_difficulty", "team_a_difficulty", "s_suppkey % 5 + 1", "int"),
]
_STATUS = [("event", "gameweek", "w.m", "int"), ("date", "match_date", "cast(w.started_at + INTERVAL 12 DAY AS date)", "date"), ("points", "points", "CASE WHEN w.m < r.m THEN 'r' ELSE 'l' END", "string"), ("bonus_added", "bonus_added", "w.m + 1 < r.m OR w.m % 2 = 0", "boolean")]
_PAIRS = "runs r JOIN runs w ON w.y = r.y"
_ROUND = "runs r JOIN runs w ON w.y = r.y JOIN {supplier} s ON s_suppkey % 12 + 1 = w.m"


def _fact(i: int, c: str) -> str:
    """A number for the i-th measure of a fact."""
    return f"(o_orderkey + {i}) % {7 + i}"


_HISTORY = [
    ("element", "fpl_id", "o_custkey", "int"), ("fixture", "fixture_id", "o_orderkey", "int"), ("round", "gameweek", "m", "int"), ("opponent_team", "opponent_team_fpl_id", "o_orderkey % 25", "int"), ("was_home", "was_home", "o_orderkey % 2 = 0", "boolean"), ("kickoff_time", "kickoff_time", "o_orderdate", "timestamp"),
    ("team_h_score", "team_h_score", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 4 END", "int"), ("team_a_score", "team_a_score", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 3 END", "int"),
    *[(c, c, _fact(i, c), "int") for i, c in enumerate(staging.HISTORY_INTS)], *[(c, c, f"concat(cast(o_orderkey % {9 + i} AS string), '.5')", "double") for i, c in enumerate(staging.HISTORY_DOUBLES)], ("modified", "modified", "o_orderkey % 5 = 0", "boolean"),
]


def _world(tables: dict[str, str]) -> str:
    return "WITH " + ", ".join(f"{k} AS ({v.format(**tables)})" for k, v in WORLD.items())


def _spark(spark, sf_dir: str, sql: str) -> DataFrame:
    names = [t for t in ("orders", "supplier", "nation", "region") if "{" + t + "}" in sql or any("{" + t + "}" in v for v in WORLD.values())]
    return spark.sql(_world({t: "{" + t + "}" for t in names}) + " " + sql, **{t: read(spark, sf_dir, t) for t in names})


def _objects(spec: list[tuple]) -> str:
    return ", ".join(f"{sql} AS {field}" for field, _, sql, _ in spec)


def _part(of: str) -> str:
    return f"{of} DIV {PART}"


def _gathered(rows: DataFrame, *keys: str):
    """Rows grouped where they meet: a task that reads the tables has rows of very many keys, and would hold and sort all of them as lists."""
    return rows.repartition(*keys).groupBy(*keys)


def _arrays(spark, sf_dir: str, spec: list[tuple], rows: str, name: str, key: str = "r.run_id", by: str = "0") -> DataFrame:
    """One array of objects for each key and part of the ids ``by``."""
    each = _spark(spark, sf_dir, f"SELECT {key} AS k, {_part(by)} AS part, {_objects(spec)} FROM {rows}")
    return _gathered(each, "k", "part").agg(F.collect_list(F.struct(*[field for field, *_ in spec])).alias(name)).drop("part")


def _body(key, *fields: str):
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("body")


def world(spark, sf_dir: str) -> staging.Sources:
    """What a build reads, from the driver's tables."""
    players = _spark(spark, sf_dir, "SELECT run_id AS k, count(*) AS total_players FROM elements GROUP BY run_id")
    elements = _arrays(spark, sf_dir, _ELEMENT, "elements", "elements", "run_id", "o_custkey").join(F.broadcast(players), "k")
    boot = _arrays(spark, sf_dir, _EVENT, _PAIRS, "events").join(F.broadcast(players), "k")  # a row for each run
    for spec, table, name in ((_TEAM, "nation", "teams"), (_POSITION, "region", "element_types")):
        few = _spark(spark, sf_dir, f"SELECT 1 AS k, {_objects(spec)} FROM {{{table}}}").groupBy("k").agg(F.collect_list(F.struct(*[f for f, *_ in spec])).alias(name)).drop("k")
        boot = boot.crossJoin(F.broadcast(few))  # one row
    fixtures, status = _arrays(spark, sf_dir, _FIXTURE, _ROUND, "list", by="s_suppkey"), _arrays(spark, sf_dir, _STATUS, _PAIRS, "status")
    picks = _spark(spark, sf_dir, "SELECT concat('raw/fpl/entry-picks/', run_id, '/', cast(o_custkey AS string)) AS k, m, o_orderkey, o_totalprice, o_orderpriority FROM base")
    pick = F.struct(F.col("o_orderkey").alias("position"), (F.col("o_orderkey") % 600).alias("element"), (F.col("o_orderkey") % 3).alias("multiplier"), (F.col("o_orderkey") % 2 == 0).alias("is_captain"), (F.col("o_orderkey") % 2 == 1).alias("is_vice_captain"))
    most = F.max_by(F.col("o_orderpriority"), F.col("o_orderkey"))
    picks = _gathered(picks, "k").agg(
        F.struct(F.first("m").alias("event"), F.sum(F.col("o_orderkey") % 50).alias("points"), F.count(F.lit(1)).alias("event_transfers"), (F.count(F.lit(1)) * 4).alias("event_transfers_cost"), F.min(F.col("o_orderkey") % 9).alias("overall_rank")).alias("entry_history"),
        F.when(most == "1-URGENT", F.lit(None)).otherwise(most).alias("active_chip"), F.collect_list(pick).alias("picks"), F.collect_list(F.struct((F.col("o_orderkey") % 600).alias("element_out"), (F.col("o_orderkey") % 500).alias("element_in"))).alias("automatic_subs"),
    )
    past = _arrays(spark, sf_dir, _HISTORY, "base", "history", "concat('history/', cast(y AS string), '/fpl/element-summary/', cast(o_custkey AS string))")
    cap = "struct(capture_key AS key, endpoint, received_at, 'x' AS content_sha256, 1 AS content_length, 200 AS http_status, shape_ok, usable, season)"
    found = _gathered(_spark(spark, sf_dir, f"SELECT run_id, -1 AS part, {cap} AS c FROM live UNION ALL SELECT run_id, {_part('o_custkey')} AS part, {cap} AS c FROM picked"), "run_id", "part").agg(F.collect_list("c").alias("captures")).drop("part")
    runs = _spark(spark, sf_dir, "SELECT run_id, y, m, started_at, status, kind, ref FROM runs").join(found, "run_id").select(
        "run_id", F.col("started_at").cast("date").cast("string").alias("extraction_date"), F.col("started_at").cast("string").alias("started_at"), F.col("started_at").cast("string").alias("ended_at"), "status", F.lit("schedule").alias("trigger"), F.lit("2").alias("raw_contract_version"),
        F.struct(F.col("kind").alias("kind"), F.col("ref").alias("ref"), F.lit("w").alias("workflow"), F.lit("1").alias("github_run_id"), F.lit(None).cast("string").alias("aws_principal")).alias("origin"), "captures",
    )
    old = "struct(capture_key AS key, endpoint, received_at, 'y' AS content_sha256, 2 AS content_length, 200 AS http_status, shape_ok, usable, season, 'revalidated' AS shape_source, 'v1' AS validator_version)"
    catalog = _gathered(_spark(spark, sf_dir, f"SELECT run_id, 'history' AS scope, {_part('o_custkey')} AS part, {old} AS c FROM past"), "run_id", "scope", "part").agg(F.collect_list("c").alias("captures")).drop("part")
    panel = _gathered(_spark(spark, sf_dir, f"SELECT DISTINCT cast(y AS string) AS season, o_custkey AS entry_id, {_part('o_custkey')} AS part FROM base"), "season", "part").agg(F.collect_list(F.struct("entry_id", F.when(F.col("entry_id") % 3 == 0, "top").otherwise("rest").alias("cohort"))).alias("entries")).drop("part")
    markers = _spark(spark, sf_dir, "SELECT m AS event, 5 AS entries, CASE WHEN m = 12 THEN 'nowhere' ELSE run_id END AS run_id, started_at AS recorded_at FROM runs")

    def keyed(df, endpoint, *fields):
        return df.select(F.concat(F.lit(f"raw/fpl/{endpoint}/"), "k").alias("capture_key"), _body("k", *fields))

    payloads = {
        "bootstrap_static": keyed(elements, "bootstrap-static", "elements", "total_players").union(keyed(boot, "bootstrap-static", "events", "teams", "element_types", "total_players")), "event_status": keyed(status, "event-status", "status"),
        "fixtures": fixtures.select(F.concat(F.lit("raw/fpl/fixtures/"), "k").alias("capture_key"), F.to_json("list").alias("body")),
        "element_summary": past.select(F.col("k").alias("capture_key"), _body("k", "history")), "entry_picks": picks.select(F.col("k").alias("capture_key"), _body("k", "entry_history", "active_chip", "picks", "automatic_subs")),
    }
    return staging.Sources(runs, catalog, _spark(spark, sf_dir, "SELECT run_id, origin_kind FROM seeds"), payloads, panel, markers)


# --- the same in DuckDB ----------------------------------------------------------------------------------

_DUCK = {t: t for t in ("orders", "supplier", "nation", "region")}
_INDEX = """idx AS (SELECT capture_key, run_id, 'manifest' AS index_source, NULL::VARCHAR AS scope, endpoint, received_at, shape_ok, usable, season, NULL::VARCHAR AS shape_source FROM (SELECT * FROM live UNION ALL SELECT capture_key, run_id, endpoint, received_at, usable, shape_ok, season FROM picked)
    WHERE run_id IN (SELECT run_id FROM runs WHERE status <> 'IN_PROGRESS') UNION ALL SELECT capture_key, run_id, 'catalog', 'history', endpoint, received_at, shape_ok, usable, season, 'revalidated' FROM past),
    adm AS (SELECT i.*, r.started_at, CASE WHEN r.run_id IS NULL AND coalesce(s.origin_kind, '') <> 'history_port' THEN 'run_not_finalized' WHEN r.kind IS NULL AND s.origin_kind IS NULL THEN 'origin_unknown'
        WHEN r.kind IS NOT NULL AND coalesce(r.kind || ' ' || r.ref, '') <> 'ci refs/heads/main' THEN 'not_production' WHEN r.kind IS NULL AND s.origin_kind = 'local' THEN 'not_production' WHEN NOT coalesce(i.usable, false) THEN 'unusable' WHEN i.season IS NULL THEN 'null_season' END AS unadmitted_reason
        FROM idx i LEFT JOIN (SELECT * FROM runs WHERE status <> 'IN_PROGRESS') r ON r.run_id = i.run_id LEFT JOIN seeds s ON s.run_id = i.run_id),
    ok AS (SELECT capture_key, season, run_id, coalesce(started_at, received_at)::DATE AS extraction_date, date_trunc('second', coalesce(started_at, received_at))::TIMESTAMP AS extracted_at, received_at AS observed_at, endpoint, scope FROM adm WHERE unadmitted_reason IS NULL)"""
_CAP = "ok.capture_key, ok.season, ok.extraction_date, ok.run_id, ok.extracted_at, ok.observed_at"


def _sql(select: str, more: str = "") -> str:
    return f"{_world(_DUCK)}, {_INDEX}{', ' + more if more else ''} {select}"


def _values(spec: list[tuple]) -> str:
    def one(sql: str, name: str, kind: str) -> str:
        sql = f"nullif({sql}, '')" if name in ("news", "selected_by_percent") else sql
        return f"({sql})::{kind.replace('int', 'INTEGER') if kind == 'int' else kind} AS {name}"

    return ", ".join(one(sql, name, kind) for _, name, sql, kind in spec)


def _staged(spec: list[tuple], rows: str, endpoint: str, run: str = "r.run_id", more: str = "") -> str:
    return f"SELECT {_CAP}, {_values(spec)}{more} FROM {rows.format(**_DUCK)} JOIN ok ON ok.capture_key = concat('raw/fpl/{endpoint}/', {run})"


STAGED = {
    "player": _staged(_ELEMENT, "elements e", "bootstrap-static", "e.run_id", ", (SELECT count(*) FROM elements x WHERE x.run_id = e.run_id)::INTEGER AS total_players"),
    "team": _staged(_TEAM, "runs r CROSS JOIN nation", "bootstrap-static"), "position": _staged(_POSITION, "runs r CROSS JOIN region", "bootstrap-static"), "gameweek": _staged(_EVENT, _PAIRS, "bootstrap-static"), "fixture": _staged(_FIXTURE, _ROUND, "fixtures"), "gameweek_status": _staged(_STATUS, _PAIRS, "event-status"),
    "player_fixture": f"SELECT {_CAP}, {_values(_HISTORY)} FROM base JOIN ok ON ok.capture_key = concat('history/', y::VARCHAR, '/fpl/element-summary/', o_custkey::VARCHAR)",
    "picks_capture": "SELECT ok.capture_key, ok.season, ok.run_id, ok.observed_at, o_custkey::INTEGER AS entry_id, m::INTEGER AS gameweek, nullif(max_by(o_orderpriority, o_orderkey), '1-URGENT') AS active_chip, sum(o_orderkey % 50)::INTEGER AS points, count(*)::INTEGER AS event_transfers, (count(*) * 4)::INTEGER AS event_transfers_cost, min(o_orderkey % 9)::INTEGER AS overall_rank, count(*)::INTEGER AS pick_count FROM base JOIN ok ON ok.capture_key = concat('raw/fpl/entry-picks/', base.run_id, '/', o_custkey::VARCHAR) GROUP BY ALL",
    "picks": "SELECT ok.capture_key, ok.season, o_custkey::INTEGER AS entry_id, m::INTEGER AS gameweek, o_orderkey::INTEGER AS slot, (o_orderkey % 600)::INTEGER AS fpl_id, (o_orderkey % 3)::INTEGER AS multiplier, o_orderkey % 2 = 0 AS is_captain, o_orderkey % 2 = 1 AS is_vice_captain FROM base JOIN ok ON ok.capture_key = concat('raw/fpl/entry-picks/', base.run_id, '/', o_custkey::VARCHAR)",
    "settled": "SELECT p.season, r.m::INTEGER AS gameweek, 5 AS entries, CASE WHEN r.m = 12 THEN 'nowhere' ELSE r.run_id END AS run_id, r.started_at AS recorded_at FROM runs r LEFT JOIN (SELECT DISTINCT run_id, season, split_part(endpoint, '/', 3)::INTEGER AS gw FROM idx WHERE endpoint LIKE 'entry-picks/%') p ON p.run_id = CASE WHEN r.m = 12 THEN 'nowhere' ELSE r.run_id END AND p.gw = r.m",
    "panel": "SELECT DISTINCT y::VARCHAR AS season, o_custkey::INTEGER AS entry_id, CASE WHEN o_custkey % 3 = 0 THEN 'top' ELSE 'rest' END AS cohort FROM base",
}


def _with(*names: str) -> str:
    return ", ".join(f"{n} AS ({STAGED[n]})" for n in names)


def relation(name: str, sql: str):
    """Register a relation with its SQL."""

    def keep(f):
        QUERIES[name], ORACLE_SQL[name] = lambda spark, sf_dir: f(world(spark, sf_dir)), sql
        QUERIES[name].__doc__ = f.__doc__
        return f

    return keep


for _name, _attr in (("stg_player", "player"), ("stg_team", "team"), ("stg_position", "position"), ("stg_gameweek", "gameweek"), ("stg_fixture", "fixture"), ("stg_gameweek_status", "gameweek_status"), ("stg_player_fixture", "player_fixture")):
    relation(_name, _sql(STAGED[_attr]))(lambda s, a=_attr: getattr(s, a))
relation("stg_entry_picks", _sql(STAGED["picks"]))(lambda s: s.entry_picks)
relation("stg_entry_picks_settlement", _sql(STAGED["settled"]))(lambda s: s.settlement)
relation("stg_manager_panel", _sql(STAGED["panel"]))(lambda s: s.manager_panel)
relation("base_capture_index", _sql("SELECT capture_key, run_id, index_source, scope, endpoint, received_at, shape_ok, usable, season, shape_source FROM idx"))(lambda s: s.index.drop("content_sha256", "content_length", "http_status", "validator_version"))
relation("int_capture_admission", _sql("SELECT capture_key, run_id, season, unadmitted_reason IS NULL AS admitted, unadmitted_reason IS NULL AND coalesce(shape_source = 'revalidated', false) AND NOT shape_ok AS flagged_revalidation, unadmitted_reason FROM adm"))(lambda s: s.admission)
relation("int_admitted_capture", _sql("SELECT capture_key, season, run_id, extraction_date, extracted_at, observed_at, endpoint FROM ok"))(lambda s: s.admitted.drop("scope"))


@relation("stg_run", _sql("SELECT run_id, started_at::DATE AS extraction_date, started_at AS run_started_at, started_at AS run_ended_at, status, 'schedule' AS trigger, '2' AS raw_contract_version, kind AS origin_kind, ref AS origin_ref, 'w' AS origin_workflow, '1' AS origin_github_run_id, NULL::VARCHAR AS origin_aws_principal FROM runs WHERE status <> 'IN_PROGRESS'"))
def stg_run(s):
    """Finalised runs."""
    return s.run


@relation("stg_player_history_capture", _sql(f"SELECT {_CAP}, count(*)::INTEGER AS history_count, sum(o_orderkey)::BIGINT AS fixtures FROM base JOIN ok ON ok.capture_key = concat('history/', y::VARCHAR, '/fpl/element-summary/', o_custkey::VARCHAR) GROUP BY ALL"))
def stg_player_history_capture(s):
    """Captures with the length of their array, and the sum of a field of it."""
    return s.player_history_capture.withColumn("fixtures", F.aggregate("history", F.lit(0).cast("long"), lambda a, x: a + x["fixture"].cast("long"))).drop("history")


@relation("stg_entry_picks_capture", _sql(STAGED["picks_capture"]))
def stg_entry_picks_capture(s):
    """Captures of picks, their arrays left aside (see stg_entry_picks)."""
    return s.entry_picks_capture.drop("automatic_subs", "picks")


_NEW = "ORDER BY observed_at DESC, run_id DESC"
_TOP = "(SELECT season, max(struct_pack(o := observed_at, r := run_id)) AS c FROM {0} GROUP BY 1)"


@relation("int_player_season", _sql(f"SELECT season, fpl_id, player_code, web_name, position_id, run_id FROM player QUALIFY row_number() OVER (PARTITION BY season, fpl_id {_NEW}) = 1", _with("player")))
def int_player_season(s):
    """Each player's newest attributes in a season."""
    return served.player_season(s.player)


@relation("int_gameweek_status", _sql("SELECT season, gameweek, coalesce(bool_or(a), false) AS is_ratified FROM (SELECT season, gameweek, run_id, bool_and(points = 'r' AND bonus_added) AS a FROM gameweek_status GROUP BY ALL) GROUP BY ALL", _with("gameweek_status")))
def int_gameweek_status(s):
    """Periods that some capture shows as final on all days."""
    return served.gameweek_status(s.gameweek_status)


@relation("dim_team", _sql(f"SELECT t.season, team_fpl_id, team_code, team_name, team_short_name FROM team t JOIN {_TOP.format('team')} n ON n.season = t.season AND n.c = struct_pack(o := t.observed_at, r := t.run_id)", _with("team")))
def dim_team(s):
    """Teams of each season's newest capture."""
    return served.dim_team(s.team)


@relation("dim_player", _sql(f"SELECT p.season, p.fpl_id, p.player_code, p.web_name, p.position_id, x.position_short_name FROM (SELECT * FROM player QUALIFY row_number() OVER (PARTITION BY season, fpl_id {_NEW}) = 1) p LEFT JOIN position x ON x.season = p.season AND x.run_id = p.run_id AND x.position_id = p.position_id", _with("player", "position")))
def dim_player(s):
    """Players with their position's short name in the same capture."""
    return served.dim_player(served.player_season(s.player), s.position)


@relation("dim_fixture", _sql(f"""SELECT n.season, n.fixture_id, n.gameweek, n.kickoff_time, n.team_h_fpl_id, n.team_a_fpl_id, n.team_h_score, n.team_a_score, n.finished, d.team_h_difficulty, d.team_a_difficulty, d.before AS difficulty_is_pre_kickoff FROM n JOIN
    (SELECT f.*, n.kickoff_time IS NULL OR f.observed_at < n.kickoff_time AS before FROM fixture f JOIN n USING (season, fixture_id) QUALIFY row_number() OVER (PARTITION BY f.season, f.fixture_id ORDER BY before DESC, CASE WHEN before THEN f.observed_at END DESC NULLS LAST, CASE WHEN before THEN f.run_id END DESC NULLS LAST, f.observed_at, f.run_id) = 1) d USING (season, fixture_id)""", _with("fixture") + f", n AS (SELECT * FROM fixture QUALIFY row_number() OVER (PARTITION BY season, fixture_id {_NEW}) = 1)"))
def dim_fixture(s):
    """Fixtures with the difficulty known before kickoff."""
    return served.dim_fixture(s.fixture)


def _history_sql(of: str, key: str, fields: list[str], more: list[str]) -> str:
    row = "struct_pack(" + ", ".join(f"{f} := {f}" for f in fields) + ")"
    w = f"(PARTITION BY season, {key} ORDER BY observed_at, run_id)"
    opened = f"(SELECT * FROM (SELECT *, lag({row}) OVER w AS prev, row_number() OVER w AS n FROM {of} WINDOW w AS {w}) WHERE n = 1 OR prev IS DISTINCT FROM {row})"
    return f"SELECT season, {key}, observed_at AS valid_from, lead(observed_at) OVER {w} AS valid_to, {', '.join([*fields, *more])} FROM {opened}"


@relation("dim_player_status_history", _sql(_history_sql("player", "fpl_id", served.STATUS, ["news_added", "player_code", "capture_key"]), _with("player")))
def dim_player_status_history(s):
    """Openings of each player's status."""
    return served.player_status_history(s.player)


@relation("dim_fixture_schedule_history", _sql(_history_sql("fixture", "fixture_id", served.SCHEDULE, ["capture_key"]), _with("fixture")))
def dim_fixture_schedule_history(s):
    """Openings of each fixture's schedule."""
    return served.fixture_schedule_history(s.fixture)


@relation("fct_player_market_snapshot", _sql("SELECT season, fpl_id, capture_key, observed_at, now_cost, selected_by_percent, transfers_in_event, transfers_out_event FROM player", _with("player")))
def fct_player_market_snapshot(s):
    """Market values of every capture."""
    return served.fct_player_market_snapshot(s.player)


def _built(s: staging.Sources, name: str, settled: served.Settled = served.Settled(), **others: graph.Node) -> DataFrame:
    """A relation by a build of all that it is made of, each once; ``others`` take the place of the warehouse's relations of their names."""
    return graph.relation_of(s.manifests.sparkSession, warehouse.nodes(s, settled) | others, name)


@relation("dim_gameweek", _sql(f"""SELECT d.season, d.gameweek, d.deadline_time, CASE WHEN passed THEN before END AS last_capture_before_deadline_at, CASE WHEN passed THEN date_diff('second', before, d.deadline_time) END::INTEGER AS state_age_seconds, CASE WHEN s.is_ratified THEN d.ranked_count END AS ranked_count
    FROM (SELECT g.*, (SELECT max(observed_at) FROM gameweek c WHERE c.season = g.season) >= g.deadline_time AS passed, (SELECT max(observed_at) FROM gameweek c WHERE c.season = g.season AND c.observed_at < g.deadline_time) AS before FROM (SELECT * FROM gameweek QUALIFY row_number() OVER (PARTITION BY season, gameweek {_NEW}) = 1) g) d
    LEFT JOIN (SELECT season, gameweek, coalesce(bool_or(a), false) AS is_ratified FROM (SELECT season, gameweek, run_id, bool_and(points = 'r' AND bonus_added) AS a FROM gameweek_status GROUP BY ALL) GROUP BY ALL) s USING (season, gameweek)""", _with("gameweek", "gameweek_status")))
def dim_gameweek(s):
    """Periods with the last capture before their deadline."""
    return _built(s, "dim_gameweek")


_GRID = f"""win AS (SELECT * FROM picks_capture QUALIFY row_number() OVER (PARTITION BY season, entry_id, gameweek {_NEW}) = 1),
    joined AS (SELECT season, entry_id, min(gameweek) AS joined FROM win SEMI JOIN settled USING (season, gameweek) GROUP BY ALL),
    grid AS (SELECT p.season, p.entry_id, p.cohort, s.gameweek, CASE WHEN joined IS NULL OR s.gameweek < joined THEN 'not_yet_joined' WHEN capture_key IS NOT NULL THEN 'captured' ELSE 'missing_after_join' END AS status, CASE WHEN joined IS NOT NULL AND s.gameweek >= joined THEN capture_key END AS capture_key
        FROM panel p JOIN (SELECT DISTINCT season, gameweek FROM settled) s USING (season) LEFT JOIN joined USING (season, entry_id) LEFT JOIN win ON win.season = p.season AND win.entry_id = p.entry_id AND win.gameweek = s.gameweek)"""
_MANAGERS = _with("picks_capture", "settled", "panel", "picks") + ", " + _GRID


def _manager_grid(s):
    return served.manager_grid(s.manager_panel, s.settlement, s.entry_picks_capture)


@relation("int_manager_gameweek_status", _sql("SELECT season, entry_id, cohort, gameweek, status, capture_key FROM grid", _MANAGERS))
def int_manager_gameweek_status(s):
    """Managers by settled period."""
    return _manager_grid(s).select("season", "entry_id", "cohort", "gameweek", "status", "capture_key")


@relation("dim_manager_panel", _sql("SELECT p.season, p.entry_id, p.cohort, j.first_active_gw FROM panel p LEFT JOIN (SELECT season, entry_id, min(gameweek) AS first_active_gw FROM picks_capture SEMI JOIN settled USING (season, gameweek) GROUP BY ALL) j USING (season, entry_id)", _MANAGERS))
def dim_manager_panel(s):
    """The panel with each manager's first settled period."""
    return served.dim_manager_panel(s.manager_panel, s.settlement, s.entry_picks_capture)


@relation("fct_manager_gameweek", _sql("SELECT g.season, g.entry_id, g.gameweek, g.cohort, c.active_chip, c.event_transfers, c.event_transfers_cost, nullif(c.overall_rank, 0) AS overall_rank FROM grid g JOIN picks_capture c USING (capture_key) WHERE g.status = 'captured'", _MANAGERS))
def fct_manager_gameweek(s):
    """Captured periods of managers, their substitutions left aside (see fct_manager_pick)."""
    return served.fct_manager_gameweek(_manager_grid(s), s.entry_picks_capture).drop("automatic_subs")


@relation("fct_manager_pick", _sql("SELECT g.season, g.entry_id, g.gameweek, p.slot, p.fpl_id, p.is_captain, p.is_vice_captain, list_contains((SELECT list(x.slot % 500) FROM picks x WHERE x.capture_key = g.capture_key), p.fpl_id) AS is_auto_sub_in, list_contains((SELECT list(x.slot % 600) FROM picks x WHERE x.capture_key = g.capture_key), p.fpl_id) AS is_auto_sub_out FROM grid g JOIN picks p USING (capture_key) WHERE g.status = 'captured'", _MANAGERS))
def fct_manager_pick(s):
    """Picks with their part in the substitutions."""
    return _built(s, "fct_manager_pick")


_BEST = """kept AS (SELECT f.* FROM player_fixture f SEMI JOIN (SELECT f.season, f.fpl_id, f.fixture_id FROM player_fixture f JOIN (SELECT season, fpl_id, max(struct_pack(o := observed_at, r := run_id)) AS c FROM player_fixture GROUP BY ALL) n ON n.season = f.season AND n.fpl_id = f.fpl_id AND n.c = struct_pack(o := f.observed_at, r := f.run_id)) k USING (season, fpl_id, fixture_id)),
    best AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY season, fpl_id, fixture_id ORDER BY (team_h_score IS NOT NULL AND team_a_score IS NOT NULL) DESC, observed_at DESC, run_id DESC) = 1)"""


@relation("fct_player_fixture", _sql(f"SELECT {', '.join('b.' + c for c in served.FIXTURE_COLUMNS)}, s.is_ratified, CASE WHEN b.was_home THEN n.team_h_fpl_id ELSE n.team_a_fpl_id END AS team_fpl_id FROM best b LEFT JOIN (SELECT season, gameweek, coalesce(bool_or(a), false) AS is_ratified FROM (SELECT season, gameweek, run_id, bool_and(points = 'r' AND bonus_added) AS a FROM gameweek_status GROUP BY ALL) GROUP BY ALL) s USING (season, gameweek) LEFT JOIN (SELECT * FROM fixture QUALIFY row_number() OVER (PARTITION BY season, fixture_id {_NEW}) = 1) n ON n.season = b.season AND n.fixture_id = b.fixture_id", _with("player_fixture", "gameweek_status", "fixture") + ", " + _BEST))
def fct_player_fixture(s):
    """Facts of players by fixture."""
    final = served.gameweek_status(s.gameweek_status)
    out = served.fct_player_fixture(s.player_fixture, final, served.dim_fixture(s.fixture), served.Settled())
    # With no closed season and no fallback, what has no status stays open: null, as the join gives it.
    return out.withColumn("is_ratified", F.when(F.col("is_ratified"), True).otherwise(F.col("is_ratified")))


@relation("int_player_gameweek_spine", _sql(f"SELECT DISTINCT p.season, p.fpl_id, p.web_name, g.gameweek FROM (SELECT * FROM player QUALIFY row_number() OVER (PARTITION BY season, fpl_id {_NEW}) = 1) p JOIN (SELECT g.season, g.gameweek FROM gameweek g JOIN {_TOP.format('gameweek')} n ON n.season = g.season AND n.c = struct_pack(o := g.observed_at, r := g.run_id) WHERE g.finished) g USING (season)", _with("player", "gameweek")))
def int_player_gameweek_spine(s):
    """Players by finished period."""
    return served.player_gameweek_spine(served.player_season(s.player), s.gameweek)


_STATUS_NOW = "(SELECT season, gameweek, coalesce(bool_or(a), false) AS is_ratified FROM (SELECT season, gameweek, run_id, bool_and(points = 'r' AND bonus_added) AS a FROM gameweek_status GROUP BY ALL) GROUP BY ALL)"


def _measures() -> str:
    """SQL of the sums of a period and of the values of its last fixture that has one."""
    sums = [f"sum({c})::INTEGER AS {c}" for c in served.INTS] + [f"sum({c}::DECIMAL(18, 4))::DOUBLE AS {c}" for c in served.EXPECTED] + [f"round(sum({c}::DECIMAL(18, 4)), 1)::DOUBLE AS {c}" for c in served.INDICES]
    return ", ".join([*sums, *[f"arg_max({c}, struct_pack(k := kickoff_time, f := fixture_id)) FILTER ({c} IS NOT NULL AND kickoff_time IS NOT NULL) AS {c}" for c in served.MARKET]])


_WEEKS = f"""{_BEST}, facts AS (SELECT b.*, coalesce(s.is_ratified, false) AS is_ratified FROM best b LEFT JOIN {_STATUS_NOW} s USING (season, gameweek)),
    summed AS (SELECT season, fpl_id, gameweek, count(fixture_id)::INTEGER AS fixture_count, min(kickoff_time) AS first_kickoff_time, max(kickoff_time) AS last_kickoff_time, bool_and(is_ratified) AS is_ratified, {_measures()} FROM facts GROUP BY season, fpl_id, gameweek),
    spine AS (SELECT DISTINCT p.season, p.fpl_id, p.web_name, g.gameweek FROM (SELECT * FROM player QUALIFY row_number() OVER (PARTITION BY season, fpl_id {_NEW}) = 1) p JOIN (SELECT g.season, g.gameweek FROM gameweek g JOIN {_TOP.format('gameweek')} n ON n.season = g.season AND n.c = struct_pack(o := g.observed_at, r := g.run_id) WHERE g.finished) g USING (season)),
    moments AS (SELECT * FROM (SELECT season, gameweek, deadline_time FROM gameweek QUALIFY row_number() OVER (PARTITION BY season, gameweek {_NEW}) = 1) d WHERE (SELECT max(observed_at) FROM gameweek c WHERE c.season = d.season) >= d.deadline_time AND (SELECT min(observed_at) FROM gameweek c WHERE c.season = d.season) < d.deadline_time),
    teams_then AS ({_history_sql("player", "fpl_id", served.STATUS, [])}), schedule AS ({_history_sql("fixture", "fixture_id", served.SCHEDULE, [])}),
    planned AS (SELECT m.season, m.gameweek, unnest([x.team_h_fpl_id, x.team_a_fpl_id]) AS team FROM moments m JOIN schedule x ON x.season = m.season AND x.gameweek = m.gameweek AND x.valid_from < m.deadline_time AND (x.valid_to IS NULL OR x.valid_to >= m.deadline_time)),
    asked AS (SELECT s.season, s.fpl_id, s.gameweek, t.team_fpl_id FROM spine s JOIN moments m USING (season, gameweek) JOIN (SELECT season, min(valid_from) AS first FROM schedule GROUP BY 1) z ON z.season = s.season AND z.first < m.deadline_time LEFT JOIN teams_then t ON t.season = s.season AND t.fpl_id = s.fpl_id AND t.valid_from < m.deadline_time AND (t.valid_to IS NULL OR t.valid_to >= m.deadline_time)),
    weeks AS (SELECT s.season, s.fpl_id, s.gameweek, s.web_name, coalesce(f.fixture_count, 0) AS fixture_count, f.* EXCLUDE (season, fpl_id, gameweek, fixture_count), CASE WHEN a.team_fpl_id IS NOT NULL THEN (SELECT count(*) FROM planned n WHERE n.season = a.season AND n.gameweek = a.gameweek AND n.team = a.team_fpl_id)::INTEGER END AS fixture_count_at_deadline
        FROM spine s LEFT JOIN summed f ON f.season = s.season AND f.fpl_id = s.fpl_id AND f.gameweek = s.gameweek LEFT JOIN asked a ON a.season = s.season AND a.fpl_id = s.fpl_id AND a.gameweek = s.gameweek)"""


@relation("fct_player_gameweek", _sql("SELECT * FROM weeks", _with("player", "gameweek", "gameweek_status", "fixture", "player_fixture") + ", " + _WEEKS))
def fct_player_gameweek(s):
    """Players by finished period, with the fixtures that their team had at the deadline."""
    return _built(s, "fct_player_gameweek")


@relation("int_manager_gameweek_points", _sql("SELECT g.season, g.entry_id, g.gameweek, c.active_chip, c.points AS fpl_points, sum(p.multiplier * coalesce(w.total_points, 0))::BIGINT AS rebuilt_points FROM grid g JOIN picks_capture c USING (capture_key) JOIN picks p USING (capture_key) LEFT JOIN weeks w ON w.season = g.season AND w.gameweek = g.gameweek AND w.fpl_id = p.fpl_id WHERE g.status = 'captured' GROUP BY ALL", _MANAGERS + ", " + _with("player", "gameweek", "gameweek_status", "fixture", "player_fixture") + ", " + _WEEKS))
def int_manager_gameweek_points(s):
    """The publisher's points of managers beside those rebuilt from their picks."""
    return _built(s, "int_manager_gameweek_points")


@relation("int_player_fixture_history_mismatch", _sql("SELECT NULL::VARCHAR AS season, NULL::VARCHAR AS run_id, NULL::VARCHAR AS capture_key, NULL::TIMESTAMP AS observed_at, 0 AS expected_rows, 0::BIGINT AS staged_rows WHERE false"))
def int_player_fixture_history_mismatch(s):
    """Captures whose array isn't as long as their staged rows are many: none."""
    return served.history_mismatch(s.player_history_capture, s.player_fixture)


@relation("int_unstaged_admitted_capture", _sql("SELECT split_part(endpoint, '/', 1) AS endpoint, season, run_id, capture_key, observed_at, CASE WHEN endpoint = 'fixtures' THEN 'warn' ELSE 'error' END AS severity FROM ok WHERE endpoint IN ('event-status', 'fixtures')"))
def int_unstaged_admitted_capture(s):
    """Admitted captures without staged rows, were two endpoints not staged."""
    def unstaged(admitted, team, position, picks, history):
        staged = {"bootstrap-static": [team, position], "entry-picks": [picks], "element-summary": [history], "fixtures": [], "event-status": []}
        return checks.unstaged_by_endpoint(admitted, staged, {"fixtures": "warn"})

    return _built(s, "int_unstaged_admitted_capture", int_unstaged_admitted_capture=graph.Node(unstaged, ("admitted", "team", "position", "entry_picks_capture", "player_history_capture")))


@relation("int_endpoint_freshness", _sql("SELECT e.endpoint, newest, round(epoch_us(TIMESTAMP '2001-08-01 00:00:00' - newest) / 3600000000.0, 1)::DOUBLE AS age_hours, CASE WHEN e.endpoint = 'element-summary' THEN 'exempt' WHEN newest IS NULL OR epoch_us(TIMESTAMP '2001-08-01 00:00:00' - newest) > 64800000000 THEN 'error' WHEN epoch_us(TIMESTAMP '2001-08-01 00:00:00' - newest) > 21600000000 THEN 'warn' ELSE 'ok' END AS status FROM (VALUES ('bootstrap-static'), ('fixtures'), ('event-status'), ('element-summary'), ('gone')) e(endpoint) LEFT JOIN (SELECT split_part(endpoint, '/', 1) AS endpoint, max(observed_at) AS newest FROM ok WHERE scope IS DISTINCT FROM 'history' GROUP BY 1) n USING (endpoint)"))
def int_endpoint_freshness(s):
    """Age of each endpoint's newest live capture at a fixed moment."""
    live = s.admitted.filter(~F.col("scope").eqNullSafe("history")).select(F.split_part("endpoint", F.lit("/"), F.lit(1)).alias("endpoint"), F.col("observed_at").alias("received_at"))
    ends = s.admitted.sparkSession.createDataFrame([(e, e == "element-summary") for e in ("bootstrap-static", "fixtures", "event-status", "element-summary", "gone")], "endpoint string, exempt boolean")
    return checks.freshness(ends, live, F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")).select("endpoint", "newest", "age_hours", "status")


_LAST = "(SELECT split_part(endpoint, '/', 1) AS e, arg_max(run_id, struct_pack(o := observed_at, r := run_id)) AS run_id FROM ok WHERE starts_with(capture_key, 'raw/') GROUP BY 1)"
# Each source with its endpoint and the keys to look for. The last key of two sources isn't there.
PRESENCE = {
    "bootstrap_static": ("bootstrap-static", {"total_players": {}, "elements.id": {"record_path": "$.elements[*]"}, "elements.gone": {"record_path": "$.elements[*]"}, "elements.old": {"record_path": "$.elements[*]", "presence_exempt": "left by design"}}),
    "entry_picks": ("entry-picks", {"picks.position": {"record_path": "$.picks[*]"}, "entry_history.points": {"record_path": "$.entry_history"}, "entry_history.gone": {"record_path": "$.entry_history"}}),
}


@relation("int_source_key_presence", _sql(f"""SELECT source_name, column_name, run_id, captures, records, CASE WHEN ends_with(column_name, 'gone') THEN records ELSE 0 END::BIGINT AS missing FROM (SELECT t.s AS source_name, t.c AS column_name, l.run_id, x.captures, CASE t.k WHEN 'one' THEN x.captures WHEN 'elements' THEN (SELECT count(*) FROM elements WHERE elements.run_id = l.run_id) ELSE (SELECT count(*) FROM base WHERE base.run_id = l.run_id) END::BIGINT AS records
    FROM (VALUES ('bootstrap_static', 'bootstrap-static', 'total_players', 'one'), ('bootstrap_static', 'bootstrap-static', 'elements.id', 'elements'), ('bootstrap_static', 'bootstrap-static', 'elements.gone', 'elements'), ('entry_picks', 'entry-picks', 'picks.position', 'base'), ('entry_picks', 'entry-picks', 'entry_history.points', 'one'), ('entry_picks', 'entry-picks', 'entry_history.gone', 'one')) t(s, e, c, k)
    JOIN {_LAST} l ON l.e = t.e JOIN (SELECT run_id, split_part(endpoint, '/', 1) AS e, count(*) AS captures FROM ok GROUP BY 1, 2) x ON x.run_id = l.run_id AND x.e = t.e)"""))
def int_source_key_presence(s):
    """Records of each source's newest live run with and without the keys that staging reads."""
    out = None
    for source, (endpoint, columns) in PRESENCE.items():
        objects = s.payloads[source].withColumnRenamed("body", "json")
        got = presence.source_key_presence(source, presence.consumed_key_specs(columns), presence.latest_live_run(s.admitted, endpoint, objects), objects)
        out = got if out is None else out.unionByName(got)
    return out


@relation("publish_expected_rows", _sql("""SELECT t.n AS table_name, season, (CASE WHEN t.n IN ('fct_player_fixture', 'fct_player_gameweek') THEN coalesce(p, 0) * coalesce(w, 0) WHEN t.n = 'dim_team' THEN 20 WHEN t.n = 'dim_fixture' THEN 380 WHEN t.n = 'fct_player_market_snapshot' THEN coalesce(c, 0) WHEN t.n = 'dim_fixture_schedule_history' THEN coalesce(f, 0) WHEN t.n = 'fct_manager_gameweek' THEN coalesce(mg, 0) WHEN t.n = 'fct_manager_pick' THEN 15 * coalesce(mg, 0) ELSE coalesce(p, 0) END)::BIGINT AS expected
    FROM (SELECT season FROM player UNION SELECT season FROM team UNION SELECT season FROM position UNION SELECT season FROM gameweek UNION SELECT season FROM fixture UNION SELECT season FROM gameweek_status UNION SELECT season FROM player_fixture) q LEFT JOIN pl USING (season) LEFT JOIN gw USING (season) LEFT JOIN fx USING (season) LEFT JOIN mn USING (season)
    CROSS JOIN (VALUES ('fct_player_fixture'), ('fct_player_gameweek'), ('dim_team'), ('dim_player'), ('dim_fixture'), ('dim_player_status_history'), ('fct_player_market_snapshot'), ('dim_fixture_schedule_history'), ('fct_manager_gameweek'), ('fct_manager_pick')) t(n)
    UNION ALL SELECT 'dim_gameweek', season, 38 FROM (SELECT DISTINCT season FROM ok WHERE endpoint = 'bootstrap-static')""",
    _with("player", "team", "position", "gameweek", "fixture", "gameweek_status", "player_fixture", "picks_capture", "settled", "panel") + """, pl AS (SELECT season, count(DISTINCT fpl_id) AS p, count(*) AS c FROM player GROUP BY 1),
    gw AS (SELECT g.season, count(*) FILTER (WHERE g.season <> '1998' OR g.finished) AS w FROM gameweek g JOIN (SELECT season, arg_max(run_id, struct_pack(o := observed_at, r := run_id)) AS r FROM gameweek GROUP BY 1) l ON l.season = g.season AND l.r = g.run_id GROUP BY 1),
    fx AS (SELECT season, count(DISTINCT fixture_id) AS f FROM fixture GROUP BY 1), jw AS (SELECT season, entry_id, min(gameweek) AS fw FROM picks_capture JOIN settled USING (season, gameweek) GROUP BY ALL),
    mn AS (SELECT s.season, count(*) AS mg FROM settled s JOIN panel USING (season) JOIN jw USING (season, entry_id) WHERE jw.fw <= s.gameweek GROUP BY 1)"""))
def publish_expected_rows(s):
    """Rows that each served table should have by season, with one season live."""
    return expectations.expected_rows(s, "1998")


# --- whole builds, gaps and settlement ----------------------------------------------------------------

_GAPS = f"""have AS (SELECT *, split_part(endpoint, '/', 1) AS e FROM ok WHERE starts_with(capture_key, 'raw/')),
    present AS (SELECT * FROM have WHERE (e = 'bootstrap-static' AND NOT contains(capture_key, '/r1998')) OR (e = 'entry-picks' AND split_part(capture_key, '/', 5)::INTEGER % 3 <> 0)),
    chosen AS (SELECT e, arg_max(run_id, struct_pack(o := observed_at, r := run_id)) AS run_id FROM present GROUP BY 1), newest AS {_LAST},
    gap AS (SELECT n.e, max(h.run_id) AS latest_run_id, count(h.run_id) AS missing FROM newest n LEFT JOIN (SELECT * FROM have ANTI JOIN present USING (capture_key)) h ON h.e = n.e AND h.run_id = n.run_id GROUP BY 1),
    gaps AS (SELECT t.s AS source_name, t.c AS column_name, c.run_id, x.captures, CASE t.k WHEN 'one' THEN x.captures WHEN 'elements' THEN (SELECT count(*) FROM elements WHERE elements.run_id = c.run_id) ELSE (SELECT count(*) FROM base WHERE base.run_id = c.run_id AND o_custkey % 3 <> 0) END::BIGINT AS records, g.latest_run_id, g.missing::BIGINT AS latest_run_missing_bytes
        FROM (VALUES ('bootstrap_static', 'bootstrap-static', 'total_players', 'one'), ('bootstrap_static', 'bootstrap-static', 'elements.id', 'elements'), ('bootstrap_static', 'bootstrap-static', 'elements.gone', 'elements'), ('entry_picks', 'entry-picks', 'picks.position', 'base'), ('entry_picks', 'entry-picks', 'entry_history.points', 'one'), ('entry_picks', 'entry-picks', 'entry_history.gone', 'one')) t(s, e, c, k)
        JOIN chosen c ON c.e = t.e JOIN (SELECT run_id, e, count(*) AS captures FROM present GROUP BY 1, 2) x ON x.run_id = c.run_id AND x.e = t.e JOIN gap g ON g.e = t.e)"""


def _gaps(s: staging.Sources) -> DataFrame:
    """Presence where payloads are missing: all of a year's bootstraps, and a third of the picks."""
    lost = {"bootstrap_static": F.contains("capture_key", F.lit("/r1998")), "entry_picks": F.split_part("capture_key", F.lit("/"), F.lit(5)).cast("int") % 3 == 0}
    nodes = {"admitted": graph.Node(lambda: s.admitted)} | {source: graph.Node(lambda source=source: s.payloads[source].filter(~lost[source]).withColumnRenamed("body", "json"), kept=True) for source in PRESENCE}
    nodes["gaps"] = graph.Node(lambda admitted, *objects: reduce(DataFrame.unionByName, [
        presence.source_presence(source, presence.consumed_key_specs(columns), admitted, endpoint, o) for (source, (endpoint, columns)), o in zip(PRESENCE.items(), objects, strict=True)
    ]), ("admitted", *PRESENCE))
    return graph.relation_of(s.manifests.sparkSession, nodes, "gaps")


@relation("source_presence_gaps", _sql("SELECT source_name, column_name, run_id, captures, records, CASE WHEN ends_with(column_name, 'gone') THEN records ELSE 0 END::BIGINT AS missing, latest_run_id, latest_run_missing_bytes FROM gaps", _GAPS))
def source_presence_gaps(s):
    """Key presence in the newest captures that have a payload, beside the newest run's captures without one."""
    return _gaps(s)


@relation("source_presence_findings", _sql(f"""SELECT source_name, column_name, run_id, captures, records, records AS missing, '{presence.REMOVED}' AS finding FROM gaps WHERE ends_with(column_name, 'gone') AND records > 0
    UNION ALL SELECT DISTINCT source_name, NULL, latest_run_id, 0, 0, latest_run_missing_bytes, '{presence.NO_PAYLOAD}' FROM gaps WHERE latest_run_missing_bytes > 0""", _GAPS))
def source_presence_findings(s):
    """What a build would say of the gaps, removed keys and partial ones together."""
    p = _gaps(s)
    return presence.source_findings(p, "removed").union(presence.source_findings(p, "partial"))


@relation("consumed_key_findings", _sql(f"""SELECT t.c AS column_name, l.run_id, (SELECT count(*) FROM ok WHERE ok.run_id = l.run_id AND endpoint = 'bootstrap-static') AS captures, (SELECT count(*) FROM elements WHERE elements.run_id = l.run_id) AS records, (SELECT count(*) FROM elements WHERE elements.run_id = l.run_id) AS missing, '{presence.REMOVED}' AS finding
    FROM (VALUES ('elements.gone')) t(c), {_LAST} l WHERE l.e = 'bootstrap-static'"""))
def consumed_key_findings(s):
    """Keys that no player of the newest bootstrap has, presence and findings in one."""
    objects = s.payloads["bootstrap_static"].withColumnRenamed("body", "json")
    specs = presence.consumed_key_specs(PRESENCE["bootstrap_static"][1])
    return presence.consumed_key_findings("bootstrap_static", specs, presence.latest_live_run(s.admitted, "bootstrap-static", objects), objects, "removed").drop("source_name")


SETTLED = served.Settled(("1995",), "1996", datetime.datetime(1996, 6, 1))


@relation("fct_player_fixture_settled", _sql("""SELECT b.season, b.fpl_id, b.fixture_id, CASE WHEN b.season = '1995' THEN true ELSE coalesce(s.is_ratified, b.season = '1996' AND b.kickoff_time < TIMESTAMP '1996-06-01' AND b.team_h_score IS NOT NULL AND b.team_a_score IS NOT NULL) END AS is_ratified
    FROM best b LEFT JOIN """ + _STATUS_NOW + """ s USING (season, gameweek)""", _with("player_fixture", "gameweek_status", "fixture") + ", " + _BEST))
def fct_player_fixture_settled(s):
    """Facts ratified by a closed season, a status capture or, where status captures hadn't begun, a date."""
    return _built(s, "fct_player_fixture", SETTLED).select("season", "fpl_id", "fixture_id", "is_ratified")


@relation("dim_gameweek_settled", _sql(f"""SELECT d.season, d.gameweek, CASE WHEN s.is_ratified OR (s.season IS NULL AND d.season = '1996' AND d.deadline_time < TIMESTAMP '1996-06-01') THEN d.ranked_count END AS ranked_count
    FROM (SELECT * FROM gameweek QUALIFY row_number() OVER (PARTITION BY season, gameweek {_NEW}) = 1) d LEFT JOIN (SELECT * FROM {_STATUS_NOW} WHERE gameweek > 3) s USING (season, gameweek)""", _with("gameweek", "gameweek_status")))
def dim_gameweek_settled(s):
    """Ranked counts of periods, of those without a status capture by a date; the first three periods of each season have none."""
    late = graph.Node(lambda status: served.gameweek_status(status).filter("gameweek > 3"), ("gameweek_status",))
    return _built(s, "dim_gameweek", SETTLED, int_gameweek_status=late).select("season", "gameweek", "ranked_count")


@relation("player_history_mismatch_found", _sql("SELECT season, run_id, capture_key, observed_at, count(*)::INTEGER AS expected_rows, count(*) FILTER (fixture_id % 13 <> 0) AS staged_rows FROM player_fixture GROUP BY ALL HAVING count(*) FILTER (fixture_id % 13 = 0) > 0", _with("player_fixture")))
def player_history_mismatch_found(s):
    """Captures found out when staging loses some of their facts."""
    return served.history_mismatch(s.player_history_capture, s.player_fixture.filter("fixture_id % 13 <> 0"))


@relation("player_status_as_of", _sql(f"""SELECT a.season, a.fpl_id, a.as_of_time, {', '.join('h.' + c for c in asof.STATUS_COLUMNS)} FROM (SELECT season, fpl_id, kickoff_time + INTERVAL 3 DAY AS as_of_time FROM player_fixture) a
    LEFT JOIN ({_history_sql("player", "fpl_id", served.STATUS, [])}) h ON h.season = a.season AND h.fpl_id = a.fpl_id AND h.valid_from < a.as_of_time AND (h.valid_to IS NULL OR h.valid_to >= a.as_of_time)""", _with("player", "player_fixture")))
def player_status_as_of(s):
    """The status that was in force three days after each fact."""
    asked = s.player_fixture.select("season", "fpl_id", (F.col("kickoff_time") + F.expr("INTERVAL 3 DAYS")).alias("as_of_time"))
    return asof.player_status_as_of(asked, served.player_status_history(s.player))


# No live capture has facts, and the schedule's JSON leaves null fields out: two warnings.
_CHECKED = {name: "warned" if name in ("keys_partial:element_summary", "keys_partial:fixtures") else "passed" for name in warehouse.standing_checks()}


@relation("warehouse_build", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS name, 'built' AS status, (SELECT count(*) FROM ({ORACLE_SQL[t]})) AS n_rows" for t in warehouse.SERVED) + ") UNION ALL SELECT name, status, NULL FROM (VALUES " + ", ".join(f"('{n}', '{st}')" for n, st in _CHECKED.items()) + ") c(name, status)")
def warehouse_build(s):
    """One build of the whole warehouse with its standing checks: what was built, with its rows, and how the checks went."""
    return warehouse.report(s)
