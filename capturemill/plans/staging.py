"""The staged relations: declared records of admitted captures, typed.

``Sources`` holds what a build reads: run manifests, the backfill catalog, seeded origins and the payloads by capture key. A payload
relation has ``capture_key, body`` (JSON text), whether read from files or at hand. Identity comes from the index; a path only gives the key.

A capture that is too large for one text may come in parts: texts of one key that share its arrays' items among them, each whole JSON with the fields of the
root that go with its items. Manifests, catalog and panels may come in parts too, each with the run's or season's fields and some of its array.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capturemill.functions.scalars import capture_key
from capturemill.operators.captures import admit
from capturemill.sources.declared import capture_index, cast_columns, declared_records, parsed
from capturemill.sources.files import Files
from capturemill.sources.places import Reading

# The staged columns by relation, as the payload's name, the column's name and its type.
PLAYER = "id fpl_id int, web_name web_name string, code player_code int, element_type position_id int, total_points total_points int, team team_fpl_id int, status status string, chance_of_playing_this_round chance_of_playing_this_round int, chance_of_playing_next_round chance_of_playing_next_round int, news news string, news_added news_added timestamp_ntz, can_select can_select boolean, removed removed boolean, now_cost now_cost int, selected_by_percent selected_by_percent decimal(4;1), transfers_in_event transfers_in_event int, transfers_out_event transfers_out_event int"
TEAM = "id team_fpl_id int, code team_code int, name team_name string, short_name team_short_name string, strength strength int"
POSITION = "id position_id int, singular_name position_name string, singular_name_short position_short_name string"
GAMEWEEK = "id gameweek int, deadline_time deadline_time timestamp_ntz, finished finished boolean, data_checked data_checked boolean, is_current is_current boolean, ranked_count ranked_count int"
FIXTURE = "id fixture_id int, event gameweek int, kickoff_time kickoff_time timestamp_ntz, team_h team_h_fpl_id int, team_a team_a_fpl_id int, team_h_score team_h_score int, team_a_score team_a_score int, finished finished boolean, team_h_difficulty team_h_difficulty int, team_a_difficulty team_a_difficulty int"
STATUS = "event gameweek int, date match_date date, points points string, bonus_added bonus_added boolean"
HISTORY_KEYS = "element fpl_id int, fixture fixture_id int, round gameweek int, opponent_team opponent_team_fpl_id int, was_home was_home boolean, kickoff_time kickoff_time timestamp_ntz, team_h_score team_h_score int, team_a_score team_a_score int"
HISTORY_INTS = "minutes starts total_points bonus bps goals_scored assists clean_sheets goals_conceded own_goals penalties_saved penalties_missed yellow_cards red_cards saves clearances_blocks_interceptions recoveries tackles defensive_contribution value selected transfers_in transfers_out transfers_balance".split()
HISTORY_DOUBLES = "expected_goals expected_assists expected_goal_involvements expected_goals_conceded influence creativity threat ict_index".split()
PICK = "position slot int, element fpl_id int, multiplier multiplier int, is_captain is_captain boolean, is_vice_captain is_vice_captain boolean"
SUBSTITUTION = "element_out fpl_id_out int, element_in fpl_id_in int"
ENTRY = "event gameweek int, points points int, event_transfers event_transfers int, event_transfers_cost event_transfers_cost int, overall_rank overall_rank int"
BOOTSTRAP = {"elements": PLAYER, "events": GAMEWEEK, "teams": TEAM, "element_types": POSITION}
CAPTURE = ["capture_key", "season", "extraction_date", "run_id", "extracted_at", "observed_at"]


def _spec(text: str) -> list[tuple[str, str, str]]:
    return [tuple(x.strip().replace(";", ",").split(" ", 2)) for x in text.split(",")]


HISTORY = [*_spec(HISTORY_KEYS), *[(c, c, "int") for c in HISTORY_INTS], *[(c, c, "double") for c in HISTORY_DOUBLES], ("modified", "modified", "boolean")]


def consumed() -> dict[str, tuple[str, dict[str, dict]]]:
    """Each payload's endpoint, and the declared columns with the place of their records, by the names that staging reads."""

    def at(text_or_spec, path, prefix=""):
        spec = _spec(text_or_spec) if isinstance(text_or_spec, str) else text_or_spec
        return {prefix + field: {"record_path": path} for field, _, _ in spec}

    boot = {"total_players": {}}
    for array, text in BOOTSTRAP.items():
        boot |= at(text, f"$.{array}[*]", f"{array}.")
    picks = {"active_chip": {}} | at(ENTRY, "$.entry_history", "entry_history.") | at(PICK, "$.picks[*]", "picks.") | at(SUBSTITUTION, "$.automatic_subs[*]", "automatic_subs.")
    return {
        "bootstrap_static": ("bootstrap-static", boot), "fixtures": ("fixtures", at(FIXTURE, "$[*]")), "event_status": ("event-status", at(STATUS, "$.status[*]", "status.")),
        "element_summary": ("element-summary", at(HISTORY, "$.history[*]", "history.")), "entry_picks": ("entry-picks", picks),
    }


def _leaves(spec: list[tuple[str, str, str]]) -> dict:
    return {field: None for field, _, _ in spec}


def _typed(records: DataFrame, spec: list[tuple[str, str, str]], keep: list[str]) -> DataFrame:
    named = records.select(*keep, *[F.col(f"`{field}`").alias(name) for field, name, _ in spec])
    return cast_columns(named, {name: kind for _, name, kind in spec if kind != "string"})


def _struct(x: Column, text: str) -> Column:
    return F.struct(*[x[field].cast(kind).alias(name) for field, name, kind in _spec(text)])


def payloads_from_files(spark: SparkSession, paths: list[str], root: str) -> DataFrame:
    """``capture_key, body`` of payload files, whole, by their places below ``root``."""
    return spark.read.text(paths, wholetext=True).select(capture_key(F.col("_metadata.file_path"), root).alias("capture_key"), F.col("value").alias("body"))


# The schemas of manifests, catalog, markers and panels.
_CAPTURES = "array<struct<key: string, endpoint: string, received_at: string, content_sha256: string, content_length: bigint, http_status: int, shape_ok: boolean, usable: boolean, season: string{more}>>"
MANIFESTS = "raw_contract_version string, run_id string, extraction_date string, status string, started_at string, ended_at string, trigger string, origin struct<kind: string, workflow: string, ref: string, github_run_id: string, aws_principal: string>, captures " + _CAPTURES.format(more="")
CATALOG = "run_id string, scope string, captures " + _CAPTURES.format(more=", shape_source: string, validator_version: string")
MARKERS = "event int, entries int, run_id string, recorded_at string"
PANEL = "season string, entries array<struct<entry_id: bigint, cohort: string>>"


def declarations() -> dict[str, dict]:
    """What is read of each source's payloads, as a whole capture."""
    return {
        "bootstrap_static": {a: [_leaves(_spec(t))] for a, t in BOOTSTRAP.items()} | {"total_players": None}, "fixtures": _leaves(_spec(FIXTURE)), "event_status": {"status": [_leaves(_spec(STATUS))]}, "element_summary": {"history": [_leaves(HISTORY)]},
        "entry_picks": {"active_chip": None, "entry_history": _leaves(_spec(ENTRY)), "automatic_subs": [_leaves(_spec(SUBSTITUTION))], "picks": [_leaves(_spec(PICK))]},
    }


def sources_from_files(spark: SparkSession, reading: Reading, seeds: DataFrame) -> Sources:
    """What a build reads, from the trees of ``reading``: manifests, catalog, markers and panels below ``<raw>/fpl``, payloads as ``reading`` says. Unreadable manifests fail the build."""
    top, files = reading.roots.raw.rstrip("/") + "/fpl", Files(spark)

    def small(pattern: str, schema: str) -> DataFrame:
        if not files.names(f"{top}/{pattern}"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(f"{top}/{pattern}")

    records, payloads = {}, {}
    for source, fields in declarations().items():
        records[source] = reading.captures(spark, source, fields).drop("path")
        payloads[source] = payloads_from_files(spark, reading.globs(spark, source), "fpl")
    return Sources(small("_manifests/*/*/manifest.json", MANIFESTS), small("_catalog/backfill/*.json", CATALOG), seeds, payloads, small("_panels/*/*.json", PANEL), small("_settlement/entry-picks/*/marker.json", MARKERS), records)


def stg_run(manifests: DataFrame) -> DataFrame:
    """Finalised runs with their origin laid flat, each once in however many parts its manifest comes."""
    m = manifests.filter("status <> 'IN_PROGRESS'")
    return m.select(
        "run_id", F.col("extraction_date").cast("date").alias("extraction_date"), F.col("started_at").cast("timestamp_ntz").alias("run_started_at"), F.col("ended_at").cast("timestamp_ntz").alias("run_ended_at"),
        "status", "trigger", "raw_contract_version", *[F.col(f"origin.{c}").alias(f"origin_{c}") for c in ("kind", "ref", "workflow", "github_run_id", "aws_principal")],
    ).distinct()


@dataclass
class Sources:
    """What a build reads, and the staged relations made of it."""

    manifests: DataFrame
    catalog: DataFrame
    seeds: DataFrame
    payloads: dict[str, DataFrame]
    panel: DataFrame
    markers: DataFrame
    #: Sources whose declared columns are read already (capture_key and the columns), such as from compacted parts; their payloads aren't needed.
    records: dict[str, DataFrame] = field(default_factory=dict)

    @cached_property
    def index(self) -> DataFrame:
        return capture_index(self.manifests, self.catalog)

    @cached_property
    def run(self) -> DataFrame:
        return stg_run(self.manifests)

    def _marked(self, *more: str) -> DataFrame:
        """The index with each capture's admission. Runs and seeds have a row for each run and are broadcast, so that no task gets all captures of a run."""
        kept = ["capture_key", "run_id", "season", "usable", "shape_ok", "shape_source", *more]
        return admit(self.index.select(*kept), F.broadcast(self.run), F.broadcast(self.seeds))

    @cached_property
    def admission(self) -> DataFrame:
        return self._marked().select("capture_key", "run_id", "season", "admitted", "flagged_revalidation", "unadmitted_reason")

    @cached_property
    def admitted(self) -> DataFrame:
        """Admitted captures with the day and the second of their run, or of the capture itself, by one pass over the index."""
        runs = self.run.select("run_id", F.col("extraction_date").alias("_day"), F.col("run_started_at").alias("_started"))
        j = self._marked("received_at", "endpoint", "scope").filter("admitted").join(F.broadcast(runs), "run_id", "left")
        return j.select(
            "capture_key", "season", "run_id", F.coalesce("_day", F.col("received_at").cast("date")).alias("extraction_date"),
            F.date_trunc("second", F.coalesce("_started", "received_at")).cast("timestamp_ntz").alias("extracted_at"), F.col("received_at").alias("observed_at"), "endpoint", "scope",
        )

    def _staged(self, source: str, fields: dict, path: str, *more: str) -> DataFrame:
        got = declared_records(self.records[source], fields, path, ["capture_key"]) if source in self.records else parsed(self.payloads[source], fields, path)
        return got.join(self.admitted.select(*CAPTURE, *more), "capture_key")

    def preset(self, **made: DataFrame) -> Sources:
        """The same sources with some of their relations given, such as tables of a build; payloads by ``payload_<source>``, read records by ``records_<source>``."""
        payloads = {k.removeprefix("payload_"): made.pop(k) for k in list(made) if k.startswith("payload_")}
        records = {k.removeprefix("records_"): made.pop(k) for k in list(made) if k.startswith("records_")}
        out = replace(self, payloads=self.payloads | payloads, records=self.records | records)
        out.__dict__.update(made)
        return out

    @cached_property
    def bootstrap(self) -> DataFrame:
        """The arrays of each bootstrap capture, parsed once for the four relations that are made of them."""
        return self._staged("bootstrap_static", {a: [_leaves(_spec(t))] for a, t in BOOTSTRAP.items()} | {"total_players": None}, "$")

    def _of_bootstrap(self, array: str, *more: Column) -> DataFrame:
        each = self.bootstrap.select(*CAPTURE, *more, F.inline(array))
        return _typed(each, _spec(BOOTSTRAP[array]), [c for c in each.columns if c not in _leaves(_spec(BOOTSTRAP[array]))])

    @cached_property
    def player(self) -> DataFrame:
        """Players of each capture with the capture's own number of players."""
        return self._of_bootstrap("elements", F.col("total_players").cast("int").alias("total_players")).withColumn("news", F.nullif(F.col("news"), F.lit("")))

    @cached_property
    def team(self) -> DataFrame:
        return self._of_bootstrap("teams")

    @cached_property
    def position(self) -> DataFrame:
        return self._of_bootstrap("element_types")

    @cached_property
    def gameweek(self) -> DataFrame:
        return self._of_bootstrap("events")

    @cached_property
    def gameweek_status(self) -> DataFrame:
        spec = _spec(STATUS)
        return _typed(self._staged("event_status", {"status": [_leaves(spec)]}, "$.status[*]"), spec, CAPTURE)

    @cached_property
    def fixture(self) -> DataFrame:
        spec = _spec(FIXTURE)
        return _typed(self._staged("fixtures", _leaves(spec), "$[*]"), spec, CAPTURE)

    @cached_property
    def player_history_capture(self) -> DataFrame:
        """Each capture's whole array of facts and its length."""
        got = self._staged("element_summary", {"history": [_leaves(HISTORY)]}, "$")
        return got.select(*CAPTURE, F.array_size("history").alias("history_count"), "history")

    @cached_property
    def player_fixture(self) -> DataFrame:
        return _typed(self.player_history_capture.select(*CAPTURE, F.inline("history")), HISTORY, CAPTURE)

    @cached_property
    def entry_picks_capture(self) -> DataFrame:
        fields = {"active_chip": None, "entry_history": _leaves(_spec(ENTRY)), "automatic_subs": [_leaves(_spec(SUBSTITUTION))], "picks": [_leaves(_spec(PICK))]}
        got = self._staged("entry_picks", fields, "$", "endpoint")
        return got.select(
            "capture_key", "season", "run_id", "observed_at", F.split_part("endpoint", F.lit("/"), F.lit(4)).try_cast("int").alias("entry_id"), "active_chip", *[F.col(f"entry_history.{field}").cast(kind).alias(name) for field, name, kind in _spec(ENTRY)],
            F.transform("automatic_subs", lambda s: _struct(s, SUBSTITUTION)).alias("automatic_subs"), F.array_size("picks").alias("pick_count"), F.transform("picks", lambda p: _struct(p, PICK)).alias("picks"),
        )

    @cached_property
    def entry_picks(self) -> DataFrame:
        return self.entry_picks_capture.select("capture_key", "season", "entry_id", "gameweek", F.inline("picks"))

    @cached_property
    def settlement(self) -> DataFrame:
        """Settlement markers with the season that the index has for their run and period: none, one or several."""
        part = F.split_part("endpoint", F.lit("/"), F.lit(3))
        seasons = self.index.filter(F.split_part("endpoint", F.lit("/"), F.lit(1)) == "entry-picks").select("run_id", part.try_cast("int").alias("gameweek"), "season").distinct()
        m = self.markers.select(F.col("event").cast("int").alias("gameweek"), F.col("entries").cast("int").alias("entries"), "run_id", F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"))
        return m.join(seasons, ["run_id", "gameweek"], "left").select("season", "gameweek", "entries", "run_id", "recorded_at")

    @cached_property
    def manager_panel(self) -> DataFrame:
        e = self.panel.select("season", F.explode("entries").alias("e"))
        return e.select(F.col("season").cast("string").alias("season"), F.col("e.entry_id").cast("int").alias("entry_id"), F.col("e.cohort").cast("string").alias("cohort"))

    def all(self) -> dict[str, DataFrame]:
        """The staged relations by the names that the served ones go by."""
        names = ("player", "team", "position", "gameweek", "gameweek_status", "fixture", "player_fixture", "entry_picks_capture", "entry_picks", "settlement", "manager_panel")
        return {n: getattr(self, n) for n in names}
