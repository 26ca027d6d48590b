"""Captures, manifests, catalogs and panels that come in parts."""

import os

import pytest
from pyspark.sql import functions as F

from capturemill.operators import presence
from capturemill.plans import graph, relations, staging, warehouse

SF = "/root/testdata/sf0.001"


def test_no_row_of_the_captures_grows_with_the_tables(spark, monkeypatch):
    monkeypatch.setattr(relations, "PART", 16)
    s = relations.world(spark, SF)
    texts = s.payloads["bootstrap_static"].select(F.json_array_length(F.get_json_object("body", "$.elements")).alias("n")).union(s.payloads["fixtures"].select(F.json_array_length("body")))
    live = 3  # captures of a run that aren't of a manager
    sizes = [df.agg(F.max(F.size(c))).first()[0] for df, c in ((s.manifests, "captures"), (s.catalog, "captures"), (s.panel, "entries"))]
    assert texts.agg(F.max("n")).first()[0] <= 16 and live <= min(sizes) and max(sizes) <= 16


def test_parts_are_staged_as_the_whole(spark, monkeypatch):
    rows = {}
    for part in (16, 1_000_000):
        monkeypatch.setattr(relations, "PART", part)
        s = relations.world(spark, SF)
        rows[part] = [sorted(map(str, df.collect())) for df in (s.player, s.team, s.run, s.admission, s.manager_panel)]
    assert rows[16] == rows[1_000_000] and all(rows[16])


def test_a_manifest_in_parts_is_one_run(spark):
    head = ("1", "r1", "2024-01-01", "SUCCEEDED", "2024-01-01 00:00:00", "2024-01-01 00:00:00", "t", ("ci", "w", "m", "1", None))
    m = spark.createDataFrame([(*head, [(k, "e", "2024-01-01 00:00:00", "x", 1, 200, True, True, "s")]) for k in ("a", "b")], staging.MANIFESTS)
    s = staging.Sources(m, spark.createDataFrame([], staging.CATALOG), m, {}, m, m)
    assert s.run.count() == 1 and sorted(r.capture_key for r in s.index.collect()) == ["a", "b"]


def test_a_capture_in_parts_is_one_record_at_its_root(spark):
    captures = spark.createDataFrame([("a", "r1")], "capture_key string, run_id string")
    objects = spark.createDataFrame([("a", '{"n": 1, "l": [{"k": 1}]}'), ("a", '{"m": null, "l": [{"k": 1}, {}]}')], "capture_key string, json string")
    specs = presence.consumed_key_specs({"n": {}, "m": {}, "gone": {}, "l.k": {"record_path": "$.l[*]"}})
    got = presence.source_key_presence("s", specs, captures, objects)
    assert sorted((r.column_name, r.records, r.missing) for r in got.collect()) == [("gone", 1, 1), ("l.k", 3, 1), ("m", 1, 0), ("n", 1, 0)]


def test_lists_are_made_where_their_rows_meet(spark):
    s = relations.world(spark, SF)
    for df in (s.manifests, s.catalog, s.panel, s.payloads["entry_picks"], s.payloads["element_summary"]):
        plan = df._jdf.queryExecution().executedPlan().toString()
        last = max(i for i, line in enumerate(plan.splitlines()) if "ObjectHashAggregate" in line)
        assert "REPARTITION_BY_COL" in "".join(plan.splitlines()[last:][:4])


def test_admission_shuffles_no_capture(spark):
    head = ("1", "r1", "2024-01-01", "SUCCEEDED", "2024-01-01 00:00:00", "2024-01-01 00:00:00", "t", ("ci", "w", "refs/heads/main", "1", None))
    m = spark.createDataFrame([(*head, [(k, "e", "2024-01-01 00:00:00", "x", 1, 200, True, True, "s")]) for k in ("a", "b")], staging.MANIFESTS)
    seeds = spark.createDataFrame([], "run_id string, origin_kind string")
    s = staging.Sources(m, spark.createDataFrame([], staging.CATALOG), seeds, {}, m, m)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in s.admitted._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.capture_key for r in s.admitted.collect()) == ["a", "b"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["fct_player_fixture_settled", "dim_gameweek_settled", "fct_manager_pick", "dim_gameweek", "int_unstaged_admitted_capture"])
def test_what_reads_captures_several_times_is_built_in_steps(spark, name):
    df = relations.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 1 and all("/relation-" in f for f in df.inputFiles()) and df.count()


def test_records_read_several_times_by_one_relation_are_a_table(spark):
    for wanted, several in (("dim_gameweek", "gameweek"), ("fct_player_fixture", "player_fixture")):
        with graph.Build(spark, warehouse.nodes(relations.world(spark, SF))) as build:
            build.run([wanted])
            assert {"admitted", several, wanted} <= set(os.listdir(build.folder.removeprefix("file:")))
