"""A build of relations: what is made once, what a check stops, what is left behind."""

import os

import pytest
from pyspark.sql import functions as F

from capturemill.plans import graph, served, warehouse
from capturemill.plans.graph import Build, Check, Node
from capturemill.plans.relations import world

SF = "/root/testdata/sf0.001"


def _counted(spark, made, name, make):
    def run(*needs):
        made.append(name)
        return make(*needs)

    return run


def test_shared_relations_are_made_once_and_the_folder_goes(spark):
    made = []
    nodes = {
        "a": Node(_counted(spark, made, "a", lambda: spark.range(10))),
        "b": Node(_counted(spark, made, "b", lambda a: a.filter("id > 3")), ("a",)),
        "c": Node(_counted(spark, made, "c", lambda a: a.filter("id < 8")), ("a",)),
        "d": Node(_counted(spark, made, "d", lambda b, c: b.join(c, "id")), ("b", "c")),
        "unwanted": Node(_counted(spark, made, "unwanted", lambda: spark.range(1))),
    }
    with Build(spark, nodes) as build:
        got = build.run(["d"])
        assert sorted(r.id for r in got["d"].collect()) == [4, 5, 6, 7]
        assert sorted(os.listdir(build.folder.removeprefix("file:"))) == ["a", "d"]  # b and c are read once: parts of d's plan
        assert build.run(["d", "c"])["d"].count() == 4
    assert sorted(made) == ["a", "b", "c", "d"] and not os.path.exists(build.folder.removeprefix("file:"))
    assert {r.status for r in build.records.values()} == {"built"}


def test_a_check_stops_what_needs_its_relations(spark):
    nodes = {"a": Node(lambda: spark.range(5)), "b": Node(lambda a: a, ("a",)), "c": Node(lambda b: b, ("b",)), "other": Node(lambda: spark.range(2)), "broken": Node(lambda: spark.range(1).select("gone"))}
    checks = {
        "no_four": Check(lambda a: a.filter("id = 4"), ("a",), ("b",)), "no_nine": Check(lambda a: a.filter("id = 9"), ("a",), ("other",)),
        "few": Check(lambda a: a.filter("id > 1"), ("a",), ("other",), warn=True), "on_broken": Check(lambda x: x, ("broken",)),
    }
    with Build(spark, nodes, checks) as build:
        got = build.run(["a", "c", "other", "broken", *checks])
        status = {n: r.status for n, r in build.records.items()}
        assert set(got) == {"a", "other"}
    assert status == {"a": "built", "b": "skipped", "c": "skipped", "other": "built", "broken": "failed", "no_four": "failed", "no_nine": "passed", "few": "warned", "on_broken": "skipped"}
    assert "'id': 4" in build.records["no_four"].said and "gone" in build.records["broken"].said
    with pytest.raises(graph.NotBuilt, match="no_four"):
        graph.relation_of(spark, nodes, "c", checks)


def test_rings_and_unknown_names_are_refused(spark):
    ring = {"a": Node(lambda b: b, ("b",)), "b": Node(lambda a: a, ("a",))}
    with Build(spark, ring) as build, pytest.raises(ValueError, match="a > b > a"):
        build.run(["a"])
    with Build(spark, {}) as build, pytest.raises(KeyError):
        build.run(["x"])


def test_a_removed_key_stops_its_payloads_relations(spark):
    """A build over captures whose players have lost a key: relations of that payload are left out, the others are built."""
    s = world(spark, SF)
    cut = s.payloads["bootstrap_static"].withColumn("body", F.regexp_replace("body", '"now_cost":[0-9]+,', ""))
    s = s.preset(payload_bootstrap_static=cut)
    status = {r.name: (r.status, r.n_rows) for r in warehouse.report(s, wanted=["dim_team", "dim_fixture", "fct_player_gameweek"]).collect()}
    assert status["keys_removed:bootstrap_static"][0] == "failed" and status["keys_removed:fixtures"][0] == "passed"
    assert status["dim_team"][0] == status["fct_player_gameweek"][0] == "skipped"
    # Served relations wait for the gap check, which needs every payload's relations.
    assert status["unstaged_captures"][0] == "skipped" and status["dim_fixture"][0] == "skipped"


def test_an_unstaged_capture_stops_what_is_served(spark):
    s = world(spark, SF)
    broken = F.when(F.col("capture_key") == s.admitted.filter("startswith(endpoint, 'fixtures')").agg(F.max("capture_key")).first()[0], "not JSON").otherwise(F.col("body"))
    s = s.preset(payload_fixtures=s.payloads["fixtures"].withColumn("body", broken))
    with Build(spark, warehouse.nodes(s, served.Settled()), warehouse.standing_checks()) as build:
        got = build.run(["fixture", "dim_fixture"])
        assert set(got) == {"fixture"} and build.records["unstaged_captures"].status == "failed" and build.records["dim_fixture"].status == "skipped"
