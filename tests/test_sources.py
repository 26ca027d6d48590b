"""Settled periods, places and key presence."""

import hashlib
import json

import pytest

from capturemill.operators import presence
from capturemill.sources import compaction, places

FIELDS = {"id": None, "items": [{"a": None, "b": None}]}


def test_settled_periods_are_sealed_once(spark, tmp_path):
    raw, dest, captures = tmp_path / "picks", tmp_path / "parts", {}
    for season, period, entry, run in (("s1", "3", "7", "r1"), ("s1", "3", "8", "r1"), ("s1", "4", "7", "r2"), ("s1", "5", "7", "r3")):
        p = raw / season / period / entry / "2024-01-01" / run / "payload.json"
        p.parent.mkdir(parents=True)
        p.write_text(json.dumps({"id": entry + period, "items": []}))
        sha = "0" if run == "r2" else hashlib.sha256(p.read_bytes()).hexdigest()
        captures.setdefault(run, []).append({"key": "raw/fpl/entry-picks/" + str(p.relative_to(raw)), "endpoint": f"entry-picks/entry/{period}/{entry}", "season": season, "content_sha256": sha})
    markers = [{"event": 3, "run_id": "r1"}, {"event": 4, "run_id": "r2"}, {"event": 5, "run_id": "none"}]
    done, failed = compaction.compact_settled(spark, str(raw), str(dest), FIELDS, markers, captures)
    assert done == [("s1", "3")] and set(failed) == {"4", "5"}  # a digest differs; the run has no index
    assert compaction.compact_settled(spark, str(raw), str(dest), FIELDS, markers[:1], captures) == ([], {})
    assert sorted(r.id for r in compaction.period_read(spark, str(raw), str(dest), FIELDS).collect()) == ["73", "74", "75", "83"]
    with pytest.raises(compaction.CompactionError):
        compaction.marker_season([{"endpoint": "entry-picks/entry/3/1", "season": s} for s in ("s1", "s2")], "3")


def test_places_and_seeds(spark, tmp_path):
    assert places.before_cutoff(["r/2024-01-02/x/p", "r/2024-01-01/y/p"], "2024-01-02") == ["r/2024-01-01/y/p"]
    with pytest.raises(ValueError):
        places.before_cutoff(["r/2024-01-02/x/p"], "2024-01-01")
    with pytest.raises(places.DestinationRefused):
        places.check_destination("s3://b/parts", "push", "s3://b/parts/")
    places.check_destination("s3://b/parts", "schedule", "s3://b/parts")
    places.check_destination("s3://b/parts-test", "push", "s3://b/parts")
    assert places.PayloadRoots("raw/", "old").globs("e/*.json") == ["raw/e/*.json", "old/e/*.json"]
    (tmp_path / "seed.csv").write_text("run_id,origin_kind,github_run_id,workflow,ref\nr1,ci,,w,\n")
    assert [tuple(r) for r in places.read_seed(spark, str(tmp_path / "seed.csv")).collect()] == [("r1", "ci", None, "w", None)]


def test_presence_findings_of_the_newest_run(spark):
    admitted = spark.createDataFrame([("raw/a", "e/1", "r1", 1), ("raw/b", "e/2", "r2", 2), ("raw/c", "e/3", "r2", 2), ("history/d", "e/4", "r9", 9)], "capture_key string, endpoint string, run_id string, observed_at int")
    objects = spark.createDataFrame([("raw/b", '{"l": [{"m": [{"k": null}, {"k": 1}]}, {"m": [{}]}]}'), ("raw/a", "{}")], "capture_key string, json string")
    run = presence.latest_live_run(admitted, "e", objects)
    assert [tuple(r) for r in run.collect()] == [("raw/b", "r2")]
    lost = presence.latest_live_run_missing(admitted, "e", objects).first()
    assert tuple(lost) == ("r2", 1)
    specs = presence.consumed_key_specs({"l.m.k": {"record_path": "$.l[*].m[*]"}, "gone": {"presence_exempt": " "}, "left": {"presence_exempt": "known"}})
    got = presence.source_key_presence("s", specs, run, objects)
    assert sorted((r.column_name, r.captures, r.records, r.missing) for r in got.collect()) == [("gone", 1, 1, 1), ("l.m.k", 1, 3, 1)]
    assert [r.column_name for r in presence.consumed_key_findings("s", specs, run, objects, "removed").collect()] == ["gone"]
    told = got.selectExpr("*", "'r2' as latest_run_id", "1 as latest_run_missing_bytes")
    assert {r.finding for r in presence.source_findings(told, "partial").collect()} == {presence.PARTIAL, presence.NO_PAYLOAD}
    none = presence.consumed_key_findings("s", specs, run.limit(0), objects, "partial").collect()
    assert [r.finding for r in none] == [presence.NO_CAPTURE]
