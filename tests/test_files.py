"""Compaction, reads, publish, comparison, metrics, re-keying and whole builds over files, all by the session's file systems."""

import hashlib
import json
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from capturemill.functions import scalars
from capturemill.plans import builds, staging, warehouse
from capturemill.plans.graph import Build, Node
from capturemill.plans.publish import contract_failures, publish, served_paths
from capturemill.plans.relations import world
from capturemill.sources import compaction, declared, places, rekey
from capturemill.sources.files import Files

FIELDS = {"id": None, "items": [{"a": None, "b": None}]}


def _put(root, day, run, value):
    p = root / "e" / day / run / "payload.json"
    p.parent.mkdir(parents=True)
    p.write_text(value if isinstance(value, str) else json.dumps(value))


def _index(spark, raw, day, sha=None):
    """``day, key, content_sha256`` of a day's files, or with a wrong digest."""
    rows = [(day, str(p.relative_to(raw)), sha or hashlib.sha256(p.read_bytes()).hexdigest()) for p in sorted(raw.rglob("payload.json")) if p.parts[-3] == day]
    return spark.createDataFrame(rows, "day string, key string, content_sha256 string")


def test_declared_read_compaction_and_union(spark, tmp_path):
    raw, dest = tmp_path / "raw", "file:" + str(tmp_path / "parts")  # a path and a URI
    _put(raw, "2024-01-01", "r1", {"id": "1", "items": [{"a": 1, "x": 9}, {"b": "z"}]})
    _put(raw, "2024-01-02", "r2", {"id": "2", "items": []})
    _put(raw, "2024-01-03", "r3", {"id": "3", "items": [{"a": 5}], "other": 1})
    before = sorted(map(str, compaction.compacted_read(spark, str(raw), dest, FIELDS).select("id", "items").collect()))
    done, failed = compaction.run_step(spark, str(raw), dest, FIELDS, "2024-01-03", 60, _index(spark, raw, "2024-01-01").union(_index(spark, raw, "2024-01-02")), strip=str(raw) + "/")
    assert [m["capture_day"] for m in done] == ["2024-01-01", "2024-01-02"] and failed == {}
    record = builds.compaction_record(done, failed)
    assert record["total_files"] == 2 and [u["unit"] for u in record["units"]] == ["2024-01-01", "2024-01-02"] and all(u["seconds"] > 0 for u in record["units"])
    assert compaction.select_days(spark, str(raw), dest, "2024-01-03") == []
    got = compaction.compacted_read(spark, str(raw), dest, FIELDS)
    assert sorted(map(str, got.select("id", "items").collect())) == before
    rows = declared.declared_records(got, FIELDS, "$.items[*]", ["id"]).collect()
    assert sorted((r.id, r.a, r.b) for r in rows if r.a) == [("1", "1", None), ("3", "5", None)] and len(rows) == 3
    with pytest.raises(ValueError):
        declared.declared_records(got, FIELDS, "$.nope[*]", [])
    with pytest.raises(compaction.CompactionError, match="digests differ"):
        compaction.compact_day(spark, str(raw), "2024-01-03", FIELDS, dest, _index(spark, raw, "2024-01-03", "0"), str(raw) + "/")
    assert not list((tmp_path / "parts" / "2024-01-03").glob("part-*"))  # what didn't reconcile is gone
    (tmp_path / "parts" / "_manifest" / "2024-01-09.json").write_text('{"capture_day": "x"}')
    with pytest.raises(compaction.CompactionError):
        compaction.compacted_read(spark, str(raw), dest, FIELDS)


def test_unreadable_payloads_are_left_out_or_fail(spark, tmp_path):
    _put(tmp_path, "2024-01-01", "r1", "{not json")
    _put(tmp_path, "2024-01-01", "r2", {"id": "1"})
    files = [r.path for r in compaction.day_listing(spark, str(tmp_path)).collect()]
    assert compaction.days_of(spark, str(tmp_path)) == ["2024-01-01"] and compaction.days_of(spark, str(tmp_path / "none")) == []
    assert declared.read_captures(spark, files, FIELDS).count() == 1
    with pytest.raises(Exception):
        declared.read_captures(spark, files, FIELDS, strict=True).collect()
    _put(tmp_path, "2024-01-02", "r1", {"id": "1"})
    _put(tmp_path, "2024-01-02", "r2", "")
    for day in ("2024-01-01", "2024-01-02"):
        with pytest.raises(compaction.CompactionError, match="2 files, 1 in the part"):
            compaction.compact_day(spark, str(tmp_path), day, FIELDS, str(tmp_path / "parts"))


def test_of_two_compactions_one_commits(spark, tmp_path):
    raw, dest = tmp_path / "raw", str(tmp_path / "parts")
    for run in ("r1", "r2"):
        _put(raw, "2024-01-01", run, [{"id": run + x, "items": []} for x in "ab"])  # an array gives a row for each element
    with ThreadPoolExecutor(2) as pool:
        tries = [pool.submit(compaction.compact_day, spark, str(raw), "2024-01-01", FIELDS, dest) for _ in range(2)]
    errors = [t.exception() for t in tries if t.exception()]
    assert len(errors) == 1 and "another run" in str(errors[0])
    assert len(list((tmp_path / "parts" / "2024-01-01").glob("part-*"))) == 1
    assert sorted(r.id for r in compaction.compacted_read(spark, str(raw), dest, FIELDS).collect()) == ["r1a", "r1b", "r2a", "r2b"]


def test_compacted_raw_history_and_cutoff_reads(spark, tmp_path):
    """Parts, a raw tail and ported seasons, each capture once; the raw switch gives the same rows, a cutoff the older ones."""
    raw, history, parts = tmp_path / "raw", tmp_path / "history", tmp_path / "parts"

    def put(top, player, day, run, value):
        p = top / "fpl" / "element-summary" / player / day / run / "payload.json"
        p.parent.mkdir(parents=True)
        p.write_text(json.dumps(value))

    for i, day in enumerate(["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-03"]):
        put(raw, str(i), day, "r1", {"history": [{"element": i}] if i else []})
    put(history / "2020-21", "9", "2021-06-01", "h1", {"history": [{"element": 9}]})
    other = raw / "fpl" / "fixtures" / "2024-01-01" / "r1" / "payload.json"
    other.parent.mkdir(parents=True)
    other.write_text("[]")
    fields, roots = {"history": [{"element": None}]}, places.PayloadRoots(str(raw), str(history), str(parts))
    base = str(raw / "fpl" / "element-summary")
    compaction.run_step(spark, base, str(parts / "fpl" / "element-summary"), fields, "2024-01-03", 60)

    def read(**how):
        return sorted((r.capture_key, str(r.history)) for r in places.Reading(roots, **how).captures(spark, "element_summary", fields).collect())

    whole = read()
    assert len(whole) == 5 and read(raw=True) == whole
    assert whole[0][0] == "history/2020-21/fpl/element-summary/9/2021-06-01/h1/payload.json" and whole[1][0].startswith("raw/fpl/element-summary/0/")
    assert [k.split("/")[-3] for k, _ in read(cutoff="2024-01-03")] == ["2021-06-01", "2024-01-01", "2024-01-01", "2024-01-02"]
    with pytest.raises(compaction.CompactionError, match="nothing to read"):
        read(cutoff="2000-01-01")
    for p in list((raw / "fpl" / "element-summary").rglob("payload.json")):
        if p.parts[-3] != "2024-01-03":
            p.unlink()  # compacted days need no raw files
    assert read() == whole


def test_publish_guards(spark, tmp_path):
    d = spark.createDataFrame([("s1", 1), ("s1", 2), ("s2", 3)], "season string, v int")
    served, dest = tmp_path / "served", "file:" + str(tmp_path / "served")

    def put(df, want, **how):
        return publish(spark, {"t": df}, {"t": want}, dest, 1, **how)

    assert put(d, {"s1": 2, "s2": 1}) and not served.exists()  # no baseline
    assert put(d, {"s1": 2, "s2": 1}, without_baseline=True) == []
    assert put(d, {"s1": 9, "s2": 1}) and put(d.filter("v > 1"), {})
    assert put(d.filter("v > 1"), {}, restated={"s1"}) == []
    assert spark.read.parquet(served_paths(spark, dest)["t"]).count() == 2
    assert len([p for p in served.iterdir() if p.is_dir() and p.name != "_manifests"]) == 2 and sorted(p.name for p in (served / "_manifests").glob("*.json")) == ["00000001.json", "00000002.json"]
    assert json.loads((served / "manifest.json").read_text())["restated_seasons"] == ["s1"]
    assert put(d, {}) == [] and len([p for p in served.iterdir() if p.is_dir()]) == 3  # of three builds the first is gone
    (served / "_manifests" / "00000004.json").write_text("{")
    assert put(d, {}) and put(d, {}, without_baseline=True) == []
    assert contract_failures({"contract_version": 2, "columns": {"t": [["a", "int"]]}}, 2, {"t": [["a", "bigint"]]})
    assert not contract_failures({"contract_version": 2, "columns": {"t": [["a", "int"]]}}, 2, {"t": [["a", "int"], ["b", "int"]]})
    assert contract_failures({"contract_version": 2, "columns": {}}, 1, {})


def test_of_two_publishes_after_the_same_one_one_commits(spark, tmp_path):
    dest = str(tmp_path / "served")
    tables = [spark.range(n).selectExpr("'s' as season", "id") for n in (1, 5, 6)]
    assert publish(spark, {"t": tables[0]}, {"t": {}}, dest, 1, without_baseline=True) == []
    with ThreadPoolExecutor(2) as pool:
        said = [x.result() for x in [pool.submit(publish, spark, {"t": t}, {"t": {}}, dest, 1) for t in tables[1:]]]
    lost = [i for i, x in enumerate(said) if x]
    if lost:  # else they came one after the other
        assert len(lost) == 1
        assert spark.read.parquet(served_paths(spark, dest)["t"]).count() == (6 if lost[0] == 0 else 5)
    files = Files(spark)
    with pytest.raises(FileExistsError):
        files.put(dest + "/_manifests/00000001.json", "late")
    assert "row_counts" in files.read(dest + "/_manifests/00000001.json") and not [p for p in tmp_path.glob("served/_manifests/.*") if not p.name.endswith(".crc")]


def test_builds_are_compared_with_one_sided_tables(spark, tmp_path):
    a = spark.createDataFrame([("s1", 1, "x"), ("s1", 2, "y"), ("s1", 2, "y")], "season string, k int, v string")
    b = spark.createDataFrame([("s1", 1, "z"), ("s1", 2, "y")], "season string, k int, v string")
    got = builds.build_diff({"t": a, "old": a, "u": a.limit(0)}, {"t": b, "u": b.limit(0), "w": b.drop("v")}, {"t": ["season", "k"], "none": ["k"]}, ("r", "r"))
    assert got.differing == ["none", "old", "t", "w"] and got.columns == {"t": ["v"]}
    assert {r["table"]: (r["before_rows"], r["after_rows"], r["only_before"], r["only_after"]) for r in got.counts} == {"t": (3, 2, 1, 1), "old": (3, 0, 2, 0), "w": (0, 2, 0, 2)}
    assert builds.build_diff({"t": a}, {"t": a.distinct()}, {}, ("r", "r")).differing == ["t"]  # copies count
    with pytest.raises(builds.Inconclusive):
        builds.build_diff({}, {}, {}, ("r1", "r2"))
    builds.export_build(spark, {"t": a}, str(tmp_path / "out"), 5, "r9")
    assert spark.read.json(str(tmp_path / "out" / "build")).first().newest_run_id == "r9"


def test_fingerprints_tell_multisets_apart(spark):
    a = spark.createDataFrame([("s1", 1, None, "x", [None, 1]), ("s1", 2, "y", None, [1, None]), ("s2", 2, "y", None, [])], "season string, k int, u string, v string, l array<int>")

    def prints(d):
        return sorted(map(str, builds.fingerprint(d, ["k"]).collect()))

    assert prints(a.repartition(3)) == prints(a.orderBy(F.desc("k")).coalesce(1))
    swapped = a.select("season", "k", F.col("v").alias("u"), F.col("u").alias("v"), "l")
    for other in (swapped, a.union(a.limit(1)), a.withColumn("l", F.reverse("l")), a.withColumn("l", F.lit(None).cast("array<int>"))):
        assert prints(other) != prints(a)


def test_equal_buckets_are_not_read_again(spark, tmp_path):
    """The comparison of two exports opens files of the buckets whose fingerprints differ, and of no others."""
    old = spark.range(5000).selectExpr("cast(id % 3 as string) as season", "id as k", "id * 2 as v").withColumn("w", F.when(F.col("k") % 7 != 0, F.col("k")))
    new = old.withColumn("v", F.when(F.col("k") == 17, -1).otherwise(F.col("v"))).filter("k <> 18")
    for name, df in (("a", old), ("b", new)):
        builds.export_build(spark, {"t": df, "same": old}, str(tmp_path / name), 1, "r", {"t": ["k"], "same": ["k"]})
    got = builds.export_diff(spark, str(tmp_path / "a"), str(tmp_path / "b"), ["t", "same"])
    rows = {(r.table_name, r.season): (r.before_rows, r.after_rows, r.only_before, r.only_after) for r in got.collect()}
    assert rows[("t", "2")] == (1666, 1666, 1, 1) and rows[("t", "0")] == (1667, 1666, 1, 0) and rows[("same", "0")] == (1667, 1667, 0, 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    want = {r._bucket for r in builds.with_bucket(old.filter("k in (17, 18)"), ["k"]).collect()}
    filters = {frozenset(map(int, re.findall(r"\d+", x))) for x in re.findall(r"PartitionFilters: \[_bucket#\d+L? IN \(([\d,]+)\)", plan)} | {frozenset([int(x)]) for x in re.findall(r"PartitionFilters: \[isnotnull\(_bucket#\d+L?\), \(_bucket#\d+L? = (\d+)\)", plan)}
    assert filters == {frozenset(want)} and "/same" not in plan


def test_metrics_come_from_spark(spark, tmp_path):
    m = builds.Metrics(spark)
    with m.timed("t"):
        spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 10).alias("k")).count().write.parquet(str(tmp_path / "t"))
    with m.timed("nothing"):
        pass
    record = m.record({"t": spark.createDataFrame([("a",), ("a",), ("b",)], "capture_key string")}, trigger="schedule", run_id="r1")
    got = record["stages"]["t"]
    assert got["tasks"] >= 5 and got["rows_written"] == 10 and got["bytes_written"] > 0 and got["shuffle_bytes"] > 0 and record["stages"]["nothing"]["tasks"] == 0
    assert record["captures"] == {"t": 2} and record["peak_memory"]["heap_bytes"] > 0 and record["seconds"]["t"] > 0 and record["trigger"] == "schedule"
    with Build(spark, {"a": Node(lambda: spark.range(500)), "b": Node(lambda a: a.filter("id > 9"), ("a",), kept=True)}) as build:
        build.run(["a", "b"])
        figures = build.figures()
    assert figures["a"].rows_written == 500 and figures["b"].rows_read == 500 and figures["b"].rows_written == 490


def _archive(root):
    for name, value in {"bootstrap.json": {"teams": [{"id": 1, "name": "Ä", "x": 1.5, "big": 12345678901234567890}]}, "fixtures.json": [], "gw_3.json": {"a": None}, "gw_12.json": {"a": True}, "players/007.json": {"history": [1, 2]}}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(json.dumps(value, indent=2).replace("1.5,", "1.50,"))


def test_a_season_is_rekeyed_once(spark, tmp_path):
    archive, dest, moment = tmp_path / "archive", tmp_path / "history", "20240526T034626Z"
    _archive(archive)
    run = f"{moment}-{hashlib.sha256((archive / 'bootstrap.json').read_bytes()).hexdigest()[:6]}"

    def go(**how):
        return rekey.rekey(spark, str(archive), str(dest), "2023-24", moment, **how)

    assert go(dry_run=True) == {"run_id": run, "planned": 5, "already_there": 0, "written": 0} and not dest.exists()
    assert go() == {"run_id": run, "planned": 5, "already_there": 0, "written": 5}
    there = sorted(str(p.relative_to(dest)) for p in dest.rglob("payload.json"))
    assert there == [f"2023-24/fpl/{e}/2024-05-26/{run}/payload.json" for e in ("bootstrap-static", "element-summary/7", "event-live/03", "event-live/12", "fixtures")]
    at = dest / f"2023-24/fpl/bootstrap-static/2024-05-26/{run}"
    assert (at / "payload.json").read_text() == '{"teams":[{"id":1,"name":"\\u00c4","x":1.50,"big":12345678901234567890}]}'
    meta = json.loads((at / "metadata.json").read_text())
    assert meta["content_sha256"] == hashlib.sha256((at / "payload.json").read_bytes()).hexdigest() and meta["archive_sha256"][:6] == run[-6:] and meta["synthetic"]
    assert go()["written"] == 0  # a second run does nothing
    (dest / there[0]).unlink()
    assert go() == {"run_id": run, "planned": 5, "already_there": 4, "written": 1}  # a broken one goes on
    (dest / there[1]).write_text("{}")
    with pytest.raises(rekey.RekeyRefused, match="other content"):
        go()


def test_an_archive_that_would_lose_a_file_is_refused(spark, tmp_path):
    _archive(tmp_path / "a")
    (tmp_path / "a" / "players" / "7.json").write_text("{}")  # the same key as 007
    with pytest.raises(rekey.RekeyRefused, match="several files"):
        rekey.rekey(spark, str(tmp_path / "a"), str(tmp_path / "h"), "s", "20240526T034626Z")
    (tmp_path / "a" / "players" / "7.json").write_text("")
    with pytest.raises(rekey.RekeyRefused, match="1 of 6 files are empty"):
        rekey.rekey(spark, str(tmp_path / "a"), str(tmp_path / "h"), "s", "20240526T034626Z")
    (tmp_path / "a" / "odd.txt").write_text("x")
    with pytest.raises(rekey.RekeyRefused, match="without an endpoint.*odd.txt"):
        rekey.rekey(spark, str(tmp_path / "a"), str(tmp_path / "h"), "s", "20240526T034626Z")
    assert not (tmp_path / "h").exists()


def test_names_times_and_dates(spark):
    d = spark.createDataFrame([("s3://b/x/20240526T034626Z-ab.json", "20240526T034626Z", 2024, 2, 29), ("x", "nothing", 2023, 2, 29)], "p string, t string, y int, m int, d int")
    got = d.select(scalars.parse_filename(F.col("p")), scalars.parse_filename(F.col("p"), True), scalars.strptime(F.col("t"), "%Y%m%dT%H%M%SZ"), scalars.make_date(F.col("y"), F.col("m"), F.col("d"))).collect()
    assert tuple(got[0]) == ("20240526T034626Z-ab.json", "20240526T034626Z-ab", datetime(2024, 5, 26, 3, 46, 26), date(2024, 2, 29)) and tuple(got[1]) == ("x", "x", None, None)
    now = spark.range(1).select(scalars.utc_now().alias("n"), scalars.utc_now("2024-01-02 03:04:05").alias("p")).first()
    assert now.p == datetime(2024, 1, 2, 3, 4, 5) and abs((now.n - datetime.now(UTC).replace(tzinfo=None)).total_seconds()) < 60


def _as_files(s, root):
    """The world's captures as files: manifests, catalog, markers, panels and payloads below ``root``; ported seasons apart."""
    longer = lambda c: F.transform(c, lambda x: x.withField("key", F.concat(F.regexp_replace(x["key"], "^history/([0-9]{4})/", "history/$1-99/"), F.lit("/2020-01-01/x/payload.json"))))

    def write(df, path):
        for i, r in enumerate(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).collect()):
            p = root / "raw" / "fpl" / path.format(i=i)
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(r.j)

    write(s.manifests.withColumn("captures", longer("captures")), "_manifests/2020-01-01/{i}/manifest.json")
    write(s.catalog.withColumn("captures", longer("captures")), "_catalog/backfill/{i}.json")
    write(s.markers, "_settlement/entry-picks/{i}/marker.json")
    write(s.panel, "_panels/{i}/manager-panel.json")
    for df in s.payloads.values():
        for r in df.collect():
            p = root / re.sub(r"^history/(\d{4})/", r"history/\1-99/", r.capture_key) / "2020-01-01/x/payload.json"
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(r.body)
    return places.PayloadRoots(str(root / "raw"), str(root / "history"), str(root / "parts"))


def test_a_build_from_files_equals_one_from_memory(spark, tmp_path):
    s = world(spark, "/root/testdata/sf0.001")
    roots = _as_files(s, tmp_path)
    wanted = ["dim_team", "dim_fixture", "dim_player_status_history", "fct_player_fixture", "fct_player_gameweek", "fct_manager_pick"]
    # A run of the world is one more part of a key than a day's run.
    deeper = {"bootstrap_static": ("fpl/bootstrap-static/*/*/*/payload.json", None), "fixtures": ("fpl/fixtures/*/*/*/payload.json", None), "event_status": ("fpl/event-status/*/*/*/payload.json", None), "entry_picks": ("fpl/entry-picks/*/*/*/*/payload.json", None)}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(places, "PATTERNS", places.PATTERNS | deeper)
        for reading in (places.Reading(roots, raw=True), places.Reading(roots)):
            f = staging.sources_from_files(spark, reading, s.seeds)
            with Build(spark, warehouse.nodes(f)) as one, Build(spark, warehouse.nodes(s)) as two:
                a, b = one.run(wanted), two.run(wanted)
                assert set(a) == set(wanted), [r for r in one.records.values() if r.status != "built"]
                for t in wanted:
                    cols = [c for c in b[t].columns if c != "capture_key"]
                    assert b[t].count() and a[t].select(cols).exceptAll(b[t].select(cols)).isEmpty() and b[t].select(cols).exceptAll(a[t].select(cols)).isEmpty(), t
