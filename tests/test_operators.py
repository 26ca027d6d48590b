"""Literal-data tests of the edges that SQL comparison doesn't reach."""

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from capturemill.functions import scalars
from capturemill.operators import asof, captures, checks, diff, history, spine
from capturemill.plans.relations import ORACLE_SQL, QUERIES
from capturemill.sources import declared

SF = "/root/testdata/sf0.001"
T = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events pages".split():
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _norm(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    d = QUERIES[name](spark, SF)
    cols = sorted(d.columns)
    rel = duck.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    assert _norm(map(tuple, d.select(*cols).collect())) == _norm(rel.select(*cols).fetchall())


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize(("offset", "want"), [(timedelta(microseconds=1), 5), (timedelta(0), None), (timedelta(hours=1), 5), (timedelta(hours=1, microseconds=1), None)])
def test_as_of_is_strict_and_age_bound_inclusive(spark, offset, want):
    r = spark.createDataFrame([(1, T + offset)], "k int, at timestamp_ntz")
    h = spark.createDataFrame([(1, T, 5), (None, T - timedelta(days=1), 9)], "k int, t timestamp_ntz, v int")
    got = asof.as_of(r, h, "at", "t", ["k"], ["v"], F.expr("INTERVAL 1 HOUR")).first()
    assert got.v == want


def test_as_of_keeps_duplicate_requests_and_null_keys(spark):
    r = spark.createDataFrame([(1, T), (1, T), (None, T)], "k int, at timestamp_ntz")
    h = spark.createDataFrame([(1, T - timedelta(1), None), (None, T - timedelta(1), 7)], "k int, t timestamp_ntz, v int")
    assert [(x.k, x.v) for x in asof.as_of(r, h, "at", "t", ["k"], ["v"]).orderBy("k").collect()] == [(None, None), (1, None), (1, None)]


def test_scd2_reopens_and_compares_nulls(spark):
    d = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", "b", "b", "a", None, None])], "k int, t int, v string")
    got = [(x.valid_from, x.valid_to, x.v) for x in history.scd2(d, ["k"], ["t"], ["v"]).orderBy("valid_from").collect()]
    assert got == [(0, 1, "a"), (1, 3, "b"), (3, 4, "a"), (4, None, None)]
    assert checks.broken_intervals(history.scd2(d, ["k"], ["t"], ["v"]), ["k"]).count() == 0


def test_retraction_drops_a_key_with_all_its_captures(spark):
    d = spark.createDataFrame([(1, "x", 1), (1, "y", 1), (1, "x", 2), (2, "z", 1)], "e int, k string, t int")
    assert {tuple(r) for r in captures.retract(d, ["e"], ["e", "k"], ["t"]).collect()} == {(1, "x", 1), (1, "x", 2), (2, "z", 1)}


def test_rollup_of_nulls_is_false(spark):
    d = spark.createDataFrame([(1, 1, None), (2, 1, True), (2, 2, False)], "k int, c int, ok boolean")
    assert {tuple(r) for r in captures.all_then_any(d, ["k"], ["c"], F.col("ok"), "v").collect()} == {(1, False), (2, True)}


def test_admission_cascade_takes_the_first_reason(spark):
    rows = [("a", "r1", True, "s"), ("b", "r2", True, "s"), ("c", "r3", None, "s"), ("d", "r3", True, None), ("e", "r3", True, "s"), ("f", "r4", True, "s"), ("g", "r5", True, "s"), ("h", "r6", True, "s"), ("i", "r7", True, "s")]
    index = spark.createDataFrame([(*r, False, "revalidated" if r[0] in "eb" else None) for r in rows], "capture_key string, run_id string, usable boolean, season string, shape_ok boolean, shape_source string")
    runs = spark.createDataFrame([("r2", "local", "refs/heads/main"), ("r3", "ci", "refs/heads/main"), ("r4", None, None), ("r5", "ci", "refs/heads/other")], "run_id string, origin_kind string, origin_ref string")
    seeds = spark.createDataFrame([("r6", "ci"), ("r7", "history_port")], "run_id string, origin_kind string")
    got = {r.capture_key: (r.unadmitted_reason, r.flagged_revalidation) for r in captures.admit(index, runs, seeds).collect()}
    want = {"a": "run_not_finalized", "b": "not_production", "c": "unusable", "d": "null_season", "e": None, "f": "origin_unknown", "g": "not_production", "h": "run_not_finalized", "i": None}
    assert got == {k: (v, k == "e") for k, v in want.items()}


def test_freshness_uses_the_exact_age(spark):
    ends = spark.createDataFrame([("x", False)], "endpoint string, exempt boolean")
    for seconds, status in ((6 * 3600, "ok"), (6 * 3600 + 10, "warn"), (18 * 3600 + 1, "error")):
        c = spark.createDataFrame([("x", T)], "endpoint string, received_at timestamp_ntz")
        r = checks.freshness(ends, c, F.lit(T + timedelta(seconds=seconds)).cast("timestamp_ntz")).first()
        assert r.status == status and r.age_hours == round(seconds / 3600, 1)


def test_missed_windows_of_the_newest_moments(spark):
    m = spark.createDataFrame([("s", 1, T, 1), ("s", 1, T + timedelta(hours=9), 2), ("s", 2, T - timedelta(days=9), 1), ("s", 3, T + timedelta(hours=10), 1)], "season string, gw int, at timestamp_ntz, seen int")
    c = spark.createDataFrame([("s", T - timedelta(minutes=5)), ("t", T + timedelta(hours=9) - timedelta(minutes=5))], "season string, t timestamp_ntz")
    now = F.lit(T + timedelta(hours=10)).cast("timestamp_ntz")
    got = checks.missed_windows(m, c, ["season"], "at", "t", 60, now, ["season", "gw"], [F.desc("seen")], F.lit(T).cast("timestamp_ntz")).collect()
    assert [(r.gw, r.at) for r in got] == [(1, T + timedelta(hours=9))]


def test_vanished_sources_are_found(spark):
    a = spark.createDataFrame([("x", "r1", T, "k1", None), ("x", "r2", T + timedelta(1), "k2", None), ("y/1", "r1", T, "k3", "history"), ("z", "r2", T, "k4", None)], "endpoint string, run_id string, observed_at timestamp_ntz, capture_key string, scope string")
    last = checks.latest_live_captures(a)
    assert {r.capture_key for r in last.collect()} == {"k2", "k4"}
    got = checks.capture_findings(spark.createDataFrame([("x",), ("y",), ("z",)], "endpoint string"), last, spark.createDataFrame([("k2",)], "capture_key string"))
    assert {tuple(r) for r in got.collect()} == {("y", "no admitted live capture", 0), ("z", "captures without a payload", 1)}


def test_last_value_skips_nulls(spark):
    f = spark.createDataFrame([(1, 1, "a"), (1, 2, None)], "k int, t int, v string")
    assert spine.fill_spine(f.select("k").distinct(), f, ["k"], "t", {}, {"v": F.col("v")}, ["t"]).first().v == "a"


def test_keys_and_casts(spark):
    d = spark.createDataFrame([("s3://b/raw/fpl/x/2024/payload.json",), ("s3://b/history/2024-25/fpl/x/payload.json",)], "p string")
    assert [r[0] for r in d.select(scalars.capture_key(F.col("p"), "fpl")).collect()] == ["raw/fpl/x/2024/payload.json", "history/2024-25/fpl/x/payload.json"]
    n = spark.createDataFrame([("9007199254740993", "1.6", "")], "a string, b string, c string")
    assert tuple(declared.cast_columns(n, {"a": "bigint", "b": "int", "c": "int"}).first()) == (9007199254740993, 2, None)


def test_checks_need_bounds_and_pass_nulls(spark):
    d = spark.createDataFrame([(None,), (1,), (5,)], "v int")
    assert [r.v for r in checks.value_between(d, "v", 1, 4).collect()] == [5]
    with pytest.raises(ValueError):
        checks.value_between(d, "v")


def test_json_null_counts_as_present(spark):
    d = spark.createDataFrame([('{"a": null}',), ('{"b": 1}',)], "j string")
    got = {r.key: (r.records, r.missing) for r in checks.key_presence(d, "j", ["a", "b", "c"]).collect()}
    assert got == {"a": (2, 1), "b": (2, 1), "c": (2, 2)}
    assert [r.key for r in checks.presence_findings(checks.key_presence(d, "j", ["a", "c"]), "removed").collect()] == ["c"]


def test_row_diff_counts_copies(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "v int"), spark.createDataFrame([(1,), (3,)], "v int")
    assert {(r.v, r.side, r.surplus) for r in diff.row_diff(a, b).collect()} == {(1, "left", 1), (2, "left", 1), (3, "right", 1)}
