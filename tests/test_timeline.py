"""Time lines of hot keys against brute force: as-of joins, histories, intervals and counts at a moment, cut into slices and whole."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from capturemill.operators import asof, captures, history, spine
from capturemill.operators.timeline import SHARE, SLICES, Timeline

T = datetime(2024, 1, 1)
CUT = {"share": 4, "least": 20}


def _draw(seed, n=1500, hot=0.6):
    """Rows of one hot key and many small ones, with ties in time and nulls."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 1 if rng.random() < hot else rng.choice([None, *range(2, 60)])
        out.append((i, key, None if rng.random() < 0.02 else T + timedelta(minutes=rng.randint(0, 900) if rng.random() < 0.7 else 450)))
    return out


def _as_of(requests, relation):
    out = []
    for i, k, at in requests:
        hits = [(t, j) for j, kk, t in relation if k is not None and at is not None and t is not None and kk == k and t < at]
        out.append((i, max(hits)[1] if hits else None))
    return sorted(out)


@pytest.mark.parametrize("how", [CUT, {"share": 0}, {}])
def test_as_of_of_a_hot_key_equals_brute_force(spark, how):
    left, right = _draw(1), _draw(2)
    r = spark.createDataFrame(left, "i int, k int, at timestamp_ntz").repartition(6)
    h = spark.createDataFrame(right, "j int, k int, t timestamp_ntz").repartition(6)
    got = asof.as_of(r, h, "at", "t", ["k"], ["j"], **how)
    assert sorted((x.i, x.j) for x in got.collect()) == _as_of(left, right)
    aged = asof.as_of(r, h.withColumn("seen", F.col("t")), "at", "t", ["k"], ["seen"], F.expr("INTERVAL 5 MINUTES"), **how)
    for x in aged.filter("seen is not null").collect():
        assert x["at"] - timedelta(minutes=5) <= x.seen < x["at"]


def test_no_task_holds_a_hot_key(spark):
    rows = spark.range(200_000).select(F.lit(7).alias("k"), (F.col("id") * 3).alias("t"))
    line = Timeline(rows.unionAll(spark.range(500).select(F.col("id").cast("int") + 100, F.col("id"))), ["k"], "t", least=1000)
    assert line.cut and line.by == ["k", "_slice"]
    sizes = [r["count"] for r in line.rows.filter("k = 7").groupBy(*line.by).count().collect()]
    assert len(sizes) == SLICES and max(sizes) < 2 * 200_000 / SLICES
    assert line.rows.filter("k <> 7 and _slice <> -1").count() == 0
    assert not Timeline(rows, ["k"], "t").rows.filter("k <> 7").count() and not Timeline(rows.limit(1000), ["k"], "t", least=1000).cut
    even = spark.range(100_000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("t"))
    assert not Timeline(even, ["k"], "t", least=0).cut and SHARE == 64


def _scd2(rows, order):
    out = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=order)
        opened = [r for i, r in enumerate(mine) if i == 0 or r[3] != mine[i - 1][3]]
        out += [(k, r[1], opened[i + 1][1] if i + 1 < len(opened) else None, r[3], r[2]) for i, r in enumerate(opened)]
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [CUT, {"share": 0}])
def test_history_of_a_hot_key_equals_brute_force(spark, how):
    rng = random.Random(5)
    rows = [(k or 0, t, i, rng.choice(["a", "b", None])) for i, k, t in _draw(4) if t is not None]
    d = spark.createDataFrame(rows, "k int, t timestamp_ntz, run int, v string").repartition(6)
    got = history.scd2(d, ["k"], ["t", "run"], ["v"], ["run"], **how)
    assert sorted(map(tuple, got.collect()), key=str) == _scd2(rows, lambda r: (r[1], r[2]))


def test_history_without_changes_crosses_slices(spark):
    """One state over thousands of captures of one key opens once; a change in the last slice closes the first."""
    d = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.when(F.col("id") < 4990, "x").otherwise("y").alias("v"))
    assert sorted(map(tuple, history.scd2(d, ["k"], ["t"], ["v"], **CUT).collect())) == [(1, 0, 4990, "x"), (1, 4990, None, "y")]


@pytest.mark.parametrize("how", [CUT, {"share": 0}])
def test_interval_join_equals_brute_force(spark, how):
    rng = random.Random(6)
    rows = [(k or 0, t, i, rng.choice("abc")) for i, k, t in _draw(7) if t is not None]
    requests = [(i, k, t) for i, k, t in _draw(8)]
    d = spark.createDataFrame(rows, "k int, t timestamp_ntz, run int, v string")
    h = history.scd2(d, ["k"], ["t", "run"], ["v"])
    table = [tuple(x) for x in h.collect()]
    want = []
    for i, k, at in requests:
        hits = [(f, v) for kk, f, to, v in table if at is not None and kk == k and f < at and (to is None or at <= to)]
        assert len(hits) <= 1
        want.append((i, *(hits[0] if hits else (None, None))))
    r = spark.createDataFrame(requests, "i int, k int, at timestamp_ntz")
    got = history.in_force(r, h, ["k"], "at", **how).select("i", "valid_from", "v").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    inner = history.in_force(r, h, ["k"], "at", "inner", **how).select("i", "valid_from", "v").collect()
    assert sorted(map(tuple, inner)) == sorted(w for w in want if w[1])


def test_interval_join_compares_in_proportion(spark):
    """On one key with many openings, each request passes as one row by one window; no operator makes pairs of requests and openings."""
    n = 30_000
    h = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("valid_from"), (F.col("id") + 1).alias("valid_to"), F.col("id").alias("v"))
    r = spark.range(n).select(F.col("id").alias("i"), F.lit(1).alias("k"), F.col("id").alias("at"))
    got = history.in_force(r, h, ["k"], "at", share=4, least=100)
    assert got.filter("v = at - 1").count() == n - 1 and got.count() == n
    got.write.format("noop").mode("overwrite").save()
    plan, made = got._jdf.queryExecution().executedPlan().toString(), []

    def visit(node):
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            made.append(metrics.apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(got._jdf.queryExecution().executedPlan())
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and max(made, default=0) <= 2 * n


@pytest.mark.parametrize("how", [CUT, {"share": 0}])
def test_count_at_a_moment_equals_brute_force(spark, how):
    rng = random.Random(12)
    captured = [(rng.choice(["s1", "s2"]), rng.randint(1, 12), T + timedelta(hours=rng.randint(0, 300)), i, rng.choice([None, 1, 2, 2, 2]), rng.choice([None, 10, 10, 11, 12]), rng.choice([10, 11])) for i in range(900)]
    plan = history.scd2(spark.createDataFrame(captured, "season string, item int, t timestamp_ntz, run int, period int, home int, away int"), ["season", "item"], ["t", "run"], ["period", "home", "away"])
    moved = [(rng.choice(["s1", "s2"]), rng.randint(1, 9), T + timedelta(hours=rng.randint(0, 300)), i, rng.choice([10, 11, 12, 13])) for i in range(80)]
    groups = history.scd2(spark.createDataFrame(moved, "season string, entity int, t timestamp_ntz, run int, team int"), ["season", "entity"], ["t", "run"], ["team"])
    asked = [(rng.choice(["s1", "s2", "s3"]), rng.randint(1, 10), rng.choice([1, 2, 3]), T + timedelta(hours=rng.choice([rng.randint(-5, 310), 100, 200]))) for _ in range(400)]
    got = spine.count_at_moment(spark.createDataFrame(asked, "season string, entity int, period int, at timestamp_ntz"), groups, plan, "season", "at", "entity", "team", "period", ["home", "away"], **how)
    p, g = [tuple(x) for x in plan.collect()], [tuple(x) for x in groups.collect()]
    want = []
    for season, entity, period, at in asked:
        known = [x[2] for x in p if x[0] == season]
        if not known or min(known) >= at:
            continue
        team = [x[4] for x in g if x[0] == season and x[1] == entity and x[2] < at and (x[3] is None or at <= x[3])]
        live = [x for x in p if x[0] == season and x[2] < at and (x[3] is None or at <= x[3]) and x[4] == period]
        n = sum((x[5] == team[0]) + (x[6] == team[0]) for x in live) if team else None
        want.append((season, entity, period, at, team[0] if team else None, n))
    assert sorted(map(tuple, got.select("season", "entity", "period", "at", "team", "n_at_moment").collect()), key=str) == sorted(want, key=str)
    assert {0, None} < {w[-1] for w in want} and max(w[-1] or 0 for w in want) > 2


def test_latest_is_cut_down_before_the_shuffle(spark):
    """A key's rows are reduced to one in each input partition, so that no task of the shuffle gets a hot key's rows."""
    d = spark.range(0, 60_000, 1, 6).select((F.col("id") % 2 * 0).alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("run"))
    got = captures.latest(d, ["k"], [F.desc("t"), F.desc("run")])
    assert got.collect()[0].t == 59_999
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_equal_requests_for_a_count_are_counted_once(spark, monkeypatch):
    """Large inputs that ask for few different things give what others give, and shuffle those alone."""
    groups = spark.createDataFrame([(1, e, e % 3 if e % 7 else None, e % 5, None) for e in range(60)], "season int, entity int, team int, valid_from int, valid_to int")
    items = spark.createDataFrame([(1, p, p % 3, (p + 1) % 3, f, f + 3 if f % 2 else None) for p in range(4) for f in range(6)], "season int, period int, home int, away int, valid_from int, valid_to int")
    asked = spark.createDataFrame([(1, e, p, at) for e in range(70) for p in (0, 1, 9) for at in (2, 4, 8)], "season int, entity int, period int, at int")
    got = []
    for small in (spine.SMALL, -1):
        monkeypatch.setattr(spine, "SMALL", small)
        df = spine.count_at_moment(asked, groups, items, "season", "at", "entity", "team", "period", ["home", "away"])
        got.append((sorted(map(tuple, df.collect()), key=str), "BroadcastHashJoin" in df._jdf.queryExecution().sparkPlan().toString()))
    assert got[0][0] == got[1][0] and len(got[0][0]) == 630 and got[1][1] and any(r[-1] for r in got[0][0])
