"""Data-quality operators. Each returns the rows that violate it, so an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capturemill.functions.scalars import seconds_between
from capturemill.operators.captures import latest


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside of the list; null passes."""
    return df.filter(~F.col(column).isin(values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null value is missing in the parent."""
    p = parent.select(F.col(parent_column).alias("_p")).filter("_p is not null").distinct()
    return df.filter(F.col(column).isNotNull()).join(p, F.col(column) == F.col("_p"), "left_anti")


def value_between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside of the inclusive bounds; null passes."""
    if low is None and high is None:
        raise ValueError("value_between needs a bound")
    bad = F.lit(False)
    bad = bad | (F.col(column) < low) if low is not None else bad
    bad = bad | (F.col(column) > high) if high is not None else bad
    return df.filter(bad)


def constant_per_key(df: DataFrame, column: str, key: list[str]) -> DataFrame:
    """Keys with more than one value, or with nulls, and what was found."""
    g = df.groupBy(*key).agg(F.count_distinct(column).alias("n_values"), F.count_if(F.col(column).isNull()).alias("n_nulls"), F.array_join(F.array_sort(F.collect_set(F.col(column).cast("string"))), ",").alias("found"))
    return g.filter("n_values > 1 or n_nulls > 0")


def null_exactly_when(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """Rows where a column isn't null exactly when the condition holds (null: doesn't), with the columns' names."""
    c = F.coalesce(condition, F.lit(False))
    bad = F.concat_ws(",", *[F.when(F.col(x).isNull() != c, F.lit(x)) for x in columns])
    return df.withColumn("violating", bad).filter("violating <> ''")


def freshness(endpoints: DataFrame, captures: DataFrame, now: Column, warn_hours: float = 6, error_hours: float = 18) -> DataFrame:
    """Age of each endpoint's newest capture and its status by the exact age; the limits are strict, an endpoint without a capture is an error, and ``age_hours`` is rounded for show."""
    newest = captures.groupBy("endpoint").agg(F.max("received_at").alias("newest"))
    j = endpoints.join(newest, "endpoint", "left").withColumn("_age", seconds_between(F.col("newest"), now) / 3600.0)
    late = F.when(F.col("exempt"), "exempt").when(F.col("newest").isNull() | (F.col("_age") > error_hours), "error").when(F.col("_age") > warn_hours, "warn").otherwise("ok")
    return j.withColumn("status", late).withColumn("age_hours", F.round("_age", 1)).drop("_age")


def missed_windows(moments: DataFrame, captures: DataFrame, keys: list[str], moment: str, time: str, minutes: int, now: Column, key: list[str] | None = None, newest: list[Column] | None = None, since: Column | None = None) -> DataFrame:
    """Moments before ``now`` without a capture in the ``minutes`` before them.

    With ``key`` and ``newest`` (an order) only the newest moment of each key counts; moments before ``since`` precede the coverage.
    """
    if key is not None:
        moments = latest(moments, key, newest)
    due = moments.filter(F.col(moment) < now)
    due = due if since is None else due.filter(F.col(moment) >= since)
    c = captures.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(time).alias("_t"))
    cond = (F.col("_t") < F.col(moment)) & (F.col("_t") >= F.col(moment) - F.make_dt_interval(mins=F.lit(minutes)))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_k_{k}"))
    return due.join(c, cond, "left_anti")


def latest_live_captures(admitted: DataFrame) -> DataFrame:
    """The admitted captures of each endpoint's newest run, history left aside. ``admitted``: endpoint, run_id, observed_at, capture_key, scope."""
    live = admitted.filter(~F.col("scope").eqNullSafe("history")).withColumn("endpoint", F.split_part("endpoint", F.lit("/"), F.lit(1)))
    newest = live.groupBy("endpoint").agg(F.max(F.struct("observed_at", "run_id")).alias("_newest"))
    return live.join(newest, "endpoint").filter(F.col("run_id") == F.col("_newest.run_id")).drop("_newest")


def capture_findings(endpoints: DataFrame, latest_live: DataFrame, payloads: DataFrame) -> DataFrame:
    """``endpoint, finding, captures``: endpoints without an admitted live capture, and those with captures whose payload isn't there. A source that has vanished can't pass."""
    none = endpoints.select("endpoint").distinct().join(latest_live, "endpoint", "left_anti").select("endpoint", F.lit("no admitted live capture").alias("finding"), F.lit(0).cast("long").alias("captures"))
    gone = latest_live.join(payloads.select("capture_key").distinct(), "capture_key", "left_anti").groupBy("endpoint").agg(F.count(F.lit(1)).alias("captures"))
    return none.unionByName(gone.select("endpoint", F.lit("captures without a payload").alias("finding"), "captures"))


def count_mismatch(declared: DataFrame, rows: DataFrame, key: str, size: str) -> DataFrame:
    """Keys whose declared number of elements isn't the number of rows."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return declared.join(n, key, "left").filter(~F.col(size).eqNullSafe(F.col("n_rows")))


def never_shrinks(df: DataFrame, group: list[str], time: str, size: str) -> DataFrame:
    """Captures with a smaller size than the one before."""
    return df.withColumn("before", F.lag(size).over(Window.partitionBy(*group).orderBy(time))).filter(F.col(size) < F.col("before"))


def broken_intervals(history: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose intervals don't meet end to end, or that haven't exactly one open row as their last."""
    w = Window.partitionBy(*keys).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    h = history.withColumn("_next", F.lead("valid_from").over(w))
    bad = h.groupBy(*keys).agg(F.count_if(~F.col("valid_to").eqNullSafe(F.col("_next"))).alias("n_breaks"), F.count_if(F.col("valid_to").isNull()).alias("n_open"))
    return bad.filter("n_breaks > 0 or n_open <> 1")


def key_presence(objects: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """For each declared key, the JSON records and those that lack it. A null value counts as present. One pass over the records."""
    have = F.json_object_keys(json)
    counts = objects.select(have.alias("k")).agg(F.count(F.lit(1)).alias("records"), *[F.count_if(~F.coalesce(F.array_contains("k", x), F.lit(False))).alias(f"m_{i}") for i, x in enumerate(keys)])
    return counts.select("records", F.explode(F.array(*[F.struct(F.lit(x).alias("key"), F.col(f"m_{i}").alias("missing")) for i, x in enumerate(keys)])).alias("r")).select("r.key", "records", "r.missing")


def presence_findings(presence: DataFrame, mode: str) -> DataFrame:
    """``removed``: keys missing in all records; ``partial``: in some. No records give no finding."""
    if mode not in ("removed", "partial"):
        raise ValueError(mode)
    every = F.col("missing") == F.col("records")
    return presence.filter((F.col("records") > 0) & (every if mode == "removed" else (F.col("missing") > 0) & ~every))


def unstaged(admitted: DataFrame, staged: list[DataFrame], key: str) -> DataFrame:
    """Admitted captures that no staged relation has."""
    all_keys = staged[0].select(key)
    for s in staged[1:]:
        all_keys = all_keys.union(s.select(key))
    return admitted.join(all_keys.distinct(), key, "left_anti")


def unstaged_by_endpoint(admitted: DataFrame, staged: dict[str, list[DataFrame]], severity: dict[str, str]) -> DataFrame:
    """Admitted captures of the endpoints in ``staged`` that none of an endpoint's relations has, with the endpoint's severity (``error`` unless given)."""
    spark = admitted.sparkSession
    scope = spark.createDataFrame([(e, severity.get(e, "error")) for e in staged], "endpoint string, severity string")
    here = admitted.withColumn("endpoint", F.split_part("endpoint", F.lit("/"), F.lit(1))).join(F.broadcast(scope), "endpoint")  # a row for each endpoint
    seen = spark.createDataFrame([], "endpoint string, capture_key string")
    for e, relations in staged.items():
        for r in relations:
            seen = seen.union(r.select(F.lit(e), "capture_key"))
    return here.join(seen.distinct(), ["endpoint", "capture_key"], "left_anti").select("endpoint", "season", "run_id", "capture_key", "observed_at", "severity")
