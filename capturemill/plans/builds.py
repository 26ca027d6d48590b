"""Builds as a whole: export, comparison of two, shape and metrics."""

from __future__ import annotations

import datetime
import time
import uuid
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Inconclusive(RuntimeError):
    """Two builds read different newest runs."""


def newest_run(staged: list[DataFrame]) -> str | None:
    """The greatest run id of any staged relation."""
    return reduce(DataFrame.union, [s.select("run_id") for s in staged]).agg(F.max("run_id")).first()[0]


#: Buckets of a table's keys in fingerprints and exports.
BUCKETS = 64
_SUMS = ["_h0", "_h1", "_h2", "_h3"]


def with_bucket(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``_bucket`` by the keys, so that a changed row stays where it was."""
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def fingerprint(df: DataFrame, keys: list[str], season: str = "season", buckets: int = BUCKETS) -> DataFrame:
    """``season, _bucket, _n`` and sums of two 64-bit hashes over the rows, by season (null in a table without one) and bucket.

    Equal multisets of rows have equal sums whatever their order or files; others differ but for a chance in 2^128. A task sends one row for each season and bucket.
    """
    simple = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    parts = [x for c in df.columns for x in ((F.col(f"`{c}`"), F.col(f"`{c}`").isNull()) if c in simple else (F.to_json(F.struct(F.col(f"`{c}`")), {"ignoreNullFields": "false"}),))]
    of = F.col(season).cast("string") if season in df.columns else F.lit(None).cast("string")
    keyed = with_bucket(df, keys, buckets).select(of.alias("season"), "_bucket", F.xxhash64(*parts).alias("_x"), F.xxhash64(F.lit(7), *parts).alias("_y"))
    halves = [F.sum(F.col(h).bitwiseAND(0xFFFFFFFF)) for h in ("_x", "_y")] + [F.sum(F.shiftrightunsigned(h, 32)) for h in ("_x", "_y")]  # halves, so that no sum leaves a long
    return keyed.groupBy("season", "_bucket").agg(F.count(F.lit(1)).alias("_n"), *[x.alias(n) for x, n in zip(halves, _SUMS, strict=True)])


def bucket_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``season, _bucket, before_rows, after_rows, _same`` of two fingerprints."""
    a, b = (x.select("season", "_bucket", F.col("_n").alias(n), F.struct(*_SUMS).alias(f"_{n}")) for x, n in ((before, "before_rows"), (after, "after_rows")))
    j = a.withColumnsRenamed({"season": "_s", "_bucket": "_b"})
    j = j.join(b, j["_s"].eqNullSafe(b["season"]) & (j["_b"] == b["_bucket"]), "full")
    zero = F.lit(0).cast("long")
    return j.select(F.coalesce("season", "_s").alias("season"), F.coalesce("_bucket", "_b").alias("_bucket"), F.coalesce("before_rows", zero).alias("before_rows"), F.coalesce("after_rows", zero).alias("after_rows"),
                    (F.col("_before_rows").eqNullSafe(F.col("_after_rows")) & F.col("before_rows").eqNullSafe(F.col("after_rows"))).alias("_same"))


def one_sided(before: DataFrame, after: DataFrame, season: str = "season") -> DataFrame:
    """``season, only_before, only_after``: distinct rows of one side alone. Equal rows are summed first, in one shuffle of both sides."""
    both = before.withColumn("_b", F.lit(1)).withColumn("_a", F.lit(0)).unionByName(after.withColumn("_b", F.lit(0)).withColumn("_a", F.lit(1)))
    rows = both.groupBy(*before.columns).agg(F.sum("_b").alias("_b"), F.sum("_a").alias("_a"))
    return rows.groupBy(season).agg(F.count_if(F.col("_a") == 0).alias("only_before"), F.count_if(F.col("_b") == 0).alias("only_after"))


def export_build(spark: SparkSession, tables: dict[str, DataFrame], dest: str, seconds: int, newest: str | None, keys: dict[str, list[str]] | None = None) -> None:
    """Each table as Parquet below ``dest``, laid by buckets of its keys (all columns without ``keys``), the fingerprints of all, and the build's seconds and newest run as JSON."""
    prints = []
    for name, df in tables.items():
        by = (keys or {}).get(name, df.columns)
        with_bucket(df, by).write.mode("overwrite").partitionBy("_bucket").parquet(f"{dest}/{name}")
        back = spark.read.schema(df.schema).parquet(f"{dest}/{name}").drop("_bucket")
        prints.append(fingerprint(back, by).withColumn("table_name", F.lit(name)))
    reduce(DataFrame.unionByName, prints).coalesce(1).write.mode("overwrite").parquet(f"{dest}/fingerprints")
    spark.createDataFrame([(seconds, newest)], "seconds long, newest_run_id string").coalesce(1).write.mode("overwrite").json(f"{dest}/build")


def export_diff(spark: SparkSession, before: str, after: str, tables: list[str]) -> DataFrame:
    """``table_name, season, before_rows, after_rows, only_before, only_after`` of two exports whose tables have the same columns.

    The fingerprints decide which buckets differ, and the files of these alone are read: nothing of an equal table is.
    """
    a, b = (spark.read.parquet(f"{d}/fingerprints") for d in (before, after))
    out = None
    for t in tables:
        counts = bucket_counts(a.filter(F.col("table_name") == t), b.filter(F.col("table_name") == t))
        buckets = [r._bucket for r in counts.filter("NOT _same").select("_bucket").distinct().collect()]  # BUCKETS at most
        seasons = counts.groupBy("season").agg(F.sum("before_rows").alias("before_rows"), F.sum("after_rows").alias("after_rows"))
        zero = F.lit(0).cast("long")
        if buckets:
            x, y = (spark.read.parquet(f"{d}/{t}").filter(F.col("_bucket").isin(buckets)).drop("_bucket") for d in (before, after))
            alone = one_sided(x, y).withColumn("_s", F.col("season").cast("string")).drop("season")
            seasons = seasons.join(alone, F.col("season").eqNullSafe(F.col("_s")), "left").drop("_s")
        else:
            seasons = seasons.withColumns({"only_before": zero, "only_after": zero})
        one = seasons.select(F.lit(t).alias("table_name"), "season", "before_rows", "after_rows", *[F.coalesce(c, zero).alias(c) for c in ("only_before", "only_after")])
        out = one if out is None else out.unionByName(one)
    return out


def season_counts(before: DataFrame, after: DataFrame, season: str = "season", keys: list[str] | None = None) -> DataFrame:
    """``season, before_rows, after_rows, only_before, only_after``: rows, and distinct rows of one side alone.

    Only rows of buckets whose fingerprints differ are shuffled and compared; without ``keys`` a bucket is one of whole rows.
    """
    keys = keys or before.columns
    counts = bucket_counts(fingerprint(before, keys, season), fingerprint(after, keys, season))
    odd = counts.filter("NOT _same").select(F.col("season").alias("_s"), F.col("_bucket").alias("_b"))

    def differing(df: DataFrame) -> DataFrame:
        d = with_bucket(df, keys)
        return d.join(odd, F.col(season).cast("string").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")), "left_semi").drop("_bucket")

    alone = one_sided(differing(before), differing(after), season).withColumn("_s", F.col(season).cast("string"))
    by = counts.groupBy("season").agg(F.sum("before_rows").alias("before_rows"), F.sum("after_rows").alias("after_rows"))
    zero = F.lit(0).cast("long")
    return by.join(alone.drop(season), F.col("season").eqNullSafe(F.col("_s")), "left").select(F.col("season").cast(before.schema[season].dataType).alias(season), "before_rows", "after_rows", *[F.coalesce(c, zero).alias(c) for c in ("only_before", "only_after")])


def conflicting_columns(before: DataFrame, after: DataFrame, keys: list[str]) -> list[str]:
    """Columns that differ on some key that both sides have."""
    rest = [c for c in before.columns if c not in keys]
    if not rest:
        return []
    x, y = before.select(*keys, F.struct(*rest).alias("_x")), after.select(*keys, F.struct(*rest).alias("_y"))
    counts = x.join(y, keys).agg(*[F.count_if(~F.col(f"_x.`{c}`").eqNullSafe(F.col(f"_y.`{c}`"))).alias(c) for c in rest]).first()
    return [c for c in rest if counts[c]]


@dataclass
class BuildDiff:
    """Counts by table and season, what is wrong with a table as a whole, and columns with other values on the same keys."""

    counts: list[dict] = field(default_factory=list)
    problems: dict[str, str] = field(default_factory=dict)
    columns: dict[str, list[str]] = field(default_factory=dict)

    @property
    def differing(self) -> list[str]:
        rows = [r["table"] for r in self.counts if r["only_before"] or r["only_after"] or r["before_rows"] != r["after_rows"]]
        return sorted({*self.problems, *rows})


def build_diff(before: dict[str, DataFrame], after: dict[str, DataFrame], keys: dict[str, list[str]], newest: tuple[str | None, str | None]) -> BuildDiff:
    """Two builds table by table, those that one side alone has and those that ``keys`` names included. Only counts by season come to the driver."""
    if newest[0] != newest[1]:
        raise Inconclusive(f"newest runs {newest[0]} and {newest[1]} differ")
    out = BuildDiff()
    for table in sorted({*keys, *before, *after}):
        a, b = before.get(table), after.get(table)
        if a is None and b is None:
            out.problems[table] = "absent from both sides"
            continue
        if a is None or b is None:
            out.problems[table] = "new: absent before" if a is None else "gone: absent after"
            a, b = (b.limit(0), b) if a is None else (a, a.limit(0))
        elif a.dtypes != b.dtypes:
            out.problems[table] = "columns differ"
            continue
        rows = [r.asDict() for r in season_counts(a, b, keys=keys.get(table)).orderBy("season").collect()]
        out.counts += [{"table": table, **r} for r in rows]
        if table not in out.problems and table in out.differing:
            out.columns[table] = conflicting_columns(a, b, keys.get(table, a.columns))
    return out


def build_shape(tables: dict[str, DataFrame], season: str = "season") -> DataFrame:
    """``table_name, season, n_rows``; of a table without a season its rows, with a null season."""
    each = []
    for name, df in tables.items():
        of = F.col(season).cast("string") if season in df.columns else F.lit(None).cast("string")
        each.append(df.groupBy(of.alias("season")).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "season", "n_rows"))
    return reduce(DataFrame.unionByName, each)


@dataclass
class Stages:
    """What Spark did for a name: task seconds, rows and bytes in and out, bytes shuffled and spilled, and the most memory that a stage's tasks used."""

    tasks: int = 0
    task_seconds: float = 0.0
    rows_read: int = 0
    bytes_read: int = 0
    rows_written: int = 0
    bytes_written: int = 0
    shuffle_bytes: int = 0
    spilled_bytes: int = 0
    peak_memory_bytes: int = 0


def stages_of(spark: SparkSession, name: str) -> Stages:
    """The stages of all jobs whose group or description is ``name``, from Spark's own status store, which runs with or without the UI."""
    store, out, seen = spark.sparkContext._jsc.sc().statusStore(), Stages(), set()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    jobs = store.jobsList(None)
    for i in range(jobs.size()):
        job = jobs.apply(i)
        if name not in [x.get() for x in (job.jobGroup(), job.description()) if x.isDefined()]:
            continue
        ids = job.stageIds()
        for k in range(ids.size()):
            if ids.apply(k) in seen:
                continue
            seen.add(ids.apply(k))
            tries = store.stageData(ids.apply(k), False, spark.sparkContext._jvm.java.util.ArrayList(), False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0))
            for t in range(tries.size()):
                s = tries.apply(t)
                out.tasks += s.numCompleteTasks()
                out.task_seconds += s.executorRunTime() / 1000
                out.rows_read += s.inputRecords()
                out.bytes_read += s.inputBytes()
                out.rows_written += s.outputRecords()
                out.bytes_written += s.outputBytes()
                out.shuffle_bytes += s.shuffleWriteBytes()
                out.spilled_bytes += s.diskBytesSpilled()
                out.peak_memory_bytes = max(out.peak_memory_bytes, s.peakExecutionMemory())
    return out


def peak_memory(spark: SparkSession) -> dict[str, int]:
    """The most heap and off-heap bytes that any executor (the driver, where it runs the tasks) has held."""
    executors, out = spark.sparkContext._jsc.sc().statusStore().executorList(False), {"heap_bytes": 0, "off_heap_bytes": 0}
    for i in range(executors.size()):
        peak = executors.apply(i).peakMemoryMetrics()
        if peak.isDefined():
            for name, metric in (("heap_bytes", "JVMHeapMemory"), ("off_heap_bytes", "JVMOffHeapMemory")):
                out[name] = max(out[name], peak.get().getMetricValue(metric))
    return out


class Metrics:
    """What a build took, for its record: seconds and Spark's own figures by relation."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.seconds, self.stages = spark, {}, {}

    @contextmanager
    def timed(self, name: str):
        """Whatever Spark does in here counts for ``name``."""
        began, group = time.monotonic(), f"{name}-{uuid.uuid4().hex}"
        self.spark.sparkContext.setJobGroup(group, name)
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.monotonic() - began
            self.stages[name] = stages_of(self.spark, group)
            self.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    def record(self, staged: dict[str, DataFrame], status: str = "success", trigger: str = "", run_id: str = "") -> dict:
        """The record: when, why and how it ended, seconds by relation and in all, distinct captures of each staged relation, Spark's figures and peak memory."""
        captures = {n: d.agg(F.count_distinct("capture_key")).first()[0] for n, d in staged.items() if "capture_key" in d.columns}
        return {
            "run_id": run_id, "trigger": trigger, "status": status, "built_at": datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "seconds": {n: round(s, 3) for n, s in self.seconds.items()}, "total_seconds": round(sum(self.seconds.values()), 3),
            "captures": captures, "stages": {n: asdict(s) for n, s in self.stages.items()}, "peak_memory": peak_memory(self.spark), "cpu_count": self.spark.sparkContext.defaultParallelism,
        }


def compaction_record(done: list[dict], failed: dict[str, str]) -> dict:
    """What a compaction step did: its units with files, rows and seconds, and why others were left."""
    units = [{"unit": m.get("capture_day") or f"{m['season']} {m['gameweek']}", "files": m["payload_files"], "rows": m["parquet_rows"], "seconds": m.get("seconds")} for m in done]
    return {"units": units, "total_files": sum(u["files"] for u in units), "total_seconds": round(sum(u["seconds"] or 0 for u in units), 3), "failed": failed}
