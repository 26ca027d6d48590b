"""Small-file compaction with reconciliation, and the union read of compacted and raw units.

A unit is a day, or a settled period of a season. Its payloads become one part in a folder of its own, each file read once: parsed, and
hashed by its bytes. The part is reconciled by joins with the listing and the index, and then a new manifest names it. The
manifest is the commit, and is written last and once: of two runs that compact one unit, one commits and the other takes its part
away. Everything goes through Spark and the file system of the paths' scheme (:mod:`.files`).
"""

from __future__ import annotations

import datetime
import json
import posixpath
import time
import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capturemill.functions.scalars import segment

from .declared import declared_schema, declared_typed, read_captures
from .files import Files, listing


class CompactionError(RuntimeError):
    """A unit doesn't reconcile."""


def day_listing(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, modified, day`` of the payloads below ``root``; the day is the third part from the end."""
    return listing(spark, root).withColumn("day", segment(F.col("path"), -3))


def days_of(spark: SparkSession, root: str) -> list[str]:
    """The days with payloads, in order."""
    return [r.day for r in day_listing(spark, root).select("day").distinct().orderBy("day").collect()]  # a row for each day


def _committed(files: Files, dest: str, pattern: str, named: str) -> dict[str, dict]:
    """Manifests by their place below ``dest/_manifest``. An unreadable one, one of another unit than its name says (``named`` reads it), or one whose part is missing fails."""
    out, base = {}, files.qualified(posixpath.join(dest, "_manifest"))
    for path in files.names(posixpath.join(dest, "_manifest", pattern)):
        unit = path.removeprefix(base + "/").removesuffix(".json")
        try:
            m = json.loads(files.read(path))
            said = named.format(**m)
        except (ValueError, KeyError, TypeError) as e:
            raise CompactionError(f"unreadable manifest {path}") from e
        if said != unit:
            raise CompactionError(f"{path} is of {said}")
        m["part"] = posixpath.join(dest, m.get("part", unit))
        if not files.exists(m["part"]):
            raise CompactionError(f"the part of {unit} is missing")
        out[unit] = m
    return out


def manifests(spark: SparkSession, dest: str) -> dict[str, dict]:
    """Manifests by day."""
    return _committed(Files(spark), dest, "*.json", "{capture_day}")


def hashed_captures(spark: SparkSession, paths: list[str], fields: dict) -> DataFrame:
    """``path, sha256`` and the declared columns of the records of each file, read once. A top-level array gives a row for each element; an unreadable file gives none."""
    kind = declared_schema(fields)
    body = F.col("content").cast("string")
    one = F.from_json(body, kind)
    records = F.when(F.startswith(F.ltrim(body), F.lit("[")), F.from_json(body, T.ArrayType(kind))).when(F.coalesce(*[one[c].isNotNull() | F.lit(None) for c in fields]), F.array(one))
    raw = spark.read.format("binaryFile").load(paths)
    return raw.select("path", F.sha2("content", 256).alias("sha256"), F.explode(records).alias("_r")).select("path", "sha256", "_r.*")


def _differences(part: DataFrame, index: DataFrame, strip: str) -> int:
    """Keys and digests of one side alone."""
    key = F.element_at(F.split("path", f"\\Q{strip}\\E", 2), -1) if strip else F.col("path")
    have = part.select(key.alias("key"), "sha256").distinct().withColumn("_have", F.lit(True))
    both = have.join(index.select("key", F.col("content_sha256").alias("sha256")).distinct().withColumn("_want", F.lit(True)), ["key", "sha256"], "full")
    return both.filter("_have IS NULL OR _want IS NULL").count()


def _compact(spark: SparkSession, dest: str, unit: str, said: dict, files: DataFrame, patterns: list[str], fields: dict, index: DataFrame | None, strip: str, one_row: bool = False) -> dict:
    """Write a unit's part, reconcile it, and commit its manifest."""
    fs = Files(spark)
    part = posixpath.join(unit, f"part-{uuid.uuid4().hex}")
    at = posixpath.join(dest, part)
    kept = False
    try:
        hashed_captures(spark, patterns, fields).coalesce(1).write.option("compression", "zstd").parquet(at)
        back = spark.read.parquet(at)
        got = back.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("path").alias("p")).first()
        n_files = sum(fs.count(p) for p in patterns)
        strangers = files.select("path").join(back.select("path").distinct(), "path", "left_anti").count()
        if got.p != n_files or strangers:  # an empty file is no row of a listing
            raise CompactionError(f"{unit}: {n_files} files, {got.p} in the part, {strangers} of those listed missing")
        if one_row and got.n != n_files:
            raise CompactionError(f"{unit}: {n_files} files, {got.n} rows")
        if index is not None and (odd := _differences(back, index, strip)):
            raise CompactionError(f"{unit}: {odd} keys or digests differ from the index")
        manifest = {**said, "payload_files": n_files, "parquet_rows": got.n, "distinct_filenames": got.p, "part": part, "compacted_at": datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")}
        try:
            fs.put(posixpath.join(dest, "_manifest", f"{unit}.json"), json.dumps(manifest))
        except FileExistsError as e:
            raise CompactionError(f"{unit}: another run has compacted it") from e
        kept = True
    finally:
        if not kept:
            fs.delete(at)
    return manifest


def day_patterns(spark: SparkSession, root: str, days: list[str], below: str | None = None) -> list[str]:
    """Patterns of the payloads of some days: ``below`` is a payload's pattern under ``root``, whose third part from the end is the day; without it one is made for each depth that has payloads."""
    if below is None:
        up = len(Files(spark).qualified(root).rstrip("/").split("/"))
        found = day_listing(spark, root).filter(F.col("day").isin(days)).select("day", (F.size(F.split("path", "/")) - up).alias("n")).distinct().collect()  # a row for each day and depth
        return sorted("/".join([root.rstrip("/"), *["*"] * (r.n - 3), r.day, "*", "payload.json"]) for r in found)
    parts = below.split("/")
    return ["/".join([root.rstrip("/"), *parts[:-3], day, *parts[-2:]]) for day in sorted(days)]


def compact_day(spark: SparkSession, root: str, day: str, fields: dict, dest: str, index: DataFrame | None = None, strip: str = "") -> dict:
    """Write a day's payloads below ``root`` as one part, reconcile, and only then commit its manifest.

    Every listed file must be in the part and, with ``index`` (``key, content_sha256``), keys and digests must agree. A day that has a manifest stays as it is.
    """
    files = day_listing(spark, root).filter(F.col("day") == day)
    return _compact(spark, dest, day, {"capture_day": day}, files, day_patterns(spark, root, [day]), fields, index, strip)


def select_days(spark: SparkSession, root: str, dest: str, today: str, runs: list[dict] = (), close_days: int = 1) -> list[str]:
    """Closed days with payloads and no manifest yet, oldest first.

    A day is closed ``close_days`` before ``today`` (a date in ISO form), and while no run of the day (``extraction_date``) is IN_PROGRESS.
    """
    done = manifests(spark, dest)
    last = (datetime.date.fromisoformat(today) - datetime.timedelta(days=close_days)).isoformat()
    busy = {r.get("extraction_date") for r in runs if r.get("status") == "IN_PROGRESS"}
    return [d for d in days_of(spark, root) if d <= last and d not in done and d not in busy]


def run_step(spark: SparkSession, root: str, dest: str, fields: dict, today: str, budget_seconds: float, index: DataFrame | None = None, strip: str = "", runs: list[dict] = (), close_days: int = 1) -> tuple[list[dict], dict[str, str]]:
    """Compact days until the budget is spent: the manifests of what was done with its ``seconds``, and what failed. A begun day ends, and a failing day, whatever its error, is left for the next run. ``index`` has ``day, key, content_sha256``."""
    began, done, failed = time.monotonic(), [], {}
    for day in select_days(spark, root, dest, today, runs, close_days):
        if (now := time.monotonic()) - began >= budget_seconds:
            break
        try:
            got = compact_day(spark, root, day, fields, dest, None if index is None else index.filter(F.col("day") == day), strip)
            done.append({**got, "seconds": round(time.monotonic() - now, 3)})
        except (CompactionError, PySparkException, OSError) as e:
            failed[day] = str(e)
    return done, failed


def _union(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise CompactionError("there is nothing to read")
    return reduce(DataFrame.unionByName, parts)


def _read_parts(spark: SparkSession, done: dict[str, dict], fields: dict) -> list[DataFrame]:
    """Committed parts in the declared shape. Parts of one schema are one scan, however many units there are."""
    by_schema: dict[str, list[str]] = {}
    for unit in sorted(done):
        by_schema.setdefault(spark.read.parquet(done[unit]["part"]).schema.json(), []).append(done[unit]["part"])
    return [declared_typed(spark.read.parquet(*of), fields, ["path"]) for of in by_schema.values()]


def _read_raw(spark: SparkSession, patterns: list[str], fields: dict) -> DataFrame:
    return declared_typed(read_captures(spark, patterns, fields), fields, ["path"])


def fixed_part(below: str) -> str:
    """A pattern's parts before its first wildcard."""
    return "/".join(below.split("/")[: [*("*" in x for x in below.split("/")), True].index(True)])


def compacted_read(spark: SparkSession, root: str, dest: str, fields: dict, below: str | None = None, history: str | None = None) -> DataFrame:
    """Days with a manifest from their parts, the other days and all of the ported seasons below ``history`` from raw files, each coerced to the declared shape.

    ``below`` is the payloads' pattern under ``root``, and under each season of ``history``. The raw tail is what a listing has beyond the
    manifests' days. Every capture is read once.
    """
    done = manifests(spark, dest)
    parts = _read_parts(spark, done, fields)
    sealed = spark.createDataFrame([(d,) for d in done], "day string")
    there = day_listing(spark, posixpath.join(root, fixed_part(below)) if below else root)
    tail = [r.day for r in there.join(F.broadcast(sealed), "day", "left_anti").select("day").distinct().collect()]  # a row for each day
    if tail:
        parts.append(_read_raw(spark, day_patterns(spark, root, tail, below), fields))
    if history:
        if below is None:
            raise ValueError("ported seasons are read by a pattern")
        if Files(spark).names(posixpath.join(history, "*", fixed_part(below))):
            parts.append(_read_raw(spark, [posixpath.join(history, "*", below)], fields))
    return _union(parts)


def raw_read(spark: SparkSession, root: str, fields: dict, below: str, history: str | None = None, before: str | None = None) -> DataFrame:
    """Every capture from raw files; with ``before``, those of days before it. No capture is an error."""
    files, parts = Files(spark), []
    for top, pattern, from_ in ((root, below, posixpath.join(root, fixed_part(below))), (history, f"*/{below}", history)):
        if top is None or not files.exists(from_):
            continue
        there = day_listing(spark, from_).filter(F.contains("path", F.lit(f"/{fixed_part(below)}/")))
        days = [r.day for r in (there.filter(F.col("day") < before) if before else there).select("day").distinct().collect()]  # a row for each day
        if days:
            parts.append(_read_raw(spark, day_patterns(spark, top, days, pattern), fields))
    return _union(parts)


# --- units of a season and a period, sealed once the period is settled ------------------------------------


def period_listing(spark: SparkSession, root: str) -> DataFrame:
    """``path, season, period, run_id`` of the payloads ``<season>/<period>/<entry>/<day>/<run>/payload.json`` below ``root``."""
    up = len(Files(spark).qualified(root).rstrip("/").split("/"))
    found = listing(spark, root).filter(F.size(F.split("path", "/")) == up + 6)
    return found.select("path", segment(F.col("path"), -6).alias("season"), segment(F.col("path"), -5).alias("period"), segment(F.col("path"), -2).alias("run_id"))


def period_manifests(spark: SparkSession, dest: str) -> dict[tuple[str, str], dict]:
    """Manifests by season and period."""
    found = _committed(Files(spark), dest, "season=*/gameweek=*.json", "season={season}/gameweek={gameweek}")
    return {(m["season"], str(m["gameweek"])): m for m in found.values()}


def marker_season(captures: list[dict] | None, period: str, endpoint: str = "entry-picks") -> str:
    """The one season that a settlement marker's run has for its period, by the run's finalised captures (endpoint, season)."""
    if captures is None:
        raise CompactionError("the marker's run has no finalised index")
    seasons = {c["season"] for c in captures if (p := c["endpoint"].split("/"))[0] == endpoint and len(p) > 2 and p[2] == period}
    if len(seasons) != 1:
        raise CompactionError(f"the marker's run has seasons {sorted(map(str, seasons))} for {period}")
    return seasons.pop()


def _period_pattern(root: str, season: str, period: str) -> str:
    return posixpath.join(root, season, period, "*", "*", "*", "payload.json")


def compact_period(spark: SparkSession, root: str, season: str, period: str, fields: dict, dest: str, captures: dict[str, list[dict]], prefix: str = "raw/fpl/entry-picks") -> dict:
    """Write a settled period's payloads as one part. Each run must have a finalised index (``captures``: run to key and content_sha256), whose keys and digests are the files'."""
    files = period_listing(spark, root).filter((F.col("season") == season) & (F.col("period") == period))
    runs = sorted(r.run_id for r in files.select("run_id").distinct().collect())  # a row for each run of the period
    if not runs:
        raise CompactionError("no payload files")
    if lost := [r for r in runs if captures.get(r) is None]:
        raise CompactionError(f"runs {lost} have no finalised index")
    below = f"{prefix}/{season}/{period}/"
    index = spark.createDataFrame([(c["key"].removeprefix(prefix + "/"), c["content_sha256"]) for r in runs for c in captures[r] if c["key"].startswith(below)], "key string, content_sha256 string")
    said = {"season": season, "gameweek": int(period), "run_ids": runs}
    return _compact(spark, dest, f"season={season}/gameweek={period}", said, files, [_period_pattern(root, season, period)], fields, index, Files(spark).qualified(root).rstrip("/") + "/", one_row=True)


def compact_settled(spark: SparkSession, root: str, dest: str, fields: dict, markers: list[dict], captures: dict[str, list[dict]]) -> tuple[list[tuple[str, str]], dict[str, str]]:
    """Compact every marked period (``event, run_id``) without a manifest; what is sealed is never written again, and a failing one is left with its reason."""
    done, sealed, failed = [], period_manifests(spark, dest), {}
    for m in markers:
        period = str(m["event"])
        try:
            unit = (marker_season(captures.get(m["run_id"]), period), period)
            if unit in sealed or unit in done:
                continue
            compact_period(spark, root, *unit, fields, dest, captures)
            done.append(unit)
        except (CompactionError, PySparkException, OSError) as e:
            failed[period] = str(e)
    return done, failed


def period_read(spark: SparkSession, root: str, dest: str, fields: dict) -> DataFrame:
    """Sealed periods from their parts, all others from raw files, each coerced to the declared shape."""
    done = period_manifests(spark, dest)
    sealed = spark.createDataFrame(list(done), "season string, period string")
    tail = period_listing(spark, root).join(F.broadcast(sealed), ["season", "period"], "left_anti").select("season", "period").distinct().collect()  # a row for each period
    parts = _read_parts(spark, {"/".join(k): m for k, m in done.items()}, fields)
    if tail:
        parts.append(_read_raw(spark, sorted(_period_pattern(root, r.season, r.period) for r in tail), fields))
    return _union(parts)
