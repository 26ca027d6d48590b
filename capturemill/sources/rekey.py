"""Re-keying of an archived season: files of a snapshot get the keys that captures have, under one synthetic run.

The whole plan is made first, as a table of old and new paths with digests; a file that maps to nothing, or two that map to one key, refuse
it before a byte is written. The run's id is its moment and the beginning of the archived bootstrap's digest, so the same archive plans the
same keys. Values are kept: bodies are re-serialised compactly, and both digests are recorded. Writing skips files that are there with the
planned digest, so a broken run goes on where it stopped and a second run does nothing; one that is there with another digest refuses.
"""

import json
import posixpath
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Files

RUN_ID = re.compile(r"\d{8}T\d{6}Z-[0-9a-f]{6}")


class RekeyRefused(RuntimeError):
    """A plan that would lose or overwrite something."""


def endpoint(path: Column) -> Column:
    """The endpoint of an archived file by its place in the snapshot; null for an unknown one."""
    period, player = F.regexp_extract(path, r"^gw_(\d{1,2})\.json$", 1), F.regexp_extract(path, r"^players/(\d+)\.json$", 1)
    return (
        F.when(path == "bootstrap.json", "bootstrap-static").when(path == "fixtures.json", "fixtures")
        .when(period != "", F.concat(F.lit("event-live/"), F.lpad(period.cast("int").cast("string"), 2, "0"))).when(player != "", F.concat(F.lit("element-summary/"), player.cast("bigint").cast("string")))
    )


@F.pandas_udf(T.StringType())
def _compact(bodies: pd.Series) -> pd.Series:
    """JSON as text without spaces; numbers keep the digits they are written with."""
    keep = lambda x: _Digits(x)
    return bodies.map(lambda b: _dumps(json.loads(b, parse_float=keep, parse_int=keep)))


class _Digits(str):
    """A number as it is written."""


def _dumps(value) -> str:
    if isinstance(value, _Digits):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_dumps(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_dumps, value)) + "]"
    return json.dumps(value)


def plan(spark: SparkSession, archive: str, season: str, moment: str) -> DataFrame:
    """``old, endpoint, run_id, day, key, archive_sha256, content_sha256, content_length, body`` of every file of an archive; ``moment`` is like ``20240526T034626Z``."""
    root = Files(spark).qualified(archive).rstrip("/") + "/"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(archive)
    raw = raw.select(F.element_at(F.split("path", f"\\Q{root}\\E", 2), -1).alias("old"), "content").withColumn("endpoint", endpoint(F.col("old")))
    unknown = [r.old for r in raw.filter("endpoint IS NULL").select("old").orderBy("old").limit(5).collect()]
    if unknown:
        raise RekeyRefused(f"files without an endpoint: {unknown}")
    if (n := raw.count()) != (there := Files(spark).count_below(archive)):
        raise RekeyRefused(f"{there - n} of {there} files are empty or hidden, and would be lost")
    first = raw.filter("old = 'bootstrap.json'").select(F.sha2("content", 256).alias("sha")).first()
    if first is None:
        raise RekeyRefused("the archive has no bootstrap")
    run = f"{moment}-{first.sha[:6]}"
    if not RUN_ID.fullmatch(run):
        raise RekeyRefused(f"{run} is no run id")
    day = f"{moment[:4]}-{moment[4:6]}-{moment[6:8]}"
    body = _compact(F.col("content").cast("string"))
    out = raw.select("old", "endpoint", F.lit(run).alias("run_id"), F.lit(day).alias("day"), F.sha2("content", 256).alias("archive_sha256"), body.alias("body"))
    key = F.concat(F.lit(f"{season}/fpl/"), "endpoint", F.lit(f"/{day}/{run}/payload.json"))
    out = out.withColumns({"key": key, "content_sha256": F.sha2(F.col("body").cast("binary"), 256), "content_length": F.octet_length("body")})
    twice = [r.key for r in out.groupBy("key").count().filter("count > 1").limit(5).collect()]
    if twice:
        raise RekeyRefused(f"several files for one key: {twice}")
    return out


def _write(dest: str):
    """Files of a task, each written beside its place and then put there; Arrow's file systems reach local paths and object stores from executors."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as afs

        system, base = afs.FileSystem.from_uri(dest)
        for batch in batches:
            done = []
            for key, body, meta in zip(*(batch.column(c).to_pylist() for c in ("key", "body", "metadata")), strict=True):
                at = posixpath.join(base, key)
                system.create_dir(posixpath.dirname(at), recursive=True)
                for path, text in ((posixpath.join(posixpath.dirname(at), "metadata.json"), meta), (at, body)):  # the payload last: it is what a reader looks for
                    new = f"{path}.new"
                    with system.open_output_stream(new) as out:
                        out.write(text.encode())
                    system.move(new, path)
                done.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["key"])

    return run


def rekey(spark: SparkSession, archive: str, dest: str, season: str, moment: str, dry_run: bool = False) -> dict:
    """Move a season's archive to its keys below ``dest``: what was planned, written and found there already."""
    files, planned = Files(spark), plan(spark, archive, season, moment)
    here = posixpath.join(dest, season)
    there = spark.createDataFrame([], "key string, there_sha256 string")
    if files.exists(here):
        root = files.qualified(dest).rstrip("/") + "/"
        got = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "payload.json").load(here)
        there = got.select(F.element_at(F.split("path", f"\\Q{root}\\E", 2), -1).alias("key"), F.sha2("content", 256).alias("there_sha256"))
    j = planned.join(there, "key", "left")
    other = [r.key for r in j.filter("there_sha256 <> content_sha256").select("key").limit(5).collect()]
    if other:
        raise RekeyRefused(f"other content is there: {other}")
    todo = j.filter("there_sha256 IS NULL")
    facts = F.to_json(F.struct(F.lit(season).alias("season"), "endpoint", "run_id", F.col("day").alias("extraction_date"), F.lit(True).alias("synthetic"), F.col("old").alias("archive_path"), "archive_sha256", "content_sha256", "content_length"))
    counts = j.agg(F.count(F.lit(1)).alias("planned"), F.count("there_sha256").alias("there"), F.max("run_id").alias("run_id")).first()
    written = 0
    if not dry_run and counts.planned > counts.there:
        uri = re.sub(r"^file:/(?!/)", "file:///", files.qualified(dest))
        written = todo.select("key", "body", facts.alias("metadata")).mapInArrow(_write(uri), "key string").count()
    return {"run_id": counts.run_id, "planned": counts.planned, "already_there": counts.there, "written": written}
