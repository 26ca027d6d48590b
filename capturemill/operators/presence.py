"""Key presence: whether the records of a source's newest live run still hold the keys that staging reads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The findings' texts.
REMOVED = "key absent from every record"
PARTIAL = "key absent from some records"
NO_CAPTURE = "no admitted live capture"
NO_PAYLOAD = "latest admitted run has captures without a payload file; checked the newest captures with one"


def consumed_key_specs(columns: dict[str, dict]) -> list[tuple[str, str, str | None]]:
    """``(column, key, record path)`` of each declared column, but for those exempt for a reason that isn't blank."""
    return [(name, name.rsplit(".", 1)[-1], meta.get("record_path")) for name, meta in columns.items() if not (meta.get("presence_exempt") or "").strip()]


def latest_live_run(admitted: DataFrame, endpoint: str, present: DataFrame | None = None) -> DataFrame:
    """``capture_key, run_id`` of all captures of the run of an endpoint's newest live capture; with ``present`` only captures in it count. A maximum, not a window over all."""
    live = admitted.filter(F.startswith("capture_key", F.lit("raw/")) & (F.split_part("endpoint", F.lit("/"), F.lit(1)) == endpoint)).select("capture_key", "run_id", "observed_at")
    if present is not None:
        live = live.join(present.select("capture_key"), "capture_key", "left_semi")
    newest = live.agg(F.max(F.struct("observed_at", "run_id")).alias("_newest")).select(F.col("_newest.run_id").alias("_run"))
    return live.join(F.broadcast(newest), F.col("run_id") == F.col("_run")).select("capture_key", "run_id")  # one row


def latest_live_run_missing(admitted: DataFrame, endpoint: str, present: DataFrame) -> DataFrame:
    """``run_id, captures_without_bytes`` of the newest live run, if it has captures that aren't in ``present``."""
    gone = latest_live_run(admitted, endpoint).join(present.select("capture_key"), "capture_key", "left_anti")
    return gone.groupBy("run_id").agg(F.count(F.lit(1)).alias("captures_without_bytes"))


def records_at(objects: DataFrame, path: str | None, *keep: str) -> DataFrame:
    """``rec``, the JSON texts at a path of names and ``[*]`` below ``$`` in each ``json``, with the columns ``keep``; null ones are left out."""
    rec = objects.select(*keep, F.col("json").alias("rec"))
    for step in re.findall(r"\[\*\]|[^.\[\]$]+", path or "$"):
        rec = rec.select(*keep, (F.explode(F.from_json("rec", "array<string>")) if step == "[*]" else F.get_json_object("rec", f"$['{step}']")).alias("rec"))
    return rec.filter("rec is not null")


def source_key_presence(source: str, specs: list[tuple[str, str, str | None]], captures: DataFrame, objects: DataFrame) -> DataFrame:
    """``source_name, column_name, run_id, captures, records, missing``, a row for each spec. A key with a null value is present.

    ``captures``: capture_key and run_id; ``objects``: capture_key and json. One pass over the records of each path. What isn't in an array
    is one record of a capture, however many parts the capture comes in, and has the keys of all of them.
    """
    spark = captures.sparkSession
    payloads = objects.join(captures.select("capture_key"), "capture_key", "left_semi")
    out = spark.createDataFrame([], "column_name string, records long, missing long")
    for path in dict.fromkeys(p for _, _, p in specs):
        of = [(c, k) for c, k, p in specs if p == path]
        keys = records_at(payloads, path, "capture_key").select("capture_key", F.json_object_keys("rec").alias("k"))
        has = keys.select("capture_key", *[F.coalesce(F.array_contains("k", k), F.lit(False)).alias(f"h{i}") for i, (_, k) in enumerate(of)])
        if "[*]" not in (path or "$"):
            has = has.groupBy("capture_key").agg(*[F.bool_or(f"h{i}").alias(f"h{i}") for i in range(len(of))])
        lacking = [F.count_if(~F.col(f"h{i}")).alias(f"m{i}") for i in range(len(of))]
        counts = has.agg(F.count(F.lit(1)).alias("records"), *lacking)
        out = out.union(counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("records"), F.col(f"m{i}").alias("missing")) for i, (c, _) in enumerate(of)])).alias("r")).select("r.*"))
    run = captures.agg(F.min("run_id").alias("run_id"), F.count(F.lit(1)).alias("captures"))
    return out.crossJoin(F.broadcast(run)).select(F.lit(source).alias("source_name"), "column_name", "run_id", "captures", "records", "missing")  # one row of the run


def source_presence(source: str, specs: list[tuple[str, str, str | None]], admitted: DataFrame, endpoint: str, objects: DataFrame) -> DataFrame:
    """Presence in a source's newest live captures that have a payload, with ``latest_run_id, latest_run_missing_bytes``: the newest live run of all and its captures without one, else null and 0."""
    present = objects.select("capture_key").distinct()
    got = source_key_presence(source, specs, latest_live_run(admitted, endpoint, present), objects)
    gap = latest_live_run_missing(admitted, endpoint, present).agg(F.max("run_id").alias("latest_run_id"), F.coalesce(F.max("captures_without_bytes"), F.lit(0)).cast("long").alias("latest_run_missing_bytes"))
    return got.crossJoin(F.broadcast(gap))  # one row of the gap


def source_findings(presence: DataFrame, mode: str) -> DataFrame:
    """Findings of presence rows that also have ``latest_run_id, latest_run_missing_bytes``.

    ``removed``: keys that no record has. ``partial``: keys that some records lack, sources without a live capture, and sources whose newest run has
    captures without a payload. Columns without records give no finding of a key.
    """
    if mode not in ("removed", "partial"):
        raise ValueError(mode)
    cols = ["source_name", "column_name", "run_id", "captures", "records", "missing"]
    some = presence.filter("captures > 0")
    if mode == "removed":
        return some.filter("records > 0 and missing = records").select(*cols, F.lit(REMOVED).alias("finding"))
    text, zero = F.lit(None).cast("string"), F.lit(0).cast("long")
    none = presence.filter("captures = 0").select("source_name").distinct().select("source_name", text, text, zero, zero, zero, F.lit(NO_CAPTURE))
    lost = presence.filter("latest_run_missing_bytes > 0").select("source_name", "latest_run_id", "latest_run_missing_bytes").distinct()
    lost = lost.select("source_name", text, "latest_run_id", zero, zero, F.col("latest_run_missing_bytes").cast("long"), F.lit(NO_PAYLOAD))
    return some.filter("missing > 0 and missing < records").select(*cols, F.lit(PARTIAL).alias("finding")).union(none).union(lost)


def consumed_key_findings(source: str, specs: list[tuple[str, str, str | None]], captures: DataFrame, objects: DataFrame, mode: str) -> DataFrame:
    """Presence and findings in one, for a run whose captures all have payloads."""
    presence = source_key_presence(source, specs, captures, objects)
    return source_findings(presence.withColumn("latest_run_id", F.lit(None).cast("string")).withColumn("latest_run_missing_bytes", F.lit(0)), mode)
