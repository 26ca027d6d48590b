"""Where a run came from, when its manifest doesn't say."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capturemill.functions.scalars import seconds_between


def derive_origin(runs: DataFrame, actions: DataFrame, logs: DataFrame, seconds: int = 300) -> DataFrame:
    """``run_id, origin_kind, action_id`` of each run of ``runs`` (run_id, started_at, ported).

    ``history_port`` for ported runs; ``ci`` if just one action (action_id, action_at) whose log names the run (``logs``: action_id, run_id) began up to
    ``seconds`` before it; else ``local``. Joins by key, then the range: no run meets all actions.
    """
    named = runs.filter("not ported").join(logs.distinct(), "run_id").join(actions, "action_id")
    after = seconds_between(F.col("action_at"), F.col("started_at"))
    one = named.filter((after >= 0) & (after <= seconds)).groupBy("run_id").agg(F.count(F.lit(1)).alias("_n"), F.min("action_id").alias("action_id")).filter("_n = 1").drop("_n")
    kind = F.when(F.col("ported"), "history_port").when(F.col("action_id").isNotNull(), "ci").otherwise("local")
    return runs.select("run_id", "ported").join(one, "run_id", "left").select("run_id", kind.alias("origin_kind"), "action_id")
