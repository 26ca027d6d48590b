"""A corpus pipeline of five operators over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and gives the rows that go on. A stage's rows are written as Parquet in the shared
folder and read again, so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from capturemill.llm import decontaminate, jaccard, langid, mixing, sharding
from capturemill.llm.common import shared_folder, small_batches, table

#: A text goes when no language's share of the posterior reaches this, or when it has no letter.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a known language."""
    return langid.keep_known(docs, MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the least id."""
    return jaccard.min_keep(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.apply_mix(docs)


def hilbert_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their shard and place in it."""
    return sharding.shard_documents(docs, n_shards=40)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", source_mixing), ("sharding", hilbert_sharding)]

#: Learned models and keyed draws can't be put in SQL; tests/llm/test_pipeline.py holds the stages against brute-force versions.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. A stage's table is deleted when the next one's is whole; the last one's is the result's and stays."""
    small_batches(spark)
    shared, docs, before = shared_folder(spark), table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = os.path.join(shared, f"pipeline-{uuid.uuid4().hex}-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if before is not None:
            _delete(spark, before)
        before = out
    return docs
