"""Lloyd's clustering of integer vectors by deltas: assignments and global sums persist, and a round touches what moved.

Vectors are written once, in buckets of a row key; each round's assignments (owner and squared distance) are a table of the same
buckets, so that the two meet without a shuffle. A round compares a vector with the centroids that changed since the last one, and with
all of them only if its own owner changed. A vector that changes hands adds itself to one sum and takes itself from another; each task
gives one signed row of sums for each cluster, and the driver adds up ``k`` rows. Sums are exact integers, so the outcome does not
depend on the order of rows or tasks.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component are left out; components are limited to
``LIMIT``, beyond which a squared distance would not fit a long; fewer vectors than ``k`` make fewer clusters; equal first vectors leave
the later cluster empty, and it stays where it is; rows with equal or null ids are separate vectors (a null id comes last among the
first centroids); an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, shared_folder, small_batches, trimmed, written

#: Largest component: 64 squares of twice this fit a long.
LIMIT = 1 << 27
#: Vectors for each bucket, up to as many buckets as the session has shuffle partitions.
BUCKET_ROWS = 10_000


def integers(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id, q``: the vectors kept, each component as ``floor(scale * x)``."""
    v = F.col(vector_col)
    kept = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    q = F.transform(v, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    return df.where(v.isNotNull() & kept).select(F.col(id_col).alias("vec_id"), q.alias("q"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    return [list(r.q) for r in vectors.orderBy(order.asc_nulls_last(), "q").select("q").limit(k).collect()]


def reassign(x: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New owners and distances. Rows of an owner that stayed meet the changed centroids only; ties go to the smaller number."""
    owner, distance = owner.copy(), distance.copy()
    lost = (owner < 0) | changed[owner]
    distance[lost] = np.iinfo(np.int64).max
    owner[lost] = len(centroids)
    for c, at in enumerate(centroids):
        rows = np.arange(len(x)) if changed[c] else np.flatnonzero(lost)
        if not len(rows):
            continue
        d = x[rows] - at
        d = np.einsum("ij,ij->i", d, d)
        better = (d < distance[rows]) | ((d == distance[rows]) & (c < owner[rows]))
        owner[rows[better]] = c
        distance[rows[better]] = d[better]
    return owner, distance


def _round(centroids: list[list[int]], changed: list[bool]):
    """Joined vectors and assignments to new assignments, and a last row of signed sums for each cluster that the task's rows left or joined."""

    def run(batches):
        import pyarrow as pa

        k, dims = len(centroids), len(centroids[0])
        at, moved = np.array(centroids, dtype=np.int64), np.array(changed)
        sums, counts, key = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64), None
        kind = pa.list_(pa.int64())
        names = ["rid", "owner", "distance", "members", "delta"]
        for batch in batches:
            if not batch.num_rows:
                continue
            rid = batch.column("rid")
            key = rid[0].as_py() if key is None else key
            x = batch.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            old = batch.column("owner").to_numpy(zero_copy_only=False).astype(np.int64)
            new, distance = reassign(x, old, batch.column("distance").to_numpy(zero_copy_only=False).astype(np.int64), at, moved)
            went = np.flatnonzero(new != old)
            np.add.at(sums, new[went], x[went])
            np.add.at(counts, new[went], 1)
            left = went[old[went] >= 0]
            np.subtract.at(sums, old[left], x[left])
            np.subtract.at(counts, old[left], 1)
            yield pa.RecordBatch.from_arrays([rid, pa.array(new, pa.int32()), pa.array(distance), pa.nulls(len(new), pa.int64()), pa.nulls(len(new), kind)], names)
        c = np.flatnonzero((counts != 0) | sums.any(axis=1))
        if len(c):
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(c), pa.int64()), pa.array(c, pa.int32()), pa.nulls(len(c), pa.int64()), pa.array(counts[c]), pa.array(sums[c].tolist(), kind)], names)

    return trimmed(run)


class _Tables:
    """Tables in the buckets of ``rid``, in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def put(self, df: DataFrame) -> str:
        name = f"lloyd_{uuid.uuid4().hex}"
        self.paths[name] = os.path.join(shared_folder(self.spark), name)
        df.write.option("path", self.paths[name]).bucketBy(self.buckets, "rid").saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector kept, and ``centroid`` itself."""
    spark = df.sparkSession
    small_batches(spark)
    vectors = integers(df, id_col, vector_col, dims, scale)
    centroids = first_centroids(vectors, k, seed)
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<int>"
    if not centroids:
        return spark.createDataFrame([], schema)
    tables = _Tables(spark, max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vectors.count() // BUCKET_ROWS))))
    keyed = vectors.withColumn("rid", F.monotonically_increasing_id()).repartition(tables.buckets, "rid")
    base = tables.put(keyed)
    released(keyed)
    changed, state = [True] * len(centroids), None
    sums, counts = [[0] * dims for _ in centroids], [0] * len(centroids)
    for r in range(rounds + 1):
        if state is None:
            joined = spark.table(base).select("rid", "q", F.lit(-1).alias("owner"), F.lit(0).cast("long").alias("distance"))
        else:
            joined = spark.table(base).join(spark.table(state).where("delta IS NULL").select("rid", "owner", "distance"), "rid").select("rid", "q", "owner", "distance")
        after = tables.put(joined.mapInArrow(_round(centroids, changed), "rid long, owner int, distance long, members long, delta array<long>"))
        if state is not None:
            tables.drop(state)
        state = after
        if r == rounds:
            break
        moves = spark.table(state).where("delta IS NOT NULL").groupBy("owner").agg(F.sum("members").alias("members"), *[F.sum(F.col("delta")[i]).alias(f"d{i}") for i in range(dims)])
        for row in moves.collect():  # one row for each cluster
            counts[row.owner] += row.members
            sums[row.owner] = [a + row[f"d{i}"] for i, a in enumerate(sums[row.owner])]
        new = [[s // n for s in total] if n else old for total, n, old in zip(sums, counts, centroids, strict=True)]
        changed = [a != b for a, b in zip(new, centroids, strict=True)]
        centroids = new
        if not any(changed):
            break
    owned = spark.table(state).where("delta IS NULL").select("rid", F.col("owner").alias("cluster"), "distance")
    inertia = {r.cluster: r.total for r in owned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # one row for each cluster
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(c, inertia[c], sum(inertia.values()), digest[c], centroids[c]) for c in sorted(inertia)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<int>")
    out = written(spark.table(base).select("rid", "vec_id").join(owned, "rid").join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"))
    for name in list(tables.paths):
        tables.drop(name)
    return released(out)
