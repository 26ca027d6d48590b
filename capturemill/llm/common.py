"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Where that is unset, a temporary one on one machine; on a cluster this is an error."""
    got = spark.sparkContext._jsc.sc().getCheckpointDir()
    if got.isDefined():
        return got.get()
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="ckpt")


def small_batches(spark: SparkSession, most: int = 4_000_000) -> None:
    """Bound the batches that go to Python by bytes, so that long texts don't add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def trimmed(run):
    """The batches of ``run``, after which the worker gives its free memory back, as it stays on for other tasks."""

    def all_of(batches):
        yield from run(batches)
        give_back()

    return all_of


def give_back() -> None:
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def released(df: DataFrame) -> DataFrame:
    """Let the driver collect what lies behind ``df``, so that finished shuffles and checkpoints leave the disks."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder: smaller than a checkpoint, and read by column."""
    path = os.path.join(shared_folder(df.sparkSession), f"table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text as an array (null: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def n_words(text: Column) -> Column:
    """The number of words (null: 0), without an array of them: each word and the space after it become one character."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.coalesce(F.length(F.regexp_replace(trimmed, WORD + "+" + SPACES.replace("]+", "]*+"), "x")), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


# --- hashing of words by array arithmetic -------------------------------------------------------------

_U = np.uint64
_R = _U(0x9E3779B97F4A7C15)
_R_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCT = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_pow = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
_PIECE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every other."""
    h = h ^ (h >> _U(31))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        size = max(n, _PIECE + 1024)
        with np.errstate(over="ignore"):
            for k, r in enumerate((_R, _R_INV)):
                p = np.full(size, r, dtype=np.uint64)
                p[0] = 1
                _pow[k] = np.multiply.accumulate(p)
    return _pow[0], _pow[1]


def _piece_hashes(data: bytes, separators: np.ndarray) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    inside = ~separators[b]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(len(b) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_LOWER[b] * up[: len(b)], out=sums[1:])
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def word_hashes(data: bytes, separators: np.ndarray = _SPACE) -> np.ndarray:
    """64-bit hashes of a text's words in order, A-Z taken as a-z. Long texts are worked piece by piece."""
    if len(data) <= _PIECE:
        return _piece_hashes(data, separators)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data) and not separators[data[end]]:
            end += 1
        parts.append(_piece_hashes(data[at:end], separators))
        at = end
    return np.concatenate(parts)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(count, dtype=np.uint64)
        for j in range(n):
            h = (h ^ words[j : j + count]) * _R + _U(j + 1)
        return mix(h)


def text_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
