"""Reading semi-structured captures under a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A declaration: a field's name with None (a leaf), a dict (an object) or a list of one dict (an array of objects).
Declaration = dict


def declared_schema(fields: Declaration) -> T.StructType:
    """The read schema of a declaration; every leaf is a string, so that types never depend on the data."""

    def kind(v):
        if v is None:
            return T.StringType()
        return T.ArrayType(declared_schema(v[0])) if isinstance(v, list) else declared_schema(v)

    return T.StructType([T.StructField(k, kind(v)) for k, v in fields.items()])


def read_captures(spark: SparkSession, paths: list[str], fields: Declaration, strict: bool = False) -> DataFrame:
    """JSON captures with their ``path``. Undeclared fields aren't read and absent ones are null.

    A top-level array gives one row per element. Unreadable payloads are left out, or fail the read when ``strict`` (for manifests).
    """
    if not paths:
        raise ValueError("there is nothing to read")
    schema = declared_schema(fields)
    if strict:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(paths).select("*", F.col("_metadata.file_path").alias("path"))
    broken = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(broken).option("multiLine", True).option("mode", "PERMISSIVE").json(paths)
    return df.select("*", F.col("_metadata.file_path").alias("path")).filter(F.col("_corrupt_record").isNull() & (F.to_json(F.struct(*fields)) != "")).drop("_corrupt_record")  # Spark refuses a read of the corrupt column alone


def declared_records(df: DataFrame, fields: Declaration, path: str, keep: list[str]) -> DataFrame:
    """Rows of the records at ``$`` , ``$[*]`` or ``$.<array>[*]`` with the declared fields alone, beside the columns ``keep``."""
    if not fields:
        raise ValueError("no declared column")
    if path in ("$", "$[*]"):
        return df.select(*keep, *fields)
    if path.startswith("$.") and path.endswith("[*]") and path[2:-3].isidentifier():
        array = path[2:-3]
        if not isinstance(fields.get(array), list):
            raise ValueError(f"{array} isn't a declared array")
        return df.select(*keep, F.explode(array).alias("_r")).select(*keep, *[F.col(f"_r.{c}").alias(c) for c in fields[array][0]])
    raise ValueError(f"unsupported record path {path}")


def declared_typed(df: DataFrame, fields: Declaration, keep: list[str]) -> DataFrame:
    """Coerce a relation whose types have drifted to the declared all-string shape."""
    have = [c for c in fields if c in df.columns]
    j = F.from_json(F.to_json(F.struct(*have)) if have else F.lit("{}"), declared_schema(fields))
    return df.select(*keep, j.alias("_j")).select(*keep, "_j.*")


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Named columns cast; empty strings are null first. Integers written with decimals are rounded."""

    def one(c: str) -> Column:
        v = F.nullif(F.col(c), F.lit("")) if dict(df.dtypes)[c] == "string" else F.col(c)
        # As decimals, so that no digit of a large integer is lost.
        return (F.round(v.cast("decimal(38,9)")) if kinds[c] in ("int", "bigint") else v).cast(kinds[c])

    return df.select(*[one(c).alias(c) if c in kinds else F.col(c) for c in df.columns])


def parsed(payloads: DataFrame, fields: Declaration, path: str) -> DataFrame:
    """``capture_key`` and the declared columns of the records at ``path`` in JSON texts (capture_key, body). An unreadable body gives no record."""
    kind = declared_schema(fields)
    if path == "$[*]":
        return payloads.select("capture_key", F.explode(F.from_json("body", T.ArrayType(kind))).alias("_r")).select("capture_key", "_r.*")
    some = F.coalesce(*[F.col(f"_r.{c}").isNotNull() | F.lit(None) for c in fields])  # true if any field is there, else null
    whole = payloads.select("capture_key", F.from_json("body", kind).alias("_r")).filter(some).select("capture_key", "_r.*")
    return declared_records(whole, fields, path, ["capture_key"])


INDEX_COLUMNS = ["capture_key", "run_id", "index_source", "scope", "endpoint", "received_at", "content_sha256", "content_length", "http_status", "shape_ok", "usable", "season", "shape_source", "validator_version"]


def capture_index(manifests: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per capture: those of finalised runs' manifests, which have no scope, and all of the backfill catalog."""
    m = manifests.filter("status <> 'IN_PROGRESS'").select("run_id", F.lit("manifest").alias("index_source"), F.explode("captures").alias("c")).select("run_id", "index_source", "c.*")
    c = catalog.select("run_id", "scope", F.lit("catalog").alias("index_source"), F.explode("captures").alias("c")).select("run_id", "scope", "index_source", "c.*")
    both = m.unionByName(c, allowMissingColumns=True).withColumnRenamed("key", "capture_key")
    return both.withColumn("received_at", F.col("received_at").cast("timestamp_ntz")).select(*INDEX_COLUMNS)
