"""Where captures lie and where results may go."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturemill.functions.scalars import capture_key

from .compaction import compacted_read, fixed_part, period_read, raw_read
from .files import Files

class DestinationRefused(RuntimeError):
    """A write to a guarded place by other than a scheduled run."""


@dataclass(frozen=True)
class PayloadRoots:
    """Roots of live captures, of ported seasons (if any) and of compacted parts (if any)."""

    raw: str
    history: str | None = None
    compacted: str | None = None

    def all(self) -> list[str]:
        return [r.rstrip("/") for r in (self.raw, self.history) if r]

    def globs(self, below: str) -> list[str]:
        """A payload's pattern below each root."""
        return [f"{r}/{below}" for r in self.all()]


#: How a payload lies below a root: its pattern, and whether it is compacted by day or by settled period.
PATTERNS = {
    "bootstrap_static": ("fpl/bootstrap-static/*/*/payload.json", None), "fixtures": ("fpl/fixtures/*/*/payload.json", None), "event_status": ("fpl/event-status/*/*/payload.json", None),
    "element_summary": ("fpl/element-summary/*/*/*/payload.json", "day"), "entry_picks": ("fpl/entry-picks/*/*/*/*/*/payload.json", "period"),
}


@dataclass(frozen=True)
class Reading:
    """One answer to where captures are read from: parts and a raw tail, raw files alone (``raw=True``), or the raw files of days before ``cutoff``."""

    roots: PayloadRoots
    raw: bool = False
    cutoff: str | None = None

    def captures(self, spark: SparkSession, source: str, fields: dict) -> DataFrame:
        """``capture_key, path`` and the declared columns of a source's captures, each read once."""
        below, unit = PATTERNS[source]
        raw, history, parts = (r and r.rstrip("/") for r in (self.roots.raw, self.roots.history, self.roots.compacted))
        base = fixed_part(below)
        if unit is None or self.raw or self.cutoff or parts is None:
            got = raw_read(spark, raw, fields, below, history, self.cutoff)
        elif unit == "day":
            got = compacted_read(spark, raw, f"{parts}/{base}", fields, below, history)
        else:
            got = period_read(spark, f"{raw}/{base}", f"{parts}/{base}", fields)
        return got.withColumn("capture_key", capture_key(F.col("path"), "fpl"))

    def globs(self, spark: SparkSession, source: str) -> list[str]:
        """The patterns of a source's raw files that exist, for what looks at whole payloads; the live tree's first."""
        below, files = PATTERNS[source][0], Files(spark)
        tops = [self.roots.raw.rstrip("/")] + ([self.roots.history.rstrip("/") + "/*"] if self.roots.history else [])
        return [f"{t}/{below}" for t in tops if files.names(f"{t}/{fixed_part(below)}")]


def before_cutoff(files: list[str], cutoff: str) -> list[str]:
    """Payload files of days before ``cutoff``, sorted; none is an error."""
    out = sorted(f for f in files if len(p := f.split("/")) >= 3 and p[-3] < cutoff)
    if not out:
        raise ValueError(f"no capture before {cutoff}")
    return out


def check_destination(dest: str, event: str | None, guarded: str) -> None:
    """Only an event named ``schedule`` may write below ``guarded``."""
    if (dest.rstrip("/") + "/").startswith(guarded.rstrip("/") + "/") and event != "schedule":
        raise DestinationRefused(f"{dest} is written by scheduled runs alone, not by {event!r}")


def read_seed(spark: SparkSession, path: str, schema: str = "run_id string, origin_kind string, github_run_id string, workflow string, ref string") -> DataFrame:
    """A CSV seed with a header, by a declared schema; other columns fail."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
