"""Relations made of relations: each is made once in a build, and what several read is a table for as long as the build lasts."""

from __future__ import annotations

import atexit
import os
import tempfile
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from capturemill.plans.builds import Stages, stages_of
from capturemill.sources.files import Files


@dataclass(frozen=True)
class Node:
    """A relation: ``make`` gets the relations that it needs, in their order."""

    make: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    #: A table even if one relation reads it.
    kept: bool = False


@dataclass(frozen=True)
class Check:
    """Findings over relations. Any finding stops the relations in ``stops`` and all that need them; with ``warn`` it is only recorded."""

    find: Callable[..., DataFrame]
    needs: tuple[str, ...]
    stops: tuple[str, ...] = ()
    warn: bool = False


@dataclass(frozen=True)
class Record:
    """What became of a relation or check: ``built``, ``passed``, ``warned``, ``failed`` or ``skipped``."""

    name: str
    status: str
    seconds: float
    said: str = ""


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, a temporary one on a single machine, and an error on a cluster."""
    got = spark.sparkContext._jsc.sc().getCheckpointDir()
    shared = got.get() if got.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return shared
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="build")


class Build:
    """One run over a graph of relations, as a context: its folder goes at the end.

    Relations that don't need each other are made at the same time. A relation is a table if several relations or checks of the run read it,
    or if it is ``kept`` or wanted; plans over tables stay small, and a lost executor repeats one relation at most. Others are parts
    of the plans that read them. A relation that can't be made, or that a check stops, is left out with all that needs it; the rest is made.
    """

    def __init__(self, spark: SparkSession, nodes: dict[str, Node], checks: dict[str, Check] | None = None, workers: int = 8):
        self.spark, self.nodes, self.checks, self.workers = spark, nodes, checks or {}, workers
        self.folder = os.path.join(shared_folder(spark), f"build-{uuid.uuid4().hex}")
        self.records: dict[str, Record] = {}
        self.made: dict[str, DataFrame] = {}

    def __enter__(self) -> Build:
        return self

    def __exit__(self, *_) -> None:
        Files(self.spark).delete(self.folder)

    def _closure(self, wanted: Iterable[str]) -> dict[str, tuple[str, ...]]:
        """Everything to run for ``wanted``, each with what it waits for."""
        stopped_by = {n: tuple(c for c, k in self.checks.items() if n in k.stops) for n in self.nodes}
        out, path = {}, []

        def visit(name: str) -> None:
            if name in path:
                raise ValueError("relations need each other: " + " > ".join([*path, name]))
            if name in out:
                return
            if name not in self.nodes and name not in self.checks:
                raise KeyError(f"no relation {name}")
            path.append(name)
            needs = self.checks[name].needs if name in self.checks else (*self.nodes[name].needs, *stopped_by[name])
            for n in needs:
                visit(n)
            path.pop()
            out[name] = needs

        for name in wanted:
            visit(name)
        return out

    def run(self, wanted: Iterable[str]) -> dict[str, DataFrame]:
        """The wanted relations that could be made, as tables of the build's folder. ``records`` tells of each relation and check."""
        wanted = list(wanted)
        todo = self._closure(wanted)
        readers = Counter(n for name in todo for n in dict.fromkeys(todo[name]) if n in self.nodes)
        tables = {n for n in todo if n in self.nodes and (readers[n] > 1 or self.nodes[n].kept or n in wanted)}
        tables |= {n for name in todo if name in self.checks for n in self.checks[name].needs}
        with ThreadPoolExecutor(self.workers) as pool:
            running, left = {}, [n for n in todo if n not in self.records]
            while left or running:
                for name in [n for n in left if all(x in self.records for x in todo[n])]:
                    left.remove(name)
                    bad = [x for x in todo[name] if self.records[x].status in ("failed", "skipped")]
                    if bad:
                        self.records[name] = Record(name, "skipped", 0.0, "after " + ", ".join(bad))
                    else:
                        running[pool.submit(self._one, name, name in tables)] = name
                for done in wait(running, return_when=FIRST_COMPLETED).done if running else ():
                    self.records[running.pop(done)] = done.result()
        return {n: self.made[n] for n in wanted if n in self.made}

    def _group(self, name: str) -> str:
        return f"{os.path.basename(self.folder)}:{name}"

    def figures(self) -> dict[str, Stages]:
        """What Spark did for each relation and check; a relation that is part of another's plan is in that one's figures."""
        return {n: got for n in self.records if (got := stages_of(self.spark, self._group(n))).tasks}

    def _one(self, name: str, table: bool) -> Record:
        began = time.perf_counter()
        self.spark.sparkContext.setJobGroup(self._group(name), name)
        try:
            if name in self.checks:
                check = self.checks[name]
                found = check.find(*(self.made[n] for n in check.needs)).limit(5).collect()  # a few, for the record
                status = ("warned" if check.warn else "failed") if found else "passed"
                return Record(name, status, time.perf_counter() - began, "; ".join(str(r.asDict()) for r in found))
            node = self.nodes[name]
            df = node.make(*(self.made[n] for n in node.needs))
            if table:
                path = os.path.join(self.folder, name.replace(":", "-"))
                df.write.parquet(path)
                df = self.spark.read.schema(df.schema).parquet(path)
            self.made[name] = df
            return Record(name, "built", time.perf_counter() - began)
        except Exception as e:  # the rest of the build goes on
            return Record(name, "failed", time.perf_counter() - began, f"{type(e).__name__}: {e}"[:2000])


class NotBuilt(RuntimeError):
    """A wanted relation failed or was stopped."""


def relation_of(spark: SparkSession, nodes: dict[str, Node], name: str, checks: dict[str, Check] | None = None) -> DataFrame:
    """One relation by a build of what it needs. Its own table outlives the build and is deleted when the driver's process ends."""
    with Build(spark, nodes, checks) as build:
        made = build.run([name])
        if name not in made:
            raise NotBuilt("; ".join(f"{r.name} {r.status}: {r.said}" for r in build.records.values() if r.status in ("failed", "skipped")))
        schema, path = made[name].schema, os.path.join(shared_folder(spark), f"relation-{uuid.uuid4().hex}")
        Files(spark).move(os.path.join(build.folder, name.replace(":", "-")), path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # a stopped session took its folder's handle along
        Files(spark).delete(path)
