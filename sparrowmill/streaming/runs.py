"""Runs of several steps: each step's table is staged by run, nothing is seen before the run is published, and a run that
failed goes on where it stopped.

A step is known to be done by a mark written after its table, a part of a flushed step likewise, so what a failure leaves
half written is never read and is written over. Publishing adds one small pointer file, which either is there or is not.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A step takes the session and the tables of the steps before it, by name.
Function = Callable[[SparkSession, dict[str, DataFrame]], DataFrame]


@dataclass
class Step:
    """``flush``: a key by which the rows are written in so many parts, each kept as soon as it is there; see Run."""

    name: str
    run: Function
    flush: tuple[str, int] | None = None


class Files:
    """Small files beside tables, on whatever file system holds them."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def put(self, path: str, text: str) -> None:
        """Writes beside the place and moves there, so a reader sees all of it or nothing."""
        draft = f"{path}.draft"
        out = self.fs.create(self.path(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(self.path(path), False)
        if not self.fs.rename(self.path(draft), self.path(path)):
            raise OSError(f"{path} was not written")

    def drop(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


class Run:
    """The steps of one run below ``root``/runs/``name``."""

    def __init__(self, spark: SparkSession, root: str, name: str, steps: list[Step]) -> None:
        self.spark, self.root, self.name, self.steps = spark, root.rstrip("/"), name, steps
        self.home = f"{self.root}/runs/{name}"
        self.files = Files(spark, self.home)

    def _mark(self, step: str, part: int | None = None) -> str:
        return f"{self.home}/_done/{step}" + ("" if part is None else f".{part}")

    def done(self, step: str) -> bool:
        return self.files.exists(self._mark(step))

    def table(self, step: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.home}/{step}/*" if next(s for s in self.steps if s.name == step).flush else f"{self.home}/{step}")

    def go(self, first: str | None = None, last: str | None = None) -> list[str]:
        """Runs the steps from ``first`` to ``last`` that aren't done and returns their names.

        With ``first`` named, that step and all after it are done anew; the steps before it must be done.
        """
        names = [s.name for s in self.steps]
        lo, hi = names.index(first) if first else 0, names.index(last) if last else len(names) - 1
        missing = [n for n in names[:lo] if not self.done(n)]
        if missing:
            raise ValueError(f"not done yet: {', '.join(missing)}")
        if first:
            for step in self.steps[lo:]:
                for part in (None, *range(step.flush[1] if step.flush else 0)):
                    self.files.drop(self._mark(step.name, part))
        ran = []
        for step in self.steps[lo : hi + 1]:
            if self.done(step.name):
                continue
            self._run(step, {n: self.table(n) for n in names[: names.index(step.name)]})
            ran.append(step.name)
        return ran

    def _run(self, step: Step, before: dict[str, DataFrame]) -> None:
        rows, path = step.run(self.spark, before), f"{self.home}/{step.name}"
        if step.flush is None:
            rows.write.mode("overwrite").parquet(path)
        else:
            key, parts = step.flush
            for part in range(parts):
                if not self.files.exists(self._mark(step.name, part)):
                    own = rows.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
                    own.write.mode("overwrite").parquet(f"{path}/part={part}")
                    self.files.put(self._mark(step.name, part), "")
        self.files.put(self._mark(step.name), json.dumps({"step": step.name, "columns": rows.columns}))

    def publish(self) -> None:
        """Makes this run the one that readers see; all its steps must be done."""
        missing = [s.name for s in self.steps if not self.done(s.name)]
        if missing:
            raise ValueError(f"not done yet: {', '.join(missing)}")
        flushed = [s.name for s in self.steps if s.flush]
        self.files.put(f"{self.root}/runs/{self.name}/_published", "")
        order = len(pointers(self.spark, self.root))
        self.files.put(f"{self.root}/_published/{order:09d}.json", json.dumps({"run": self.name, "flushed": flushed}))


def pointers(spark: SparkSession, root: str) -> list[str]:
    files = Files(spark, root)
    where = files.path(f"{root.rstrip('/')}/_published")
    return sorted(s.getPath().getName() for s in files.fs.listStatus(where) if s.getPath().getName().endswith(".json")) if files.fs.exists(where) else []


def published(spark: SparkSession, root: str, step: str) -> DataFrame:
    """A step's table of the run published last."""
    names = pointers(spark, root)
    if not names:
        raise FileNotFoundError(f"nothing is published below {root}")
    said = spark.read.schema("run string, flushed array<string>").json(f"{root.rstrip('/')}/_published/{names[-1]}").first()
    path = f"{root.rstrip('/')}/runs/{said.run}/{step}"
    return spark.read.parquet(f"{path}/*" if step in said.flushed else path)
