"""Helpers shared by the operators: column idioms, lineage cuts and shared folders."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of an Arrow batch; a row may be a long text or its whole set of shingles.
BATCH = 256
#: Words are maximal runs of anything but space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " +"), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; one of our own only where none is set."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='sparrowmill-')}"
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def cut(df: DataFrame) -> DataFrame:
    """Computes a frame once and forgets its lineage; the copy lies in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a path in the shared folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when this driver ends."""
    path = f"{shared_root(spark).rstrip('/')}/sparrowmill-{label}-{uuid.uuid4().hex}"

    def tidy() -> None:
        try:
            drop(spark, path)
        except Exception:  # the session is gone already; the cluster's own clean-up is left
            pass

    atexit.register(tidy)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Like cut(), as a columnar table: for frames of which later steps read few columns."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query that runs within as soon as the query ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


class Scratch:
    """Tables that a job of several steps keeps for a while: each is deleted by its path as soon as it is let go, the rest at the end.

    Within, Spark also deletes each query's shuffle files when the query ends. What is to outlive the block is written()
    by itself.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.held = spark, []
        self.shuffles = brief_shuffles(spark)

    def __enter__(self) -> Scratch:
        self.shuffles.__enter__()
        return self

    def __exit__(self, *why: object) -> None:
        self.let_go(*[df for df, _ in self.held])
        self.shuffles.__exit__(*why)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = shared_path(self.spark, label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def let_go(self, *frames: DataFrame | None) -> None:
        for path in [p for df, p in self.held if any(df is f for f in frames)]:
            drop(self.spark, path)
        self.held = [(df, p) for df, p in self.held if not any(df is f for f in frames)]


def bounded(df: DataFrame) -> DataFrame:
    """The frame, with Arrow batches of at most BATCH rows where the session leaves Spark's own 10,000: texts are long.

    Spark has this for sessions only and reads it when a plan runs, which is after this returns; so it stays set.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return df


#: Bytes up to which the smaller side of a join is sent to all tasks.
SMALL = 8 << 20


def looked_up(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``df`` joined with a side that is usually small: sent to all tasks if it measures SMALL or less, else shuffled.

    Its bytes are those of its strings, and 16 for each other column.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in small.schema if f.dataType.simpleString() in ("string", "binary")]
    fixed = 16 * len(small.columns)
    size = small.agg(F.sum(sum(texts, F.lit(fixed)).cast("long"))).first()[0] or 0
    return df.join(F.broadcast(small) if size <= SMALL else small, on, how)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
