"""Polling: new rows are taken once, however often they arrive or a batch is replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def poll(spark: SparkSession, path: str, schema: str, format_: str = "parquet", **options: str) -> DataFrame:
    """A stream over the files of a folder."""
    reader = spark.readStream.format(format_).schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def once(stream: DataFrame, key: list[str], time: str, late: str) -> DataFrame:
    """Rows whose key was not seen within the delay; state older than that is dropped."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def has_rows(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def merge_unseen(target: str, on: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """A batch function that appends rows whose id the target lacks; each batch has a folder of its own.

    A replayed batch overwrites its folder, so nothing is taken twice and nothing is lost.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = transform(batch).dropDuplicates([on])
        if has_rows(spark, target):
            known = spark.read.parquet(target)
            if "batch" in known.columns:
                known = known.where(F.col("batch") != number)
            new = new.join(known.select(on), on, "left_anti")
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return run


def drain(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Takes all that has arrived, in batches, and stops."""
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def unfinished(rows: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """Rows that a run, cut short, has left to do."""
    return rows.join(done.select(on).distinct(), on, "left_anti")
