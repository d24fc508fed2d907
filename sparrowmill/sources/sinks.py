"""Results on disk: versions with a pointer, exports, digests and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_version(df: DataFrame, root: str, version: str) -> str:
    """Writes a new version beside the others and points to it; inputs are never overwritten."""
    spark, path = df.sparkSession, f"{root}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    pointer = spark.range(1).select(F.lit(version).alias("version"), F.unix_micros(F.current_timestamp()).alias("written"))
    pointer.coalesce(1).write.mode("append").json(f"{root}/_pointer")
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The version that was pointed to last, whatever the versions are called."""
    pointers = spark.read.schema("version string, written long").json(f"{root}/_pointer")
    newest = pointers.agg(F.max_by("version", "written")).first()[0]
    return spark.read.parquet(f"{root}/version={newest}")


def export_json(df: DataFrame, path: str) -> None:
    """One file of JSON lines; for results that people read."""
    df.coalesce(1).write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """One file of CSV that spreadsheets read as UTF-8: it begins with a byte order mark, which stands before the first name."""
    df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.coalesce(1).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def digest(df: DataFrame) -> DataFrame:
    """(n_rows, digest): the same for the same rows in any order, from sums of row hashes."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    number = lambda a: F.conv(F.substring(row, a, 15), 16, 10).cast("decimal(38,0)")
    sums = df.select(number(1).alias("a"), number(16).alias("b")).agg(F.count("*").alias("n_rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.select("n_rows", F.sha2(F.concat_ws(":", "n_rows", F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))), 256).alias("digest"))


def gate(issues: DataFrame, area: str | None = None) -> None:
    """Raises if any issue (rule, area, id) is left."""
    found = issues if area is None else issues.where(F.col("area") == area)
    counts = found.groupBy("rule").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "rule").limit(20).collect()
    if counts:
        raise ValueError("issues: " + ", ".join(f"{r['rule']} {r['n']}" for r in counts))


def overlay(rows: DataFrame, edits: DataFrame, on: str, column: str) -> DataFrame:
    """Edits by id over a column; a blank edit changes nothing."""
    named = edits.select(on, F.nullif(F.trim(column), F.lit("")).alias("_edit"))
    out = rows.join(named, on, "left")
    return out.withColumn(column, F.coalesce("_edit", column)).drop("_edit")
