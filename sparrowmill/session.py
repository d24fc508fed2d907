"""Sessions and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "sparrowmill", **settings: str) -> SparkSession:
    """A session with the settings the operators expect: adaptive plans, UTC, skewed joins split at run time."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; a time without zone is read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for field in df.schema.fields:
        if field.dataType.simpleString() == "timestamp_ntz":
            df = df.withColumn(field.name, df[field.name].cast("timestamp"))
    return df


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out in turn, some tasks a core: a table of few bytes comes in one or two tasks, whatever a row costs later."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
