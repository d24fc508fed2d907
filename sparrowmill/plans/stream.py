"""Queries over streams of the driver's events, and over formats and feeds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify
from ..operators import similarity
from ..session import table
from ..sources import documents, sinks
from ..streaming import incremental

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def shared(spark: SparkSession, label: str) -> str:
    """A new folder where the session keeps what all executors see."""
    return f"{similarity.shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def arrivals(spark: SparkSession, d: str) -> tuple[DataFrame, str]:
    """A stream of events, and a folder for what becomes of it."""
    path = f"{d}/event[s].parquet"  # a pattern, since the source takes no single file
    batch = spark.read.parquet(path)
    out = shared(spark, "events")
    return incremental.poll(spark, path, batch.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")), out


@query
def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """One event of each id, taken by a stream that is drained twice; the second time brings nothing."""
    stream, out = arrivals(spark, d)
    keyed = stream.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "user_id", "event_type")
    for _ in range(2):
        incremental.drain(keyed, incremental.merge_unseen(f"{out}/rows", "event_id"), f"{out}/state")
    return spark.read.parquet(f"{out}/rows").drop("batch")


SQL["stream_dedupe"] = "SELECT DISTINCT event_id, epoch_us(ts) AS ts, user_id, event_type FROM events"


@query
def stream_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """Users by type of event as a stream first sees them: state is kept within a watermark."""
    stream, out = arrivals(spark, d)
    first = incremental.once(stream.select("ts", "user_id", "event_type"), ["user_id", "event_type"], "ts", "60 days")
    incremental.drain(first, incremental.merge_unseen(f"{out}/rows", "id", lambda b: b.select(F.concat_ws(":", "user_id", "event_type").alias("id"), "user_id", "event_type")), f"{out}/state")
    return spark.read.parquet(f"{out}/rows").select("user_id", "event_type")


SQL["stream_first_seen"] = "SELECT DISTINCT user_id, event_type FROM events"


@query
def unfinished(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "events").where("event_type = 'purchase' AND value > 60").select("user_id")
    users = table(spark, d, "events").select("user_id").distinct()
    return incremental.unfinished(users, done, "user_id")


SQL["unfinished"] = """
SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60)
"""


@query
def convert_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages through the readers by ending: which have a text, and the codes of the rest."""
    name = F.concat(F.col("page_id").cast("string"), F.element_at(F.array(*[F.lit(x) for x in (".html", ".pdf", ".png", ".txt")]), (F.col("page_id") % 4 + 1).cast("int")))
    files = table(spark, d, "pages").select("page_id", name.alias("path"), F.col("html").cast("binary").alias("content"))
    out = documents.convert_files(files)
    return out.groupBy(F.coalesce("error", F.lit("OK")).alias("code")).agg(F.count("*").alias("n"))


SQL["convert_pages"] = """
SELECT CASE page_id % 4 WHEN 0 THEN CASE WHEN contains(html, 'view_cont') THEN 'OK' ELSE 'NO_VIEW_CONT' END
       WHEN 1 THEN 'UNSUPPORTED_FORMAT' WHEN 2 THEN 'OCR_NEEDED' ELSE 'UNKNOWN_FORMAT' END AS code, count(*)::BIGINT AS n FROM pages GROUP BY 1
"""


@query
def record_grades(spark: SparkSession, d: str) -> DataFrame:
    """Customers graded like records: by orders, balance and segment."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))
    rows = table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0, ["n", "closed"])
    grade = classify.information_grade(F.col("n") % 3, F.col("c_acctbal") > 0, F.col("closed"), F.col("n"), F.col("c_mktsegment") == "BUILDING")
    able = classify.eligibility(F.col("grade"), F.col("closed"))
    score = classify.base_match(F.col("grade"), F.when(F.col("n") > 10, "high").when(F.col("n") > 5, "medium").otherwise("low"), F.col("c_acctbal") > 5000)
    return rows.withColumn("grade", grade).select("c_custkey", "grade", able.alias("eligibility"), score.alias("base"))


SQL["record_grades"] = """
WITH o AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS closed FROM orders GROUP BY 1),
r AS (SELECT c_custkey, c_acctbal, c_mktsegment, coalesce(n, 0) AS n, coalesce(closed, 0) AS closed FROM customer LEFT JOIN o ON c_custkey = o_custkey),
p AS (SELECT *, CASE n % 3 WHEN 2 THEN 2 WHEN 1 THEN 1 ELSE 0 END + (c_acctbal > 0)::INT + (closed >= 1)::INT + (n >= 1)::INT
             + (c_mktsegment = 'BUILDING')::INT AS points FROM r),
g AS (SELECT *, CASE WHEN points >= 4 THEN 'detailed' WHEN points >= 2 THEN 'moderate' ELSE 'vague' END AS grade FROM p)
SELECT c_custkey, grade, CASE WHEN grade = 'detailed' AND closed <= 2 THEN 'able' WHEN grade <> 'vague' THEN 'check' ELSE 'need' END AS eligibility,
       least(99, 50 + CASE grade WHEN 'detailed' THEN 25 WHEN 'moderate' THEN 15 ELSE 0 END
             + CASE WHEN n > 10 THEN 10 WHEN n > 5 THEN 5 ELSE 0 END + CASE WHEN c_acctbal > 5000 THEN 5 ELSE 0 END) AS base FROM g
"""


@query
def digest(spark: SparkSession, d: str) -> DataFrame:
    """Whether a table, dealt anew, has the same digest."""
    n = table(spark, d, "nation")
    a, b = sinks.digest(n), sinks.digest(n.repartition(5, "n_regionkey"))
    return a.join(b, "digest").select(a["n_rows"], F.lit(True).alias("same"))


SQL["digest"] = "SELECT count(*)::BIGINT AS n_rows, true AS same FROM nation"
