"""Queries over measures, clusters and weighted terms."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates, alike, clustering, similarity, textmodels
from ..session import table

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def quantile_bins(spark: SparkSession, d: str) -> DataFrame:
    return clustering.quantile_levels(table(spark, d, "customer"), "c_acctbal").groupBy("c_mktsegment", "level").agg(F.count("*").alias("n"))


SQL["quantile_bins"] = """
WITH q AS (SELECT quantile_cont(c_acctbal, [0.25, 0.5, 0.75]) AS c FROM customer)
SELECT c_mktsegment, (1 + len(list_filter(c, lambda x: x <= c_acctbal)))::VARCHAR AS level, count(*)::BIGINT AS n
FROM customer, q GROUP BY 1, 2
"""


def _contingency_sql(pairs: str) -> str:
    return f"""
WITH p AS ({pairs}), n AS (SELECT a, b, count(*)::DOUBLE AS n FROM p GROUP BY 1, 2),
r AS (SELECT a, sum(n) AS s FROM n GROUP BY 1), c AS (SELECT b, sum(n) AS s FROM n GROUP BY 1),
x AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM n) AS s, (SELECT sum(n) FROM n) AS n, (SELECT sum(n * ln(n)) FROM n) AS h,
             (SELECT sum(s * (s - 1) / 2) FROM r) AS sa, (SELECT sum(s * ln(s)) FROM r) AS ha,
             (SELECT sum(s * (s - 1) / 2) FROM c) AS sb, (SELECT sum(s * ln(s)) FROM c) AS hb),
y AS (SELECT *, sa * sb / (n * (n - 1) / 2) AS e, (sa + sb) / 2 AS m, ln(n) - ha / n AS hu, ln(n) - hb / n AS hv, ln(n) + (h - ha - hb) / n AS mi FROM x)
SELECT round(CASE WHEN m - e = 0 THEN 1.0 ELSE (s - e) / (m - e) END, 9)::DOUBLE AS ari,
       round(CASE WHEN hu + hv = 0 THEN 1.0 ELSE mi / ((hu + hv) / 2) END, 9)::DOUBLE AS nmi, n::BIGINT AS n FROM y
"""


@query
def contingency_ari(spark: SparkSession, d: str) -> DataFrame:
    near = clustering.centroid_labels(table(spark, d, "embeddings"), "embedding", "label", "vec_id")
    return clustering.contingency(near, F.col("label"), F.col("nearest"))


SQL["contingency_ari"] = _contingency_sql("""
  WITH e AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS x FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),
  m AS (SELECT label, i, avg(x) AS m FROM e GROUP BY 1, 2),
  g AS (SELECT vec_id, e.label AS a, m.label AS b, round(sum((x - m) * (x - m)), 6) AS g FROM e JOIN m USING (i) GROUP BY 1, 2, 3)
  SELECT a, b FROM g QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY g, b) = 1""")


@query
def label_agreement(spark: SparkSession, d: str) -> DataFrame:
    return clustering.contingency(table(spark, d, "labels"), F.col("quality"), F.col("toxic"))


SQL["label_agreement"] = _contingency_sql("SELECT quality AS a, toxic AS b FROM labels")


@query
def cluster_profile(spark: SparkSession, d: str) -> DataFrame:
    """Sources as clusters: size, top language and its share, three first documents."""
    docs = table(spark, d, "documents")
    n = docs.groupBy("source", "lang").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    top = aggregates.top_per_group(n, ["source"], [F.desc("n"), F.col("first")], 1).select("source", F.col("lang").alias("top_lang"), "n")
    panel = aggregates.panel(docs, "source", "doc_id")
    return panel.join(top, "source").select("source", F.col("n_rows").alias("size"), "top_lang", F.round(F.col("n") / F.col("n_rows"), 9).alias("share"), "sample")


SQL["cluster_profile"] = """
WITH n AS (SELECT source, lang, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY 1, 2),
t AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, f) = 1),
s AS (SELECT source, count(*)::BIGINT AS size, array_to_string(list_sort(list(doc_id))[1:3], ',') AS sample FROM documents GROUP BY 1)
SELECT source, size, lang AS top_lang, round(n / size, 9)::DOUBLE AS share, sample FROM s JOIN t USING (source)
"""


@query
def viability(spark: SparkSession, d: str) -> DataFrame:
    return clustering.viability(table(spark, d, "embeddings"), "label")


SQL["viability"] = """
WITH s AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT count(*)::BIGINT AS n_clusters, min(n)::BIGINT AS smallest, round(max(n) / sum(n), 9)::DOUBLE AS largest_share,
       min(n) >= greatest(5, ceil(0.01 * sum(n))) AND max(n) / sum(n) <= 0.75 AS viable FROM s
"""


def nation_facts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"))
    return table(spark, d, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_nationkey", "n_regionkey", "n", "mean")


@query
def gower_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Distances of nations (a fixed list): region, customers and their mean balance."""
    f = nation_facts(spark, d)
    spans = f.agg((F.max("n") - F.min("n")).alias("sn"), (F.max("mean") - F.min("mean")).alias("sm")).withColumn("k", F.lit(1))
    a = f.select(*[F.col(c).alias(f"a_{c}") for c in f.columns]).withColumn("k", F.lit(1)).join(spans, "k")
    b = f.select(*[F.col(c).alias(f"b_{c}") for c in f.columns]).withColumn("k", F.lit(1))
    dist = similarity.gower(
        [(F.col("a_n_regionkey"), F.col("b_n_regionkey"))],
        [(F.col("a_n"), F.col("b_n"), F.col("sn")), (F.col("a_mean"), F.col("b_mean"), F.col("sm"))],
        [],
    )
    return a.join(b, "k").where("a_n_nationkey < b_n_nationkey").select(F.col("a_n_nationkey").alias("a"), F.col("b_n_nationkey").alias("b"), F.round(dist, 9).alias("distance"))


SQL["gower_pairs"] = """
WITH f AS (SELECT n_nationkey AS k, n_regionkey AS r, n, mean FROM nation LEFT JOIN (
  SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY 1) ON n_nationkey = c_nationkey),
s AS (SELECT max(n) - min(n) AS sn, max(mean) - min(mean) AS sm FROM f)
SELECT a.k AS a, b.k AS b, round((CASE WHEN a.r = b.r THEN 0.0 ELSE 1.0 END
    + coalesce(abs(a.n - b.n) / CASE WHEN sn > 0 THEN sn ELSE 1 END, 0.0) + coalesce(abs(a.mean - b.mean) / CASE WHEN sm > 0 THEN sm ELSE 1 END, 0.0))
  / (1 + (a.n IS NOT NULL AND b.n IS NOT NULL)::INT + (a.mean IS NOT NULL AND b.mean IS NOT NULL)::INT), 9)::DOUBLE AS distance
FROM f a JOIN f b ON a.k < b.k, s
"""


@query
def pam(spark: SparkSession, d: str) -> DataFrame:
    """Nations by medoids, with the silhouette of the clustering."""
    x = clustering.matrix(nation_facts(spark, d).fillna(0), ["n_nationkey", "n_regionkey", "n", "mean"])
    dist = clustering.gower_matrix(x[:, 2:], x[:, 1:2])
    labels, medoids = clustering.pam(dist, 4)
    s = clustering.silhouette(dist, labels)
    rows = [(int(k), int(c), int(x[medoids[c], 0]), round(s, 9)) for k, c in zip(x[:, 0], labels, strict=True)]
    return spark.createDataFrame(rows, "n_nationkey int, cluster int, medoid int, silhouette double")


@query
def linkage(spark: SparkSession, d: str) -> DataFrame:
    """Nations by average linkage."""
    x = clustering.matrix(nation_facts(spark, d).fillna(0), ["n_nationkey", "n_regionkey", "n", "mean"])
    labels = clustering.average_linkage(clustering.gower_matrix(x[:, 2:], x[:, 1:2]), 5)
    return spark.createDataFrame([(int(k), int(c)) for k, c in zip(x[:, 0], labels, strict=True)], "n_nationkey int, cluster int")


@query
def lca(spark: SparkSession, d: str) -> DataFrame:
    """Latent classes of orders by status, priority and price level: fits of 2 to 4 classes over counted patterns."""
    o = clustering.quantile_levels(table(spark, d, "orders"), "o_totalprice")
    counts = o.groupBy("o_orderstatus", "o_orderpriority", "level").agg(F.count("*").alias("n")).orderBy("o_orderstatus", "o_orderpriority", "level").collect()
    x = np.stack([np.unique([r[j] for r in counts], return_inverse=True)[1] for j in range(3)], axis=1)
    w = np.array([r["n"] for r in counts], float)
    rows = []
    for k in (2, 3, 4):
        m = clustering.LatentClasses(k, starts=6, rounds=80).fit(x, w)
        figures = (m.likelihood, m.bic, m.aic, m.entropy)
        rows.append((k, *[round(float(v), 4) for v in figures], m.parameters))
    return spark.createDataFrame(rows, "k int, likelihood double, bic double, aic double, entropy double, parameters int")


@query
def kmeans(spark: SparkSession, d: str) -> DataFrame:
    """Vectors by k-means, held against their labels."""
    e = table(spark, d, "embeddings")
    got = textmodels.kmeans_labels(e, "vec_id", F.col("embedding"), 8)
    return clustering.contingency(got.join(e, "vec_id"), F.col("label"), F.col("cluster"))


@query
def tfidf_search(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose id is divisible by 100, and the five documents most like each by weighted terms."""
    docs = table(spark, d, "documents").select("doc_id", F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: F.char_length(w) >= 2).alias("tokens"))
    return alike.most_alike(docs, "doc_id", "tokens", F.col("doc_id") % 100 == 0)


SQL["tfidf_search"] = r"""
WITH t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) >= 2)) AS token FROM documents),
tf AS (SELECT doc_id, token, count(*) AS tf FROM t GROUP BY 1, 2),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY 1),
n AS (SELECT count(*) AS n FROM documents),
raw AS (SELECT doc_id, token, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN df USING (token), n WHERE df >= 2 AND df <= 0.98 * n),
w AS (SELECT doc_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw),
c AS (SELECT q.doc_id AS query, d.doc_id, round(sum(q.w * d.w), 6) AS cosine FROM w q JOIN w d USING (token)
      WHERE q.doc_id % 100 = 0 AND q.doc_id <> d.doc_id GROUP BY 1, 2)
SELECT query, rank::INT AS rank, doc_id, cosine FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY cosine DESC, doc_id) AS rank FROM c) WHERE rank <= 5
"""


@query
def numeric_prep(spark: SparkSession, d: str) -> DataFrame:
    """Logarithms with missing values filled by the median, in standard units of the whole table."""
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.log1p("c_acctbal")).alias("x"))
    s = c.agg(F.median("x").alias("m")).withColumn("k", F.lit(1))
    filled = c.withColumn("k", F.lit(1)).join(F.broadcast(s), "k").select("c_custkey", F.coalesce("x", "m").alias("x"), "k")
    z = filled.groupBy("k").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))
    return filled.join(F.broadcast(z), "k").select("c_custkey", F.round((F.col("x") - F.col("mean")) / F.col("sd"), 6).alias("z"))


SQL["numeric_prep"] = """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN ln(1 + c_acctbal) END AS x FROM customer),
f AS (SELECT c_custkey, coalesce(x, (SELECT median(x) FROM c)) AS x FROM c)
SELECT c_custkey, round((x - avg(x) OVER ()) / stddev_pop(x) OVER (), 6) AS z FROM f
"""
