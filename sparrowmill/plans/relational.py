"""Queries over joins, windows, groups, sets and similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates, matching, relations, requests, similarity
from ..session import table

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def exact_groups(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "n_chars", F.md5("text").alias("h"))
    rep = relations.representatives(docs, ["h"], [F.desc("n_chars"), F.col("doc_id")])
    return rep.select("doc_id", "group_size", "is_representative", "weight")


SQL["exact_groups"] = """
SELECT doc_id, count(*) OVER (PARTITION BY md5(text))::BIGINT AS group_size,
       row_number() OVER (PARTITION BY md5(text) ORDER BY n_chars DESC, doc_id) = 1 AS is_representative,
       round(1.0 / count(*) OVER (PARTITION BY md5(text)), 8)::DOUBLE AS weight FROM documents
"""


@query
def group_numbers(spark: SparkSession, d: str) -> DataFrame:
    groups = table(spark, d, "documents").groupBy(F.md5(text.compact(F.col("text"))).alias("k")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    return relations.numbered_groups(groups, "least", "GRP").select("group_name", "least", "n")


SQL["group_numbers"] = r"""
SELECT 'GRP-' || lpad(row_number() OVER (ORDER BY least)::VARCHAR, greatest(4, length(row_number() OVER (ORDER BY least)::VARCHAR))::INT, '0')
       AS group_name, least, n
FROM (SELECT min(doc_id) AS least, count(*)::BIGINT AS n FROM documents GROUP BY md5(lower(regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g'))))
"""


@query
def new_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    good = table(spark, d, "labels").where("quality = 1")
    toxic = table(spark, d, "labels").where("toxic = 1")
    return relations.new_rows(docs, good, toxic, on="doc_id").select("doc_id", "lang", "source")


SQL["new_ids"] = """
SELECT doc_id, lang, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (quality = 1 OR toxic = 1))
"""


@query
def known_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_semi").select("doc_id", "lang")


SQL["known_ids"] = "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)"


@query
def restore_missing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    current = docs.where("lang <> 'es'").select("doc_id", "lang", F.lit("current").alias("origin"))
    return relations.restore_missing(current, docs.select("doc_id", "source", F.lit("saved").alias("origin")), "doc_id")


SQL["restore_missing"] = """
SELECT doc_id, lang, 'current' AS origin, NULL::VARCHAR AS source FROM documents WHERE lang <> 'es'
UNION ALL SELECT doc_id, NULL, 'saved', source FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'es')
"""


@query
def cache_apply(spark: SparkSession, d: str) -> DataFrame:
    cache = table(spark, d, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, "blocked").alias("source"), F.when(F.col("quality") == 0, "xx").alias("lang")
    )
    return relations.apply_cache(table(spark, d, "documents").select("doc_id", "lang", "source"), cache, "doc_id", ["lang", "source"])


SQL["cache_apply"] = """
SELECT doc_id, CASE WHEN quality = 0 THEN 'xx' ELSE lang END AS lang, CASE WHEN toxic = 1 THEN 'blocked' ELSE source END AS source
FROM documents LEFT JOIN labels USING (doc_id)
"""


@query
def best_candidate(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    rows = docs.select("doc_id", F.lit("old").alias("value"), (F.col("n_chars") % 100).alias("score"))
    a = docs.where("n_chars % 3 > 0").select("doc_id", F.lit("first").alias("value"), (F.col("n_chars") % 90).alias("score"), F.lit(1).alias("priority"))
    b = docs.where("n_chars % 2 = 0").select("doc_id", F.lit("second").alias("value"), (F.col("doc_id") % 120).alias("score"), F.lit(2).alias("priority"))
    return relations.best_candidate(rows, a.union(b), "doc_id", "value", "score", "priority")


SQL["best_candidate"] = """
WITH c AS (
  SELECT doc_id, 'first' AS value, n_chars % 90 AS score, 1 AS p FROM documents WHERE n_chars % 3 > 0
  UNION ALL SELECT doc_id, 'second', doc_id % 120, 2 FROM documents WHERE n_chars % 2 = 0),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, p) = 1)
SELECT d.doc_id, CASE WHEN b.score > n_chars % 100 THEN b.value ELSE 'old' END AS value,
       CASE WHEN b.score > n_chars % 100 THEN b.score ELSE n_chars % 100 END AS score
FROM documents d LEFT JOIN b USING (doc_id)
"""


@query
def intervals_merged(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", F.unix_micros("ts").alias("start"))
    return relations.merge_intervals(e.withColumn("end", F.col("start") + 3_600_000_000), ["user_id"], "start", "end")


SQL["intervals_merged"] = """
WITH e AS (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + 3600000000 AS t FROM events),
b AS (SELECT *, CASE WHEN s <= max(t) OVER (PARTITION BY user_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                THEN 0 ELSE 1 END AS brk FROM e),
i AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS island FROM b)
SELECT user_id, min(s) AS start, max(t) AS "end", count(*)::BIGINT AS n FROM i GROUP BY user_id, island
"""


@query
def last_write_wins(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("ts"), "value")
    return relations.last_write(e, ["user_id", "event_type"], F.struct("ts", "event_id"))


SQL["last_write_wins"] = """
SELECT event_id, user_id, event_type, epoch_us(ts) AS ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""


@query
def paged(spark: SparkSession, d: str) -> DataFrame:
    """The second page of three of each status, by price."""
    w = Window.partitionBy("o_orderstatus").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").withColumn("place", F.row_number().over(w)).where("place BETWEEN 4 AND 6").select("o_orderstatus", "o_orderkey", "place")


SQL["paged"] = """
SELECT o_orderstatus, o_orderkey, place::INT AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders)
WHERE place BETWEEN 4 AND 6
"""


@query
def top_category(spark: SparkSession, d: str) -> DataFrame:
    """The most common language of each source; the first seen wins ties."""
    n = table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    return aggregates.top_per_group(n, ["source"], [F.desc("n"), F.col("first")], 1).select("source", "lang", "n")


SQL["top_category"] = """
SELECT source, lang, n FROM (SELECT source, lang, count(*)::BIGINT AS n, min(doc_id) AS f FROM documents GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, f) = 1
"""


def word_sets(spark: SparkSession, d: str) -> DataFrame:
    """Documents that stand for their set of words: (doc_id, words)."""
    rows = table(spark, d, "documents").select("doc_id", text.word_set(F.col("text")).alias("words"))
    key = F.md5(F.array_join(F.array_sort("words"), " "))
    return rows.groupBy(key.alias("k")).agg(F.min_by(F.struct("doc_id", "words"), "doc_id").alias("r")).select("r.*")


@query
def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of representatives whose word sets have a Jaccard similarity of 0.8 or more."""
    found = similarity.jaccard_pairs(word_sets(spark, d), "doc_id", "words", 0.8)
    return found.select("a", "b", F.col("both").cast("long").alias("n_both"), F.round("jaccard", 9).alias("jaccard"))


SQL["near_duplicates"] = r"""
WITH w AS (
  SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) >= 2)) AS w FROM documents),
r AS (SELECT min(doc_id) AS doc_id, any_value(w) AS w FROM w GROUP BY list_sort(w)),
t AS (SELECT doc_id, len(w) AS n, unnest(w) AS token FROM r),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS n_both
      FROM t x JOIN t y ON x.token = y.token AND x.doc_id < y.doc_id AND least(x.n, y.n) >= 0.8 * greatest(x.n, y.n) - 1e-9 GROUP BY ALL)
SELECT a, b, n_both::BIGINT AS n_both, round(n_both / (na + nb - n_both), 9)::DOUBLE AS jaccard FROM p WHERE n_both >= 0.8 * (na + nb - n_both) - 1e-9
"""


@query
def families(spark: SparkSession, d: str) -> DataFrame:
    """Documents of one text, or of one long text but for case, marks and spaces, or linked by others, as families."""
    key = text.compact(F.col("text"))
    docs = table(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("h"), F.md5(key).alias("k"), F.char_length(key).alias("n"))
    edges = similarity.group_edges(docs, "doc_id", F.col("h")).union(similarity.group_edges(docs, "doc_id", F.col("k"), F.col("n") >= 80))
    found = similarity.components(docs, edges, "doc_id")
    sizes = found.groupBy("component").agg(F.count("*").alias("size"))
    return found.join(sizes, "component").select("doc_id", F.col("component").alias("family"), "size", F.round(1.0 / F.col("size"), 8).alias("weight"))


SQL["families"] = r"""
WITH RECURSIVE k AS (SELECT doc_id, md5(text) AS h, lower(regexp_replace(text, '[^\p{L}\p{N}]+', '', 'g')) AS k FROM documents),
e AS (SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY h) AS b FROM k
      UNION SELECT doc_id, min(doc_id) OVER (PARTITION BY k) FROM k WHERE length(k) >= 80),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM k UNION SELECT reach.a, s.b FROM reach JOIN s ON reach.b = s.a),
f AS (SELECT a AS doc_id, min(b) AS family FROM reach GROUP BY 1)
SELECT doc_id, family, count(*) OVER (PARTITION BY family)::BIGINT AS size,
       round(1.0 / count(*) OVER (PARTITION BY family), 8)::DOUBLE AS weight FROM f
"""


@query
def allocation_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Whether families hold each document once, and their weights sum to the number of families."""
    fam = families(spark, d)
    same = relations.same_ids(fam, table(spark, d, "documents"), "doc_id")
    sums = fam.agg(F.countDistinct("family").alias("n_families"), F.round(F.sum("weight"), 4).alias("weights"))
    return same.withColumn("k", F.lit(1)).join(sums.withColumn("k", F.lit(1)), "k").drop("k")


SQL["allocation_invariants"] = f"""
SELECT 0::BIGINT AS missing_left, 0::BIGINT AS missing_right, 0::BIGINT AS repeated_left, 0::BIGINT AS repeated_right,
       count(DISTINCT family)::BIGINT AS n_families, round(sum(weight), 4)::DOUBLE AS weights FROM ({SQL['families']})
"""


@query
def fuzzy_titles(spark: SparkSession, d: str) -> DataFrame:
    """Part names of one type that are alike by matching blocks; pairs of distinct names."""
    return similarity.blocked_ratio_pairs(table(spark, d, "part"), "p_partkey", "p_type", "p_name", 0.86)


#: Six requests: goal, stage, region, mode, industry.
REQUESTS = [
    (1, "URGENT", "O", "NATION_3", "none", "BUILDING"),
    (2, "LOW", None, "NATION_7", "region_first", None),
    (3, None, "F", "any", "national_only", "MACHINERY"),
    (4, "MEDIUM", "O", "NATION_12", "strict", None),
    (5, None, None, None, "none", "AUTOMOBILE"),
    (6, "HIGH", "P", "NATION_20", "region_first", "HOUSEHOLD"),
]
GOALS = ("URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW")


def offers(spark: SparkSession, d: str) -> DataFrame:
    """Customers as offers: goals from their orders' priorities, stages from statuses, region from their nation."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.array_sort(F.collect_set(F.substring_index("o_orderpriority", "-", -1))).alias("goals"),
        F.array_sort(F.collect_set("o_orderstatus")).alias("stages"),
        F.count("*").alias("n_orders"),
    )
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.join(orders, F.col("c_custkey") == F.col("o_custkey"))
    return rows.select(
        F.col("c_custkey").alias("offer"), "goals", "stages", "n_name", "n_regionkey", "c_mktsegment",
        (F.col("c_custkey") % 4 == 0).alias("national"), (F.col("c_custkey") % 5 == 0).alias("universal"),
        F.when(F.col("c_acctbal") > 5000, "able").when(F.col("c_acctbal") > 0, "check").otherwise("").alias("eligible"),
        F.when(F.col("c_custkey") % 7 > 0, F.col("c_custkey") % 60).alias("days_left"),
        (F.col("c_custkey") % 3 == 0).alias("verified"), (50 + F.col("n_orders") % 50).alias("quality"),
    )


def scored(spark: SparkSession, d: str, asked: list[tuple] = REQUESTS) -> DataFrame:
    """(request, offer, ...) of the offers that pass a request's hard filters: a fixed list of requests, all offers."""
    q = spark.createDataFrame(asked, "request int, goal string, stage string, region string, mode string, industry string")
    groups = table(spark, d, "nation").select(F.col("n_name").alias("qn"), F.col("n_regionkey").alias("region_group"))
    q = q.join(groups, F.col("region") == F.col("qn"), "left")
    both = offers(spark, d).crossJoin(F.broadcast(q))
    o = {
        "goals": F.col("goals"), "stages": F.col("stages"), "industries": F.array("c_mktsegment"), "universal": F.col("universal"),
        "national": F.col("national"), "region": F.col("n_name"), "region_group": F.col("n_regionkey"), "eligible": F.col("eligible"),
        "days_left": F.col("days_left"), "verified": F.col("verified"), "quality": F.col("quality"),
    }
    r = {k: F.col(k) for k in ("goal", "stage", "region", "region_group", "mode", "industry")}
    passes, pool, earned = matching.match_points(o, r)
    rows = both.where(passes).withColumn("pscore", matching.match_score(pool, earned))
    return rows.withColumn("region_order", matching.region_order(o, r)).withColumn(
        "own", F.coalesce(F.col("n_name") == F.col("region"), F.lit(False))
    )


@query
def match_score(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("request", "offer", "pscore", "region_order")


def _scored_sql(asked: list[tuple] = REQUESTS) -> str:
    lit = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    values = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in asked)
    return f"""
q AS (SELECT v.*, n_regionkey AS region_group FROM (VALUES {values}) v(request, goal, stage, region, mode, industry) LEFT JOIN nation ON region = n_name),
o AS (
  SELECT c_custkey AS offer, list(DISTINCT split_part(o_orderpriority, '-', -1)) AS goals, list(DISTINCT o_orderstatus) AS stages,
         any_value(n_name) AS n_name, any_value(n_regionkey) AS rg, c_custkey % 4 = 0 AS national,
         any_value(c_mktsegment) AS segment, c_custkey % 5 = 0 AS universal,
         CASE WHEN any_value(c_acctbal) > 5000 THEN 'able' WHEN any_value(c_acctbal) > 0 THEN 'check' ELSE '' END AS eligible,
         CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 60 END AS days_left, c_custkey % 3 = 0 AS verified, 50 + count(*) % 50 AS quality
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey),
m AS (
  SELECT q.*, o.*, coalesce(n_name = region, false) AS own, coalesce(rg = region_group, false) AS grp,
         region IS NOT NULL AND region <> 'any' AS asks FROM q, o),
s AS (
  SELECT *,
    (CASE WHEN goal IS NOT NULL THEN 40 ELSE 0 END + CASE WHEN stage IS NOT NULL THEN 16 ELSE 0 END + CASE WHEN asks THEN 22 ELSE 0 END
     + CASE WHEN industry IS NOT NULL THEN 22 ELSE 0 END + 18) AS pool,
    (CASE WHEN goal IS NOT NULL THEN [40, 40, 34, 28, 22, 20][1 + least(len(goals), 5)] ELSE 0 END
     + CASE WHEN stage IS NOT NULL THEN 16 ELSE 0 END
     + CASE WHEN asks THEN CASE WHEN own THEN 22 WHEN grp THEN 16 ELSE 11 END ELSE 0 END
     + CASE WHEN industry IS NULL THEN 0 WHEN segment = industry AND NOT universal THEN 22 ELSE 11 END
     + CASE WHEN eligible = 'able' THEN 5 WHEN eligible <> '' THEN 2 ELSE 0 END
     + CASE WHEN days_left IS NULL THEN 2 WHEN days_left BETWEEN 0 AND 14 THEN 4 WHEN days_left BETWEEN 15 AND 45 THEN 2 ELSE 0 END
     + CASE WHEN verified THEN 3 ELSE 0 END + floor(greatest(0.0, (quality - 50) / 50.0 * 6) + 0.5)) AS earned
  FROM m
  WHERE (goal IS NULL OR list_contains(goals, goal)) AND (stage IS NULL OR list_contains(stages, stage))
    AND (industry IS NULL OR universal OR segment = industry) AND (mode <> 'national_only' OR national)
    AND (NOT asks OR CASE WHEN mode = 'strict' THEN (own OR grp) AND NOT national ELSE own OR grp OR national END)),
r AS (
  SELECT request, offer, goal, mode, national, own, grp, days_left,
         greatest(4, least(99, floor(earned::DOUBLE / pool * 99 + 0.5)))::INT AS pscore,
         CASE mode WHEN 'strict' THEN 1.0 WHEN 'national_only' THEN 3.0
           WHEN 'region_first' THEN CASE WHEN own THEN 4.0 WHEN grp THEN 3.5 WHEN national THEN 2.0 ELSE 1.0 END
           ELSE CASE WHEN national THEN 1.0 ELSE 0.0 END END::DOUBLE AS region_order FROM s)"""


SQL["match_score"] = f"WITH {_scored_sql()} SELECT request, offer, pscore, region_order FROM r"


@query
def sections(spark: SparkSession, d: str) -> DataFrame:
    """The first five offers of each section of a request's answer."""
    name = F.when(F.col("mode") == "region_first", F.when(F.col("region_order") >= 3.5, "regional").otherwise("national")).when(
        F.col("mode") == "none", F.when(F.col("national"), "national").otherwise("regional")
    ).otherwise(F.col("mode"))
    rows = scored(spark, d).withColumn("section", name)
    out = matching.top(rows, ["request", "section"], [F.desc("region_order"), F.desc("pscore"), F.col("offer")], 5)
    return out.select("request", "section", "rank", "offer", "pscore")


SQL["sections"] = f"""
WITH {_scored_sql()},
x AS (SELECT *, CASE mode WHEN 'region_first' THEN CASE WHEN region_order >= 3.5 THEN 'regional' ELSE 'national' END
                 WHEN 'none' THEN CASE WHEN national THEN 'national' ELSE 'regional' END ELSE mode END AS section FROM r)
SELECT request, section, rank::INT AS rank, offer, pscore FROM (
  SELECT *, row_number() OVER (PARTITION BY request, section ORDER BY region_order DESC, pscore DESC, offer) AS rank FROM x) WHERE rank <= 5
"""


@query
def sort_override(spark: SparkSession, d: str) -> DataFrame:
    """The first five of each request by days left; an offer without an end comes last."""
    rows = scored(spark, d).withColumn("left", F.coalesce("days_left", F.lit(9999)))
    out = matching.top(rows, ["request"], [F.col("left"), F.desc("pscore"), F.col("offer")], 5)
    return out.select("request", "rank", "offer", F.col("left").cast("long"))


SQL["sort_override"] = f"""
WITH {_scored_sql()}
SELECT request, rank::INT AS rank, offer, l::BIGINT AS "left" FROM (
  SELECT *, coalesce(days_left, 9999) AS l, row_number() OVER (PARTITION BY request ORDER BY coalesce(days_left, 9999), pscore DESC, offer) AS rank
  FROM r) WHERE rank <= 5
"""


#: Each request with each goal in place of its own.
FACETS = [(10 * r[0] + k, g, *r[2:]) for r in REQUESTS for k, g in enumerate(GOALS)]


@query
def facet_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many offers a request would match if it chose another goal."""
    n = scored(spark, d, FACETS).groupBy((F.floor(F.col("request") / 10)).cast("int").alias("request"), "goal").agg(F.count("*").alias("n"))
    return n.select("request", "goal", "n")


SQL["facet_counts"] = f"WITH {_scored_sql(FACETS)} SELECT (request // 10)::INT AS request, goal, count(*)::BIGINT AS n FROM r GROUP BY 1, 2"

#: What is left of a request that is relaxed: its goal.
RELAXED = [(r[0], r[1], None, None, "none", None) for r in REQUESTS if r[1]]


@query
def relaxed_matches(spark: SparkSession, d: str) -> DataFrame:
    """Up to four offers for a request's goal alone that the request itself does not list."""
    listed = scored(spark, d).select("request", "offer")
    more = scored(spark, d, RELAXED).join(listed, ["request", "offer"], "left_anti")
    return matching.top(more, ["request"], [F.desc("region_order"), F.desc("pscore"), F.col("offer")], 4).select("request", "rank", "offer", "pscore")


SQL["relaxed_matches"] = f"""
SELECT request, rank::INT AS rank, offer, pscore FROM (
  SELECT *, row_number() OVER (PARTITION BY request ORDER BY region_order DESC, pscore DESC, offer) AS rank
  FROM (WITH {_scored_sql(RELAXED)} SELECT * FROM r) m
  WHERE NOT EXISTS (SELECT 1 FROM (WITH {_scored_sql()} SELECT request, offer FROM r) l WHERE l.request = m.request AND l.offer = m.offer))
WHERE rank <= 4
"""


@query
def hybrid_rank(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items as requests: the five documents that rank first by length and shared words."""
    q = table(spark, d, "benchmark").select("item_id", text.word_set(F.col("text"), 4).alias("qt"))
    docs = table(spark, d, "documents").select("doc_id", text.word_set(F.col("text"), 4).alias("dt"), F.least(F.col("n_chars") % 100, F.lit(99)).alias("score"))
    lex = matching.lexical_scores(q, docs, "item_id", "doc_id", "qt", "dt")
    ranked = lex.join(docs.select("doc_id", "score"), "doc_id").withColumn("hybrid", F.round(matching.hybrid(F.col("score"), F.col("lex")), 9))
    return matching.top(ranked, ["item_id"], [F.desc("hybrid"), F.col("doc_id")], 5).select("item_id", "rank", "doc_id", "hits", "hybrid")


_WORDS4 = r"list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) >= 4))"
SQL["hybrid_rank"] = f"""
WITH q AS (SELECT item_id, len(t) AS n, unnest(t) AS token FROM (SELECT item_id, {_WORDS4} AS t FROM benchmark)),
d AS (SELECT doc_id, least(n_chars % 100, 99) AS score, unnest({_WORDS4}) AS token FROM documents),
h AS (SELECT item_id, doc_id, count(*)::BIGINT AS hits, round(0.6 * any_value(score) / 99 + 0.4 * (count(*) / any_value(n)), 9) AS hybrid
      FROM q JOIN d USING (token) GROUP BY 1, 2)
SELECT item_id, rank::INT AS rank, doc_id, hits, hybrid FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY hybrid DESC, doc_id) AS rank FROM h) WHERE rank <= 5
"""

SEARCHES = [(1, ["tion", "blest"], "en"), (2, ["eau", "mente"], "fr"), (3, ["keit", "schu"], "de"), (4, ["ción", "mente"], "es")]


@query
def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    """Requests of keywords and a language: two points a keyword, three for the language, the five best of each."""
    each = [
        F.struct(F.lit(i).alias("request"), matching.keyword_score(F.col("text"), words, F.col("lang"), lang).alias("score"))
        for i, words, lang in SEARCHES
    ]
    rows = table(spark, d, "documents").select("doc_id", F.explode(F.array(*each)).alias("s")).select("doc_id", "s.request", "s.score")
    return matching.top(rows.where("score > 0"), ["request"], [F.desc("score"), F.col("doc_id")], 5).select("request", "rank", "doc_id", "score")


def _search_sql() -> str:
    parts = []
    for i, words, lang in SEARCHES:
        points = " + ".join(f"CASE WHEN contains(text, '{w}') THEN 2 ELSE 0 END" for w in words)
        parts.append(f"SELECT {i} AS request, doc_id, {points} + CASE WHEN lang = '{lang}' THEN 3 ELSE 0 END AS score FROM documents")
    return f"""SELECT request, rank::INT AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY request ORDER BY score DESC, doc_id) AS rank FROM ({' UNION ALL '.join(parts)}) WHERE score > 0)
    WHERE rank <= 5"""


SQL["keyword_search"] = _search_sql()


REQUEST_PROFILE = requests.Profile(
    goals={"motion": ["tion", "ing "], "things": ["blest", "onth"], "people": ["ther"]},
    stages={"early": ["Then ", "First"], "late": ["sion", "ded "]},
    regions=requests.Aliases((("thand", "Thand", "north"), ("eaes", "Eaes", "south"), ("thandor", "Thandor", "north"), ("ouan", "Ouan", "west"))),
    nation_wide=("every", "onter"),
    only_there=("onoran", "hain"),
    routes=((r"[?]", "question"), (r"\d", "amount"), (r"^Th", "more")),
)


@query
def request_parse(spark: SparkSession, d: str) -> DataFrame:
    """Texts of the benchmark and of documents as requests in plain words."""
    rows = table(spark, d, "documents").select("doc_id", "text", F.lit("document").alias("kind"))
    rows = rows.unionByName(table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), "text", F.lit("item").alias("kind")))
    out = requests.parse(rows, "text", REQUEST_PROFILE)
    note = requests.explain(F.col("goal"), F.col("stage"), F.col("region"), F.col("mode"))
    return out.select("kind", "doc_id", "goal", F.array_join("goals", ",").alias("goals"), "stage", "region", "region_group", "mode", "route", note.alias("note"))


def _parse_sql() -> str:
    p = REQUEST_PROFILE
    has = lambda ws: "(" + " OR ".join(f"contains(text, '{w}')" for w in ws) + ")"
    first = lambda g: "CASE " + " ".join(f"WHEN {has(ws)} THEN '{n}'" for n, ws in g.items()) + " END"
    place = lambda k: "CASE " + " ".join(f"WHEN contains(text, '{r[0]}') THEN '{r[k]}'" for r in p.regions.longest_first()) + " END"
    goals = ", ".join(f"CASE WHEN {has(ws)} THEN '{n}' END" for n, ws in sorted(p.goals.items()))
    routes = " ".join(f"WHEN regexp_matches(text, '{x}') THEN '{n}'" for x, n in p.routes)
    return f"""
WITH d AS (SELECT 'document' AS kind, doc_id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark),
x AS (SELECT kind, doc_id, {first(p.goals)} AS goal, concat_ws(',', {goals}) AS goals, {first(p.stages)} AS stage,
                  {place(1)} AS region, {place(2)} AS region_group, {has(p.nation_wide)} AS wide, {has(p.only_there)} AS there,
                  CASE {routes} ELSE 'summary' END AS route FROM d),
m AS (SELECT *, CASE WHEN wide AND region IS NULL THEN 'national_only' WHEN region IS NULL THEN 'none' WHEN there THEN 'strict'
                ELSE 'region_first' END AS mode FROM x)
SELECT kind, doc_id, goal, goals, stage, region, region_group, mode, route,
       concat_ws(', ', 'for ' || goal, 'at stage ' || stage, 'in ' || region, 'mode ' || mode) AS note FROM m
"""


SQL["request_parse"] = _parse_sql()
