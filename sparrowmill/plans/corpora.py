"""Queries over whole texts and vectors: reduced terms, groups by many keys, canonical forms, measures and repairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical, text, wording
from ..operators import aggregates, allocation, gridfit, records, retry, selection, similarity, textmodels, validity
from ..session import spread, table
from ..streaming import runs

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def text_svd(spark: SparkSession, d: str) -> DataFrame:
    """Documents in 60 dimensions: how many known terms each has, their weights' sum, and the reduced row's length."""
    rows, reduced = textmodels.reduce_texts(table(spark, d, "documents"), "doc_id", F.col("text"))
    length = F.round(F.sqrt(validity.dot(F.col("vector"), F.col("vector"))), 6)
    summed = F.round(F.aggregate("weights", F.lit(0.0), lambda s, x: s + x), 6)
    known = rows.select("doc_id", F.size("ats").alias("n_terms"), summed.alias("weights"))
    return known.join(reduced.rows.select("doc_id", F.size("vector").alias("dims"), length.alias("length")), "doc_id")


SQL["text_svd"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
g AS (SELECT doc_id, unnest(list_concat(w, list_transform(list_zip(w[1:-2], w[2:]), lambda p: p[1] || ' ' || p[2]))) AS t FROM w),
tf AS (SELECT doc_id, t, count(*) AS tf FROM g GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM documents),
v AS (SELECT t, count(*) AS df, sum(tf) AS often FROM tf, n GROUP BY t, n HAVING count(*) >= 2 AND count(*) <= 0.98 * n ORDER BY often DESC, t LIMIT 3000),
x AS (SELECT doc_id, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN v USING (t), n)
SELECT d.doc_id, count(w)::INTEGER AS n_terms, round(coalesce(sum(w) / sqrt(sum(w * w)), 0), 6)::DOUBLE AS weights,
       60::INTEGER AS dims, CASE WHEN count(w) > 0 THEN 1 ELSE 0 END::DOUBLE AS length
FROM documents d LEFT JOIN x USING (doc_id) GROUP BY d.doc_id
"""


@query
def cluster_measures(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return validity.measures(e, F.col("embedding"), F.col("label"))


SQL["cluster_measures"] = """
WITH e AS (SELECT vec_id, label AS c, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
u AS (SELECT *, list_transform(x, lambda y: y / sqrt(list_dot_product(x, x))) AS u FROM e),
f AS (SELECT vec_id, c, unnest(x) AS x, unnest(u) AS u, unnest(range(len(x))) AS i FROM u),
s AS (SELECT c, i, sum(u) AS su, avg(x) AS m FROM f GROUP BY 1, 2),
v AS (SELECT c, list(su ORDER BY i) AS su, list(m ORDER BY i) AS m FROM s GROUP BY 1),
n AS (SELECT c, count(*)::DOUBLE AS n FROM e GROUP BY 1), k AS (SELECT v.*, n FROM v JOIN n USING (c)),
p AS (SELECT u.vec_id, u.c, k.c AS o, CASE WHEN u.c = k.c THEN (n - list_dot_product(u.u, k.su)) / (n - 1) ELSE 1 - list_dot_product(u.u, k.su) / n END AS d,
      list_distance(u.x, k.m) AS far, n FROM u, k),
ab AS (SELECT vec_id, c, any_value(d) FILTER (c = o) AS a, min(d) FILTER (c <> o) AS b, any_value(far) FILTER (c = o) AS far FROM p GROUP BY 1, 2),
w AS (SELECT c, avg(far) AS spread, sum(far * far) AS within FROM ab GROUP BY 1),
g AS (SELECT list(m ORDER BY i) AS g FROM (SELECT i, avg(x) AS m FROM f GROUP BY 1)),
b AS (SELECT sum(n * power(list_distance(m, g), 2)) AS between FROM k, g),
r AS (SELECT avg(r) AS db FROM (SELECT x.c, max((wx.spread + wy.spread) / list_distance(x.m, y.m)) AS r
      FROM k x JOIN k y ON x.c <> y.c JOIN w wx ON wx.c = x.c JOIN w wy ON wy.c = y.c GROUP BY 1)),
t AS (SELECT count(*) AS n, count(DISTINCT c) AS k, avg((b - a) / greatest(a, b)) AS s FROM ab)
SELECT t.n::BIGINT AS n, t.k::BIGINT AS clusters, round(s, 6)::DOUBLE AS silhouette, round(db, 6)::DOUBLE AS davies_bouldin,
       round((between / (t.k - 1)) / ((SELECT sum(within) FROM w) / (t.n - t.k)), 4)::DOUBLE AS calinski_harabasz FROM t, b, r
"""


@query
def fold_strength(spark: SparkSession, d: str) -> DataFrame:
    """Prediction strength of nearest centres over five folds of whole groups of vectors."""
    e = table(spark, d, "embeddings").withColumn("family", F.floor(F.sqrt(F.col("vec_id"))).cast("long"))
    return validity.held_out_strength(e, "vec_id", "embedding", "label", "family", 5)


SQL["fold_strength"] = """
WITH RECURSIVE e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x, floor(sqrt(vec_id))::BIGINT AS g FROM embeddings),
sz AS (SELECT g, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, g) AS i FROM e GROUP BY g),
deal AS (SELECT 0::BIGINT AS i, [0, 0, 0, 0, 0]::BIGINT[] AS load, NULL::BIGINT AS g, NULL::INTEGER AS fold
  UNION ALL SELECT sz.i, list_transform(deal.load, lambda y, j: CASE WHEN j = list_position(deal.load, list_min(deal.load)) THEN y + sz.n ELSE y END),
    sz.g, (list_position(deal.load, list_min(deal.load)) - 1)::INTEGER FROM deal JOIN sz ON sz.i = deal.i + 1),
x AS (SELECT e.*, fold FROM e JOIN deal USING (g)),
f AS (SELECT vec_id, fold, label, unnest(x) AS x, unnest(range(len(x))) AS i FROM x),
own AS (SELECT fold, label, i, avg(x) AS m FROM f GROUP BY ALL),
rest AS (SELECT k.fold, f.label, f.i, avg(f.x) AS m FROM (SELECT DISTINCT fold FROM x) k JOIN f ON f.fold <> k.fold GROUP BY ALL),
vo AS (SELECT fold, label, list(m ORDER BY i) AS m FROM own GROUP BY ALL), vr AS (SELECT fold, label, list(m ORDER BY i) AS m FROM rest GROUP BY ALL),
a AS (SELECT vec_id, x.fold, vr.label AS a FROM x JOIN vr USING (fold) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(power(list_distance(x.x, vr.m), 2), 6), vr.label) = 1),
b AS (SELECT vec_id, vo.label AS b FROM x JOIN vo USING (fold) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(power(list_distance(x.x, vo.m), 2), 6), vo.label) = 1),
n AS (SELECT fold, a, b, count(*)::DOUBLE AS n FROM a JOIN b USING (vec_id) GROUP BY ALL),
s AS (SELECT fold, a, CASE WHEN sum(n) > 1 THEN sum(n * (n - 1)) / (sum(n) * (sum(n) - 1)) END AS s FROM n GROUP BY ALL)
SELECT fold, (SELECT count(*) FROM x WHERE x.fold = s.fold)::BIGINT AS rows, round(coalesce(min(s), 1), 9)::DOUBLE AS strength FROM s GROUP BY fold
"""


def _record(docs: DataFrame) -> tuple[DataFrame, dict]:
    """Documents as records: the first line as title, the first 150 characters as summary, the last 20 as period."""
    body = F.coalesce(F.col("text"), F.lit(""))
    first = F.split_part(body, F.lit("\n"), F.lit(1))
    fields = {
        "title": F.concat(F.lit("["), F.col("source"), F.lit("] "), first), "summary": F.left(body, F.lit(150)), "period": F.right(body, F.lit(20)),
        "region": F.col("lang"), "institution": F.col("source"), "executor": F.lit(None).cast("string"),
        "category": F.col("lang"), "subcategory": F.lit(""),
    }
    lines = F.slice(F.split(body, "\n"), 1, 12)
    structure = F.struct(F.struct(lines.alias("lines"), F.col("lang").alias("kind")).alias("support"), F.col("source").alias("institution"))
    return docs, {"fields": fields, "structure": structure}


@query
def allocations(spark: SparkSession, d: str) -> DataFrame:
    """Publications, contents and families of documents taken as records, by five keys."""
    docs, how = _record(table(spark, d, "documents"))
    return allocation.allocate(allocation.keyed(docs, "doc_id", **how), "doc_id")


_NORMAL = r"trim(regexp_replace(replace(lower({}), 'ß', 'ss'), '[\s\x1C-\x1F\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g'))"
SQL["allocations"] = rf"""
WITH RECURSIVE r AS (
  SELECT doc_id, source, lang, {_NORMAL.format("'[' || source || '] ' || split_part(coalesce(text, ''), chr(10), 1)")} AS title,
         {_NORMAL.format("left(coalesce(text, ''), 150)")} AS summary, {_NORMAL.format("right(coalesce(text, ''), 20)")} AS period,
         list_sort(list_transform(string_split(coalesce(text, ''), chr(10))[1:12], lambda x: {_NORMAL.format('x')})) AS lines FROM documents),
k AS (SELECT doc_id, lang, source, regexp_replace(title, '[^\p{{L}}\p{{N}}]+', '', 'g') AS head, period, lines,
             regexp_replace(summary, '[^\p{{L}}\p{{N}}]+', '', 'g') AS s,
             regexp_replace(regexp_replace(title, '^\[[^\]]*\]', ''), '[^\p{{L}}\p{{N}}]+', '', 'g') AS stem FROM r),
u AS (SELECT doc_id AS a, 0 AS kind, md5(concat_ws('|', head, lang, source, s, period)) AS key FROM k
  UNION ALL SELECT doc_id, 1, md5('x' || lang || '|' || source || '|' || lines::VARCHAR) FROM k
  UNION ALL SELECT doc_id, 1, md5('y' || lang || '|' || source || '|' || s) FROM k WHERE length(s) >= 40
  UNION ALL SELECT doc_id, 2, md5('f' || stem) FROM k WHERE length(stem) >= 8
  UNION ALL SELECT doc_id, 2, md5('s' || s) FROM k WHERE length(s) >= 80),
w AS (SELECT a, kind, key FROM u UNION ALL SELECT a, 2, key || kind FROM u WHERE kind < 2),
e AS (SELECT DISTINCT kind, a, min(a) OVER (PARTITION BY kind, key) AS b FROM w),
s AS (SELECT kind, a, b FROM e UNION SELECT kind, b, a FROM e),
reach AS (SELECT kind, doc_id AS a, doc_id AS b FROM k, (SELECT unnest([0, 1, 2]) AS kind) UNION SELECT s.kind, reach.a, s.b FROM reach JOIN s ON reach.b = s.a AND reach.kind = s.kind)
SELECT a AS doc_id, min(b) FILTER (kind = 0) AS publication, min(b) FILTER (kind = 1) AS content, min(b) FILTER (kind = 2) AS family FROM reach GROUP BY a
"""


@query
def structure_digests(spark: SparkSession, d: str) -> DataFrame:
    """Digests of events as nested values: properties as a map, the rest as a struct, and a list in two orders."""
    e = spread(table(spark, d, "events"))
    props = F.from_json("props", "map<string,string>")
    value = F.struct(F.col("value"), F.struct(F.col("event_type").alias("type"), F.lit(0).alias("zero")).alias("event"), props.alias("props"), F.array("event_type", F.upper(F.col("props")), F.lit("A  b")).alias("list"))
    turned = F.struct(F.array(F.lit("a b"), F.upper(F.col("props")), "event_type").alias("list"), props.alias("props"), F.struct(F.lit(0).alias("zero"), F.col("event_type").alias("type")).alias("event"), F.col("value"))
    rows = e.select("event_id", value.alias("v"), turned.alias("t"))
    kinds = rows.schema["v"].dataType, rows.schema["t"].dataType
    return rows.select("event_id", canonical.digest(F.col("v"), kinds[0]).alias("digest"), (canonical.digest(F.col("v"), kinds[0]) == canonical.digest(F.col("t"), kinds[1])).alias("same"))


SQL["structure_digests"] = r"""
WITH x AS (SELECT event_id, lower(event_type) AS t, lower(props) AS p, CASE WHEN value = 0 THEN '' ELSE lower(value::VARCHAR) END AS v,
  list_sort(['"' || lower(event_type) || '"', '"' || replace(lower(props), '"', '\"') || '"', '"a b"']) AS l,
  json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, sha1('{"event":{"type":"' || t || '","zero":""},"list":[' || array_to_string(l, ',') || '],"props":{"k":"' || k || '"},"value":"' || v || '"}') AS digest, true AS same FROM x
"""

#: Terms of the invented tongues, a particle that follows a closed syllable, and how words are said twice.
PLAIN_TERMS = (("worthless", "of no worth"), ("inthe", "in the"), ("tion", "sion"), ("les ", "des "))


@query
def term_replacements(spark: SparkSession, d: str) -> DataFrame:
    """Documents with terms replaced; after a new word ' a ' becomes ' an ', and a repeated last word goes."""
    out = wording.replace_terms(F.col("text"), PLAIN_TERMS, ((" a ", " an "), ("s ", "s- ")), "(?: of| the)", r"([.,]?\s)", lambda w: w[-1] in "hn")
    return table(spark, d, "documents").select("doc_id", out.alias("o")).select("doc_id", F.md5("o.text").alias("text"), "o.applied")


SQL["term_replacements"] = r"""
WITH a AS (SELECT doc_id, replace(text, 'worthless', 'of no worth') AS t, contains(text, 'worthless') AS h1 FROM documents),
b AS (SELECT doc_id, h1, replace(t, 'inthe', 'in the') AS t, contains(t, 'inthe') AS h2 FROM a),
c AS (SELECT doc_id, h1, h2, replace(t, 'tion', 'sion') AS t, contains(t, 'tion') AS h3 FROM b),
e AS (SELECT doc_id, h1, h2, h3, replace(t, 'les ', 'des ') AS t, contains(t, 'les ') AS h4 FROM c),
f AS (SELECT *, CASE WHEN h1 THEN regexp_replace(replace(replace(t, 'of no worth a ', 'of no worth an '), 'of no worths ', 'of no worths- '), 'of no worth(?: of| the)\s+worth([.,]?\s)', 'of no worth\1', 'g') ELSE t END AS u FROM e),
g AS (SELECT *, CASE WHEN h2 THEN regexp_replace(u, 'in the(?: of| the)\s+the([.,]?\s)', 'in the\1', 'g') ELSE u END AS v FROM f),
h AS (SELECT *, CASE WHEN h3 THEN regexp_replace(replace(replace(v, 'sion a ', 'sion an '), 'sions ', 'sions- '), 'sion(?: of| the)\s+sion([.,]?\s)', 'sion\1', 'g') ELSE v END AS w FROM g),
i AS (SELECT *, CASE WHEN h4 THEN regexp_replace(w, 'des (?: of| the)\s+des([.,]?\s)', 'des \1', 'g') ELSE w END AS x FROM h)
SELECT doc_id, md5(x) AS text, concat_ws(',', CASE WHEN h1 THEN 'worthless→of no worth' END, CASE WHEN h2 THEN 'inthe→in the' END, CASE WHEN h3 THEN 'tion→sion' END, CASE WHEN h4 THEN 'les →des ' END) AS applied FROM i
"""


@query
def source_statistics(spark: SparkSession, d: str) -> DataFrame:
    """What each source fills in: text, lang, n_chars, first line and a mark of lists."""
    docs = table(spark, d, "documents").withColumn("first", F.nullif(F.split_part("text", F.lit("\n"), F.lit(2)), F.lit(""))).withColumn(
        "marks", F.nullif(F.regexp_extract("text", r"[|•#]", 0), F.lit(""))
    )
    return aggregates.field_statistics(docs, "source", ["text", "lang", "n_chars", "first", "marks"])


SQL["source_statistics"] = r"""
WITH d AS (SELECT source, text, lang, n_chars::VARCHAR AS n_chars, nullif(split_part(text, chr(10), 2), '') AS first, nullif(regexp_extract(text, '[|•#]'), '') AS marks FROM documents),
u AS (SELECT source, 'text' AS field, text AS v FROM d UNION ALL SELECT source, 'lang', lang FROM d UNION ALL SELECT source, 'n_chars', n_chars FROM d
      UNION ALL SELECT source, 'first', first FROM d UNION ALL SELECT source, 'marks', marks FROM d)
SELECT source, field, count(*)::BIGINT AS n_rows, count(v) FILTER (trim(v) <> '')::BIGINT AS present, round(100.0 * count(v) FILTER (trim(v) <> '') / count(*), 1)::DOUBLE AS share,
  min(length(v)) FILTER (trim(v) <> '')::INTEGER AS shortest, max(length(v)) FILTER (trim(v) <> '')::INTEGER AS longest,
  round(avg(length(v)) FILTER (trim(v) <> ''), 2)::DOUBLE AS average FROM u GROUP BY 1, 2
"""


@query
def completeness(spark: SparkSession, d: str) -> DataFrame:
    """How many of five fields documents have, as distribution by language."""
    docs = table(spark, d, "documents").withColumn("first", F.split_part("text", F.lit("\n"), F.lit(2))).withColumn("marks", F.regexp_extract("text", r"[|•#]", 0))
    docs = docs.withColumn("many", F.when(F.col("n_chars") > 1000, F.col("n_chars")))
    share = aggregates.completeness(docs, ["text", "source", "first", "marks", "many"])
    return docs.withColumn("share", share).groupBy("lang", "share").agg(F.count("*").alias("n"))


SQL["completeness"] = r"""
SELECT lang, round(((trim(text) <> '')::INT + (trim(source) <> '')::INT + (trim(split_part(text, chr(10), 2)) <> '')::INT
  + (regexp_extract(text, '[|•#]') <> '')::INT + (n_chars > 1000)::INT) / 5.0, 4)::DOUBLE AS share, count(*)::BIGINT AS n FROM documents GROUP BY 1, 2
"""


#: What a text may suffer from, and what mends it, in order; a model would answer in its place.
REPAIRS = (("marks", r"[|•#]+", " "), ("lines", r"\n+", " "), ("digits", r"[0-9]+", ""), ("space", r" {2,}", " "))


def _weak(t):
    return retry.weaknesses(t, {**{n: F.rlike(t, F.lit(p)) for n, p, _ in REPAIRS}, "long": F.char_length(t) > 2000, "start": F.rlike(t, F.lit("^[a-z]"))})


def _mend(rows: DataFrame) -> DataFrame:
    """Mends the first weakness named; it knows no answer to a wrong start."""
    first, out = F.col("hints")[0], F.when(F.col("hints")[0] == "long", F.left("text", F.lit(2000)))
    for name, pattern, new in REPAIRS:
        out = out.when(first == name, F.regexp_replace("text", pattern, new))
    return rows.select("doc_id", out.alias("answer"))


@query
def retry_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Documents mended in at most six rounds, a weakness at a time, while their score rises."""
    score = lambda t: 100 - 15 * F.size(_weak(t))
    out = retry.improve(table(spark, d, "documents"), "doc_id", "text", _mend, score, _weak, 95, 6)
    return out.select("doc_id", F.md5("text").alias("text"), "score", "accepted", "asked")


_SCORE = "100 - 15 * ((regexp_matches({0}, '[|•#]+'))::INT + regexp_matches({0}, '\\n+')::INT + regexp_matches({0}, '[0-9]+')::INT + regexp_matches({0}, ' {{2,}}')::INT + (length({0}) > 2000)::INT + regexp_matches({0}, '^[a-z]')::INT)"
SQL["retry_rounds"] = rf"""
WITH RECURSIVE s AS (
  SELECT doc_id, coalesce(text, '') AS text, {_SCORE.format("coalesce(text, '')")} AS score, 0 AS round, 0 AS accepted, true AS mended FROM documents
  UNION ALL SELECT doc_id, CASE WHEN new > score THEN answer ELSE text END, greatest(score, coalesce(new, 0)), round + 1,
    accepted + coalesce(new > score, false)::INT, coalesce(new > score, false) FROM (
      SELECT *, {_SCORE.format("answer")} AS new FROM (
        SELECT *, CASE WHEN regexp_matches(text, '[|•#]+') THEN regexp_replace(text, '[|•#]+', ' ', 'g') WHEN regexp_matches(text, '\n+') THEN regexp_replace(text, '\n+', ' ', 'g')
          WHEN regexp_matches(text, '[0-9]+') THEN regexp_replace(text, '[0-9]+', '', 'g') WHEN regexp_matches(text, ' {{2,}}') THEN regexp_replace(text, ' {{2,}}', ' ', 'g')
          WHEN length(text) > 2000 THEN left(text, 2000) END AS answer FROM s WHERE score < 95 AND round < 6))),
r AS (SELECT round FROM s WHERE round > 0 GROUP BY round HAVING NOT bool_or(mended) ORDER BY round LIMIT 1),
l AS (SELECT s.* FROM s WHERE round <= coalesce((SELECT round FROM r), 6) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round DESC) = 1)
SELECT doc_id, md5(text) AS text, score::DOUBLE AS score, accepted::INTEGER AS accepted, round::INTEGER AS asked FROM l
"""


@query
def staged_run(spark: SparkSession, d: str) -> DataFrame:
    """Documents cleaned in flushed parts, measured and reported on by a run of three steps that is published at its end."""
    steps = [
        runs.Step("clean", lambda s, _: table(s, d, "documents").select("doc_id", "lang", "source", text.squeeze(F.col("text")).alias("text")), ("doc_id", 4)),
        runs.Step("measured", lambda s, t: t["clean"].select("lang", "source", F.char_length("text").alias("n"), F.size(F.split("text", " ")).alias("words"))),
        runs.Step("report", lambda s, t: t["measured"].groupBy("lang", "source").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_chars"), F.max("words").alias("most_words"))),
    ]
    root = similarity.scratch_path(spark, "runs")
    run = runs.Run(spark, root, "first", steps)
    run.go()
    run.publish()
    return runs.published(spark, root, "report")


SQL["staged_run"] = r"""
WITH c AS (SELECT lang, source, trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS t FROM documents)
SELECT lang, source, count(*)::BIGINT AS n_docs, sum(length(t))::BIGINT AS n_chars, max(len(string_split(t, ' ')))::INTEGER AS most_words FROM c GROUP BY 1, 2
"""


@query
def kmeans_many_starts(spark: SparkSession, d: str) -> DataFrame:
    """Vectors by k-means from 20 starts in shared passes: the clustering's measures."""
    e = table(spark, d, "embeddings")
    best = textmodels.kmeans_starts(e, "vec_id", F.col("embedding"), 10)
    return validity.measures(textmodels.kmeans_assign(e, "vec_id", F.col("embedding"), best.centres).join(e, "vec_id"), F.col("embedding"), F.col("cluster"))


@query
def grid_fits(spark: SparkSession, d: str) -> DataFrame:
    """Four methods by three numbers of clusters over a stated sample of vectors: measures, and which fit to prefer."""
    e = table(spark, d, "embeddings")
    ids, x = gridfit.sample(e, "vec_id", F.col("embedding"), 400)
    grid = [(m, k, 42) for m in gridfit.METHODS for k in (4, 7, 10)]
    fits = similarity.cut(gridfit.fit_grid(spark, x, np.array(ids) // 5, grid))
    best = selection.preferred(selection.best_by_method(fits, "method", "fit"), "fit").select("fit", "preferred")
    return fits.join(best, "fit", "left").withColumn("best", F.col("preferred").isNotNull()).withColumn("preferred", F.coalesce("preferred", F.lit(False)))


@query
def encoded_columns(spark: SparkSession, d: str) -> DataFrame:
    """Languages and sources of documents as places among their sorted levels, languages also as ones and zeros."""
    docs = table(spark, d, "documents")
    known = records.levels(docs, ["lang", "source"])
    hot = F.array_join(records.one_hot("lang", known["lang"]).cast("array<string>"), "")
    return docs.withColumn("hot", hot).select("doc_id", *[records.label_encoded(c, known[c]).alias(c) for c in known], "hot")


SQL["encoded_columns"] = """
WITH l AS (SELECT lang, dense_rank() OVER (ORDER BY lang) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT lang FROM documents)),
s AS (SELECT source, dense_rank() OVER (ORDER BY source) - 1 AS k FROM (SELECT DISTINCT source FROM documents))
SELECT doc_id, l.k::INTEGER AS lang, s.k::INTEGER AS source, repeat('0', l.k::INTEGER) || '1' || repeat('0', (n - l.k - 1)::INTEGER) AS hot FROM documents JOIN l USING (lang) JOIN s USING (source)
"""


@query
def assignment_table(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with a column of labels for each of two models."""
    e = table(spark, d, "embeddings")
    near = validity.nearest(e.withColumn("x", F.col("embedding").cast("array<double>")), "x", validity.centres(e, "embedding", "label"), "label", "c")
    signs = e.select("vec_id", F.lit("sign_k2").alias("model"), (F.col("embedding")[0] > 0).cast("int").alias("cluster"))
    labels = near.select("vec_id", F.lit("centre_k10").alias("model"), F.col("c").alias("cluster")).unionByName(signs)
    return records.assignment_rows(e.select("vec_id", "label"), "vec_id", labels, ["centre_k10", "sign_k2"])


SQL["assignment_table"] = """
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
f AS (SELECT label, unnest(x) AS x, unnest(range(len(x))) AS i FROM e), m AS (SELECT label, i, avg(x) AS m FROM f GROUP BY 1, 2),
v AS (SELECT label, list(m ORDER BY i) AS m FROM m GROUP BY 1),
a AS (SELECT vec_id, v.label AS c FROM e, v QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(power(list_distance(x, m), 2), 6), v.label) = 1)
SELECT vec_id, label, c AS centre_k10, (x[1] > 0)::INTEGER AS sign_k2 FROM e JOIN a USING (vec_id)
"""


@query
def source_sets(spark: SparkSession, d: str) -> DataFrame:
    """The languages of each source, and how many there are."""
    return aggregates.group_sets(table(spark, d, "documents"), "source", "lang").select("source", "n_values", F.array_join("values", ",").alias("langs"))


SQL["source_sets"] = """
SELECT source, count(DISTINCT lang)::BIGINT AS n_values, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs FROM documents GROUP BY source
"""
