"""Queries over rows and columns of the driver's tables: text, money, dates, classification, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, money, quality, text
from ..operators import aggregates, relations
from ..session import table

QUERIES, SQL = {}, {}

LEXICON = {
    "motion": ["tion", "ing "],
    "people": ["ther", "than "],
    "things": ["blest", "onth"],
    "places": ["lichkeit", "eaux", "mente"],
}
NEGATION = r"not | no |nicht |sin "


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def dim_distribution(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    length = aggregates.bins(F.col("n_chars"), [(4000, "long"), (400, "middle")], "short")
    return aggregates.count_by(docs, {"lang": F.col("lang"), "source": F.col("source"), "length": length}).unionByName(
        aggregates.count_by(table(spark, d, "conversations"), {"role": F.col("role")})
    )


SQL["dim_distribution"] = """
WITH v AS (
  SELECT 'lang' AS dim, lang AS value FROM documents
  UNION ALL SELECT 'source', source FROM documents
  UNION ALL SELECT 'length', CASE WHEN n_chars >= 4000 THEN 'long' WHEN n_chars >= 400 THEN 'middle' ELSE 'short' END
  FROM documents
  UNION ALL SELECT 'role', role FROM conversations)
SELECT dim, coalesce(nullif(value, ''), '[empty]') AS value, count(*)::BIGINT AS n FROM v GROUP BY 1, 2
"""


@query
def field_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return aggregates.coverage(
        rows,
        {
            "text": text.blank_to_null(F.col("text")).isNotNull(),
            "long": F.col("n_chars") >= 400,
            "labelled": F.col("quality").isNotNull(),
            "good": F.col("quality") == 1,
            "toxic": F.col("toxic") == 1,
        },
    ).withColumn("grade", F.when(F.col("share") >= 90, "always").when(F.col("share") >= 30, "partial").otherwise("rare"))


SQL["field_coverage"] = """
WITH r AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
f AS (
  SELECT 'text' AS field, count(*) FILTER (nullif(trim(text), '') IS NOT NULL) AS present, count(*) AS total FROM r
  UNION ALL SELECT 'long', count(*) FILTER (n_chars >= 400), count(*) FROM r
  UNION ALL SELECT 'labelled', count(*) FILTER (quality IS NOT NULL), count(*) FROM r
  UNION ALL SELECT 'good', count(*) FILTER (quality = 1), count(*) FROM r
  UNION ALL SELECT 'toxic', count(*) FILTER (toxic = 1), count(*) FROM r)
SELECT field, present, total, round(100.0 * present / total, 1)::DOUBLE AS share,
       CASE WHEN round(100.0 * present / total, 1) >= 90 THEN 'always'
            WHEN round(100.0 * present / total, 1) >= 30 THEN 'partial' ELSE 'rare' END AS grade
FROM f
"""


@query
def confidence_coalesce(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    found = text.coalesce_sources(
        (F.col("quality").cast("string"), 0, "labels", "high"),
        (F.when(F.col("lang") != "en", F.col("lang")), 1, "lang", "high"),
        (F.when(F.col("n_chars") > 400, F.col("source")), 2, "source", "medium"),
    )
    return rows.select("doc_id", found.alias("f")).select("doc_id", "f.value", "f.source", "f.confidence")


SQL["confidence_coalesce"] = """
SELECT doc_id,
       CASE WHEN quality IS NOT NULL THEN quality::VARCHAR WHEN lang <> 'en' THEN lang
            WHEN n_chars > 400 AND length(source) > 2 THEN source END AS value,
       CASE WHEN quality IS NOT NULL THEN 'labels' WHEN lang <> 'en' THEN 'lang'
            WHEN n_chars > 400 AND length(source) > 2 THEN 'source' ELSE 'missing' END AS source,
       CASE WHEN quality IS NOT NULL OR lang <> 'en' THEN 'high'
            WHEN n_chars > 400 AND length(source) > 2 THEN 'medium' ELSE 'missing' END AS confidence
FROM documents LEFT JOIN labels USING (doc_id)
"""


@query
def keyword_tags_negated(spark: SparkSession, d: str) -> DataFrame:
    found = text.tags(F.col("text"), LEXICON, NEGATION)
    return table(spark, d, "documents").select("doc_id", F.array_join(found, ",").alias("tags"))


def _tags_sql() -> str:
    def one(k: str) -> str:
        at = f"instr(text, '{k}')"
        start = f"greatest({at} - 50, 1)"
        return f"({at} > 0 AND NOT regexp_matches(substr(text, {start}, {at} + {len(k)} + 50 - {start}), '{NEGATION}'))"

    tags = ", ".join(f"CASE WHEN {' OR '.join(one(k) for k in ks)} THEN '{t}' END" for t, ks in LEXICON.items())
    return f"SELECT doc_id, concat_ws(',', {tags}) AS tags FROM documents"


SQL["keyword_tags_negated"] = _tags_sql()


@query
def tag_frequency(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.element_counts(table(spark, d, "documents"), text.tags(F.col("text"), LEXICON, NEGATION))


SQL["tag_frequency"] = f"""
SELECT coalesce(nullif(value, ''), '[empty]') AS value, count(*)::BIGINT AS n
FROM (SELECT unnest(string_split(tags, ',')) AS value FROM ({_tags_sql()})) GROUP BY 1
"""

EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9]"
PHONE = r"\+?\d{2,4}[ -]\d{3,4}[ -]\d{4}"
URL = r"https?://[A-Za-z0-9./_-]*[A-Za-z0-9/_-]"


@query
def contact_extract(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id",
        text.first_pattern(t, EMAIL).alias("email"),
        text.first_pattern(t, PHONE).alias("phone"),
        text.first_pattern(t, URL).alias("url"),
    )


SQL["contact_extract"] = f"""
SELECT doc_id, nullif(regexp_extract(text, '{EMAIL}', 0), '') AS email,
       nullif(regexp_extract(text, '{PHONE}', 0), '') AS phone, nullif(regexp_extract(text, '{URL}', 0), '') AS url
FROM documents
"""


@query
def html_text(spark: SparkSession, d: str) -> DataFrame:
    clean = text.clean_html(F.col("html"))
    title = text.first_pattern(F.col("html"), r"<title>[^<]*</title>")
    return table(spark, d, "pages").select("page_id", clean.alias("t"), text.clean_html(title).alias("title")).select(
        "page_id", "title", F.char_length("t").cast("long").alias("n_chars"), F.md5("t").alias("text_md5")
    )


def _clean_sql(html: str) -> str:
    out = rf"regexp_replace({html}, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g')"
    for entity, char in text.ENTITIES.items():
        to = "chr(1)" if entity == "&amp;" else "'" + char.replace("'", "''") + "'"
        out = f"replace({out}, '{entity}', {to})"
    out = f"regexp_replace({out}, '&[A-Za-z0-9_#]+;', ' ', 'g')"
    return rf"trim(regexp_replace(replace({out}, chr(1), '&'), '[ \t\n\x0B\f\r]+', ' ', 'g'))"


SQL["html_text"] = f"""
SELECT page_id, {_clean_sql("nullif(regexp_extract(html, '<title>[^<]*</title>', 0), '')")} AS title,
       length({_clean_sql('html')})::BIGINT AS n_chars, md5({_clean_sql('html')}) AS text_md5
FROM pages
"""


@query
def html_headings(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all(F.col("html"), F.lit(r"<h[1-6]>([^<]*)</h[1-6]>"), F.lit(1))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(found).alias("place", "h"))
    return rows.select("page_id", F.col("place").cast("long"), text.clean_html(F.col("h")).alias("heading"))


SQL["html_headings"] = f"""
SELECT page_id, (i - 1)::BIGINT AS place, {_clean_sql('hs[i]')} AS heading
FROM (SELECT page_id, hs, unnest(range(1, len(hs) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '<h[1-6]>([^<]*)</h[1-6]>', 1) AS hs FROM pages))
"""


@query
def section_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    short = F.when(F.char_length("line").between(1, 60), F.col("line"))
    headed = relations.carry_forward(lines, ["doc_id"], "pos", short, "heading")
    bodies = headed.groupBy("doc_id", "heading").agg(
        F.count("*").alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"),
        F.max_by("pos", F.struct(F.char_length("line").alias("n"), (-F.col("pos")).alias("p"))).cast("long").alias("longest"),
    )
    return bodies


SQL["section_carry_forward"] = """
WITH l AS (SELECT doc_id, i - 1 AS pos, ls[i] AS line FROM (
  SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
h AS (SELECT *, last_value(CASE WHEN length(line) BETWEEN 1 AND 60 THEN line END IGNORE NULLS) OVER (
  PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM l)
SELECT doc_id, heading, count(*)::BIGINT AS n_lines, sum(length(line))::BIGINT AS n_chars,
       arg_max(pos, length(line) * 1000000 - pos)::BIGINT AS longest
FROM h GROUP BY 1, 2
"""


@query
def budgeted_excerpt(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    kept = relations.budgeted(lines, ["doc_id"], "pos", "line", 2500)
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.char_length("line")).alias("n_chars"))


SQL["budgeted_excerpt"] = """
WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (
  SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
u AS (SELECT *, 2500 - coalesce(sum(length(line)) OVER (
  PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM l)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(least(length(line), room))::BIGINT AS n_chars
FROM u WHERE room > 0 GROUP BY 1
"""


@query
def money_tokens(spark: SparkSession, d: str) -> DataFrame:
    numbers = F.regexp_extract_all("text", F.lit(r"(\d{2,9})"), F.lit(1))
    values = F.transform(numbers, lambda x: x.cast("long"))
    ranked = F.slice(F.transform(F.array_sort(F.transform(values, lambda v: -v)), lambda v: -v), 1, 3)
    return table(spark, d, "documents").select(
        "doc_id", F.size(numbers).cast("long").alias("n_numbers"), F.array_max(values).alias("largest"),
        F.array_join(F.transform(ranked, lambda v: v.cast("string")), "; ").alias("top3"),
    )


SQL["money_tokens"] = r"""
WITH v AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(\d{2,9})', 1), lambda x: x::BIGINT) AS v FROM documents)
SELECT doc_id, len(v)::BIGINT AS n_numbers, list_max(v) AS largest,
       coalesce(array_to_string(list_reverse_sort(v)[1:3], '; '), '') AS top3 FROM v
"""


@query
def money_labels(spark: SparkSession, d: str) -> DataFrame:
    """Prices as labels of two units, read back."""
    won = (F.col("p_retailprice") * 100).cast("decimal(20,0)").cast("long") * 1000
    label = F.concat(F.floor(won / 100_000_000).cast("string"), F.lit("억 "), F.floor(won % 100_000_000 / 10_000).cast("string"), F.lit("만원"))
    rows = table(spark, d, "part").select("p_partkey", label.alias("label"))
    return rows.select(
        "p_partkey", "label", money.compound_value(F.col("label")).alias("compound"),
        money.first_value(F.col("label")).alias("first_token"), money.largest_value(F.col("label")).alias("largest"),
    )


SQL["money_labels"] = """
WITH p AS (SELECT p_partkey, (p_retailprice * 100)::DECIMAL(20,0)::BIGINT * 1000 AS won FROM part),
l AS (SELECT p_partkey, won // 100000000 AS eok, won % 100000000 // 10000 AS man FROM p)
SELECT p_partkey, eok || '억 ' || man || '만원' AS label, eok * 100000000 + man * 10000 AS compound,
       eok * 100000000 AS first_token, greatest(eok * 100000000, man * 10000) AS largest FROM l
"""


@query
def period_dday(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.lit("1998-06-01 09:00:00").cast("timestamp")
    rows = table(spark, d, "orders").withColumn("left", dates.days_left(F.col("o_orderdate"), as_of))
    return rows.select(
        "o_orderkey", F.col("left").alias("days_left"),
        F.when(F.to_date("o_orderdate") < F.to_date(as_of), "closed").otherwise("open").alias("status"),
        dates.in_window(F.col("o_orderdate").cast("string"), "1997-01-01", "1997-12-31").alias("in_window"),
    )


SQL["period_dday"] = """
WITH x AS (SELECT *, ceil((epoch(o_orderdate::DATE + INTERVAL 1 DAY) - 1 - epoch(TIMESTAMP '1998-06-01 09:00:00')) / 86400.0) AS l FROM orders)
SELECT o_orderkey, CASE WHEN l < 0 THEN -1 ELSE l END::INT AS days_left,
       CASE WHEN o_orderdate::DATE < DATE '1998-06-01' THEN 'closed' ELSE 'open' END AS status,
       o_orderdate::DATE BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AS in_window FROM x
"""


@query
def quality_score(spark: SparkSession, d: str) -> DataFrame:
    p = quality.ENGLISH
    rows = table(spark, d, "documents").select("doc_id", quality.score(F.col("text"), p).alias("score"), quality.issues(F.col("text"), p).alias("i"))
    return rows.select("doc_id", "score", quality.grade(F.col("score")).alias("grade"), F.array_join("i", ",").alias("issues"))


def _quality_sql() -> str:
    p = quality.ENGLISH
    q = lambda x: "'" + x.replace("'", "''") + "'"
    has = lambda ws: "(" + " OR ".join(f"contains(text, {q(w)})" for w in ws) + ")"
    rex = lambda ps: "(" + " OR ".join(f"regexp_matches(text, {q(x)})" for x in ps) + ")"
    twice = "(" + " OR ".join("(" + " + ".join(f"contains(text, {q(w)})::INT" for w in g) + " >= 2)" for g in p.synonyms) + ")"
    pts = lambda c, n: f"CASE WHEN {c} THEN {n} ELSE 0 END"
    one = r"(length(regexp_replace(text, '[^.]+', '', 'g')) = 1 AND NOT contains(text, chr(10)))"
    total = " + ".join(
        [
            f"CASE WHEN {rex([p.best_ending])} THEN 15 WHEN {rex([p.good_ending])} THEN 10 ELSE 0 END",
            "CASE WHEN length(text) BETWEEN 45 AND 100 THEN 10 WHEN length(text) BETWEEN 35 AND 110 THEN 6 ELSE 0 END",
            pts(one, 5), pts("NOT " + has(p.bureaucratic), 10), pts(has(p.motive), 15), pts(has(p.help), 15),
            pts(has(p.target), 10), pts(f"{has(p.motive)} AND {has(p.help)}", 10), pts("NOT " + rex([p.money_or_law]), 10),
        ]
    ) + "".join(f" - {pts(c, n)}" for c, n in ((twice, 8), (rex(p.grammar), 10), (rex(p.unreadable), 5), (rex(p.illogical), 10)))
    issues = ", ".join(
        f"CASE WHEN {c} THEN '{n}' END"
        for c, n in ((twice, "redundancy"), (rex(p.grammar), "grammar"), (rex(p.unreadable), "readability"), (rex(p.illogical), "logic"))
    )
    return f"""
WITH s AS (SELECT doc_id, CASE WHEN coalesce(text, '') = '' OR {has(p.refusal)} THEN 0 ELSE greatest({total}, 0) END::INT AS score,
                  concat_ws(',', {issues}) AS issues FROM documents)
SELECT doc_id, score, CASE WHEN score >= 85 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 50 THEN 'C' ELSE 'D' END AS grade,
       issues FROM s
"""


SQL["quality_score"] = _quality_sql()


@query
def grade_distribution(spark: SparkSession, d: str) -> DataFrame:
    return quality_score(spark, d).groupBy("grade").agg(
        F.count("*").alias("n"), F.min("score").alias("least"), F.max("score").alias("most"), F.round(F.avg("score"), 6).alias("mean")
    )


SQL["grade_distribution"] = f"""
SELECT grade, count(*)::BIGINT AS n, min(score) AS least, max(score) AS most, round(avg(score), 6) AS mean
FROM ({_quality_sql()}) GROUP BY 1
"""


@query
def match_bins(spark: SparkSession, d: str) -> DataFrame:
    share = F.col("o_totalprice") / 5000.0
    name = aggregates.bins(share, [(90, "90-100"), (80, "80-89"), (70, "70-79"), (60, "60-69")], "0-59")
    return table(spark, d, "orders").groupBy(name.alias("bin")).agg(F.count("*").alias("n"))


SQL["match_bins"] = """
SELECT CASE WHEN s >= 90 THEN '90-100' WHEN s >= 80 THEN '80-89' WHEN s >= 70 THEN '70-79' WHEN s >= 60 THEN '60-69' ELSE '0-59' END
       AS bin, count(*)::BIGINT AS n FROM (SELECT coalesce(o_totalprice / 5000.0, 0) AS s FROM orders) GROUP BY 1
"""


@query
def ratio_buckets(spark: SparkSession, d: str) -> DataFrame:
    old, new = F.nullif(F.col("p_size") % 10, F.lit(0)), F.nullif(F.col("p_partkey") % 7, F.lit(0))
    return table(spark, d, "part").groupBy(aggregates.ratio_change(old, new).alias("change")).agg(F.count("*").alias("n"))


SQL["ratio_buckets"] = """
WITH r AS (SELECT nullif(p_size % 10, 0) AS a, nullif(p_partkey % 7, 0) AS b FROM part)
SELECT CASE WHEN a IS NULL AND b IS NULL THEN 'none' WHEN a IS NULL THEN 'new' WHEN b IS NULL THEN 'lost' WHEN a = b THEN 'same'
            WHEN b / a <= 0.1 THEN 'tenth or less' WHEN b / a <= 0.5 THEN 'half or less' WHEN b / a >= 2 THEN 'double or more'
            ELSE 'small' END AS change, count(*)::BIGINT AS n FROM r GROUP BY 1
"""

RULES = {
    "price: high": "l_extendedprice > 90000",
    "price: per piece": "l_extendedprice / l_quantity < 950",
    "rate: discount": "l_discount >= 0.1",
    "rate: no tax": "l_tax = 0",
    "state: late": "l_linestatus = 'O' AND l_returnflag = 'R'",
}


@query
def audit_rules(spark: SparkSession, d: str) -> DataFrame:
    found = aggregates.issues(table(spark, d, "lineitem"), F.col("l_orderkey"), {n: F.expr(c) for n, c in RULES.items()})
    return found.groupBy("area", "rule").agg(F.count("*").alias("n"), F.countDistinct("id").alias("n_ids"))


SQL["audit_rules"] = " UNION ALL ".join(
    f"SELECT '{n.split(':')[0]}' AS area, '{n}' AS rule, count(*)::BIGINT AS n, count(DISTINCT l_orderkey)::BIGINT AS n_ids "
    f"FROM lineitem WHERE {c} HAVING count(*) > 0"
    for n, c in RULES.items()
)


@query
def event_json(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k long")
    return table(spark, d, "events").groupBy("event_type", (parsed["k"] % 10).alias("k")).agg(F.count("*").alias("n"))


SQL["event_json"] = """
SELECT event_type, json_extract(props, '$.k')::BIGINT % 10 AS k, count(*)::BIGINT AS n FROM events GROUP BY 1, 2
"""


@query
def law_panel(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.panel(table(spark, d, "nation"), "n_regionkey", "n_name")


SQL["law_panel"] = """
SELECT n_regionkey, count(*)::BIGINT AS n_rows, array_to_string(list_sort(list(n_name))[1:3], ',') AS sample FROM nation GROUP BY 1
"""


@query
def agency_panel(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    each = s.groupBy("n_name").agg(F.count("*").alias("n"), F.count_if(F.col("s_acctbal") > 5000).alias("n_able"), F.min("s_name").alias("first"))
    return aggregates.top_per_group(each.withColumn("g", F.lit(1)), ["g"], [F.desc("n"), F.col("n_name")], 8).drop("g").withColumn("rank", F.col("rank").cast("long"))


SQL["agency_panel"] = """
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY n DESC, n_name)::BIGINT AS rank FROM (
  SELECT n_name, count(*)::BIGINT AS n, count(*) FILTER (s_acctbal > 5000)::BIGINT AS n_able, min(s_name) AS first
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)) WHERE rank <= 8
"""


@query
def failure_codes(spark: SparkSession, d: str) -> DataFrame:
    """Errors of page urls by the code before the colon."""
    kind = F.when(F.rlike("url", F.lit(r"\.(png|jpg|gif)$")), "OCR_NEEDED: image").when(F.rlike("url", F.lit(r"\.(zip|xls|pptx)$")), "UNSUPPORTED_FORMAT: archive").when(
        F.contains("html", F.lit("</html>")), "OK"
    ).otherwise("UNKNOWN_FORMAT: no end")
    return table(spark, d, "pages").groupBy(F.substring_index(kind, ":", 1).alias("code")).agg(F.count("*").alias("n"))


SQL["failure_codes"] = r"""
SELECT CASE WHEN regexp_matches(url, '\.(png|jpg|gif)$') THEN 'OCR_NEEDED'
            WHEN regexp_matches(url, '\.(zip|xls|pptx)$') THEN 'UNSUPPORTED_FORMAT'
            WHEN contains(html, '</html>') THEN 'OK' ELSE 'UNKNOWN_FORMAT' END AS code, count(*)::BIGINT AS n FROM pages GROUP BY 1
"""
