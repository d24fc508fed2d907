"""Queries over notices made of the driver's rows: each part is a notice, its words picked by its numbers.

The engine reads notices through the rules in functions.policy and functions.classify; the SQL is written by hand, in notices_sql and here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, extract, policy
from ..functions.portable import Duck, Spark
from ..operators import aggregates, records, selection
from ..session import spread, table
from . import notices_sql

QUERIES, SQL = {}, {}
#: By query, the columns it adds to notices.
ADDED = {}
SPARK, DUCK = Spark(), Duck()
AS_OF = "2026-06-01"


def pick(key: str, options: list[str]) -> str:
    cases = " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(options))
    return f"(CASE CAST(({key}) % {len(options)} AS INT) {cases} END)"


REGION = ["서울", "경기", "부산", "강원", "공통", "인천", "전북", "제주"]
THEME = [
    "소상공인 경영안정 자금", "스마트 공장 도입", "청년 창업 지원", "수출 바우처", "재도전 폐업", "전통시장 환경 개선", "고용 안정 장려금",
    "노란우산 공제", "관광객 유치 여행업", "카페 온라인 판로", "디자인 개발", "주거 전세 보증금", "음식점 위생",
]
BENEFIT = [
    "이차보전 및 자금 보증", "컨설팅과 진단 지원", "시제품 제작과 마케팅", "인건비 및 채용 장려금", "", "해외 전시 참가비", "교육 훈련 바우처 - 현장 실습 포함",
    "노후 시설 개선", "키오스크 보급",
]
LABEL = [
    "최대 5,000만원", "업체당 2천만원 이내", "1억 5천만원", "총 300억원", "4,000천원", "40,000,000원", "00백만원 ; 3백만원", "1조 2천억원", "10백만원 ~ 20백만원",
    "", "4,000만원(사천만원)", "지원 규모 확인 필요", "8억 5천만원 또는 차등", "0원 ()", "150억원",
]
PURPOSE = [
    "중소기업의 경영애로를 해소하기 위하여 추진하고자 하는 사업을 지원합니다", "자생력이 약한 소상공인을 돕는 사업이에요.", "「지역기업 육성 조례」 제3조에 따라 지역 기업의 성장을 도모합니다",
    "강원도에 소재한 기업", "짧은 목적", "전세 보증금이 부담되는 가구를 지원하고자 하는 사업을 다음과 같이 공고합니다", "담보력이 부족한 사업자의 경쟁력 제고를 위해 운영합니다.",
]
PAPERS = [
    "사업자등록증|신분증 사본|신청서", "", " 신청서 |평가 후 제출|통장사본|통장사본|x", "매우 길고 띄어쓰기가 아주 많은 문장형 안내", "납세증명서|계획서(서식 1, 서식 2)|협약 서류", "재직증명|보완 시",
]
STEPS = ["접수|12 -|서류 심사|발표 평가|선정", "", "1|2|--", "온라인 신청|현장 실사|a|협약 체결|지급|정산|보고|종료"]
#: Columns of a notice over those of part, in words that both dialects understand.
NOTICE = {
    "id": "p_partkey",
    "title": f"concat('[', {pick('p_partkey', REGION)}, '] 2026년 ', {pick('p_partkey + p_size', THEME)}, ' 사업')",
    "subcategory": pick("p_size", ["융자", "보증", "온라인", "컨설팅", "시설/입지지원", "사업화지원", "정보화지원", "디자인/상품화/사업화", "기타", "교육", "인증"]),
    "category": pick("p_partkey", ["금융", "창업", "기술", "경영", "내수"]),
    "target": pick("p_size", ["소상공인", "중소기업", "창업벤처", "사회적기업", "", "7년 미만 기업"]),
    "summary": f"concat({pick('p_partkey', ['창업 3년 미만 기업', '예비창업자', '도내 중소기업', '소공인', '농업인', '누구나'])}, ' / ', {pick('p_partkey + 2 * p_size', BENEFIT)})",
    "benefits": pick("p_partkey + 2 * p_size", BENEFIT),
    "purpose_list": pick("p_size", ["운전자금,이자보전", "인건비", "", "마케팅비,수출", "시설개보수", "교육훈련", "컨설팅", "인증취득", ""]),
    "purpose": pick("p_partkey + p_size", PURPOSE),
    "label": pick("p_partkey", LABEL),
    "others": pick("p_size", ["", "3억원; 5억원", "2천만원"]),
    "source": pick("p_partkey + p_size", ["explicit_llm", "none", "calculated_llm", "guarded", "explicit"]),
    "value": "CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN p_size * 10 ELSE p_size * 1000000 END",
    "total": "CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_partkey * 100000 END",
    "paper_list": pick("p_partkey", PAPERS),
    "step_list": pick("p_size", STEPS),
    "exclusion": pick("p_partkey", ["", "세금 체납 기업", "휴업 또는 폐업한 기업"]),
    "phone": pick("p_size", ["02-123-4567", ""]),
    "method": pick("p_size", ["방문 접수", "a@b.kr 또는 우편", "FAX", "온라인 https://x.kr", ""]),
    "homepage": pick("p_partkey", ["", "http://y.kr"]),
    "period": pick("p_partkey", ["2026-01-01 ~ 2026-03-31", "상시 접수", "예산 소진시까지", "추후 공지", "세부사업별 상이", "선착순", "2026-12-31"]),
    "end_date": pick("p_partkey", ["2026-03-31", "", "2026-12-31"]),
    "url": pick("p_size", ["https://a.kr/1", "www.b.kr", "", "http://c.kr"]),
    "score": "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size * 3 END",
    "files": pick("p_size", ["a.hwp@b.pdf", "", "c.zip@d.hwp", "e.PDF", "f.xlsx@g.png", " @h.txt"]),
    "print_file": pick("p_partkey", ["", "p.pdf"]),
    "body": f"concat('안내', chr(10), {pick('p_partkey', ['지원 대상', '신청 자격 안내', '기타', '접수 기간'])}, chr(10), {pick('p_size', BENEFIT)}, chr(10), {pick('p_partkey', PAPERS)}, chr(10), '끝', chr(10), '문의처 02-123-4567')",
}
BASE = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in NOTICE.items()) + " FROM part"


def notices(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "part")).selectExpr(*[f"{e} AS {c}" for c, e in NOTICE.items()])


def with_purposes(q: Spark) -> str:
    return q.keep(q.split("purpose_list", ","), "p", "p <> ''")


def portable(name: str, columns, also: dict | None = None) -> None:
    """Registers columns over notices: ``columns(dialect)`` names their expressions, ``also`` such that these build on."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = notices(spark, d)
        if also:
            rows = rows.selectExpr("*", *[f"{e(SPARK)} AS {c}" for c, e in also.items()])
        return rows.selectExpr("id", *[f"{e} AS {c}" for c, e in columns(SPARK).items()])

    QUERIES[name] = run
    ADDED[name] = also or {}


portable(
    "policy_dimensions",
    lambda q: {"kind": policy.category(q), "goals": policy.goals(q), "stages": policy.stages(q), "region": policy.region(q)},
    {"purposes": with_purposes},
)
portable(
    "amount_labels",
    lambda q: {
        "standard": policy.standard_label(q, "label"), "largest": policy.largest(q, "label"), "descriptive": policy.descriptive(q, "label"),
        "guarded": policy.guarded("label", "source", "others"), "shown": policy.shown(q, "label", "source"),
    },
)
portable(
    "amount_repairs",
    lambda q: {
        "label": policy.clarified(q, "label", "big", policy.per_applicant(q, "concat('기업당 최대 2천만원, 개사당 ', others)")),
        "total": policy.consistent_total("value", "total"),
    },
    {"big": lambda q: policy.largest(q, "label")},
)
portable(
    "paper_checklist",
    lambda q: {
        "papers": policy.papers(q, q.split("paper_list", "|") if q is DUCK else q.split("paper_list", "[|]")),
        "steps": policy.steps(q, q.split("step_list", "|") if q is DUCK else q.split("step_list", "[|]"), "method"),
        "note": policy.note("exclusion", "phone"),
    },
)
portable(
    "purpose_sentences",
    lambda q: {
        "rewritten": policy.plain_words(q, "purpose"), "made": policy.sentence(q), "target_short": policy.short_target(q, "concat(summary, ' ', target)"),
        "finished": policy.finished(q, "purpose", "benefits"),
    },
    {"amount": lambda q: "label"},
)
portable("keyword_snippet", lambda q: {"snippet": policy.snippet(q, "body", r"지원\s*대상|신청\s*자격|문의\s*처")})
portable(
    "goal_repairs",
    policy.mended_record,
    {
        "goals": lambda q: pick("id", ["fund", "digital,fund", "", "digital", "hr,sales"]), "kind": lambda q: pick("id", list(policy.CATEGORY_GOALS)),
        "target_short": lambda q: pick("id", ["소상공인", "", "여행업체"]), "per_label": lambda q: pick("id", ["", "기업당 2천만원"]),
        "per_value": lambda q: "CASE WHEN id % 4 = 1 THEN 20000000 END",
    },
)


def audited(name: str, rules, also: dict) -> None:
    """Registers an audit: how many notices break each rule, by area."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = notices(spark, d).selectExpr("*", *[f"{e(SPARK)} AS {c}" for c, e in also.items()])
        found = aggregates.issues(rows, F.col("id"), {n: F.expr(c) for n, c in rules(SPARK).items()})
        return found.groupBy("area", "rule").agg(F.count("*").alias("n"))

    QUERIES[name] = run
    ADDED[name] = also


audited("policy_audit", lambda q: policy.policy_rules(q, AS_OF), {"nothing": lambda q: "1"})
audited("amount_audit", lambda q: policy.amount_rules(q, ("others",)), {"nothing": lambda q: "1"})
audited(
    "class_audit",
    policy.class_rules,
    {"goals": lambda q: pick("id", ["fund", "digital,fund", "", "hr,sales"]), "tags": lambda q: pick("id", ["food", "etc,food,maker,online,retail,service", "online"])},
)


def _added(name: str) -> dict[str, str]:
    return {c: e(DUCK) for c, e in ADDED[name].items()}


SQL |= notices_sql.by_hand(BASE, "list_filter(string_split(purpose_list, ','), lambda v: v <> '')", _added("goal_repairs"), _added("class_audit"), AS_OF)


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def notice_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of periods, targets, support, ways to apply and files."""
    files = classify.attachments(F.col("files"))
    profile = classify.document_profile(F.col("print_file"), files)
    ways = classify.channels(F.col("method"), F.col("homepage"))
    tags = classify.industries(F.concat_ws(" ", "title", "summary"))
    return notices(spark, d).select(
        "id", classify.period_type(F.col("period")).alias("period_type"), classify.known_period_type(F.col("period")).alias("known_period"),
        classify.target_type(F.col("target")).alias("target_type"), classify.support_type(F.col("category"), F.col("subcategory"), F.col("summary")).alias("support"),
        F.array_join(ways, ",").alias("ways"), classify.application_type(ways).alias("way"), profile["kind"].alias("profile"),
        F.array_join(profile["traits"], ",").alias("traits"), profile["count"].cast("long").alias("n_files"),
        F.array_join(tags, ",").alias("industries"), classify.universal(F.lit(None).cast("boolean"), tags).alias("universal"),
    )


def _kinds_sql() -> str:
    words = lambda rules, x: "CASE " + " ".join(f"WHEN contains({x}, '{w}') THEN '{n}'" for w, n in rules)
    whole = "concat_ws(' ', category, subcategory, summary)"
    support = "CASE " + " ".join(f"WHEN regexp_matches({'subcategory' if own else whole}, '{p}') THEN '{n}'" for p, own, n in classify.SUPPORTS)
    known = "CASE " + " ".join(f"WHEN regexp_matches(period, '{p}') THEN '{n}'" for p, n in classify.KNOWN_PERIODS)
    of = lambda *ends: "list_has_any(ends, [" + ", ".join(f"'{e}'" for e in ends) + "])"
    web = "regexp_matches(concat(method, ' ', homepage), 'https?://') OR homepage <> ''"
    text = "lower(concat_ws(' ', title, summary))"
    tags = ", ".join(
        "CASE WHEN " + " OR ".join(f"contains({text}, '{w}')" for w in ws) + f" THEN '{n}' END" for n, ws in sorted(classify.INDUSTRIES.items())
    )
    every = ",".join(sorted([*classify.INDUSTRIES, "etc"]))
    return f"""
WITH n AS (SELECT *, list_filter(list_transform(string_split(files, '@'), lambda x: trim(x)), lambda x: x <> '') AS names FROM ({BASE})),
e AS (SELECT *, list_transform(names, lambda x: lower(regexp_extract(x, '(\\.[^./\\\\]*)$', 1))) AS ends,
        concat_ws(',', CASE WHEN contains(method, '@') THEN 'email' END, CASE WHEN regexp_matches(method, '(?i)팩스|fax') THEN 'fax' END,
                  CASE WHEN contains(method, '우편') THEN 'post' END, CASE WHEN regexp_matches(method, '방문|내방') THEN 'visit' END,
                  CASE WHEN {web} THEN 'website' END) AS ways, coalesce(nullif(concat_ws(',', {tags}), ''), '{every}') AS industries FROM n)
SELECT id, {words(classify.PERIODS, 'period')} ELSE 'other' END AS period_type, {known} ELSE 'unknown' END AS known_period,
       {words(classify.TARGETS, 'target')} ELSE 'other' END AS target_type, {support} ELSE 'other' END AS support, ways,
       CASE WHEN contains(ways, ',') THEN 'mixed' WHEN ways = '' THEN 'other' ELSE ways END AS way,
       CASE WHEN len(names) = 0 AND print_file <> '' THEN 'html_plus_print' WHEN {of('.zip')} THEN 'bundle_package' WHEN {of('.hwp', '.hwpx')} THEN 'hwp_core'
            WHEN {of('.pdf')} THEN 'pdf_core' WHEN len(names) > 0 THEN 'mixed_attachment' ELSE 'html_only' END AS profile,
       concat_ws(',', CASE WHEN print_file <> '' THEN 'has_print_file' END, CASE WHEN {of('.hwp', '.hwpx')} THEN 'has_hwp_family' END,
                 CASE WHEN {of('.pdf')} THEN 'has_pdf' END, CASE WHEN {of('.zip')} THEN 'has_zip' END,
                 CASE WHEN {of('.xlsx', '.pptx', '.docx')} THEN 'has_office_forms' END, CASE WHEN {of('.png', '.jpg', '.jpeg', '.gif')} THEN 'has_image_asset' END) AS traits,
       len(names)::BIGINT AS n_files, industries, len(string_split(industries, ',')) >= 6 AS universal FROM e
"""


SQL["notice_kinds"] = _kinds_sql()

KEYWORDS = ["blest", "onth", "reh"]


@query
def money_excerpt(spark: SparkSession, d: str) -> DataFrame:
    """Stretches around keywords of whole documents, within a budget."""
    out = extract.excerpt(F.col("text"), KEYWORDS)
    return table(spark, d, "documents").select("doc_id", out.alias("x")).select("doc_id", F.char_length("x").cast("long").alias("n_chars"), F.md5("x").alias("md5"))


SQL["money_excerpt"] = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
p AS (SELECT r, n, k, list_transform(string_split(text, k), lambda x: length(x)) AS lens FROM t, (SELECT unnest({KEYWORDS!r}) AS k) WHERE n > 2500),
o AS (SELECT r, n, k, list_sum(lens[1:i]) + (i - 1) * length(k) AS pos FROM (SELECT *, unnest(range(1, len(lens))) AS i FROM p)),
s AS (SELECT r, greatest(pos - 120, 0) AS s, least(pos + length(k) + 180, n) AS e FROM o),
b AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY r ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS brk FROM s),
i AS (SELECT *, sum(brk) OVER (PARTITION BY r ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM b),
m AS (SELECT r, min(s) AS s, max(e) AS e FROM i GROUP BY r, island),
u AS (SELECT *, 2500 - coalesce(sum(e - s) OVER (PARTITION BY r ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM m),
x AS (SELECT r, string_agg(substr(text, (s + 1)::BIGINT, least(e - s, room)::BIGINT), ' […] ' ORDER BY s) AS x FROM u JOIN t USING (r) WHERE room > 0 GROUP BY r),
y AS (SELECT doc_id, CASE WHEN n <= 2500 THEN text ELSE coalesce(x, left(text, 2500)) END AS x FROM t LEFT JOIN x USING (r))
SELECT doc_id, length(x)::BIGINT AS n_chars, md5(x) AS md5 FROM y
"""

MODELS = {
    "algorithm": pick("p_partkey", ["pam", "linkage", "kmeans", "text", "lca"]), "k": "p_size", "viable": "p_size % 4 > 0",
    "silhouette": "CAST(p_partkey * 37 % 100 AS DOUBLE) / 100", "bic": "CAST(p_partkey * 53 % 1000 AS DOUBLE)",
    "strength": "CAST(p_partkey % 5 AS DOUBLE)", "jaccard": "CAST(p_size % 7 AS DOUBLE)", "id": "p_partkey",
}


@query
def best_models(spark: SparkSession, d: str) -> DataFrame:
    """The best fit of each method among many, and which of these to prefer."""
    rows = table(spark, d, "part").selectExpr(*[f"{e} AS {c}" for c, e in MODELS.items()])
    return selection.preferred(selection.best_by_method(rows, "algorithm", "id"), "id").select("algorithm", "id", "k", "viable", "preferred")


SQL["best_models"] = f"""
WITH m AS (SELECT {', '.join(f'{e} AS {c}' for c, e in MODELS.items())} FROM part),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY algorithm ORDER BY viable DESC, CASE WHEN algorithm = 'lca' THEN -bic ELSE silhouette END DESC, id) = 1),
f AS (SELECT id FROM b WHERE viable ORDER BY strength DESC, jaccard DESC, silhouette DESC, id LIMIT 1)
SELECT algorithm, id, k, viable, id IN (SELECT id FROM f) AS preferred FROM b
"""


@query
def editor_grid(spark: SparkSession, d: str) -> DataFrame:
    """Notices of one category that name a word, with a badge for the wording of their purpose."""
    rows = selection.grid(notices(spark, d), category="금융", word="지원", length=60)
    return rows.select("id", selection.badge(F.col("purpose")).alias("badge"))


SQL["editor_grid"] = f"""
SELECT id, CASE WHEN length(purpose) < 25 THEN 'short' WHEN regexp_matches(purpose, '합니다|입니다') THEN 'formal'
                WHEN regexp_matches(purpose, '같이|도모') THEN 'official' WHEN length(purpose) < 40 THEN 'terse' ELSE 'fine' END AS badge
FROM ({BASE}) WHERE category = '금융' AND (contains(lower(title), '지원') OR contains(lower(purpose), '지원')) AND length(purpose) < 60
"""


@query
def model_targets(spark: SparkSession, d: str) -> DataFrame:
    """Notices whose amount a model should look at, without those already answered."""
    rows = notices(spark, d).withColumn("amount", F.expr(policy.largest(SPARK, "label")))
    return selection.targets(rows, rows.where("source = 'explicit_llm'"), "id").select("id", "why")


SQL["model_targets"] = f"""
WITH n AS (SELECT *, {policy.largest(DUCK, 'label')} AS amount FROM ({BASE})),
w AS (SELECT id, source, CASE WHEN contains(label, '억원') AND amount >= 10000000000 THEN 'huge' WHEN contains(label, '총사업비') THEN 'total'
                      WHEN label IN ('', '지원 규모 확인 필요') THEN 'unknown' END AS why FROM n)
SELECT id, why FROM w WHERE why IS NOT NULL AND source <> 'explicit_llm'
"""


@query
def browse_panels(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of categories, agencies with the most policies, and what ends soon, in one table."""
    rows = notices(spark, d).select("category", F.col("title").alias("t"), F.col("end_date"), F.regexp_extract("title", r"^\[([^\]]+)\]", 1).alias("agency"))
    left = F.datediff(F.try_to_date("end_date", "yyyy-MM-dd"), F.lit("2026-03-20").cast("date"))
    return selection.panels(rows, {"category": (F.col("category"), 50), "agency": (F.col("agency"), 8), "soon": (F.when(left.between(0, 14), F.col("category")), 50)})


SQL["browse_panels"] = f"""
WITH n AS (SELECT category, regexp_extract(title, '^\\[([^\\]]+)\\]', 1) AS agency, try_cast(nullif(end_date, '') AS DATE) - DATE '2026-03-20' AS l FROM ({BASE})),
v AS (SELECT 'category' AS panel, category AS value FROM n UNION ALL SELECT 'agency', agency FROM n UNION ALL SELECT 'soon', category FROM n WHERE l BETWEEN 0 AND 14),
c AS (SELECT panel, value, count(*)::BIGINT AS n FROM v GROUP BY 1, 2)
SELECT panel, rank::BIGINT AS rank, value, n FROM (SELECT *, row_number() OVER (PARTITION BY panel ORDER BY n DESC, value) AS rank FROM c)
WHERE rank <= CASE panel WHEN 'agency' THEN 8 ELSE 50 END
"""


@query
def rebuild_report(spark: SparkSession, d: str) -> DataFrame:
    """What a rebuilt table of notices holds: rows, scores, sources, and budgets that were not told from what one applicant gets."""
    label = F.regexp_replace("label", r"\s+", "")
    eok = F.try_to_number(F.nullif(F.regexp_extract(label, r"(\d[\d,.]*)억원", 1), F.lit("")), F.lit("999,999,999")) * 100_000_000
    huge = (eok >= 10_000_000_000) & ~F.contains("label", F.lit("총사업비")) & ~F.contains("label", F.lit("당"))
    return records.rebuild_report(notices(spark, d), F.col("score"), F.col("source"), huge)


SQL["rebuild_report"] = f"""
WITH n AS (SELECT * FROM ({BASE})), t AS (SELECT count(*) AS n, avg(score) AS s, count(*) FILTER (score >= 85) AS a, count(*) FILTER (label IN ('150억원', '총 300억원')) AS bad FROM n)
SELECT 'rows' AS "check", n::DOUBLE AS value FROM t UNION ALL SELECT 'mean score', round(s, 1)::DOUBLE FROM t UNION ALL SELECT 'grade A percent', floor(100 * a / n)::DOUBLE FROM t
UNION ALL SELECT 'unresolved amounts', bad::DOUBLE FROM t UNION ALL SELECT 'source: ' || source, count(*)::DOUBLE FROM n GROUP BY source
"""
