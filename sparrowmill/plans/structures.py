"""Queries over whole rows and texts taken as notices: amounts with their structure, purposes from raw texts, audits of matches.

The SQL never reads a pattern that the engine reads: it works out what each kind of phrase has to give from the numbers put into it.
Only the scores' plain word lists are shared with the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import enrich, purposes, quality, structure
from ..operators import matching, requests
from ..session import spread, table

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _case(key: str, options: list[str]) -> str:
    return f"(CASE CAST(({key}) AS INT) " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(options)) + " END)"


_FILLER = "'\n이 안내는 해당 부서에서 확인한 뒤에 다시 알려 드릴 예정이니 꼭 참고해 주시기를 정중히 부탁드립니다. '"
_N, _V, _B = "(o_custkey % 97 + 2)", "CAST(floor(o_totalprice) AS BIGINT)", "(CAST(floor(o_totalprice) AS BIGINT) % 90 + 10)"
_EACH_KIND, _SIZE_KIND, _BUDGET_KIND, _TITLE_KIND = "o_orderkey % 6", "o_custkey % 8", "(o_orderkey + o_custkey) % 7", "o_custkey % 5"
_EACH = _case(_EACH_KIND, [
    "''", f"concat('업체당 최대 ', {_V}, '만원')", f"concat('기업 당 ', o_custkey % 9 + 1, '천만 원 이내, 개사당 총 ', {_V} % 900 + 1, '만원')",
    "'매장당 500만원'", "'학생당 약 1.5억원; 투자 건당 2억 원'", "''",
])
_SIZE = _case(_SIZE_KIND, [
    "''", f"concat('모집 규모 : 총 ', {_N}, '개사 내외')", f"concat({_N}, '개 업체 선정 예정')", f"concat('상시 근로자 ', {_N}, '개사 이내')",
    f"concat('선정인원: ', {_N}, '명 정도')", f"concat('모집기업 ', {_N}, '개사 미만')", f"concat('지원규모 1개사, 다음 차수 ', {_N}, '개사 내외')",
    f"concat('모집 대상 약 ', {_N}, '업체, 선정 기업 ', {_N} + 5, '점포')",
])
_BUDGET = _case(_BUDGET_KIND, [
    "''", f"concat('지원예산 : 국비 총 ', {_B}, '억원')", f"concat('총사업비 ', {_B} % 9 + 1, '억원')", f"concat('영업이익 및 총 사업비 ', {_B}, '억 원')",
    f"concat('사업 예산 ', {_B}, ',000백만원')", f"concat('총 지원 규모 : ', {_B}, '.5억 원')", f"concat('사업비 규모 ', {_B} * 100, '천만원')",
])
_TITLE = _case(_TITLE_KIND, ["'창업 지원 사업'", "'경영안정자금 이차 보전'", "'우수기업 포상'", "'판로 지원 사업'", "'특례보증'"])


@query
def amount_structure(spark: SparkSession, d: str) -> DataFrame:
    """What each applicant gets, how many are chosen, the whole budget, and how each is known, of orders written as notices."""
    rows = spread(table(spark, d, "orders")).selectExpr("o_orderkey", f"{_TITLE} AS title", f"concat({_EACH}, {_FILLER}, {_SIZE}, {_FILLER}, {_BUDGET}, {_FILLER}) AS body")
    return structure.with_amounts(rows, F.col("body"), F.col("title")).drop("title", "body")


SQL["amount_structure"] = f"""
WITH w AS (
  SELECT o_orderkey, {_TITLE_KIND} IN (1, 2, 4) AS undivided, {_N} AS n, {_V} AS v, {_B} AS b, o_custkey % 9 + 1 AS t,
         {_EACH_KIND} AS ek, {_SIZE_KIND} AS sk, {_BUDGET_KIND} AS bk FROM orders),
x AS (
  SELECT *, CASE ek WHEN 1 THEN '업체당 최대 ' || v || '만원' WHEN 2 THEN '기업 당 ' || t || '천만 원' WHEN 4 THEN '투자 건당 2억 원' END AS el,
         CASE ek WHEN 1 THEN v * 10000 WHEN 2 THEN t * 10000000 WHEN 4 THEN 200000000 END AS ev,
         CASE sk WHEN 1 THEN n || '개사' WHEN 2 THEN n || '개업체' WHEN 4 THEN n || '명 정도' WHEN 6 THEN n || '개사 내외' WHEN 7 THEN (n + 5) || '점포' END AS sl,
         CASE WHEN sk IN (1, 2, 4, 6) THEN n WHEN sk = 7 THEN n + 5 END AS sv,
         CASE bk WHEN 1 THEN b || '억원' WHEN 4 THEN b || ',000백만원' WHEN 5 THEN b || '.5억원' WHEN 6 THEN b * 100 || '천만원' END AS bl,
         CASE bk WHEN 1 THEN b * 100000000 WHEN 4 THEN b * 1000000000 WHEN 5 THEN b * 100000000 + 50000000 WHEN 6 THEN b * 1000000000 END AS bv FROM w),
y AS (SELECT *, CASE WHEN ev IS NULL AND NOT undivided THEN bv // sv END AS q FROM x),
z AS (SELECT *, coalesce(q >= 5000000000, false) AS absurd, CASE WHEN q < 5000000000 THEN q END AS s, (q + 5000000) // 10000000 AS tenths FROM y)
SELECT o_orderkey, bl AS total, bv::BIGINT AS total_value, CASE WHEN NOT absurd THEN sl END AS recipients, CASE WHEN NOT absurd THEN sv END::BIGINT AS recipients_value,
       coalesce(el, '약 ' || CASE WHEN s >= 100000000 THEN (tenths // 10) || CASE WHEN tenths % 10 > 0 THEN '.' || tenths % 10 ELSE '' END || '억원'
                                  ELSE format('{{:,}}', s // 10000) || '만원' END || ' (총액÷대상수)') AS "each",
       coalesce(ev, s)::BIGINT AS each_value,
       CASE WHEN ev IS NOT NULL THEN 'explicit' WHEN s IS NOT NULL THEN 'calculated' WHEN bv IS NOT NULL THEN 'total_only' ELSE 'none' END AS amount_source FROM z
"""

_TEXT = "coalesce(text, '')"
_PRINT = _case("doc_id % 4", [
    "''", f"concat('공고\n(지원목적)\n  ', {_TEXT})", f"concat('(사업목적) 2026.06.30까지 접수하는 안내입니다 꼭\n(추진목적) ', {_TEXT})",
    "'(추진목적) * 목록으로 적힌 아주 긴 목적 문장입니다 정말로'",
])
_DETAIL = _case("doc_id % 5", [
    f"concat('# 제목\n## 사업개요\n', {_TEXT}, '\n## 문의\n담당자')",
    "concat('## 사업개요\n(재)경남테크노파크에서는 「중소기업 진흥에 관한 법률」 제3조에 따라, 지역 기업의 판로 개척과 매출 성장을 위하여 추진하는 사업을 다음과 같이 공고합니다. ', "
    f"{_TEXT})", f"concat('## 사업개요\n지역의 온라인 판로 확대로 소상공인의 매출 안정을 함께 이룹니다 ☞ ', {_TEXT})", _TEXT, "'## 사업개요\n짧은 안내 ## 다음'",
])


@query
def raw_purposes(spark: SparkSession, d: str) -> DataFrame:
    """Purposes of whole documents taken as the raw texts of notices, and where each comes from."""
    rows = table(spark, d, "documents").selectExpr("doc_id", f"{_PRINT} AS printed", f"{_DETAIL} AS detail")
    return purposes.with_purpose(rows, F.col("printed"), F.col("detail")).drop("printed", "detail")


_WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SQL["raw_purposes"] = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT *, regexp_replace(split_part(regexp_replace(t, '^{_WS}+', ''), chr(10), 1), '{_WS}+$', '') AS line FROM t),
p AS (SELECT *, CASE WHEN doc_id % 4 IN (1, 2) AND length(line) >= 15 AND NOT regexp_matches(line, '^[~∼]?{_WS}*[0-9]{{4}}')
                     THEN left(trim(regexp_replace(line, '{_WS}+', ' ', 'g'), ' '), 150) END AS stated FROM l),
f AS (SELECT *, CASE WHEN length(stated) >= 20 AND NOT starts_with(stated, '* ') AND NOT starts_with(stated, '- ') THEN stated END AS printed,
             regexp_replace(trim(regexp_replace(split_part(t, '##', 1), '{_WS}+', ' ', 'g'), ' '), '[,. ]+$', '') AS body FROM p),
h AS (SELECT *, left(body, 120) AS head FROM f),
c AS (SELECT *, CASE doc_id % 5
    WHEN 0 THEN CASE WHEN length(body) > 120 AND contains(head, '.') AND 120 - strpos(reverse(head), '.') > 30 THEN left(head, 121 - strpos(reverse(head), '.'))
                     WHEN length(body) > 120 THEN left(body, 117) || '...' WHEN length(body) >= 15 THEN body END
    WHEN 1 THEN ', 지역 기업의 판로 개척과 매출 성장을 위해 진행하는 사업이에요.' WHEN 2 THEN '지역의 온라인 판로 확대로 소상공인의 매출 안정하는 사업이에요.' END AS core FROM h)
SELECT doc_id, coalesce(printed, core) AS raw_purpose, CASE WHEN printed IS NOT NULL THEN 'print' WHEN core IS NOT NULL THEN 'overview' END AS purpose_from FROM c
"""

_OPENINGS = ["자금 부담이 큰 소상공인이", "지역 상권에 활력과 활성화의", "기업을 위한 성장을 위한", "성장과 도약을", "부담을 덜고 부담을", "", "관광객을 을", "원문을 알려주시면"]
_MIDDLES = [
    " 더 쉽게 자금을 빌려 쓰도록 돕는", " 판로·홍보·수출·인증을 지원하는", " 찾는 손님이 있는 가게와 쉬는 날 없는 점포에 힘이 되는 마을의", " 5만원, 제3조, 표, 끝",
    " 다음과 같이 공고합니다", "  두 칸", " 자금",
]
_CLOSES = [" 사업이에요.", " 일을 해요.", " 사업.", " 기업의", " 사업이에요요. ", "\n둘째 줄이에요.", ""]
_PURPOSE = "concat(" + ", ".join(
    _case(f"{key} % {len(words)}", [f"'{w}'" for w in words])
    for key, words in (("p_partkey", _OPENINGS), ("(p_partkey + p_size)", _MIDDLES), ("(p_size + CAST(floor(p_retailprice) AS BIGINT))", _CLOSES))
) + ")"


@query
def purpose_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of purposes put together from three phrases, and how many issues of each kind they have."""
    p = quality.KOREAN
    rows = spread(table(spark, d, "part")).selectExpr("p_partkey", f"{_PURPOSE} AS purpose")
    rows = rows.select("p_partkey", quality.score(F.col("purpose"), p).alias("score"), quality.issues(F.col("purpose"), p).alias("i"))
    n = [(F.size("i") - F.size(F.array_remove("i", k))).cast("long").alias(k) for k in quality.PENALTIES]
    return rows.select("p_partkey", "score", quality.grade(F.col("score")).alias("grade"), *n)


def _scores_sql() -> str:
    p = quality.KOREAN
    has = lambda ws: "list_any_value([x FOR x IN [" + ", ".join(f"'{w}'" for w in ws) + "] IF contains(t, x)]) IS NOT NULL"
    both = lambda *ws: "(" + " + ".join(f"contains(t, '{w}')::INT" for w in ws) + ") >= 2"
    ends = lambda *ws: "(" + " OR ".join(f"ends_with(t, '{w}')" for w in ws) + ")"
    many = lambda w: f"(length(t) - length(replace(t, '{w}', ''))) / length('{w}')"
    bad = lambda *cs: " + ".join(f"({c})::INT" for c in cs)
    words = "list_filter(regexp_extract_all(t, '([가-힣]{2,})(을|를|이|가|은|는|에|의|로)', 1), lambda w: w NOT IN ('사업', '기업'))"
    last = "right(rtrim(t, '. '), 1) IN ('을', '를', '의', '에', '과', '와', '로', '고')"
    odd = "contains(t, '  ') OR contains(t, '··') OR left(t, 1) IN ('·', ',', '.')"
    aim = "regexp_matches(t, '위해|위한|도록|수 *있|하려|하고자') OR regexp_matches(t, '돕|지원|마련|연결|찾|키우|덜어|낮춰|높이|지키|넓히|늘려|살리|만들|이어|다지|누리|하는')"
    return f"""
WITH s AS (SELECT p_partkey, {_PURPOSE} AS purpose FROM part), t AS (SELECT *, trim(purpose, ' ' || chr(10)) AS t FROM s),
w AS (SELECT *, length(t) AS n, {has(p.motive)} AS motive, {has(p.help)} AS helps, {has(p.refusal)} AS refused,
  {bad("len(list_distinct(" + words + ")) < len(" + words + ")", f"{both('성장', '발전', '도약')} OR {both('활성화', '활력')} OR {both('넓히', '늘려', '확대')}")} AS redundancy,
  {bad("regexp_matches(t, '을 을|를 를|이 가|은 는|에 에')", "regexp_matches(t, '하는는|이에요요|도록록|에요에요|사업사업')", f"{many('위해')} >= 2 OR {many('위한')} >= 2", last, odd)} AS grammar,
  {bad(f"{many('·')} >= 3", "len(regexp_extract_all(t, '[가-힣](하는|되는|있는|없는|드는)[ \n]')) >= 3", f"{many(',')} >= 3")} AS readability,
  {bad(f"NOT ({aim})")} AS logic FROM t),
x AS (SELECT *, CASE WHEN purpose = '' OR refused THEN 0 ELSE greatest(0,
    CASE WHEN {ends('사업이에요.', '사업이예요.')} THEN 15 WHEN {ends('이에요.', '해요.', '드려요.', '어요.')} THEN 10 ELSE 0 END
    + CASE WHEN n BETWEEN 45 AND 100 THEN 10 WHEN n BETWEEN 35 AND 110 THEN 6 ELSE 0 END + CASE WHEN {many('.')} = 1 AND NOT contains(t, chr(10)) THEN 5 ELSE 0 END
    + CASE WHEN {has(p.bureaucratic)} THEN 0 ELSE 10 END + CASE WHEN motive THEN 15 ELSE 0 END + CASE WHEN helps THEN 15 ELSE 0 END
    + CASE WHEN {has(p.target)} THEN 10 ELSE 0 END + CASE WHEN motive AND helps THEN 10 ELSE 0 END
    + CASE WHEN regexp_matches(t, '「[^」]+」|[0-9]+ *(만원|억원|백만원)|제[0-9]+조') THEN 0 ELSE 10 END
    - 8 * redundancy - 10 * grammar - 5 * readability - 10 * logic) END::INT AS score FROM w)
SELECT p_partkey, score, CASE WHEN score >= 85 THEN 'A' WHEN score >= 70 THEN 'B' WHEN score >= 50 THEN 'C' ELSE 'D' END AS grade,
       redundancy::BIGINT AS redundancy, grammar::BIGINT AS grammar, readability::BIGINT AS readability, logic::BIGINT AS logic FROM x
"""


SQL["purpose_scores"] = _scores_sql()

#: Texts of offers, the regions they name, whom they are for, whether they are for starting up.
_OFFERS = [
    ("[경기] 광주시 카페 창업 지원", "gyeonggi", "", True), ("[광주] 카페 운영자금", "gwangju", "", False), ("경기도 광주 점포 개선, 광주광역시 공동", "gyeonggi,gwangju", "", False),
    ("전국 소상공인 마케팅", "", "", False), ("대전 여성기업 판로", "daejeon", "women", False), ("충청북도 청주 예비창업 지원", "chungbuk", "", True),
    ("전북특별자치도 융자", "jeonbuk", "", False), ("전라남도와 광주 상생", "gwangju,jeonnam", "", False), ("서울·인천 전시회", "seoul,incheon", "", False),
    ("광주 하남산단 기업", "gwangju", "", False), ("경기 광주 곤지암 도자기", "gyeonggi", "", False), (None, "", "", False), ("관광 여행사 지원", "", "tourism", False),
]
#: request, goal, region, mode, whether regions are looked at, mode wanted, region wanted, named groups, no start-ups first, nation-wide first.
_ASKED = [(r, None, r, "strict", True, "strict", r, [], False, False) for r in requests.PLACES] + [
    ("cafe there", "fund", "daejeon", "region_first", True, "region_first", "daejeon", [], False, False),
    ("cafe at work", "startup", "gwangju", "region_first", True, "region_first", "gwangju", [], True, False),
    ("in the town", "sales", "gyeonggi", "region_first", True, "strict", "gyeonggi", [], True, False),
    ("anywhere", "sales", None, "none", True, "none", None, [], False, True),
    ("nation-wide", "fund", None, "national_only", True, "national_only", None, [], False, True),
    ("women", None, "daejeon", "strict", True, "strict", "daejeon", ["women"], False, False),
    ("unguarded", None, "gwangju", "region_first", False, "region_first", "gwangju", [], False, True),
]
_GOAL = _case("c_custkey % 3", ["'fund'", "'sales'", "'startup'"])


@query
def match_audit(spark: SparkSession, d: str) -> DataFrame:
    """What requests for each region and scenarios get from customers taken as offers, and which expectations fail."""
    texts = _case(f"c_custkey % {len(_OFFERS)}", ["NULL" if t is None else f"'{t}'" for t, *_ in _OFFERS])
    rows = table(spark, d, "customer").selectExpr("c_custkey AS offer", f"{texts} AS title", f"{_GOAL} AS has_goal", "c_custkey % 50 AS pscore")
    people = F.array_compact(F.array(F.when(F.contains("title", F.lit("여성")), "women"), F.when(F.contains("title", F.lit("관광")), "tourism")))
    starts = F.coalesce(F.rlike("title", F.lit(r"예비창업|창업\s*지원")), F.lit(False))
    rows = rows.withColumns({"places": requests.places(F.col("title")), "special": people, "starts": starts}).withColumn("national", F.size("places") == 0)
    kinds = "request string, goal string, region string, mode string, guarded boolean, wanted_mode string, wanted_region string, named array<string>, no_starts boolean, national_first boolean"
    asked = spark.createDataFrame(_ASKED, kinds)
    there = F.coalesce(F.array_contains("places", F.col("region")), F.lit(False))
    fits = (
        (F.col("goal").isNull() | (F.col("goal") == F.col("has_goal")))
        & (~F.col("guarded") | F.col("region").isNull() | requests.region_compatible(F.col("places"), F.array("region")))
        & F.when(F.col("mode") == "strict", there).when(F.col("mode") == "national_only", F.col("national")).otherwise(True)
        & ~(F.col("guarded") & requests.excluded(F.col("special"), F.col("named")))
    )
    got = rows.crossJoin(F.broadcast(asked.select("request", "goal", "region", "mode", "guarded", "named"))).where(fits).drop("named")
    near = F.when(F.col("mode") == "region_first", F.when(there, 4).when(F.col("national"), 2).otherwise(1)).when(F.col("national"), 1).otherwise(0)
    return matching.audit(got.withColumn("near", near), asked, [F.desc("near"), F.desc("pscore"), F.col("offer")])


def _audit_sql() -> str:
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, (bool, int)) else f"[{', '.join(map(lit, v))}]::VARCHAR[]" if isinstance(v, list) else f"'{v}'"
    kinds = ", ".join(f"({i}, {lit(p.split(',') if p else [])}, {lit(w)}, {lit(s)})" for i, (_, p, w, s) in enumerate(_OFFERS))
    asked = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in _ASKED)
    return f"""
WITH k(kind, places, people, starts) AS (VALUES {kinds}),
q(request, goal, region, mode, guarded, wanted_mode, wanted_region, named, no_starts, national_first) AS (VALUES {asked}),
o AS (SELECT c_custkey AS offer, {_GOAL} AS has_goal, c_custkey % 50 AS pscore, k.*, len(places) = 0 AS national FROM customer JOIN k ON c_custkey % {len(_OFFERS)} = kind),
m AS (SELECT *, coalesce(list_contains(places, region), false) AS there FROM q, o WHERE (goal IS NULL OR goal = has_goal)
  AND (NOT guarded OR ((region IS NULL OR national OR list_contains(places, region)) AND (people = '' OR list_contains(named, people))))
  AND CASE mode WHEN 'strict' THEN list_contains(places, region) WHEN 'national_only' THEN national ELSE true END),
r AS (SELECT *, row_number() OVER (PARTITION BY request ORDER BY CASE WHEN mode <> 'region_first' THEN national::INT WHEN there THEN 4 WHEN national THEN 2 ELSE 1 END DESC,
                                   pscore DESC, offer) AS rank FROM m),
c AS (SELECT request, count(*) AS n, count(*) FILTER (national) AS n_national, count(*) FILTER (wanted_region IS NOT NULL AND NOT national AND NOT there) AS crossing,
      count(*) FILTER (people <> '' AND len(named) = 0) AS leaks, count(*) FILTER (no_starts AND starts AND rank <= 10) AS starting, bool_or(national AND rank = 1) AS leads
      FROM r GROUP BY request)
SELECT request, coalesce(n, 0) AS n, coalesce(n_national, 0) AS n_national, coalesce(crossing, 0) AS cross_region, coalesce(leaks, 0) AS special_leaks,
       coalesce(starting, 0) AS starts_first, concat_ws(',', CASE WHEN mode <> wanted_mode THEN 'mode' END, CASE WHEN national_first AND NOT coalesce(leads, false) THEN 'national first' END,
         CASE WHEN crossing > 0 THEN 'cross region' END, CASE WHEN leaks > 0 THEN 'special targets' END, CASE WHEN starting > 0 THEN 'starting up' END) AS failures
FROM q LEFT JOIN c USING (request)
"""


SQL["match_audit"] = _audit_sql()


@query
def overview_excerpts(spark: SparkSession, d: str) -> DataFrame:
    """What a prompt gets of whole documents' overviews: its length and digest."""
    rows = table(spark, d, "documents").selectExpr("doc_id", f"{_DETAIL} AS detail").select("doc_id", purposes.excerpt(F.col("detail")).alias("x"))
    return rows.select("doc_id", F.char_length("x").cast("long").alias("n_chars"), F.md5("x").alias("md5"))


SQL["overview_excerpts"] = rf"""
WITH b AS (SELECT doc_id, {_DETAIL} AS t FROM documents),
x AS (SELECT doc_id, CASE WHEN contains(t, '## 사업개요') THEN
        left(trim(regexp_replace(split_part(substr(t, strpos(t, '## 사업개요') + 7), '##', 1), '{_WS}+', ' ', 'g'), ' '), 800) ELSE left(t, 800) END AS x FROM b)
SELECT doc_id, length(x)::BIGINT AS n_chars, md5(x) AS md5 FROM x
"""

_ENDING = _case("item_id % 6", ["' 관련  정책'", "' 알려줘'", "' 정책'", "' 뭐 있나'", "' 궁금해'", "'공고 전체'"])


@query
def lookup_intents(spark: SparkSession, d: str) -> DataFrame:
    """Which benchmark items, taken as requests, go straight to a list of results."""
    rows = table(spark, d, "benchmark").selectExpr("item_id", f"concat(coalesce(text, ''), {_ENDING}) AS asked", "nullif(item_id % 4, 0) AS slot", "'' AS other")
    return rows.select("item_id", requests.goes_to_results(F.col("asked"), F.col("other"), F.col("slot").cast("string")).alias("direct"))


SQL["lookup_intents"] = "SELECT item_id, item_id % 6 IN (0, 1, 3, 5) AND item_id % 4 > 0 AS direct FROM benchmark"

_CLAIM = _case("doc_id % 4", ["left(coalesce(text, ''), 60)", "concat(left(coalesce(text, ''), 30), ' zzqx zzqy')", "'zzqa zzqb'", "' '"])


@query
def factuality_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of 300 sampled documents' claims by a model that looks for words in the whole text, and its reasons."""
    rows = enrich.sample(table(spark, d, "documents").selectExpr("doc_id", "text", f"{_CLAIM} AS claim"), "doc_id", 300)
    return enrich.factuality(rows, enrich.WordModel(), "doc_id", F.col("text"), F.col("claim"))


SQL["factuality_labels"] = rf"""
WITH s AS (SELECT doc_id, coalesce(text, '') AS text, {_CLAIM} AS claim FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 300),
w AS (SELECT *, list_filter(regexp_split_to_array(claim, '{_WS}+'), lambda x: x <> '') AS words FROM s),
m AS (SELECT *, len(list_filter(words, lambda x: NOT contains(text, x))) AS missing FROM w)
SELECT doc_id, CASE WHEN len(words) = 0 THEN 'ERROR' WHEN missing = 0 THEN 'OK' WHEN 2 * missing <= len(words) THEN 'DRIFT' ELSE 'HALLUCINATION' END AS verdict,
       CASE WHEN len(words) = 0 THEN '' ELSE missing::VARCHAR END AS reason FROM m
"""
