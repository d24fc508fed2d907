"""SQL for the queries over notices, written by hand from the rules' descriptions and from outcomes worked out for each text.

Nothing here is made by the functions that the queries run; only the notices themselves are the same.
"""

from __future__ import annotations


def _table(name: str, columns: str, rows: list[tuple]) -> str:
    def word(v: object) -> str:
        return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(map(word, r)) + ")" for r in rows) + ")"


#: label, in standard units, its largest amount, whether it is a range or names several amounts, its unit not standard, broken.
LABELS = [
    ("", "", None, False, False, False), ("00백만원 ; 3백만원", "300만원", 3_000_000, True, True, True), ("0원 ()", "0원", None, False, False, True),
    ("10백만원 ~ 20백만원", "1,000만원 ~ 2,000만원", 20_000_000, True, True, False), ("150억원", "150억원", 15_000_000_000, False, False, False),
    ("1억 5천만원", "1.5억원", 150_000_000, False, True, False), ("1조 2천억원", "1조 2,000억원", 1_200_000_000_000, False, False, False),
    ("4,000만원(사천만원)", "4,000만원", 40_000_000, False, True, False), ("4,000천원", "400만원", 4_000_000, False, True, False),
    ("40,000,000원", "4,000만원", 40_000_000, False, False, False), ("8억 5천만원 또는 차등", "8.5억원 또는 차등", 850_000_000, True, True, False),
    ("업체당 2천만원 이내", "업체당 2,000만원 이내", 20_000_000, False, True, False), ("지원 규모 확인 필요", "지원 규모 확인 필요", None, False, False, False),
    ("총 300억원", "총 300억원", 30_000_000_000, False, False, False), ("최대 5,000만원", "최대 5,000만원", 50_000_000, False, False, False),
]
#: purpose, rewritten.
REWRITTEN = [
    ("「지역기업 육성 조례」 제3조에 따라 지역 기업의 성장을 도모합니다", "지역 기업의 성장을 돕는 사업이에요"), ("강원도에 소재한 기업", "강원도에 소재한 기업"),
    ("담보력이 부족한 사업자의 경쟁력 제고를 위해 운영합니다.", "담보가 부족한 사업자의 경쟁력 강화를 위해 운영해요."),
    ("자생력이 약한 소상공인을 돕는 사업이에요.", "자립 능력이 약한 소상공인을 돕는 사업이에요."),
    ("전세 보증금이 부담되는 가구를 지원하고자 하는 사업을 다음과 같이 공고합니다", "전세 보증금이 부담되는 가구를 지원하려고 하는 사업."),
    ("중소기업의 경영애로를 해소하기 위하여 추진하고자 하는 사업을 지원합니다", "중소기업의 경영 어려움을 해소하기 위해 하려고 하는 사업을 지원해요."),
    ("짧은 목적", "짧은 목적"),
]
#: list of papers, what to bring.
PAPERS = [
    ("", "사업자등록증:have,신청서 (공고 확인 필요):need"), (" 신청서 |평가 후 제출|통장사본|통장사본|x", "신청서:need,통장사본:have,x:need"),
    ("납세증명서|계획서(서식 1, 서식 2)|협약 서류", "납세증명서:have"), ("매우 길고 띄어쓰기가 아주 많은 문장형 안내", "사업자등록증:have,신청서 (공고 확인 필요):need"),
    ("사업자등록증|신분증 사본|신청서", "사업자등록증:have,신분증 사본:have,신청서:need"), ("재직증명|보완 시", "재직증명:have"),
]
#: list of steps, what is left of them.
STEPS = [("", ""), ("1|2|--", ""), ("온라인 신청|현장 실사|a|협약 체결|지급|정산|보고|종료", "온라인 신청 > 현장 실사 > 협약 체결"), ("접수|12 -|서류 심사|발표 평가|선정", "서류 심사 > 발표 평가")]
#: other amounts, what "기업당 최대 2천만원, 개사당 " and these give each applicant at most.
EACH = [("", "기업당 최대 2천만원"), ("2천만원", "기업당 최대 2천만원"), ("3억원; 5억원", "개사당 3억원")]
#: What benefits and titles name, in order.
NAMED = [
    "이차보전=이자 보전", "이자지원=이자 지원", "이자=이자 지원", "보증료=보증료 지원", "보증=자금 보증", "멘토링=멘토링", "투자=투자 유치", "컨설팅=경영 컨설팅",
    "진단=경영 진단", "입점=온라인 입점", "라이브커머스=라이브커머스", "스마트스토어=스마트스토어", "마케팅=마케팅", "홍보=홍보", "광고=광고", "디자인=디자인 개발",
    "브랜딩=브랜드 개발", "시제품=시제품 제작", "기술개발=기술 개발", "특허=특허·IP", "인증=인증 취득", "인테리어=인테리어 개선", "간판=간판 교체",
    "리모델링=리모델링", "키오스크=키오스크 도입", "배달=배달앱 지원", "자동화=자동화 시설", "수출=수출 지원", "해외=해외 진출", "바이어=바이어 매칭",
    "고용보험=고용보험료", "사회보험=사회보험료", "인건비=인건비", "채용=채용 지원", "교육=교육", "훈련=역량 훈련",
]
DIGITAL = "디지털|스마트|키오스크|배달|온라인|정보화|클라우드|AI|인공지능|빅데이터|자동화|이커머스|플랫폼|DX|메타버스|IoT|사물인터넷|실감|가명정보|데이터|비대면|무인|VR|AR|XR|핀테크|ICT|정보통신|소프트웨어|SW|앱|보안|취약점|침해|정보보호|사이버"
TOURISM = "관광객 유치|관광 유치"


def by_hand(base: str, purposes: str, repairs: dict[str, str], classes: dict[str, str], as_of: str) -> dict[str, str]:
    """SQL by query over the notices of ``base``; the rest are the columns that some queries add to them."""
    more = lambda cols: ", ".join(f"{e} AS {c}" for c, e in cols.items())
    n = f"n AS (SELECT * FROM ({base}))"
    out = {}
    out["policy_dimensions"] = f"""
WITH {n}, x AS (SELECT *, {purposes} AS p, lower(title || ' ' || subcategory) AS t, lower(title || ' ' || summary) AS s, lower(title) || ' ' || lower(summary) || ' ' || target AS w FROM n),
k AS (SELECT *, CASE
  WHEN subcategory IN ('융자', '보증') OR list_has_any(p, ['이자보전', '보증지원']) THEN '운영자금'
  WHEN list_contains(p, '인건비') OR regexp_matches(t, '고용|인력|일자리|채용') THEN '고용·인건비'
  WHEN subcategory IN ('온라인', '오프라인', '홍보지원') OR list_has_any(p, ['마케팅비', '온라인판로']) THEN '판로·마케팅'
  WHEN regexp_matches(t, '디지털|스마트|키오스크') OR subcategory LIKE '%정보화%' THEN '디지털 전환'
  WHEN category = '창업' OR t LIKE '%창업%' OR subcategory LIKE '%사업화%' THEN '창업 지원'
  WHEN list_contains(p, '수출') OR regexp_matches(t, '해외|수출') THEN '수출·해외진출'
  WHEN regexp_matches(t, '재도전|재기|폐업') THEN '재기·재도전'
  WHEN subcategory LIKE '%시설%' OR t LIKE '%환경%' OR list_contains(p, '시설개보수') THEN '시설·환경'
  WHEN subcategory IN ('컨설팅', '교육') OR list_contains(p, '교육훈련') THEN '교육·컨설팅'
  WHEN regexp_matches(t, '공제|세제|보험|안전') THEN '안전망·세제'
  WHEN list_contains(p, '인증취득') THEN '교육·컨설팅' WHEN subcategory LIKE '%디자인%' THEN '판로·마케팅' ELSE '교육·컨설팅' END AS kind,
  concat_ws(',',
    CASE WHEN list_contains(p, '시설개보수') OR regexp_matches(s, '디지털|스마트|키오스크|배달|온라인|정보화|클라우드|빅데이터|자동화') THEN 'digital' END,
    CASE WHEN list_has_any(p, ['운전자금', '이자보전', '보증지원', '컨설팅', '인증취득']) OR regexp_matches(s, '자금|융자|대출|보증|보전|금리|운영|경영안정|일자리안정|카드수수료|세제|공제|보험료') THEN 'fund' END,
    CASE WHEN list_has_any(p, ['인건비', '교육훈련']) OR regexp_matches(s, '고용|채용|인력|인건비|일자리|직업훈련|취업|근로') THEN 'hr' END,
    CASE WHEN list_has_any(p, ['마케팅비', '온라인판로', '수출', '디자인·브랜딩']) OR regexp_matches(s, '판로|마케팅|홍보|수출|해외|입점|라이브|바우처|전시|박람회') THEN 'sales' END,
    CASE WHEN list_has_any(p, ['사업화', '재료비']) OR regexp_matches(s, '창업|사업화|재도전|사관학교|보육') THEN 'startup' END) AS g,
  w LIKE '%창업%' AS start, regexp_matches(w, '3년 미만|3년 이내') AS three, regexp_matches(w, '7년 미만|7년 이내|5년 이내') AS seven,
  regexp_extract(title, '^\\[([^\\]]+)\\]', 1) AS place FROM x),
st AS (SELECT *, concat_ws(',', CASE WHEN start OR w LIKE '%미창업%' THEN 'pre' END, CASE WHEN start OR three OR seven THEN 'y1' END,
  CASE WHEN three OR seven THEN 'y13' END, CASE WHEN seven THEN 'y3' END) AS found FROM k)
SELECT id, kind, CASE WHEN g <> '' THEN g WHEN kind IN ('운영자금', '시설·환경', '교육·컨설팅', '안전망·세제') THEN 'fund' WHEN kind = '고용·인건비' THEN 'hr'
    WHEN kind IN ('판로·마케팅', '수출·해외진출') THEN 'sales' WHEN kind = '디지털 전환' THEN 'digital' ELSE 'startup' END AS goals,
  CASE WHEN found = '' THEN 'y1,y13,y3' ELSE found END AS stages,
  CASE WHEN place IN ('', '공통') THEN 'any' WHEN place = '서울' THEN 'seoul' WHEN place IN ('경기', '인천') THEN 'gyeonggi'
    WHEN place IN ('부산', '대구', '광주', '대전', '울산', '세종') THEN 'metro' ELSE 'local' END AS region FROM st
"""
    labels = _table("l", "label, standard, largest, several, odd, broken", LABELS)
    rival = "source NOT LIKE '%\\_llm' ESCAPE '\\' AND others LIKE '%;%'"
    hint = "(n.label = '' OR n.label LIKE '%확인 필요%' OR n.label LIKE '%공고 확인%' OR n.label LIKE '%규모 확인%')"
    out["amount_labels"] = f"""
WITH {n}, {labels}
SELECT id, standard, largest::BIGINT AS largest, several AS descriptive, CASE WHEN {rival} THEN '지원 규모는 공고 확인' ELSE n.label END AS guarded,
  CASE WHEN {hint} THEN '공고 확인 필요' ELSE n.label END || '|' || CASE WHEN NOT {hint} AND source IN ('explicit_llm', 'calculated_llm', 'total_only_llm') THEN 'yes' ELSE 'no' END AS shown
FROM n JOIN l USING (label)
"""
    out["amount_repairs"] = f"""
WITH {n}, {labels}, {_table("e", "others, each", EACH)}
SELECT id, CASE WHEN largest >= 10000000000 THEN each ELSE n.label END AS label, CASE WHEN value > 0 AND total < value THEN NULL ELSE total END AS total
FROM n JOIN l USING (label) JOIN e USING (others)
"""
    out["paper_checklist"] = f"""
WITH {n}, {_table("p", "paper_list, papers", PAPERS)}, {_table("s", "step_list, steps", STEPS)}
SELECT id, papers, CASE WHEN steps <> '' THEN steps WHEN method <> '' THEN method ELSE '공고 확인 후 신청' END AS steps,
  CASE WHEN exclusion = '' AND phone = '' THEN '공고 상세 내용을 반드시 확인하세요.' WHEN exclusion = '' THEN '문의: ' || phone
       WHEN phone = '' THEN exclusion ELSE exclusion || ' / 문의: ' || phone END AS note
FROM n JOIN p USING (paper_list) JOIN s USING (step_list)
"""
    words = _table("w", "place, word, name", [(k, *x.split("=")) for k, x in enumerate(NAMED)])
    out["purpose_sentences"] = f"""
WITH {n}, {_table("r", "purpose, rewritten", REWRITTEN)}, {words},
x AS (SELECT *, trim(split_part(summary, ' / ', 1)) AS who, trim(split_part(summary, ' / ', 2)) AS what, split_part(left(benefits, 60), ' - ', 1) AS more FROM n),
f AS (SELECT id, name, min(place) AS place FROM x JOIN w ON contains(lower(what || ' ' || title), word) GROUP BY 1, 2),
g AS (SELECT id, array_to_string(list(name ORDER BY place)[1:2], '·') AS names FROM f GROUP BY 1),
y AS (SELECT x.*, coalesce(names, '') AS names, who || ' ' || target AS wt, summary || ' ' || target AS st FROM x LEFT JOIN g USING (id)),
short AS (SELECT *, CASE WHEN wt LIKE '%소상공인%' THEN '소상공인' WHEN wt LIKE '%소공인%' THEN '소공인' WHEN wt LIKE '%예비창업자%' THEN '예비창업자' WHEN wt LIKE '%청년%' THEN '청년'
   WHEN wt LIKE '%여성기업%' THEN '여성기업' WHEN wt LIKE '%사회적기업%' THEN '사회적기업' WHEN wt LIKE '%농업인%' THEN '농업인' WHEN wt LIKE '%중견기업%' THEN '중견기업' WHEN wt LIKE '%벤처기업%' THEN '벤처기업'
   WHEN wt LIKE '%창업%' AND regexp_matches(wt, '3년|7년|미만') THEN '창업기업' WHEN wt LIKE '%중소기업%' THEN '중소기업' WHEN wt LIKE '%창업%' THEN '창업기업' ELSE '중소기업·소상공인' END AS one,
   CASE WHEN st LIKE '%소상공인%' THEN '소상공인' WHEN st LIKE '%소공인%' THEN '소공인' WHEN st LIKE '%예비창업자%' THEN '예비창업자' WHEN st LIKE '%청년%' THEN '청년'
   WHEN st LIKE '%여성기업%' THEN '여성기업' WHEN st LIKE '%사회적기업%' THEN '사회적기업' WHEN st LIKE '%농업인%' THEN '농업인' WHEN st LIKE '%중견기업%' THEN '중견기업' WHEN st LIKE '%벤처기업%' THEN '벤처기업'
   WHEN st LIKE '%창업%' AND regexp_matches(st, '3년|7년|미만') THEN '창업기업' WHEN st LIKE '%중소기업%' THEN '중소기업' WHEN st LIKE '%창업%' THEN '창업기업' ELSE '중소기업·소상공인' END AS target_short FROM y),
m AS (SELECT *, regexp_extract(title, '^\\[([^\\]]+)\\]', 1) || ' ' || one || CASE WHEN one LIKE '%자' THEN '를' ELSE '을' END || ' 위한 ' ||
   CASE WHEN names = '' THEN CASE subcategory WHEN '융자' THEN '운영자금 융자' WHEN '보증' THEN '자금 보증' WHEN '온라인' THEN '온라인 판로 개척' WHEN '컨설팅' THEN '경영 컨설팅'
     WHEN '시설/입지지원' THEN '시설 개선·환경 정비' WHEN '사업화지원' THEN '창업 사업화' WHEN '정보화지원' THEN '디지털 전환' WHEN '디자인/상품화/사업화' THEN '제품 개발·사업화' WHEN '교육' THEN '역량 강화 교육' ELSE '경영 지원' END
   WHEN names LIKE '%지원' THEN names ELSE names || ' 지원' END AS made FROM short)
SELECT id, rewritten, CASE WHEN label <> '' AND length(made) < 32 THEN made || ' (' || label || ')' ELSE made END AS made, target_short,
  CASE WHEN length(purpose) < 25 AND length(benefits) > 10 AND length(more) > 10 THEN regexp_replace(purpose, '[. ]+$', '') || ' — ' || trim(more) || '.'
       WHEN regexp_matches(purpose, '(\\.|요)$') THEN purpose ELSE regexp_replace(purpose, '[,. ]+$', '') || '.' END AS finished
FROM m JOIN r USING (purpose)
"""
    out["keyword_snippet"] = f"""
WITH {n}, x AS (SELECT id, string_split(body, chr(10)) AS lines FROM n),
h AS (SELECT id, lines, list_position(list_transform(lines, lambda l: regexp_matches(l, '지원\\s*대상|신청\\s*자격|문의\\s*처')), true) AS line FROM x),
s AS (SELECT id, CASE WHEN line > 0 THEN trim(array_to_string(lines[line:line + 4], chr(10)), ' ' || chr(10)) END AS t FROM h)
SELECT id, CASE WHEN length(t) > 10 THEN t END AS snippet FROM s
"""
    fallback = "CASE kind WHEN '고용·인건비' THEN 'hr' WHEN '판로·마케팅' THEN 'sales' WHEN '수출·해외진출' THEN 'sales' WHEN '디지털 전환' THEN 'digital' WHEN '창업 지원' THEN 'startup' WHEN '재기·재도전' THEN 'startup' ELSE 'fund' END"
    out["goal_repairs"] = f"""
WITH n AS (SELECT *, {more(repairs)} FROM ({base})), x AS (SELECT *, title || ' ' || purpose || ' ' || benefits AS t, string_split(goals, ',') AS g FROM n),
a AS (SELECT *, CASE WHEN list_contains(g, 'fund') AND regexp_matches(purpose, '전세|월세|주거|보증금|기숙사|출산급여|양육|육아|장례|장제|생계비')
    AND NOT regexp_matches(purpose || title, '운영자금|경영안정|시설자금|창업자금|긴급경영|이차보전 융자|정책자금|육성자금|발전자금') THEN list_filter(g, lambda v: v <> 'fund') ELSE g END AS g1 FROM x),
b AS (SELECT *, CASE WHEN list_contains(g1, 'digital') AND NOT regexp_matches(t, '{DIGITAL}') THEN list_filter(g1, lambda v: v <> 'digital') ELSE g1 END AS g2 FROM a),
c AS (SELECT *, regexp_matches(title, '{TOURISM}') AS tour, array_to_string(g2, ',') AS joined FROM b),
d AS (SELECT *, CASE WHEN tour AND (target LIKE '%여행%' OR title LIKE '%여행사%') THEN '여행사' ELSE target_short END AS short FROM c)
SELECT id, CASE WHEN joined <> '' THEN joined WHEN regexp_matches(t, '주거|전세|월세|출산|양육|육아|보육료|생계') THEN '' ELSE {fallback} END AS goals,
  CASE WHEN tour THEN '판로·마케팅' ELSE kind END AS kind, short AS target_short,
  CASE WHEN benefits <> '' THEN benefits WHEN target <> '' THEN target WHEN short <> '' THEN short ELSE '지원내용은 공고 확인' END AS benefits,
  CASE WHEN target <> '' THEN target ELSE short END AS target, CASE WHEN per_label = '' THEN label ELSE per_label END AS label,
  CASE WHEN per_label = '' OR per_value IS NULL THEN value ELSE per_value END AS value FROM d
"""
    counted = lambda with_, rules: "WITH " + with_ + ", " + "v AS (" + " UNION ALL ".join(f"SELECT '{r.replace(chr(39), chr(39) * 2)}' AS rule FROM x WHERE {c}" for r, c in rules.items()) + ") SELECT split_part(rule, ':', 1) AS area, rule, count(*)::BIGINT AS n FROM v GROUP BY ALL"
    out["policy_audit"] = counted(
        f"x AS (SELECT * FROM ({base}))",
        {
            "whole: missing": "title = '' OR purpose = '' OR label = '' OR url = ''", "purpose: short": "length(purpose) BETWEEN 1 AND 24",
            "purpose: long": "length(purpose) > 140", "purpose: ending": "purpose <> '' AND purpose NOT LIKE '%요.' AND purpose NOT LIKE '%요'",
            "purpose: official": "regexp_matches(purpose, '(?:합니다|입니다)[.]?$') OR regexp_matches(purpose, '「.*법')",
            "purpose: target": "regexp_matches(left(purpose, 17), '^.{0,12}(?:에 소재|에 등록|을 영위|를 영위)')",
            "amount: rivals": f"{rival} AND source <> 'guarded'",
            "amount: huge": "value >= 10000000000 AND NOT regexp_matches(label, '당|총사업비|보증|공고 확인')", "amount: tiny": "value > 0 AND value < 10000",
            "target: missing": "target = ''", "period: over": f"end_date < '{as_of}'", "link: form": "url <> '' AND url NOT LIKE 'http://%' AND url NOT LIKE 'https://%'",
            "match: range": "score IS NULL OR score NOT BETWEEN 0 AND 100",
        },
    )
    out["amount_audit"] = counted(
        f"{labels}, x AS (SELECT n.*, l.* EXCLUDE (label) FROM ({base}) n JOIN l USING (label))",
        {
            "unit: not standard": "odd OR others LIKE '%천만원%'",
            "value: too small": "value < 1000", "value: too large": "value > 1000000000000",
            "value: not the label's": "value > 0 AND NOT several AND abs(largest - value)::DOUBLE / greatest(largest, value) > 0.02",
            "value: broken": "broken", "total: less than one": "value > 0 AND total BETWEEN 1 AND value - 1",
            "value: missing": "largest > 0 AND (value IS NULL OR value = 0)",
        },
    )
    out["class_audit"] = counted(
        f"n AS (SELECT *, {more(classes)} FROM ({base})), x AS (SELECT *, regexp_matches(purpose || ' ' || title || ' ' || benefits, '운영자금|융자|대출|보증|경영안정|시설자금|창업자금|긴급경영|이차보전|정책자금') AS business, purpose || ' ' || title || ' ' || benefits AS t FROM n)",
        {
            "fund: housing": "regexp_matches(t, '주거|전세|월세|임대료|보증금|주택|기숙사|거주') AND list_contains(string_split(goals, ','), 'fund') AND NOT business",
            "fund: welfare": "regexp_matches(t, '출산|양육|보육|결혼|장례|의료비|생계|청년 정착|귀농|귀촌') AND list_contains(string_split(goals, ','), 'fund') AND NOT business",
            "tags: all": "len(string_split(tags, ',')) >= 6", "goals: none": "goals = ''",
        },
    )
    return out
