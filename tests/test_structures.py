import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sparrowmill import session
from sparrowmill.functions import enrich, purposes, structure
from sparrowmill.operators import matching, requests
from sparrowmill.plans import catalog, structures

from .oracle import assert_same


@pytest.mark.parametrize("name", sorted(structures.SQL))
def test_larger_tables(spark, name):
    d = "/root/testdata/sf0.01"
    assert_same(structures.QUERIES[name](spark, d), structures.SQL[name], d)


def test_walk_by_brute_force(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab1 😀\n") for _ in range(rng.randrange(60))) for _ in range(200)] + ["", "a1" * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    pattern = r"[ab]+\s?1"
    read = lambda b, m, a: F.struct(F.concat_ws("|", b, m, a).alias("label"), F.lit(1).alias("value"))
    last = lambda best, new: F.struct(F.concat_ws("/", best["label"], new["label"]).alias("label"), new["value"].alias("value"))
    got = {r.id: r.s.label if r.s else "" for r in rows.select("id", structure.walk(F.col("t"), pattern, 7, 5, read, last).alias("s")).collect()}
    seen = lambda t, m: "|".join((t[max(0, m.start() - 7) : m.start()], m[0], t[m.end() : m.end() + 5]))
    assert got == {i: "/".join(seen(t, m) for m in re.finditer(pattern, t)) for i, t in enumerate(texts)}


def test_phrases_by_their_ends(spark):
    rng = random.Random(5)
    parts = ["을 위해", "를\n위해", "을위해", "으로 ", "로", "지원", "안정", "가나다라마바", "😀", "\n", " ", "x" * 25]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(600)] + ["", "가" * 90 + "을 위해", "을 위해" + "😀" * 90 + "을  위해"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for least, most, end in (purposes.FOR_THE_SAKE_OF, purposes.MEANS_AND_AIM):
        got = {r.id: r.x for r in rows.select("id", purposes._led(F.col("t"), least, most, end).alias("x")).collect()}
        want = {i: m[0] if (m := re.search(f".{{{least},{most}}}?{end}", t)) else None for i, t in enumerate(texts)}
        assert got == want and len(set(want.values())) > 50


def test_phrases_of_a_long_text(spark):
    rows = spark.createDataFrame([("가나다 라마바 " * 700_000,)], "t string").select("t").cache()
    rows.count()
    began = time.perf_counter()
    assert rows.select(purposes.core(F.col("t")).alias("x")).first().x.endswith("...")
    assert time.perf_counter() - began < 8


AMOUNTS = [
    (None, None, (None, None, None, None, None, None, "none")),
    ("", "", (None, None, None, None, None, None, "none")),
    ("업체당 최대 200만원, 기업당 최대 500만원, 기업 당 500만원", "x", (None, None, None, None, "기업당 최대 500만원", 5_000_000, "explicit")),
    ("지원예산: 10억원, 모집규모: 20개사", "창업 지원", ("10억원", 10**9, "20개사", 20, "약 5,000만원 (총액÷대상수)", 50_000_000, "calculated")),
    ("지원예산: 10억원, 모집규모: 20개사", "소상공인 융자", ("10억원", 10**9, "20개사", 20, None, None, "total_only")),
    ("총사업비 200억원, 선정규모 3개 기업", "x", ("200억원", 2 * 10**10, None, None, None, None, "total_only")),
    ("총사업비 9억원 국비 12억원", "x", ("12억원", 1_200_000_000, None, None, None, None, "total_only")),
    ("선정 인원 30명, 7개사 선정, 지원 대상 규모 5개사, 8개소", None, (None, None, "5개사", 5, None, None, "none")),
    ("모집규모 99999999999999999999개사", None, (None, None, None, None, None, None, "none")),
    ("은행 12개사 선정", None, (None, None, None, None, None, None, "none")),
    ("은행" + "가" * 41 + " 12개사 선정", None, (None, None, "12개사", 12, None, None, "none")),
]


def test_amounts(spark):
    rows = spark.createDataFrame([(i, b, t) for i, (b, t, _) in enumerate(AMOUNTS)], "id int, body string, title string")
    out = structure.with_amounts(rows, F.col("body"), F.col("title")).orderBy("id").collect()
    assert [tuple(r)[3:] for r in out] == [want for _, _, want in AMOUNTS]
    assert structure.with_amounts(rows.limit(0), F.col("body"), F.col("title")).count() == 0


def test_amounts_of_a_long_text(spark):
    body = "업체당 3만원 모집규모 2개사 " * 2000 + "기업당 1억원"
    row = structure.with_amounts(spark.createDataFrame([(body,)], "b string"), F.col("b"), F.lit("x")).first()
    assert (row.each_value, row.recipients_value) == (100_000_000, 2)


LONG = "가나다라 " * 40
PURPOSES = [
    (None, None, None, None),
    ("", "## 사업개요", None, None),
    ("(지원목적) 지역 소상공인의 경영 부담을 덜고 매출을 늘린다\n다음 줄", None, "지역 소상공인의 경영 부담을 덜고 매출을 늘린다", "print"),
    ("(지원목적) ~ 2026.06.30 까지 접수하는 공고입니다", "## 사업개요\n짧다", None, None),
    ("(지원목적) 열다섯 글자를 조금 넘는 글", "", None, None),
    ("지원목적 없음", "앞\n## 사업개요\n부산경제진흥원은 지역 청년 기업의 자금 부담 완화를 위하여 시행하는 사업이오니 신청 바랍니다\n## 끝",
     "지역 청년 기업의 자금 부담 완화를 위해 진행하는 사업이에요.", "overview"),
    ("", "## 사업개요 「청년 도약」 참여 기업을 아래와 같이 모집하오니 바라며", "'청년 도약' 참여 기업을 아래와 같이 모집", "overview"),
    ("", "## 사업개요 「청년 도약」에 함께할 기업을 찾습니다, ", "'청년 도약'에 함께할 기업을 찾습니다", "overview"),
    ("", "## 사업개요 " + LONG, LONG[:117] + "...", "overview"),
    ("", "## 사업개요 " + LONG[:60] + "끝. " + LONG, LONG[:60] + "끝.", "overview"),
]


def test_purposes(spark):
    rows = spark.createDataFrame([(i, p, d) for i, (p, d, *_) in enumerate(PURPOSES)], "id int, p string, d string")
    out = purposes.with_purpose(rows, F.col("p"), F.col("d")).orderBy("id").collect()
    assert [tuple(r)[3:] for r in out] == [tuple(want) for _, _, *want in PURPOSES]
    assert purposes.with_purpose(rows.limit(0), F.col("p"), F.col("d")).count() == 0


def test_places(spark):
    texts = [None, "", "[경기] 광주시", "광주광역시 [경기] 광주", "경기도 하남과 광주시", "경기 의 긴 이름이 붙은 곳 그리고 또 광주시", "충청남도·전라남도"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = [r.p for r in rows.select("id", requests.places(F.col("t")).alias("p")).orderBy("id").collect()]
    assert got == [[], [], ["gyeonggi"], ["gyeonggi", "gwangju"], ["gyeonggi"], ["gyeonggi", "gwangju"], ["chungnam", "jeonnam"]]


def test_failed_audit_raises(spark):
    report = structures.match_audit(spark, "/root/testdata/sf0.001")
    with pytest.raises(ValueError, match="unguarded: .*cross region"):
        matching.passed(report)
    matching.passed(report.where("failures = ''"))
    assert {r.request for r in report.where("failures = ''").collect()} >= set(requests.PLACES)


class Fixed:
    def __init__(self, answers):
        self.answers = answers

    def complete(self, prompt):
        return self.answers[int(prompt.splitlines()[-1])]


def test_verdicts(spark):
    answers = [None, "", "판정 : drift\n근거: 꾸밈말 ", "판정：HALLUCINATION", "잘 모르겠습니다" * 20, "근거: 없음"]
    rows = spark.range(len(answers))
    got = enrich.factuality(rows, Fixed(answers), "id", F.lit(None).cast("string"), F.col("id").cast("string")).orderBy("id").collect()
    assert [(r.verdict, r.reason) for r in got] == [
        ("ERROR", ""), ("ERROR", ""), ("DRIFT", "꾸밈말"), ("HALLUCINATION", "판정：HALLUCINATION"), ("PARSE_ERROR", ("잘 모르겠습니다" * 20)[:80]), ("PARSE_ERROR", "없음"),
    ]


def test_lookups(spark):
    go = lambda t, *s: spark.range(1).select(requests.goes_to_results(F.lit(t), *[F.lit(x).cast("string") for x in s])).first()[0]
    assert go("카페 관련 정책", None, "food") and not go("카페 관련 정책", None, "") and not go("카페", "food") and not go(None, "food")


def test_rows_that_cost_much_are_dealt_over_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    few = spark.range(1000, numPartitions=1)
    dealt = session.spread(few)
    sizes = [len(p) for p in dealt.rdd.glom().collect()]
    assert len(sizes) >= 4 * cores and sum(sizes) == 1000 and max(sizes) <= 1000 // len(sizes) + 1
    queries = catalog.queries()
    for name in ("purpose_sentences", "notice_kinds", "purpose_scores", "structure_digests", "amount_structure"):
        assert queries[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4 * cores, name
