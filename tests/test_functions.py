import pytest
from pyspark.sql import functions as F

from sparrowmill.functions import classify, dates, enrich, money, quality, text


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(0)]).select(column).first()[0]


@pytest.mark.parametrize(
    ("label", "first", "compound", "largest"),
    [
        ("최대 1억 5,000만원", 100_000_000, 150_000_000, 100_000_000),
        ("3천만원", 30_000_000, 30_000_000, 30_000_000),
        ("2조 3천억원", 2_000_000_000_000, 2_300_000_000_000, 2_000_000_000_000),
        ("1.5억원 (2,000만원 별도)", 150_000_000, 170_000_000, 150_000_000),
        ("예산 12345678원", None, None, 12_345_678),
        ("없음", None, None, None),
    ],
)
def test_money(spark, label, first, compound, largest):
    c = F.lit(label)
    assert one(spark, money.first_value(c)) == first
    assert one(spark, money.compound_value(c)) == compound
    assert one(spark, money.largest_value(c)) == largest


def test_won_label(spark):
    assert one(spark, money.won_label(F.lit(150_000_000))) == "1억 5,000만원"
    assert one(spark, money.won_label(F.lit(9_000))) == "9000원"


def test_provenance(spark):
    n = F.lit(None).cast("long")
    assert one(spark, money.provenance(F.lit(5), F.lit(100), F.lit(10))).source == "explicit"
    assert tuple(one(spark, money.provenance(n, F.lit(100), F.lit(10)))) == (10, "calculated")
    assert one(spark, money.provenance(n, F.lit(100), n)).source == "total_only"
    assert one(spark, money.provenance(n, n, n)).source == "none"


def test_days_left(spark):
    at = F.lit("2026-06-02 12:00:00").cast("timestamp")
    end = lambda s: dates.days_left(F.lit(s).cast("timestamp"), at)
    assert [one(spark, end(s)) for s in ("2026-06-02", "2026-06-03", "2026-06-01", "2026-05-30")] == [1, 2, 0, -1]
    assert one(spark, dates.days_left(F.lit(None).cast("timestamp"), at)) is None


def test_window_and_period(spark):
    assert one(spark, dates.in_window(F.lit("2026-05-01 10:00"), "2026-05-01", "2026-05-02"))
    assert not one(spark, dates.in_window(F.lit("soon"), "2026-05-01", "2026-05-02"))
    assert str(one(spark, dates.period_end(F.lit("2026-01-01 ~ 2026-02-03"), ["상시"]))) == "2026-02-03"
    assert one(spark, dates.period_end(F.lit("상시 2026-02-03"), ["상시"])) is None


def test_clean_html(spark):
    raw = "<p>a&nbsp;&lt;b&gt; &amp;lt; &copy;</p>\n<script>x < y</script> c"
    assert one(spark, text.clean_html(F.lit(raw))) == "a <b> &lt; c"


def test_negated_tags(spark):
    lexicon = {"loan": ["융자", "대출"], "grant": ["보조금"]}
    c = text.tags(F.lit("융자 제외 대상이며 보조금은 지급"), lexicon, "제외")
    assert one(spark, c) == []
    far = "융자 지원" + "가" * 60 + "제외"
    assert one(spark, text.tags(F.lit(far), lexicon, "제외")) == ["loan"]


def test_sources_in_order(spark):
    c = text.coalesce_sources((F.lit("ab"), 2, "api", "high"), (F.lit("from page"), 5, "html", "high"))
    assert tuple(one(spark, c)) == ("from page", "html", "high")
    assert one(spark, text.coalesce_sources((F.lit(None).cast("string"), 2, "api", "high"))).source == "missing"


def test_section_and_particles(spark):
    md = "# t\n## 사업개요\n\n본문 하나\n## 다음\nx"
    assert one(spark, text.section(F.lit(md), "사업개요")) == "본문 하나"
    assert one(spark, text.with_particle(F.lit("자금"), "을", "를")) == "자금을"
    assert one(spark, text.with_particle(F.lit("교육비"), "을", "를")) == "교육비를"
    assert one(spark, text.syllable_pairs(F.lit("창업 자금"))) == ["창업", "자금", "업자"]


def test_cascades(spark):
    assert one(spark, classify.period_type(F.lit("2026 ~ 예산 소진"))) == "date_range"
    assert one(spark, classify.known_period_type(F.lit("2026 ~ 예산 소진"))) == "budget_exhausted"
    assert one(spark, classify.target_type(F.lit("중소기업, 소상공인"))) == "small_business"
    assert one(spark, classify.support_type(F.lit("금융"), F.lit("창업"), F.lit("교육"))) == "startup"
    found = classify.channels(F.lit("방문 또는 a@b.kr"), F.lit(""))
    assert one(spark, found) == ["email", "visit"]
    assert one(spark, classify.application_type(found)) == "mixed"
    names = classify.attachments(F.lit("a.HWP@ b.pdf @"))
    profile = one(spark, classify.document_profile(F.lit("p.pdf"), names))
    assert (profile.kind, profile.traits, profile["count"]) == ("hwp_core", ["has_print_file", "has_hwp_family", "has_pdf"], 2)
    assert one(spark, F.size(classify.industries(F.lit("우주")))) == 6
    assert not one(spark, classify.universal(F.lit(False), F.array(*[F.lit(str(i)) for i in range(6)])))


def test_quality(spark):
    good = "자금 부담이 큰 소상공인이 더 쉽게 자금을 빌려 쓸 수 있게 도와 드리고 성장까지 함께 챙기는 사업이에요."
    assert one(spark, quality.score(F.lit(good), quality.KOREAN)) >= 85
    assert one(spark, quality.score(F.lit("죄송하지만 정보가 부족합니다"), quality.KOREAN)) == 0
    assert one(spark, quality.grade(F.lit(70))) == "B"
    assert one(spark, quality.score(F.lit(""), quality.KOREAN)) == one(spark, quality.score(F.lit(None).cast("string"), quality.ENGLISH)) == 0
    assert one(spark, quality.issues(F.lit(" 부담을 덜고 부담을 낮춰 성장과 발전을 돕는 사업사업의 "), quality.KOREAN)) == ["redundancy", "redundancy", "grammar", "grammar"]


def test_enrichment(spark):
    assert enrich.first_object('x {“a”: 1,} y') == {"a": 1}
    assert enrich.first_object("nothing") is None
    assert enrich.last_line("a\n- 'b'\n") == "b"
    rows = spark.createDataFrame([(1, "p\nq"), (2, "r")], "id int, t string")
    cache = spark.createDataFrame([(2, "kept")], "id int, answer string")
    got = enrich.with_cache(rows, cache, enrich.EchoModel(), "id", F.col("t")).collect()
    assert {(r.id, r.answer) for r in got} == {(1, "q"), (2, "kept")}
    assert one(spark, enrich.valid_labels(F.array(F.lit("x"), F.lit("b")), ["a", "b"])) == ["b"]
    assert one(spark, enrich.valid_labels(F.array(F.lit("all")), ["a", "b"])) == ["a", "b"]
