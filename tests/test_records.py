from pyspark.sql import functions as F

from sparrowmill.operators import records

DETAIL = """# 제목
## 사업개요

소상공인 운전자금과 홍보 지원
## 신청기간

2026-01-01 ~ 2026-03-31
## 문의처

02-123-4567, a@b.kr
"""
ATTACHED = "업체당 최대 5,000만원, 대출 금리 연 2.0%\n지원제외: 세금 체납 기업, 유흥 업종\n제출서류\n - 사업자등록증\n - 신분증\n"


def items(spark):
    rows = [
        ("1", "[서울] 소상공인 자금", "금융", "정책자금", "소상공인", None, "방문 접수", "http://x.kr", "a.hwp@b.zip", "p.pdf", None, "2026-01-05 10:00"),
        ("2", "빈 공고", None, None, None, "상시", None, None, None, None, None, None),
    ]
    names = ["pblancId", "pblancNm", "categoryName", "pldirSportRealmMlsfcCodeNm", "trgetNm", "reqstBeginEndDe", "reqstMthPapersCn", "rceptEngnHmpgUrl", "fileNm", "printFileNm", "bsnsSumryCn", "creatPnttm"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    for n in ("pldirSportRealmLclasCodeNm", "jrsdInsttNm", "excInsttNm", "refrncNm"):
        df = df.withColumn(n, F.lit(None).cast("string"))
    first = F.col("pblancId") == "1"
    return df.withColumn("detail", F.when(first, DETAIL).otherwise("")).withColumn("attached", F.when(first, ATTACHED).otherwise(""))


def test_classified(spark):
    a, b = records.classified(items(spark)).orderBy("id").collect()
    assert (a.target_type, a.support_type, a.application_channels, a.document_profile, a.attachment_count) == (
        "small_business", "funding", ["visit", "website"], "bundle_package", 2,
    )
    assert (b.period_type, b.application_type, b.document_profile) == ("always_open", "other", "html_only")
    assert records.in_window(items(spark), "2026-01-01", "2026-01-31").count() == 1


def test_from_notice_to_card(spark):
    k = records.knowledge(records.normalised(items(spark)))
    p = {r.id: r for r in records.policies(k, "2026-03-20").collect()}
    a, b = p["1"], p["2"]
    assert (a.region, a.purposes, a.amount["max"], a.rate) == ("서울", ["운전자금", "마케팅비"], "업체당 최대 5,000만원", "연 2.0%")
    assert (a.documents, str(a.end_date), a.status, a.days_left) == (["사업자등록증", "신분증"], "2026-03-31", "open", 12)
    assert (a.grade, a.eligible, a.match, a.contact.phone) == ("detailed", "able", 90, "02-123-4567")
    assert (b.region, b.grade, b.period_type, b.days_left, b.match) == ("공통", "vague", "unknown", None, 50)  # two characters from the feed are too few to count
    card = records.cards(k).where("id = '1'").first()
    assert card.amount == "업체당 최대 5,000만원" and len(card.exclusions) <= 3


def test_section_map(spark):
    lines = ["no heading", "# A", "short one", "# B", "bbbbbb", "# A", "longer than before", "# A", "tiny"]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "id int, pos int, line string")
    got = {r.section: r.body for r in records.section_map(df, "id", "pos", "line", [("^# A", "a"), ("^# B", "b")]).collect()}
    assert got == {"a": "longer than before", "b": "bbbbbb"}
