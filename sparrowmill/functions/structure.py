"""Structure of amounts in a notice's text: what each applicant gets, how many are chosen, the whole budget, and how each is known.

All expressions stay in the JVM. Null texts and texts without a hit give null values and the source 'none'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import money

# Korean words around amounts and numbers of recipients -----------------------------------------------
APPLICANTS = ("업체", "기업", "사업자", "점포", "업소", "개사", "개인", "학생", "농가", "어가", "투자 건")
MONEY_UNITS = ("억 원", "천 만 원", "백 만 원", "만 원")
SIZE_SIGNALS = (
    "모집 규모", "선정 규모", "지원 규모", "모집 인원", "선정 인원", "모집 기업", "선정 기업", "모집 업체", "선정 업체", "모집 대상", "선정 대상",
    "지원 대상 규모", "총 지원 규모",
)
FIRM_UNITS = ("개 사", "개 기업", "개 업체", "업체", "업소", "점포")
PERSON_UNITS = ("명", "인")
AFTER_SIZES = ("내외", "정도", "이내", "선정", "선발", "모집", "지원")
KEPT_AFTER_SIZES = ("내외", "정도", "이내")
#: A number of something else, if one of these stands within 40 characters before it.
OTHER_SIZES = (
    "종업원", "상시 근로자", "근로자 수", "직원 수", "고용 인원", "대표자", "담당자", "가족 수", "구성원", "평균 인원", "매출액", "연 매출", "은행", "부문",
    "표창", "포상", "시상", "도급", "법인이", "이상인", "이상의",
)
RECENT_YEARS = r"최근\s*\d+\s*년"
#: A bound and no number of recipients, if one of these stands within 20 characters after it.
BOUNDS = ("이하", "미만", "이상", "초과", "부문")
#: Names of budgets and what may stand before their amount, from the surest to the least sure.
BUDGETS = (
    ("지원 예산", r"(?:국비\s*)?(?:총\s*)?"), ("총 사업비", ""), ("사업 예산", ""), ("(?:예산|사업비) 규모", ""), ("총 지원 규모", ""), ("국비", r"(?:총\s*)?"),
)
#: Business figures that a budget is taken for, if one stands from 30 characters before it to 10 after it.
FIGURES = (
    "영업 이익", "매출 액", "자산 총액", "자본금", "순이익", "당기", "거래액", "거래 규모", "시가총액", "연 매출",
)
#: Titles of loans, guarantees and awards, whose total divided by their number means nothing.
UNDIVIDED = ("융자", "이차 보전", "보증", "대출", "포상", "표창", "시상", "상장", "운전자금", "육성자금", "경영안정자금")
LEAST_BUDGET, MOST_EACH = 1_000_000_000, 5_000_000_000
LEAST_COUNT, MOST_COUNT = 2, 100_000
# -------------------------------------------------------------------------------------------------------------------


def _any(words: tuple[str, ...]) -> str:
    """A pattern for any of the words, in their order, however they are spaced."""
    return "(?:" + "|".join(w.replace(" ", r"\s*") for w in words) + ")"


AMOUNT = _any(MONEY_UNITS)
EACH = rf"{_any(APPLICANTS)}\s*당\s*(?:총|최대|한도|상한|약)?\s*\d[\d,.]*\s*{AMOUNT}"
SIZES = (
    rf"{_any(SIZE_SIGNALS)}\s*[:：]?\s*(?:약|총)?\s*\d[\d,]*\s*{_any(FIRM_UNITS)}",
    rf"\d[\d,]*\s*{_any(FIRM_UNITS)}\s*{_any(AFTER_SIZES)}",
    rf"{_any(SIZE_SIGNALS)}\s*[:：]?\s*(?:약|총)?\s*\d[\d,]*\s*{_any(PERSON_UNITS)}\s*{_any(AFTER_SIZES)}?",
)


#: A label and its value.
FOUND = "struct<label:string,value:bigint>"


def greater(best: Column, other: Column) -> Column:
    """The one with the greater positive value, the first of equal ones."""
    return F.when(F.coalesce(other["value"] > F.coalesce(best["value"], F.lit(0)), F.lit(False)), other).otherwise(best)


def walk(text: Column, pattern: str, before: int, after: int, read, choose) -> Column:
    """One pass over all matches from left to right: ``read(before, found, after)`` gives a label and value or null, ``choose`` keeps one.

    A match sees so many characters before it and after it. The pass carries these alone, so its work grows with the text's length;
    a text without a match is only scanned.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    behind = F.regexp_extract_all(text, F.lit(rf"(?:{pattern})(?=((?s:.{{0,{after}}})))"), F.lit(1))
    gaps = F.slice(between, 1, F.size(found))
    parts = F.zip_with(F.arrays_zip(found.alias("m"), behind.alias("a")), gaps, lambda x, g: F.struct(x["m"].alias("m"), x["a"].alias("a"), g.alias("g")))
    start = F.struct(F.lit("").alias("tail"), F.lit(None).cast(FOUND).alias("best"))

    def step(state: Column, x: Column) -> Column:
        seen = F.right(F.concat(state["tail"], x["g"]), F.lit(before))
        tail = F.right(F.concat(seen, x["m"]), F.lit(before))
        return F.struct(tail.alias("tail"), choose(state["best"], read(seen, x["m"], x["a"]).cast(FOUND)).cast(FOUND).alias("best"))

    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(parts, start, step)["best"])


def first_amount(found: Column) -> Column:
    """(label, value) of the first amount in standard spelling within a match."""
    label = F.nullif(F.regexp_extract(F.regexp_replace(found, r"\s+", ""), r"\d[\d,.]*(?:억원|천만원|백만원|만원|조원)", 0), F.lit(""))
    return F.struct(label.alias("label"), money.first_value(label).alias("value"))


def each(text: Column) -> Column:
    """(label, value) of the largest amount that the text gives for each applicant."""
    return walk(text, EACH, 0, 0, lambda _, m, __: F.struct(F.trim(m).alias("label"), first_amount(m)["value"].alias("value")), greater)


def size_label(found: Column) -> Column:
    """Number and unit of a match, with a word such as 'about' if one follows."""
    units, kept = _any((*FIRM_UNITS, *PERSON_UNITS)), _any(KEPT_AFTER_SIZES)
    parts = rf"(\d[\d,]*)\s*({units})\s*({kept})?"
    word = lambda k: F.regexp_extract(found, parts, k)
    return F.concat_ws(" ", F.concat(word(1), F.regexp_replace(word(2), r"\s+", "")), F.nullif(word(3), F.lit("")))


def recipients(text: Column) -> Column:
    """(label, value) of the number of recipients, from the surest of three kinds of phrases that has any; the largest there."""

    others, bounds = F.lit(f"{_any(OTHER_SIZES)}|{RECENT_YEARS}"), F.lit(_any(BOUNDS))

    def read(before: Column, found: Column, after: Column) -> Column:
        number = F.replace(F.regexp_extract(found, r"\d[\d,]*", 0), F.lit(","), F.lit("")).try_cast("long")
        holds = number.between(LEAST_COUNT, MOST_COUNT) & ~F.rlike(before, others) & ~F.rlike(after, bounds)
        return F.when(holds, F.struct(size_label(found).alias("label"), number.alias("value")))

    return F.coalesce(*[walk(text, p, 40, 20, read, greater) for p in SIZES])


def budget(text: Column) -> Column:
    """(label, value) of the first budget of a thousand million or more, by the names of budgets in their order."""

    def read(before: Column, found: Column, after: Column) -> Column:
        amount = first_amount(found)
        return F.when((amount["value"] >= LEAST_BUDGET) & ~F.rlike(F.concat(before, found, after), F.lit(_any(FIGURES))), amount)

    names = [rf"{name.replace(' ', r'\s*')}\s*[:：]?\s*{lead}\d[\d,]*\.?\d*\s*{AMOUNT}" for name, lead in BUDGETS]
    return F.coalesce(*[walk(text, p, 30, 10, read, lambda best, new: F.coalesce(best, new)) for p in names])


def estimate_label(value: Column) -> Column:
    """A value in hundreds of millions with one decimal, in ten-thousands, or as it is."""
    eok = F.regexp_replace(F.format_string("%s", F.round(value / 100_000_000, 1)), r"\.0$", "")
    return (
        F.when(value >= 100_000_000, F.concat(eok, F.lit("억원")))
        .when(value >= 10_000, F.concat(F.format_number(F.floor(value / 10_000), 0), F.lit("만원")))
        .otherwise(F.concat(F.format_number(value, 0), F.lit("원")))
    )


def with_amounts(df: DataFrame, text: Column, title: Column) -> DataFrame:
    """Adds total, total_value, recipients, recipients_value, each, each_value and amount_source.

    An amount for each applicant is stated, or else calculated from budget and recipients where the title allows a division and the
    outcome is below 5,000 million; beyond that the number of recipients is given up as wrong.
    """
    found = df.withColumns({"_text": F.coalesce(text, F.lit("")), "_title": F.coalesce(title, F.lit(""))})
    found = found.withColumns({"_each": each(F.col("_text")), "_size": recipients(F.col("_text")), "_total": budget(F.col("_text"))})
    stated, total, size = F.col("_each.value"), F.col("_total.value"), F.col("_size.value")
    divided = F.when(~F.rlike("_title", F.lit(_any(UNDIVIDED))), F.floor(total / size)).cast("long")
    absurd = stated.isNull() & F.coalesce(divided >= MOST_EACH, F.lit(False))
    kept = found.withColumns({"_share": F.when(stated.isNull() & (divided < MOST_EACH), divided), "_absurd": absurd})
    share = F.col("_share")
    source = F.when(stated.isNotNull(), "explicit").when(share.isNotNull(), "calculated").when(total.isNotNull(), "total_only").otherwise("none")
    out = {
        "total": F.col("_total.label"), "total_value": total,
        "recipients": F.when(~F.col("_absurd"), F.col("_size.label")), "recipients_value": F.when(~F.col("_absurd"), size),
        "each": F.coalesce(F.col("_each.label"), F.concat(F.lit("약 "), estimate_label(share), F.lit(" (총액÷대상수)"))),
        "each_value": F.coalesce(stated, share), "amount_source": source,
    }
    return kept.withColumns(out).drop("_text", "_title", "_each", "_size", "_total", "_share", "_absurd")

