"""Classification: ordered rules become one expression, the first that holds wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_any


def cascade(rules: list[tuple[Column, str]], rest: str | None) -> Column:
    out = None
    for condition, name in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out.otherwise(rest)


def hits(text: Column, names: dict[str, list[str]]) -> Column:
    """All names with a keyword in the text, sorted."""
    found = [F.when(contains_any(text, words), F.lit(n)) for n, words in names.items()]
    return F.array_sort(F.array_compact(F.array(*found)))


def plain(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


#: Words in periods of notices, in the order in which they decide.
PERIODS = (("~", "date_range"), ("상시", "always_open"), ("예산 소진", "budget_exhausted"), ("추후 공지", "announced_later"), ("세부사업별 상이", "varies_by_program"))
#: The same for knowledge records, as patterns.
KNOWN_PERIODS = (("예산\\s*소진", "budget_exhausted"), ("상시", "always_open"), ("선착순", "first_come"), ("\\d{4}", "date_range"))
#: Words for whom a notice is meant.
TARGETS = (("소상공인", "small_business"), ("창업벤처", "startup_venture"), ("중소기업", "sme"), ("사회적기업", "social_enterprise"))
#: Patterns of kinds of support; whether the subcategory alone is looked at.
SUPPORTS = (
    ("융자|보증|보험|펀드|이차보전|자금", False, "funding"),
    ("컨설팅|자문|멘토링|진단", False, "consulting"),
    ("예비창업|창업공간|창업정보제공|창업", True, "startup"),
    ("시설|입지|공간|장비", True, "facility"),
    ("교육|세미나|설명회|IR|워크숍", False, "education_event"),
    ("온라인|오프라인|홍보|공공구매|사업화|상품화|디자인|정보화", False, "commercialization"),
)
#: Words of lines of business.
INDUSTRIES = {
    "food": ["음식", "식당", "외식", "카페", "요식", "분식", "치킨", "주점", "베이커리", "급식", "외식업"],
    "retail": ["도소매", "유통", "상점", "마트", "편의점", "소매", "도매", "시장", "상가"],
    "online": ["온라인", "쇼핑몰", "플랫폼", "이커머스", "인터넷", "전자상거래"],
    "maker": ["제조", "공장", "기술", "생산", "소공인", "가공", "부품"],
    "service": ["서비스", "미용", "학원", "세탁", "수리", "교육", "의료", "헬스"],
}


def period_type(period: Column) -> Column:
    return cascade([(F.contains(plain(period), F.lit(w)), n) for w, n in PERIODS], "other")


def known_period_type(period: Column) -> Column:
    return cascade([(F.rlike(plain(period), F.lit(p)), n) for p, n in KNOWN_PERIODS], "unknown")


def target_type(target: Column) -> Column:
    return cascade([(F.contains(plain(target), F.lit(w)), n) for w, n in TARGETS], "other")


def support_type(category: Column, subcategory: Column, summary: Column) -> Column:
    whole = F.concat_ws(" ", plain(category), plain(subcategory), plain(summary))
    return cascade([(F.rlike(plain(subcategory) if own else whole, F.lit(p)), n) for p, own, n in SUPPORTS], "other")


def channels(method: Column, homepage: Column) -> Column:
    """Ways to apply, sorted."""
    method, homepage = plain(method), plain(homepage)
    web = F.rlike(F.concat_ws(" ", method, homepage), F.lit("https?://")) | (homepage != "")
    found = [
        F.when(F.contains(method, F.lit("@")), "email"),
        F.when(web, "website"),
        F.when(F.rlike(method, F.lit("방문|내방")), "visit"),
        F.when(F.contains(method, F.lit("우편")), "post"),
        F.when(F.rlike(method, F.lit("(?i)팩스|fax")), "fax"),
    ]
    return F.array_sort(F.array_compact(F.array(*found)))


def application_type(found: Column) -> Column:
    return F.when(F.size(found) > 1, "mixed").when(F.size(found) == 1, F.get(found, 0)).otherwise("other")


def extension(name: Column) -> Column:
    """The last dot and what follows, in lower case."""
    return F.lower(F.regexp_extract(plain(name), r"(\.[^./\\]*)$", 1))


def attachments(names: Column) -> Column:
    """Names put together with @, without blanks."""
    return F.filter(F.transform(F.split(plain(names), "@"), lambda x: F.trim(x)), lambda x: x != "")


def document_profile(print_file: Column, names: Column) -> Column:
    """(kind, traits, count) of a notice's files."""
    ends = F.transform(names, extension)
    one_of = lambda *e: F.arrays_overlap(ends, F.array(*[F.lit(x) for x in e]))
    printed, none = plain(print_file) != "", F.size(names) == 0
    hwp, pdf, archive = one_of(".hwp", ".hwpx"), one_of(".pdf"), one_of(".zip")
    kind = cascade(
        [(none & printed, "html_plus_print"), (archive, "bundle_package"), (hwp, "hwp_core"), (pdf, "pdf_core"), (~none, "mixed_attachment")],
        "html_only",
    )
    traits = F.array_compact(
        F.array(
            F.when(printed, "has_print_file"), F.when(hwp, "has_hwp_family"), F.when(pdf, "has_pdf"), F.when(archive, "has_zip"),
            F.when(one_of(".xlsx", ".pptx", ".docx"), "has_office_forms"), F.when(one_of(".png", ".jpg", ".jpeg", ".gif"), "has_image_asset"),
        )
    )
    return F.struct(kind.alias("kind"), traits.alias("traits"), F.size(names).alias("count"))


def information_grade(purposes: Column, has_amount: Column, exclusions: Column, documents: Column, has_contact: Column) -> Column:
    """detailed, moderate or vague, by how much a record says."""
    points = (
        F.when(purposes >= 2, 2).when(purposes >= 1, 1).otherwise(0) + has_amount.cast("int") + (exclusions >= 1).cast("int")
        + (documents >= 1).cast("int") + has_contact.cast("int")
    )
    return F.when(points >= 4, "detailed").when(points >= 2, "moderate").otherwise("vague")


def eligibility(grade: Column, exclusions: Column) -> Column:
    return cascade([((grade == "detailed") & (exclusions <= 2), "able"), (grade.isin("detailed", "moderate"), "check")], "need")


def base_match(grade: Column, confidence: Column, has_amount: Column) -> Column:
    points = 50 + F.when(grade == "detailed", 25).when(grade == "moderate", 15).otherwise(0)
    points = points + F.when(confidence == "high", 10).when(confidence == "medium", 5).otherwise(0) + F.when(has_amount, 5).otherwise(0)
    return F.least(F.lit(99), points)


def industries(text: Column) -> Column:
    """Lines of business named in a text; all of them and 'etc' where none is."""
    found = hits(F.lower(plain(text)), INDUSTRIES)
    every = F.array(*[F.lit(x) for x in sorted([*INDUSTRIES, "etc"])])
    return F.when(F.size(found) == 0, every).otherwise(found)


def universal(flag: Column, tags: Column) -> Column:
    """A set flag decides; unset, six tags mean all."""
    return F.coalesce(flag, F.size(tags) >= 6)
