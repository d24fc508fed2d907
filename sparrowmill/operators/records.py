"""Records of notices: raw items are classified, normalised and made into knowledge records and short cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, dates, extract, text

#: Fields of a feed's items.
ITEM = (
    "pblancId string, pblancNm string, categoryName string, pldirSportRealmLclasCodeNm string, pldirSportRealmMlsfcCodeNm string, "
    "trgetNm string, reqstBeginEndDe string, reqstMthPapersCn string, rceptEngnHmpgUrl string, fileNm string, printFileNm string, "
    "bsnsSumryCn string, jrsdInsttNm string, excInsttNm string, refrncNm string, creatPnttm string"
)


def classified(items: DataFrame) -> DataFrame:
    """A row of kinds for each item."""
    files = classify.attachments(F.col("fileNm"))
    profile = classify.document_profile(F.col("printFileNm"), files)
    found = classify.channels(F.col("reqstMthPapersCn"), F.col("rceptEngnHmpgUrl"))
    category = F.coalesce(F.nullif("categoryName", F.lit("")), "pldirSportRealmLclasCodeNm")
    return items.select(
        F.col("pblancId").alias("id"),
        F.col("pblancNm").alias("title"),
        F.col("categoryName").alias("category"),
        F.coalesce("pldirSportRealmMlsfcCodeNm", F.lit("")).alias("subcategory"),
        F.coalesce("trgetNm", F.lit("")).alias("target_text"),
        classify.target_type(F.col("trgetNm")).alias("target_type"),
        classify.period_type(F.col("reqstBeginEndDe")).alias("period_type"),
        classify.application_type(found).alias("application_type"),
        found.alias("application_channels"),
        profile["kind"].alias("document_profile"),
        profile["traits"].alias("document_traits"),
        profile["count"].alias("attachment_count"),
        classify.support_type(category, F.col("pldirSportRealmMlsfcCodeNm"), F.col("bsnsSumryCn")).alias("support_type"),
    )


def in_window(items: DataFrame, first: str, last: str) -> DataFrame:
    return items.where(dates.in_window(F.col("creatPnttm"), first, last))


def normalised(items: DataFrame, detail: str = "detail", attached: str = "attached") -> DataFrame:
    """Fields with where each came from: the feed first, then the page's sections, then attachments."""
    page, files = F.col(detail), F.col(attached)

    def field(api: Column, headers: tuple[str, ...]) -> Column:
        in_page = F.coalesce(*[text.section(page, h) for h in headers])
        in_files = F.coalesce(*[text.section(files, h) for h in headers])
        return text.coalesce_sources((api, 2, "api", "high"), (in_page, 5, "html", "high"), (in_files, 10, "attachment", "medium"))

    return items.select(
        F.col("pblancId").alias("id"), F.col("pblancNm").alias("title"), F.col("categoryName").alias("category"), detail, attached,
        field(text.clean_html(F.col("bsnsSumryCn")), ("사업개요", "지원내용")).alias("summary"),
        field(F.col("trgetNm"), ("지원대상", "신청대상")).alias("target"),
        field(F.col("reqstBeginEndDe"), ("신청기간", "접수기간")).alias("period"),
        field(text.clean_html(F.col("reqstMthPapersCn")), ("신청방법", "접수방법")).alias("method"),
        field(F.col("refrncNm"), ("문의처",)).alias("contact"),
    )


def knowledge(rows: DataFrame) -> DataFrame:
    """Normalised notices -> structured records."""
    whole = F.concat_ws("\n\n", "detail", "attached")
    base = rows.select(
        "id", "title", "category",
        F.coalesce(F.nullif(F.regexp_extract("title", r"^\[([^\]]+)\]", 1), F.lit("")), F.lit("공통")).alias("region"),
        extract.summary(F.coalesce("summary.value", whole)).alias("summary"),
        text.tags(F.coalesce("summary.value", whole), extract.PURPOSES, extract.NEGATION).alias("purposes"),
        extract.amounts(whole).alias("amount"),
        extract.rate(whole).alias("rate"),
        extract.exclusions(whole).alias("exclusions"),
        extract.papers(whole).alias("documents"),
        extract.steps(whole).alias("steps"),
        extract.contact(F.coalesce("contact.value", whole)).alias("contact"),
        extract.laws(whole).alias("laws"),
        F.col("period.value").alias("period"),
        classify.known_period_type(F.col("period.value")).alias("period_type"),
        dates.period_end(F.col("period.value"), ["상시", "예산 소진"]).alias("end_date"),
    )
    grade = classify.information_grade(
        F.size("purposes"), F.col("amount").isNotNull(), F.size("exclusions"), F.size("documents"),
        F.col("contact.phone").isNotNull() | F.col("contact.email").isNotNull(),
    )
    confidence = F.when(F.size("purposes") >= 2, "high").when(F.size("purposes") == 1, "medium").otherwise("low")
    return base.withColumn("grade", grade).withColumn("purpose_confidence", confidence)


def policies(records: DataFrame, as_of: str) -> DataFrame:
    """Records with what a request is held against."""
    words = F.concat_ws(" ", "title", "summary")
    tags = classify.industries(words)
    return records.select(
        "*",
        tags.alias("industries"),
        classify.universal(F.lit(None).cast("boolean"), tags).alias("universal"),
        classify.eligibility(F.col("grade"), F.size("exclusions")).alias("eligible"),
        classify.base_match(F.col("grade"), F.col("purpose_confidence"), F.col("amount").isNotNull()).alias("match"),
        F.when(F.col("end_date") < F.lit(as_of).cast("date"), "closed").otherwise("open").alias("status"),
        dates.days_left(F.col("end_date").cast("timestamp"), F.lit(as_of).cast("timestamp")).alias("days_left"),
    )


def cards(records: DataFrame) -> DataFrame:
    """Short rows for lists: cut texts, the first few of each array."""
    few = lambda c, n, most: F.transform(F.slice(c, 1, n), lambda x: text.shorten(x, most))
    return records.select(
        "id", text.shorten(F.col("title"), 120).alias("title"), text.shorten(F.col("summary"), 160).alias("summary"),
        F.col("amount.max").alias("amount"), few("purposes", 5, 40).alias("purposes"), few("exclusions", 3, 40).alias("exclusions"),
        few("documents", 5, 40).alias("documents"), "period", "grade",
    )


def section_map(lines: DataFrame, ident: str, position: str, line: str, headings: list[tuple[str, str]], cap: int = 600) -> DataFrame:
    """(id, section, body): lines under the heading that last stood before them, by the headings' names.

    A section that comes again is taken if it is longer than what was kept; what is kept is cut, so among long ones the
    last stays.
    """
    from pyspark.sql import Window

    name = classify.cascade([(F.rlike(line, F.lit(p)), n) for p, n in headings], None)
    w = Window.partitionBy(ident).orderBy(position)
    marked = lines.withColumn("_name", name).withColumn("_nth", F.count("_name").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    headed = marked.withColumn("_name", F.max("_name").over(Window.partitionBy(ident, "_nth")))
    body = headed.where(F.col("_name").isNotNull() & ~F.coalesce(name.isNotNull(), F.lit(False)))
    parts = body.groupBy(ident, "_name", "_nth").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(position, line))), lambda x: x[line]), "\n").alias("body")
    ).where(F.char_length("body") >= 5)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_nth", "body"))), lambda x: x["body"])
    kept = F.aggregate(
        ordered, F.lit(""), lambda best, b: F.when(F.char_length(b) > F.char_length(best), F.left(b, F.lit(cap))).otherwise(best)
    )
    return parts.groupBy(ident, F.col("_name").alias("section")).agg(kept.alias("body"))


# Rows for models --------------------------------------------------------------------------------------------------

#: Levels that a column may have to be encoded; more are refused.
MAX_LEVELS = 1000


def levels(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """The sorted values of each column, null left out; refuses columns with more than MAX_LEVELS."""
    one = df.agg(*[F.slice(F.array_sort(F.collect_set(F.col(c).cast("string"))), 1, MAX_LEVELS + 1).alias(c) for c in columns]).first()
    for c in columns:
        if len(one[c]) > MAX_LEVELS:
            raise ValueError(f"{c} has more than {MAX_LEVELS} levels")
    return {c: list(one[c]) for c in columns}


def label_encoded(column: str, known: list) -> Column:
    """A value's place among the sorted levels, from 0; null for unknown values and null."""
    at = F.array_position(F.array(*[F.lit(v) for v in known]), F.col(column).cast("string"))
    return F.when(at > 0, (at - 1).cast("int"))


def one_hot(column: str, known: list) -> Column:
    """An array with a one at the value's place; only zeros for unknown values and null."""
    return F.transform(F.array(*[F.lit(v) for v in known]), lambda v: F.coalesce((v == F.col(column).cast("string")).cast("int"), F.lit(0)))


def assignment_rows(records: DataFrame, ident: str, labels: DataFrame, models: list[str]) -> DataFrame:
    """Records with a column of labels for each model: from rows (ident, model, cluster) in one shuffle; null where a model has none."""
    wide = labels.where(F.col("model").isin(models)).groupBy(ident).pivot("model", models).agg(F.min("cluster"))
    return records.join(wide, ident, "left")


# A rebuilt table --------------------------------------------------------------------------------------------------


def rebuild_report(rows: DataFrame, score: Column, source: Column, unresolved: Column, grade_a: float = 85) -> DataFrame:
    """(check, value) of a rebuilt table in one pass: rows, mean score, share of grade A in percent, rows by source, unresolved amounts.

    Gates compare these with what they were before; an empty table has no mean and no share.
    """
    facts = rows.select(score.cast("double").alias("s"), F.coalesce(source.cast("string"), F.lit("legacy")).alias("source"), F.coalesce(unresolved, F.lit(False)).alias("bad"))
    by = facts.groupBy("source").agg(F.count("*").alias("n"), F.sum("s").alias("s"), F.count("s").alias("scored"), F.count_if(F.col("s") >= grade_a).alias("a"), F.count_if("bad").alias("bad"))
    all_ = by.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "s", "scored", "a", "bad")])
    named = lambda name, value: F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"))
    total = all_.select(
        F.inline(
            F.array(
                named("rows", F.col("n")), named("mean score", F.round(F.try_divide("s", "scored"), 1)),
                named("grade A percent", F.floor(F.try_divide(100 * F.col("a"), "n"))), named("unresolved amounts", F.col("bad")),
            )
        )
    )
    return total.unionByName(by.select(F.concat(F.lit("source: "), "source").alias("check"), F.col("n").cast("double").alias("value")))
