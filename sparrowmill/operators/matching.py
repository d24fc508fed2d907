"""Scores of offers against structured requests, and lexical search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import half_up


def match_points(o: dict[str, Column], q: dict[str, Column]) -> tuple[Column, Column, Column]:
    """(passes, pool, earned) of an offer for a request.

    Offer: goals, stages, industries (arrays), universal, national (booleans), region, region_group, eligible, days_left,
    verified, quality. Request: goal, stage, region, region_group, industry, mode; null is unanswered, region 'any' too.
    """
    asks_region = q["region"].isNotNull() & (q["region"] != "any")
    specific = F.coalesce(o["region"] == q["region"], F.lit(False))
    grouped = F.coalesce(o["region_group"] == q["region_group"], F.lit(False))
    regional = specific | grouped
    has_industry = F.array_contains(o["industries"], q["industry"])
    passes = (
        (q["goal"].isNull() | F.array_contains(o["goals"], q["goal"]))
        & (q["stage"].isNull() | F.array_contains(o["stages"], q["stage"]))
        & (q["industry"].isNull() | o["universal"] | (F.size(o["industries"]) == 0) | has_industry)
        & ((q["mode"] != "national_only") | o["national"])
        & (~asks_region | F.when(q["mode"] == "strict", regional & ~o["national"]).otherwise(regional | o["national"]))
    )
    by_goals = F.array(*[F.lit(x) for x in (40, 40, 34, 28, 22, 20)])
    deadline = (
        F.when(o["days_left"].isNull(), 2).when(o["days_left"].between(0, 14), 4).when(o["days_left"].between(15, 45), 2).otherwise(0)
    )
    ready = F.when(o["eligible"] == "able", 5).when(F.coalesce(o["eligible"], F.lit("")) != "", 2).otherwise(0)
    quality = half_up(F.greatest(F.lit(0.0), (F.when(F.coalesce(o["quality"], F.lit(0)) == 0, 50).otherwise(o["quality"]) - 50) / 50.0 * 6))
    asked = lambda c, n: F.when(c, n).otherwise(0)
    pool = (
        asked(q["goal"].isNotNull(), 40) + asked(q["stage"].isNotNull(), 16) + asked(asks_region, 22)
        + asked(q["industry"].isNotNull(), 22) + 12 + 6
    )
    earned = (
        asked(q["goal"].isNotNull(), F.get(by_goals, F.least(F.size(o["goals"]), F.lit(5))))
        + asked(q["stage"].isNotNull(), 16)
        + asked(asks_region, F.when(specific, 22).when(grouped, 16).otherwise(11))
        + asked(q["industry"].isNotNull(), F.when(has_industry & ~o["universal"], 22).otherwise(11))
        + ready + deadline + asked(o["verified"], 3) + quality
    )
    return F.coalesce(passes, F.lit(False)), pool, earned


def match_score(pool: Column, earned: Column) -> Column:
    return F.greatest(F.lit(4), F.least(F.lit(99), half_up(earned / pool * 99))).cast("int")


def region_order(o: dict[str, Column], q: dict[str, Column]) -> Column:
    """What a request's mode puts first: own region, then its group, then nation-wide offers."""
    specific = F.coalesce(o["region"] == q["region"], F.lit(False))
    grouped = F.coalesce(o["region_group"] == q["region_group"], F.lit(False))
    return (
        F.when(q["mode"] == "strict", 1.0)
        .when(q["mode"] == "national_only", 3.0)
        .when(q["mode"] == "region_first", F.when(specific, 4.0).when(grouped, 3.5).when(o["national"], 2.0).otherwise(1.0))
        .otherwise(F.when(o["national"], 1.0).otherwise(0.0))
    )


def lexical_scores(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, q_tokens: str, d_tokens: str) -> DataFrame:
    """(query, document, hits, lex): the share of a query's tokens that a document has, through a join of postings."""
    q = queries.select(query_id, F.size(q_tokens).alias("n"), F.explode(q_tokens).alias("token"))
    d = docs.select(doc_id, F.explode(d_tokens).alias("token"))
    hits = d.join(q, "token").groupBy(query_id, doc_id, "n").agg(F.count("*").alias("hits"))
    return hits.select(query_id, doc_id, "hits", (F.col("hits") / F.col("n")).alias("lex"))


def hybrid(score: Column, lex: Column) -> Column:
    """Six parts of the match, four of the wording."""
    return 0.6 * score / 99 + 0.4 * lex


def keyword_score(text: Column, keywords: list[str], category: Column, wanted: str) -> Column:
    """Two for each keyword in the text, three for the category."""
    total = F.when(category == wanted, 3).otherwise(0)
    for k in keywords:
        total = total + F.when(F.contains(text, F.lit(k)), 2).otherwise(0)
    return total


def top(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def audit(rows: DataFrame, expected: DataFrame, order: list[Column], first: int = 10) -> DataFrame:
    """One row for each expected request: how many offers it got, what leaked into its answer, and which expectations fail.

    Rows: request, places and special (arrays), starts (boolean), national (boolean). Expected: request, mode and wanted_mode, wanted_region (or
    null), named (array of groups of people), no_starts and national_first (booleans). A request without offers keeps its row.
    """
    keys = expected.select("request", "wanted_region", "named")
    known = rows.join(keys, "request")
    crossing = F.col("wanted_region").isNotNull() & (F.size("places") > 0) & ~F.array_contains("places", F.col("wanted_region"))
    leaking = (F.size("special") > 0) & (F.size("named") == 0)
    counts = known.groupBy("request").agg(
        F.count("*").alias("n"), F.count_if("national").alias("n_national"), F.count_if(crossing).alias("cross_region"), F.count_if(leaking).alias("special_leaks")
    )
    head = top(rows, ["request"], order, first).groupBy("request").agg(F.min_by("national", "rank").alias("leads"), F.count_if("starts").alias("starts_first"))
    out = expected.join(counts, "request", "left").join(head, "request", "left").fillna(0, ["n", "n_national", "cross_region", "special_leaks", "starts_first"])
    starts = F.when(F.col("no_starts"), F.col("starts_first")).otherwise(0)
    failures = F.concat_ws(
        ",",
        F.when(~F.equal_null("mode", "wanted_mode"), "mode"),
        F.when(F.col("national_first") & ~F.coalesce("leads", F.lit(False)), "national first"),
        F.when(F.col("cross_region") > 0, "cross region"),
        F.when(F.col("special_leaks") > 0, "special targets"),
        F.when(starts > 0, "starting up"),
    )
    return out.select("request", "n", "n_national", "cross_region", "special_leaks", starts.cast("long").alias("starts_first"), failures.alias("failures"))


def passed(report: DataFrame) -> None:
    """Raises where a request of an audit fails; the report has a row a request, so it is small."""
    bad = report.where("failures <> ''").select("request", "failures").orderBy("request").take(20)
    if bad:
        raise ValueError("; ".join(f"{r.request}: {r.failures}" for r in bad))
