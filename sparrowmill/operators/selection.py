"""Choosing among rows: the best model of each method, rows for an editor, rows for a model, panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import cascade


def best_by_method(fits: DataFrame, method: str, ident: str, by_likelihood: tuple[str, ...] = ("lca",)) -> DataFrame:
    """The best fit of each method: viable ones first, then by silhouette, or by the least bic where a method has a likelihood."""
    worth = F.when(F.col(method).isin(*by_likelihood), -F.col("bic")).otherwise(F.col("silhouette"))
    w = Window.partitionBy(method).orderBy(F.desc("viable"), worth.desc(), ident)
    return fits.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def preferred(best: DataFrame, ident: str) -> DataFrame:
    """The best fits, a row a method, with the one to prefer: viable, then strongest, most stable, best separated."""
    top = best.where("viable").orderBy(F.desc("strength"), F.desc("jaccard"), F.desc("silhouette"), ident).limit(1).select(F.col(ident).alias("_top"))
    out = best.join(F.broadcast(top), best[ident] == F.col("_top"), "left")
    return out.withColumn("preferred", F.col("_top").isNotNull()).drop("_top")


def grid(rows: DataFrame, *, category: str | None = None, word: str = "", length: int | None = None) -> DataFrame:
    """Rows of a category whose title or purpose has a word in either case, shorter than so many characters."""
    if category is not None:
        rows = rows.where(F.col("category") == category)
    if word:
        rows = rows.where(F.contains(F.lower("title"), F.lit(word.lower())) | F.contains(F.lower("purpose"), F.lit(word.lower())))
    return rows if length is None else rows.where(F.char_length("purpose") < length)


def badge(purpose: Column) -> Column:
    """What an editor should look at."""
    n = F.char_length(purpose)
    return cascade(
        [(n < 25, "short"), (F.rlike(purpose, F.lit("합니다|입니다")), "formal"), (F.rlike(purpose, F.lit("같이|도모")), "official"), (n < 40, "terse")], "fine"
    )


def targets(rows: DataFrame, answered: DataFrame, ident: str) -> DataFrame:
    """Rows whose amount is huge, marked as a whole budget, or unknown, and why; those answered already are left out."""
    label = F.col("label")
    why = cascade(
        [
            (F.contains(label, F.lit("억원")) & (F.col("amount") >= 10_000_000_000), "huge"), (F.contains(label, F.lit("총사업비")), "total"),
            (label.isin("", "지원 규모 확인 필요"), "unknown"),
        ],
        None,
    )
    return rows.withColumn("why", why).where("why IS NOT NULL").join(answered.select(ident).distinct(), ident, "left_anti")


def panels(rows: DataFrame, of: dict[str, tuple[Column, int]]) -> DataFrame:
    """(panel, rank, value, n): the most common values of each panel, counted in one pass; null values count in none."""
    pairs = F.array(*[F.struct(F.lit(p).alias("panel"), c.alias("value")) for p, (c, _) in of.items()])
    n = rows.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("panel", "value").agg(F.count("*").alias("n"))
    ranked = n.withColumn("rank", F.row_number().over(Window.partitionBy("panel").orderBy(F.desc("n"), "value")).cast("long"))
    most = cascade([(F.col("panel") == p, k) for p, (_, k) in of.items()], 0)
    return ranked.where(F.col("rank") <= most).select("panel", "rank", "value", "n")


#: What is wrong with a text, and what to tell a model about it.
HINTS = (
    (("배경/동기",), "'어려운/막막한/부담스러운' 같은 공감 표현이 부족"),
    (("대상자",), "대상자(소상공인/창업자 등)가 불명확"),
    (("도움/성장",), "'돕는/키우는/이어가는' 같은 도움 표현이 부족"),
    (("관공서", "합니다/입니다"), "관공서 문체가 남아있음 — 해요체로"),
    (("단어반복", "중언부언"), "같은 단어가 반복됨"),
    (("위해/위한", "비문"), "문장 구조가 어색함"),
    (("길이",), "길이가 부적절(50~100자 권장)"),
)


def hints(issues: Column) -> Column:
    """Issues as one line that a model understands."""
    text = F.array_join(issues, " ")
    found = [F.when(F.rlike(text, F.lit("|".join(words))), F.lit(hint)) for words, hint in HINTS]
    told = F.array_join(F.array_compact(F.array(*found)), "; ")
    return F.when(told != "", told).otherwise(F.lit("토스 스타일 규칙 미충족"))
