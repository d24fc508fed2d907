"""Repair in rounds: what scores too low is answered anew with hints at its weaknesses, and kept only if it scores higher."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .similarity import cut


def weaknesses(text: Column, rules: dict[str, Column]) -> Column:
    """The names of the rules that a text breaks, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))


def improve(
    rows: DataFrame,
    ident: str,
    text: str,
    answer: Callable[[DataFrame], DataFrame],
    score: Callable[[Column], Column],
    hints: Callable[[Column], Column],
    target: float,
    rounds: int = 3,
) -> DataFrame:
    """(ident, text, score, accepted, asked): each row's best text.

    answer: from (ident, text, hints) to (ident, answer), a model's or a rule's; no row or null is no answer. Rows that
    reach the target are never asked about, and leave the rounds as soon as they do: each round works on what is left
    alone and writes only that. A round that mends nothing is the last one. ``ident`` names a row; a null text scores as an
    empty one.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    start = rows.select(ident, value.alias("text"), score(value).cast("double").alias("score"))
    start = cut(start.withColumns({"accepted": F.lit(0), "asked": F.lit(0)}))
    done, left = [start.where(F.col("score") >= target)], start.where(F.col("score") < target)
    for _ in range(rounds):
        if left.isEmpty():
            break
        said = answer(left.select(ident, "text", hints(F.col("text")).alias("hints"))).select(F.col(ident).alias("_id"), F.col("answer").alias("_new"))
        judged = left.join(said, left[ident] == F.col("_id"), "left").withColumn("_score", F.when(F.col("_new").isNotNull(), score(F.col("_new")).cast("double")))
        better = F.coalesce(F.col("_score") > F.col("score"), F.lit(False))
        after = cut(
            judged.select(
                ident, F.when(better, F.col("_new")).otherwise(F.col("text")).alias("text"), F.when(better, F.col("_score")).otherwise(F.col("score")).alias("score"),
                (F.col("accepted") + better.cast("int")).alias("accepted"), (F.col("asked") + 1).alias("asked"), better.alias("_mended"),
            )
        )
        mended = not after.where("_mended").isEmpty()
        after = after.drop("_mended")
        done.append(after.where(F.col("score") >= target))
        left = after.where(F.col("score") < target)
        if not mended:
            break
    out = left
    for part in done:
        out = out.unionByName(part)
    return out
