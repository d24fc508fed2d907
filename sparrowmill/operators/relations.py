"""Joins, updates, windows over sequences and sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_that_must_match(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """A left join that fails, when it runs, on a row without a partner."""
    out = left.join(right.withColumn("_partner", F.lit(True)), on, "left")
    ok = F.assert_true(F.col("_partner"), F.concat(F.lit(f"no partner for {on} "), F.col(on).cast("string")))
    return out.withColumn("_ok", ok).where(F.col("_ok").isNull()).drop("_partner", "_ok")


def new_rows(candidates: DataFrame, *known: DataFrame, on: str) -> DataFrame:
    """Candidates whose id no other table has."""
    for k in known:
        candidates = candidates.join(k.select(on), on, "left_anti")
    return candidates


def restore_missing(current: DataFrame, saved: DataFrame, on: str) -> DataFrame:
    """Current rows, and saved ones that they lack."""
    return current.unionByName(saved.join(current.select(on), on, "left_anti"), allowMissingColumns=True)


def apply_cache(rows: DataFrame, cache: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Overwrites columns where the cache has a value for the id."""
    named = cache.select(on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = rows.join(named, on, "left")
    return out.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


def best_candidate(rows: DataFrame, candidates: DataFrame, on: str, value: str, score: str, priority: str) -> DataFrame:
    """Replaces a value by the best candidate's if that scores strictly higher; ties go to the first source."""
    order = F.struct(F.col(score), (-F.col(priority)).alias("p"))
    best = candidates.groupBy(on).agg(F.max_by(F.struct(value, score), order).alias("b"))
    out = rows.join(best, on, "left")
    better = F.coalesce(F.col(f"b.{score}") > F.col(score), F.col("b").isNotNull() & F.col(score).isNull())
    return out.select(
        *[c for c in rows.columns if c not in (value, score)],
        F.when(better, F.col(f"b.{value}")).otherwise(F.col(value)).alias(value),
        F.when(better, F.col(f"b.{score}")).otherwise(F.col(score)).alias(score),
    )


def last_write(df: DataFrame, key: list[str], sequence: Column) -> DataFrame:
    """The last row of each key, by an aggregate that combines before it shuffles."""
    best = df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), sequence).alias("r"))
    return best.select("r.*")


def merge_intervals(df: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Intervals of a key that overlap or touch become one: (key, start, end, n)."""
    w = Window.partitionBy(*key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_break", F.when(F.col(start) <= before, 0).otherwise(1))
    island = marked.withColumn("_island", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        island.groupBy(*key, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"))
        .drop("_island")
    )


def carry_forward(df: DataFrame, key: list[str], position: str, heading: Column, name: str) -> DataFrame:
    """The last heading at or before each row of a key."""
    w = Window.partitionBy(*key).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(heading, ignorenulls=True).over(w))


def budgeted(df: DataFrame, key: list[str], position: str, text: str, budget: int) -> DataFrame:
    """Chunks of a key in order until so many characters are used; the last is cut."""
    w = Window.partitionBy(*key).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.char_length(text)).over(w), F.lit(0))
    out = df.withColumn("_left", F.lit(budget) - used).where(F.col("_left") > 0)
    return out.withColumn(text, F.expr(f"left({text}, cast(_left as int))")).drop("_left")


def representatives(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Rows with the size of their group, whether they stand for it, and the weight that shares one among them."""
    w = Window.partitionBy(*key)
    return (
        df.withColumn("group_size", F.count("*").over(w))
        .withColumn("is_representative", F.row_number().over(w.orderBy(*order)) == 1)
        .withColumn("weight", F.round(1.0 / F.col("group_size"), 8))
    )


def numbered_groups(groups: DataFrame, least: str, prefix: str, parts: int = 256) -> DataFrame:
    """Groups named PREFIX-0001 on, in the order of their least member, a number.

    Equal ranges of numbers are counted first; a group's number is its place in its range after all ranges before, so no
    task sees all groups.
    """
    span = groups.agg(F.min(least).alias("_lo"), F.max(least).alias("_hi"))
    ranged = groups.join(F.broadcast(span)).withColumn(
        "_part", F.floor((F.col(least) - F.col("_lo")).cast("double") * parts / (F.col("_hi") - F.col("_lo") + 1))
    )
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over the ranges, not the groups
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(least))
    out = ranged.join(F.broadcast(starts), "_part").withColumn("group_name", F.format_string(f"{prefix}-%04d", F.col("_start") + place))
    return out.drop("_part", "_lo", "_hi", "_start")


def same_ids(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """(missing_left, missing_right, repeated_left, repeated_right): all zero if both have the same ids once."""
    counts = a.groupBy(on).agg(F.count("*").alias("l")).join(b.groupBy(on).agg(F.count("*").alias("r")), on, "full")
    return counts.agg(
        F.count_if(F.col("l").isNull()).alias("missing_left"),
        F.count_if(F.col("r").isNull()).alias("missing_right"),
        F.count_if(F.col("l") > 1).alias("repeated_left"),
        F.count_if(F.col("r") > 1).alias("repeated_right"),
    )
