"""Counting, coverage and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

EMPTY = "[empty]"


def named(value: Column) -> Column:
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit(EMPTY))


def count_by(df: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """(dim, value, n) for several dimensions in one pass over the rows; array dimensions count each element."""
    pairs = []
    for name, column in dims.items():
        pairs.append(F.struct(F.lit(name).alias("dim"), named(column).alias("value")))
    return df.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p.dim", "p.value").agg(F.count("*").alias("n"))


def element_counts(df: DataFrame, array: Column) -> DataFrame:
    """(value, n) over the elements of an array; rows without any count as empty."""
    return df.select(F.explode_outer(array).alias("v")).select(named(F.col("v")).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def coverage(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, present, total, share to one decimal) from conditions, in one aggregate."""
    sums = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"f{i}") for i, c in enumerate(fields.values())]
    one = df.agg(F.count("*").alias("total"), *sums)
    rows = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"f{i}").alias("present")) for i, n in enumerate(fields)])
    share = F.when(F.col("total") > 0, F.round(100.0 * F.col("present") / F.col("total"), 1))
    return one.select("total", F.inline(rows)).select("field", "present", "total", share.alias("share"))


def bins(value: Column, edges: list[tuple[float, str]], rest: str) -> Column:
    """The name of the first edge that the value reaches; null counts as 0."""
    value, out = F.coalesce(value, F.lit(0)), None
    for least, name in edges:
        out = F.when(value >= least, name) if out is None else out.when(value >= least, name)
    return out.otherwise(rest)


GRADES = [(85, "A"), (70, "B"), (50, "C")]


def ratio_change(old: Column, new: Column) -> Column:
    """How a value changed, by the ratio of new to old."""
    r = new / old
    return (
        F.when(old.isNull() & new.isNull(), "none")
        .when(old.isNull(), "new")
        .when(new.isNull(), "lost")
        .when(old == new, "same")
        .when(r <= 0.1, "tenth or less")
        .when(r <= 0.5, "half or less")
        .when(r >= 2, "double or more")
        .otherwise("small")
    )


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group in a total order, numbered from 1."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)


def panel(df: DataFrame, group: str, ident: str, n: int = 3) -> DataFrame:
    """(group, n_rows, sample): sizes and the first n ids, kept short while they are gathered.

    Ids are ranked within salts first, so that no group has to be gathered whole.
    """
    salted = df.select(group, ident, F.pmod(F.xxhash64(ident), F.lit(32)).alias("salt"))
    w = Window.partitionBy(group, "salt").orderBy(ident)
    part = salted.withColumn("r", F.row_number().over(w))
    return (
        part.groupBy(group)
        .agg(F.count("*").alias("n_rows"), F.collect_list(F.when(F.col("r") <= n, F.col(ident))).alias("s"))
        .select(group, "n_rows", F.array_join(F.slice(F.array_sort("s"), 1, n), ",").alias("sample"))
    )


def group_sets(df: DataFrame, group: str, value: str, most: int = 100) -> DataFrame:
    """(group, n_values, values): the distinct values of a group, of which the first ``most`` are listed.

    Distinct pairs are ranked within salts before they meet, so a group of many values is never gathered whole.
    """
    pairs = df.select(group, value).where(F.col(value).isNotNull()).distinct().withColumn("salt", F.pmod(F.xxhash64(value), F.lit(32)))
    ranked = pairs.withColumn("r", F.row_number().over(Window.partitionBy(group, "salt").orderBy(value)))
    listed = F.slice(F.array_sort(F.collect_list(F.when(F.col("r") <= most, F.col(value)))), 1, most)
    return ranked.groupBy(group).agg(F.count("*").alias("n_values"), listed.alias("values"))


def issues(df: DataFrame, ident: Column, rules: dict[str, Column]) -> DataFrame:
    """(rule, area, id) for each rule that a row breaks; an area is what stands before the colon."""
    found = [F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]
    out = df.select(ident.cast("string").alias("id"), F.explode(F.array_compact(F.array(*found))).alias("rule"))
    return out.select("rule", F.substring_index("rule", ":", 1).alias("area"), "id")


def filled(name: str) -> Column:
    """Whether a column holds more than blanks."""
    return F.coalesce(F.trim(F.col(name).cast("string")) != "", F.lit(False))


def field_statistics(df: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """(group, field, n_rows, present, share, shortest, longest, average) in one aggregate, fields turned into rows after it.

    Lengths are those of filled values, as text; a group that never fills a field has none.
    """
    aggs = [F.count("*").alias("n_rows")]
    for k, name in enumerate(fields):
        size = F.when(filled(name), F.char_length(F.col(name).cast("string")))
        aggs += [F.count(size).alias(f"c{k}"), F.min(size).alias(f"lo{k}"), F.max(size).alias(f"hi{k}"), F.avg(size).alias(f"mean{k}")]
    one = df.groupBy(group).agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(n).alias("field"), F.col(f"c{k}").alias("present"), F.col(f"lo{k}").alias("shortest"), F.col(f"hi{k}").alias("longest"), F.round(f"mean{k}", 2).alias("average"))
        for k, n in enumerate(fields)
    ])
    share = F.round(100.0 * F.col("present") / F.col("n_rows"), 1)
    return one.select(group, "n_rows", F.inline(rows)).select(group, "field", "n_rows", "present", share.alias("share"), "shortest", "longest", "average")


def completeness(df: DataFrame, fields: list[str]) -> Column:
    """The share of fields that a row fills, to four decimals."""
    return F.round(sum((filled(n).cast("int") for n in fields), F.lit(0)) / F.lit(float(len(fields))), 4)


def write_counted(df: DataFrame, path: str, counters: dict[str, Column], mode: str = "overwrite") -> dict[str, int]:
    """Writes a table and returns counts of rows by condition, taken in the pass that writes; ``rows`` counts all."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items()]).write.mode(mode).parquet(path)
    return dict(seen.get)
