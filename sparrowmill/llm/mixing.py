"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times. The documents of a source stand in one order,
small to large; expected copies are summed along it, one random offset is added, and a document is emitted once for
each integer boundary that its stretch of the sum crosses. As neighbours are of like size, a source's words come near
its target, and no document comes more often than the next integer above its expectation.

Defined cases: a null or blank text has size 0 and takes part with its expected copies; the null source is a source of
its own and stands last; repeated rows are separate documents; an empty table gives no rows; a source of size 0 has
target 0. Other columns pass through, and helper columns avoid their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, fresh, table

#: Size classes an octave and salts a class: a class of a source is ordered in so many independent pieces.
CLASSES, SALTS = 8, 16


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size) -> with target: water is poured by weight until ``share`` of all sizes is placed.

    A source is full at ``most`` times its size. With sources in the order of capacity by weight, the level at which
    the k-th source fills is known from sums over those before it, so the rounds of resharing need no loop. One row a
    source goes through the two windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    out = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = (
        out.withColumn("placed", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("pool", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("pool") - F.col("placed")) / F.col("open"))
        .withColumn("full", F.col("level") * F.col("weight") > F.col("cap"))
    )
    # Past the first source that is not full the level only falls.
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return out.select(
        "source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight")).alias("target")
    )


def offset(seed: int, source: Column) -> Column:
    """One random number in [0, 1) a source."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """All documents with size, source_size, target and copies (named afresh where the input has such columns)."""
    size, source_size, target, copies = fresh(docs, "size", "source_size", "target", "copies")
    cls, salt, rank, first, k0, k1, k2 = fresh(docs, "_cls", "_salt", "_rank", "_first", "_k0", "_k1", "_k2")
    keyed = docs.withColumn(size, n_words(F.col(text_col))).withColumn(
        cls, F.floor(F.log2(F.col(size) + F.lit(1.0)) * CLASSES).cast("int")
    )
    ident = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    keyed = keyed.withColumn(salt, F.conv(F.substring(ident, 1, 4), 16, 10).cast("int") % SALTS)
    key = [source_col, cls, salt]
    counts = cut(
        keyed.groupBy(*[F.col(c).alias(k) for c, k in zip(key, (k0, k1, k2))]).agg(
            F.count("*").alias("n"), F.sum(size).alias("words")
        )
    )
    sizes = counts.groupBy(F.col(k0).alias("source")).agg(F.sum("words").alias("source_size"))
    goal = targets(sizes, weights, share, most)
    along = Window.partitionBy(k0).orderBy(k1, k2).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(along), F.lit(0)))
    # What is known of a piece comes from at most CLASSES * 64 * SALTS rows a source.
    plan = starts.join(goal, starts[k0].eqNullSafe(goal["source"])).select(
        k0, k1, k2, F.col("start").alias(first), F.col("source_size").alias(source_size), F.col("target").alias(target)
    )
    within = Window.partitionBy(*key).orderBy(F.col(size), ident, F.col(id_col))
    ranked = keyed.withColumn(rank, F.row_number().over(within) - 1)
    joined = ranked.join(
        plan,
        ranked[source_col].eqNullSafe(plan[k0]) & (ranked[cls] == plan[k1]) & (ranked[salt] == plan[k2]),
    )
    # The k-th document of a source covers the stretch from k to k + 1 times the rate.
    place = F.col(first) + F.col(rank)
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    u = offset(seed, F.col(source_col))
    crossed = F.floor((place + 1) * rate + u) - F.floor(place * rate + u)
    return joined.withColumn(copies, crossed.cast("int")).select(
        *docs.columns, size, source_size, target, copies
    )


def emit(mixed: DataFrame, copies: str, columns: list[str]) -> DataFrame:
    """Each document as often as the mix takes it."""
    (one,) = fresh(mixed, "_copy")
    return mixed.withColumn(one, F.explode(F.array_repeat(F.lit(1), F.col(copies)))).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS ident
  FROM documents),
k AS (
  SELECT *, floor(log2(size + 1.0) * 8)::INT AS cls, ('0x' || substr(ident, 1, 4))::INT % 16 AS salt,
         ('0x' || substr(md5('17:' || coalesce('s' || source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0.0::DOUBLE))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0::DOUBLE)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, CASE WHEN level * weight > cap THEN cap ELSE
         weight * max(CASE WHEN level * weight <= cap THEN level END) OVER () END AS target FROM l),
r AS (
  SELECT k.*, row_number() OVER (PARTITION BY source ORDER BY cls, salt, size, ident, doc_id) - 1 AS place FROM k)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * (floor((place + 1) * x + u) - floor(place * x + u)))::BIGINT AS taken,
       (floor((place + 1) * x + u) - floor(place * x + u))::INT AS copies
FROM (SELECT r.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS x
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
"""
