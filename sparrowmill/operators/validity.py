"""How good and how steady clusterings of any number of rows are: sums by cluster, never distances of pairs of rows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def apart(a: Column, b: Column) -> Column:
    """The square of two vectors' distance."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector at length one; a vector of zeros stays."""
    length = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: F.when(length > 0, x / length).otherwise(0.0))


def sums(v: Column) -> Column:
    return vector_to_array(Summarizer.sum(array_to_vector(v)))


def beside(df: DataFrame, one: DataFrame) -> DataFrame:
    """Each row with the columns of a table of one row."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one.withColumn("_one", F.lit(1))), "_one").drop("_one")


def measures(df: DataFrame, vector: Column, cluster: Column) -> DataFrame:
    """(n, clusters, silhouette, davies_bouldin, calinski_harabasz) of a clustering, in passes over the rows.

    The silhouette's distance is one less the cosine: the mean distance of a row to a cluster follows from the sum of the
    cluster's unit vectors. A cluster of one scores 0; so does all with one cluster. The sums, a row for each cluster,
    are what tasks share. A measure that is not defined is null. Null vectors are left out.
    """
    rows = df.select(vector.cast("array<double>").alias("x"), cluster.alias("c")).where(F.col("x").isNotNull() & F.col("c").isNotNull())
    rows = rows.withColumn("u", unit(F.col("x")))
    each = rows.groupBy("c").agg(F.count("*").alias("n"), sums(F.col("u")).alias("su"), sums(F.col("x")).alias("sx"))
    each = each.withColumn("m", F.transform("sx", lambda x: x / F.col("n")))
    all_ = beside(rows, each.agg(F.collect_list(F.struct("c", "n", "su", "m")).alias("each")))
    own = F.filter("each", lambda e: e["c"] == F.col("c"))[0]
    own_n = own["n"].cast("double")
    a = (own_n - dot(F.col("u"), own["su"])) / (own_n - 1)
    others = F.transform(F.filter("each", lambda e: e["c"] != F.col("c")), lambda e: 1 - dot(F.col("u"), e["su"]) / e["n"])
    b = F.array_min(others)
    s = F.when((own_n > 1) & b.isNotNull() & (F.greatest(a, b) > 0), (b - a) / F.greatest(a, b)).otherwise(0.0)
    far = apart(F.col("x"), own["m"])
    scored = all_.select("c", s.alias("s"), far.alias("far"))
    spread = scored.groupBy("c").agg(F.sum("s").alias("s"), F.sum("far").alias("within"), F.avg(F.sqrt("far")).alias("spread"))
    known = each.join(spread, "c")
    total = known.agg(F.sum("n").alias("all_n"), F.count("*").alias("k"), sums(F.col("sx")).alias("sum_x"), F.sum("s").alias("sum_s"), F.sum("within").alias("sum_within"))
    mean = F.transform("sum_x", lambda x: x / F.col("all_n"))
    between = beside(known, total).select((F.col("n") * apart(F.col("m"), mean)).alias("b")).agg(F.sum("b").alias("between"))
    one, two = known.select("c", "m", "spread"), known.select(F.col("c").alias("c2"), F.col("m").alias("m2"), F.col("spread").alias("spread2"))
    pairs = one.join(F.broadcast(two), F.col("c") != F.col("c2")).select("c", ((F.col("spread") + F.col("spread2")) / F.sqrt(apart(F.col("m"), F.col("m2")))).alias("r"))
    bouldin = pairs.groupBy("c").agg(F.max("r").alias("r")).agg(F.avg("r").alias("davies_bouldin"))
    out = beside(beside(total, between), bouldin)
    harabasz = F.when((F.col("k") > 1) & (F.col("sum_within") > 0), (F.col("between") / (F.col("k") - 1)) / (F.col("sum_within") / (F.col("all_n") - F.col("k"))))
    return out.select(
        F.col("all_n").alias("n"), F.col("k").alias("clusters"), F.round(F.col("sum_s") / F.col("all_n"), 6).alias("silhouette"),
        F.round("davies_bouldin", 6).alias("davies_bouldin"), F.round(harabasz, 4).alias("calinski_harabasz"),
    )


def folds(df: DataFrame, group: str, k: int) -> DataFrame:
    """(group, fold): whole groups, the largest first into the emptiest fold; ties by group, then by fold.

    The sizes, one row for each group, are folded in one array; take coarser groups where there are millions.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    line = sizes.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), F.col(group).alias("g")))).alias("line"))
    start = F.struct(F.array(*[F.lit(0).cast("long")] * k).alias("load"), F.array().cast("array<int>").alias("to"))

    def deal(state: Column, x: Column) -> Column:
        to = F.array_position(state["load"], F.array_min(state["load"])).cast("int")
        load = F.transform(state["load"], lambda y, i: F.when(i + 1 == to, y - x["less"]).otherwise(y))
        return F.struct(load.alias("load"), F.concat(state["to"], F.array(to - 1)).alias("to"))

    dealt = line.select(F.arrays_zip(F.col("line.g").alias("g"), F.aggregate("line", start, deal)["to"].alias("to")).alias("z"))
    return dealt.select(F.explode("z").alias("z")).select(F.col("z.g").alias(group), F.col("z.to").alias("fold"))


def centres(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(label, m): the mean of each label's vectors."""
    n = df.groupBy(label).agg(F.count("*").alias("n"), sums(F.col(vector)).alias("s"))
    return n.select(label, F.transform("s", lambda x: x / F.col("n")).alias("m"))


def nearest(df: DataFrame, vector: str, found: DataFrame, label: str, name: str) -> DataFrame:
    """Rows with the label of the nearest centre; distances to six digits, ties by label."""
    near = lambda e: F.struct(F.round(apart(F.col(vector), e["m"]), 6).alias("d"), e[label].alias("l"))
    rows = beside(df, found.agg(F.collect_list(F.struct("m", label)).alias("_all")))
    return rows.withColumn(name, F.array_min(F.transform("_all", near))["l"]).drop("_all")


def strength(df: DataFrame, by: list[str], assigned: str, independent: str) -> DataFrame:
    """(by, strength): the least share, over assigned clusters of two or more, of pairs that the independent fit keeps together.

    Pairs are counted from sizes of the cells, never formed.
    """
    cells = df.groupBy(*by, assigned, independent).agg(F.count("*").cast("double").alias("n"))
    sizes = cells.groupBy(*by, assigned).agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("kept"))
    share = F.when(F.col("n") > 1, F.col("kept") / (F.col("n") * (F.col("n") - 1)))
    return sizes.groupBy(*by).agg(F.round(F.coalesce(F.min(share), F.lit(1.0)), 9).alias("strength"))


def held_out_strength(df: DataFrame, ident: str, vector: str, label: str, group: str, k: int) -> DataFrame:
    """(fold, rows, strength) of nearest-centre clusterings: a fold's rows by the centres of the rest, and by its own."""
    x = df.select(ident, F.col(vector).cast("array<double>").alias("x"), label, group)
    dealt = x.join(F.broadcast(folds(x, group, k)), group)
    # A fold's own sums and those of all give the rest's.
    own = dealt.groupBy("fold", label).agg(F.count("*").alias("n"), sums(F.col("x")).alias("s"))
    w = Window.partitionBy(label)
    lists = own.withColumn("tn", F.sum("n").over(w)).withColumn("ts", F.collect_list("s").over(w))
    total = F.aggregate("ts", F.transform("s", lambda _: F.lit(0.0)), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    lists = lists.withColumn("total", total)
    rest = F.when(F.col("tn") > F.col("n"), F.zip_with("total", "s", lambda t, s: (t - s) / (F.col("tn") - F.col("n"))))
    own_m = F.transform("s", lambda s: s / F.col("n"))
    table = lists.select("fold", label, own_m.alias("own"), rest.alias("rest"))
    table = table.groupBy("fold").agg(F.collect_list(F.struct(label, "own", "rest")).alias("cs"))
    rows = dealt.join(F.broadcast(table), "fold")

    def pick(which: str) -> Column:
        known = F.filter("cs", lambda e: e[which].isNotNull())
        return F.array_min(F.transform(known, lambda e: F.struct(F.round(apart(F.col("x"), e[which]), 6).alias("d"), e[label].alias("l"))))["l"]

    judged = rows.select("fold", pick("rest").alias("assigned"), pick("own").alias("independent"))
    return strength(judged, ["fold"], "assigned", "independent").join(judged.groupBy("fold").agg(F.count("*").alias("rows")), "fold").select("fold", "rows", "strength")
