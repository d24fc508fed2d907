"""Reduced terms and k-means over vectors of any number of rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .similarity import cut, written


def kmeans_labels(df: DataFrame, ident: str, vector: Column, k: int, seeds: tuple[int, ...] = (1, 2, 3), weight: str | None = None) -> DataFrame:
    """(ident, cluster) of the best of several starts."""
    x = cut(df.select(ident, array_to_vector(vector.cast("array<double>")).alias("features"), *([weight] if weight else [])))
    best = None
    for seed in seeds:
        model = KMeans(k=k, seed=seed, maxIter=30, **({"weightCol": weight} if weight else {})).fit(x)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    return best.transform(x).select(ident, F.col("prediction").alias("cluster"), "features")


def cosine_silhouette(labelled: DataFrame) -> float:
    return ClusteringEvaluator(predictionCol="cluster", distanceMeasure="cosine").evaluate(labelled)


# Reduced term space ---------------------------------------------------------------------------------------------


def grams(text: Column) -> Column:
    """Words of two or more letters, digits or underscores, lower-cased, and pairs of neighbours among them."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))

    def with_pairs(words: Column) -> Column:
        n = F.size(words) - 1
        pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.when(n > 0, F.concat(words, pairs)).otherwise(words)

    return F.transform(F.array(found), with_pairs)[0]


#: Slots that occurrences are counted in before terms are counted by themselves.
SLOTS = 1 << 18


def vocabulary(docs: DataFrame, tokens: Column, most: int = 3000, least_df: int = 2, most_share: float = 0.98) -> DataFrame:
    """(term, at, idf): of the terms in enough and not too many documents the ``most`` frequent ones, ties by spelling.

    Occurrences are first counted by slot of the terms' hashes, a bounded table. A term occurs no more often than its slot,
    so only terms of the fullest slots are counted by themselves; where the last one taken is rarer than a slot left out,
    more slots are taken. The result has ``most`` rows at most, so it may be sent to all tasks.
    """
    spark, n_docs = docs.sparkSession, docs.count()
    slots = docs.select(F.explode(tokens).alias("term")).groupBy(F.pmod(F.hash("term"), F.lit(SLOTS)).alias("slot")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).toArrow()
    totals, taken = slots["n"].to_numpy(), 4 * most
    while True:
        full = F.broadcast(spark.createDataFrame(slots.slice(0, taken).select(["slot"]))) if taken < len(totals) else None
        # Each term of a document once for its occurrences and once for the document, so that texts are split once.
        both = F.concat(F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(0).alias("d"))), F.transform(F.array_distinct(tokens), lambda t: F.struct(t.alias("t"), F.lit(1).alias("d"))))
        each = docs.select(F.explode(both).alias("x")).select(F.col("x.t").alias("term"), "x.d")
        if full is not None:
            each = each.withColumn("slot", F.pmod(F.hash("term"), F.lit(SLOTS))).join(full, "slot")
        known = each.groupBy("term").agg(F.sum(1 - F.col("d")).alias("often"), F.sum("d").alias("df"))
        known = known.where((F.col("df") >= least_df) & (F.col("df") <= most_share * n_docs))
        top = known.orderBy(F.desc("often"), "term").limit(most).collect()
        if full is None or len(top) == most and top[-1].often > totals[taken]:
            break
        taken *= 8
    rows = [(r.term, k, float(np.log((1 + n_docs) / (1 + r.df)) + 1)) for k, r in enumerate(sorted(top, key=lambda r: r.term))]
    return spark.createDataFrame(rows, "term string, at int, idf double")


def term_rows(docs: DataFrame, ident: str, tokens: Column, known: DataFrame) -> DataFrame:
    """(ident, ats, weights): sublinear tf-idf of unit length by ascending column; empty for rows without known terms. Nothing is shuffled."""
    table_ = known.orderBy("at").toArrow()
    shipped = docs.sparkSession.sparkContext.broadcast((table_["term"].combine_chunks(), table_["at"].to_numpy(), table_["idf"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, ats, idf = shipped.value
        for whole in batches:
            for batch in _bounded(whole, 1024):
                lists = batch.column("tokens")
                n = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                words = lists.flatten().dictionary_encode()
                found = pa.compute.fill_null(pa.compute.index_in(words.dictionary, value_set=terms), -1).to_numpy()[words.indices.to_numpy()]
                row = np.repeat(np.arange(len(n)), n)[found >= 0]
                key, tf = np.unique(row * max(1, len(terms)) + found[found >= 0], return_counts=True)
                row, k = np.divmod(key, max(1, len(terms)))
                w = (1 + np.log(tf)) * idf[k]
                w = w / np.sqrt(np.bincount(row, w * w, len(n)))[row]
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n)))]), pa.int32())
                cols = [pa.ListArray.from_arrays(ends, pa.array(ats[k], pa.int32())), pa.ListArray.from_arrays(ends, pa.array(w, pa.float64()))]
                yield pa.record_batch([batch.column(ident), *cols], names=[ident, "ats", "weights"])

    kind = docs.schema[ident].dataType.simpleString()
    return docs.select(ident, tokens.alias("tokens")).mapInArrow(run, f"`{ident}` {kind}, ats array<int>, weights array<double>")


def _dense(batch: pa.RecordBatch, width: int) -> np.ndarray:
    ats, weights = batch.column("ats"), batch.column("weights")
    out = np.zeros((batch.num_rows, width))
    rows = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(ats).to_numpy())
    out[rows, ats.flatten().to_numpy()] = weights.flatten().to_numpy()
    return out


def _bounded(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    yield from (batch.slice(lo, rows) for lo in range(0, batch.num_rows, rows))


def gram_times(rows: DataFrame, x: np.ndarray) -> np.ndarray:
    """A'Ax for the matrix A of term rows: one pass; each task sends one row for each term, and sums are made by term."""
    shipped = rows.sparkSession.sparkContext.broadcast(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shipped.value
        total = np.zeros_like(x)
        for batch in batches:
            for part in _bounded(batch):
                a = _dense(part, len(x))
                total += a.T @ (a @ x)
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(total.ravel()))
        yield pa.record_batch([pa.array(np.arange(len(x)), pa.int32()), values], names=["at", "sums"])

    parts = rows.select("ats", "weights").mapInArrow(run, "at int, sums array<double>")
    sums = parts.groupBy("at").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).toArrow()
    out = np.zeros_like(x)
    if len(sums):
        out[sums["at"].to_numpy()] = np.array(sums["sums"].to_pylist())
    shipped.unpersist()
    return out


@dataclass
class Reduced:
    """Singular values, the right singular vectors as columns, and the reduced rows (ident, vector)."""

    values: np.ndarray
    axes: np.ndarray
    rows: DataFrame


def truncated_svd(rows: DataFrame, ident: str, width: int, k: int = 60, beyond: int = 10, steps: int = 5, seed: int = 42) -> Reduced:
    """The k leading singular triples of term rows, by a randomised block Krylov space of A'A.

    Each step is one pass over the rows with a block of k + beyond columns; only blocks of ``width`` rows, the bounded
    vocabulary, come to the driver. Where the blocks would be as wide as the vocabulary, A'A itself is taken, exactly.
    An axis points to where its largest component is positive. Reduced rows have length one, or zero without terms.
    """
    k = max(1, min(k, width))
    if (k + beyond) * steps >= width:
        basis = np.eye(width)
    else:
        block, blocks = np.random.default_rng(seed).standard_normal((width, k + beyond)), []
        for _ in range(steps):
            block = np.linalg.qr(gram_times(rows, block))[0]
            blocks.append(block)
        basis = np.linalg.qr(np.hstack(blocks))[0]
    inner = basis.T @ gram_times(rows, basis)
    squares, turn = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(squares)[::-1][:k]
    axes = basis @ turn[:, order]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    shipped = rows.sparkSession.sparkContext.broadcast(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = shipped.value
        for batch in batches:
            for part in _bounded(batch):
                y = _dense(part, len(axes)) @ axes
                norm = np.linalg.norm(y, axis=1, keepdims=True)
                y = np.divide(y, norm, out=np.zeros_like(y), where=norm > 1e-12)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
                yield pa.record_batch([part.column(ident), vectors], names=[ident, "vector"])

    kind = rows.schema[ident].dataType.simpleString()
    return Reduced(np.sqrt(np.maximum(squares[order], 0)), axes, rows.mapInArrow(run, f"`{ident}` {kind}, vector array<double>"))


def reduce_texts(docs: DataFrame, ident: str, text: Column, terms: int = 3000, k: int = 60) -> tuple[DataFrame, Reduced]:
    """(term rows, their reduction): words and pairs, the most frequent ``terms``, k dimensions."""
    tokens = docs.select(ident, grams(text).alias("grams"))
    known = vocabulary(tokens, F.col("grams"), terms)
    rows = written(term_rows(tokens, ident, F.col("grams"), known), "terms")
    return rows, truncated_svd(rows, ident, known.count(), k)


# Many starts in one pass ----------------------------------------------------------------------------------------


@dataclass
class Start:
    """The best of several starts: its centres, its cost, and every start's cost."""

    centres: np.ndarray
    cost: float
    costs: np.ndarray


def _assign(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest, square distance) by row and start."""
    starts, k, dims = centres.shape
    flat = centres.reshape(-1, dims)
    d = (x * x).sum(1)[:, None] - 2 * x @ flat.T + (flat * flat).sum(1)
    d = d.reshape(len(x), starts, k)
    near = d.argmin(axis=2)
    return near, np.maximum(np.take_along_axis(d, near[:, :, None], 2)[:, :, 0], 0)


def kmeans_starts(df: DataFrame, ident: str, vector: Column, k: int, starts: int = 20, rounds: int = 30, tolerance: float = 1e-6, seed: int = 42) -> Start:
    """k-means from many starts at once: a round is one pass over the rows for all starts, with sums by start and cluster.

    Starts take k rows each that a hash of the id puts first. A start whose cost falls by less than the tolerance stays as it
    is; a cluster without rows keeps its centre. Only sums (starts * k rows) come to the driver.
    """
    x = df.select(F.col(ident).alias("id"), vector.cast("array<double>").alias("x")).where(F.col("x").isNotNull())
    first = x.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(starts * k).select("x").toArrow()["x"].to_pylist()
    if len(first) < k:
        raise ValueError(f"{k} clusters need as many rows")
    pool = np.array(first)
    rng = np.random.default_rng(seed)
    centres = np.stack([pool[rng.choice(len(pool), k, replace=False)] for _ in range(starts)])
    spark, costs = df.sparkSession, np.full(starts, np.inf)

    def step(live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shipped = spark.sparkContext.broadcast(centres[live])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shipped.value
            total, n, cost = np.zeros_like(c), np.zeros(c.shape[:2]), np.zeros(c.shape[:2])
            for batch in batches:
                for lo in range(0, batch.num_rows, 4096):
                    part = batch.column("x").slice(lo, 4096)
                    rows = part.flatten().to_numpy().reshape(len(part), -1)
                    near, far = _assign(rows, c)
                    for s in range(len(c)):
                        np.add.at(total[s], near[:, s], rows)
                        n[s] += np.bincount(near[:, s], minlength=c.shape[1])
                        cost[s] += np.bincount(near[:, s], far[:, s], c.shape[1])
            values = np.concatenate([total.reshape(-1, c.shape[2]), n.reshape(-1, 1), cost.reshape(-1, 1)], axis=1)
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))
            yield pa.record_batch([pa.array(np.arange(len(values)), pa.int32()), arrays], names=["at", "sums"])

        parts = x.select("x").mapInArrow(run, "at int, sums array<double>")
        got = parts.groupBy("at").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).orderBy("at").toArrow()
        values = np.array(got["sums"].to_pylist()).reshape(int(live.sum()), k, -1)
        shipped.unpersist()
        return values[:, :, :-2], values[:, :, -2], values[:, :, -1].sum(1)

    live = np.ones(starts, bool)
    for _ in range(rounds):
        total, n, cost = step(live)
        at = np.flatnonzero(live)
        gain = costs[at] - cost
        costs[at] = cost
        centres[at] = np.where(n[:, :, None] > 0, total / np.maximum(n, 1)[:, :, None], centres[at])
        live[at] = ~(gain <= tolerance * np.maximum(cost, 1e-300))
        if not live.any():
            break
    costs = step(np.ones(starts, bool))[2]
    best = int(np.argmin(costs))
    return Start(centres[best], float(costs[best]), costs)


def kmeans_assign(df: DataFrame, ident: str, vector: Column, centres: np.ndarray) -> DataFrame:
    """(ident, cluster) by the nearest centre."""
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    far = lambda c: F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    x = df.select(ident, vector.cast("array<double>").alias("x"))
    return x.select(ident, F.array_min(F.transform(table, lambda c, i: F.struct(far(c).alias("d"), i.alias("i"))))["i"].alias("cluster"))
