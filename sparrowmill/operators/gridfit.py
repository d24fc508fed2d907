"""Fits of many models at once: a table of (method, k, seed) dealt to tasks, a row of measures for each fit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clustering

#: Rows that a fit is made on; more are drawn from by a hash of the id, which is what the parameter ``most`` is for.
SAMPLE = 1500
METHODS = ("kmeans", "pam", "linkage", "lca")
FIT = "fit string, method string, k int, seed int, silhouette double, davies_bouldin double, calinski_harabasz double, bic double, smallest int, largest_share double, viable boolean, jaccard double, strength double"


def sample(df: DataFrame, ident: str, vector: Column, most: int = SAMPLE) -> tuple[list, np.ndarray]:
    """(ids, matrix) of at most ``most`` rows, those that a hash of the id puts first: a stated bound, alike at every size."""
    rows = df.select(F.col(ident).alias("id"), vector.cast("array<double>").alias("x")).where(F.col("x").isNotNull())
    got = rows.orderBy(F.xxhash64("id"), "id").limit(most).toArrow()
    return got["id"].to_pylist(), np.array(got["x"].to_pylist(), float).reshape(len(got), -1)


def lloyd(x: np.ndarray, k: int, seed: int, rounds: int = 100) -> np.ndarray:
    """k-means on a small matrix from rows far from each other with chances by their square distance."""
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    for _ in range(1, k):
        d = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
        centres.append(x[rng.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[rng.integers(len(x))])
    c, labels = np.stack(centres), None
    for _ in range(rounds):
        new = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        if labels is not None and (new == labels).all():
            break
        labels = new
        c = np.stack([x[labels == j].mean(0) if (labels == j).any() else c[j] for j in range(k)])
    return labels


def levels(x: np.ndarray, dims: int = 6) -> np.ndarray:
    """Quarters of the leading principal coordinates, for methods on categories."""
    centred = x - x.mean(0)
    y = centred @ np.linalg.svd(centred, full_matrices=False)[2][:dims].T
    return (y[:, None, :] > np.quantile(y, [0.25, 0.5, 0.75], axis=0)[None]).sum(1)


def distances(x: np.ndarray) -> np.ndarray:
    """One less the cosine of each two rows; a row of zeros is at one from all others."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    d = np.maximum(1 - u @ u.T, 0)
    np.fill_diagonal(d, 0)
    return d


def labels_of(method: str, x: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, float | None]:
    """(labels, bic or None) of one fit."""
    if method == "kmeans":
        return lloyd(x, k, seed), None
    if method == "pam":
        return clustering.pam(distances(x), k)[0], None
    if method == "linkage":
        return clustering.average_linkage(distances(x), k), None
    if method == "lca":
        y = levels(x)
        m = clustering.LatentClasses(k, starts=6, rounds=80, seed=seed).fit(y)
        return m.predict(y), m.bic
    raise ValueError(f"no method {method}")


def measured(method: str, k: int, seed: int, x: np.ndarray, groups: np.ndarray) -> dict:
    """One fit's measures, its stability over shares of the groups, and its strength over folds of them."""
    labels, bic = labels_of(method, x, k, seed)
    sizes = np.unique(labels, return_counts=True)[1]
    split = len(sizes) > 1
    fit = lambda part: labels_of(method, part, k, seed)[0]
    stable = clustering.resampled_stability(x, groups, fit, rounds=4, seed=seed)
    folds = clustering.grouped_folds(groups, 3)
    strengths = []
    for f in range(3):
        own, rest = x[folds == f], x[folds != f]
        if len(own) > k and len(rest) > k:
            other = fit(rest)
            centres = np.stack([rest[other == c].mean(0) for c in np.unique(other)])
            assigned = ((own[:, None] - centres[None]) ** 2).sum(2).argmin(1)
            strengths.append(clustering.prediction_strength(assigned, fit(own)))
    return {
        "fit": f"{method}-{k}-{seed}", "method": method, "k": k, "seed": seed,
        "silhouette": clustering.silhouette(distances(x), labels) if split else None,
        "davies_bouldin": clustering.davies_bouldin(x, labels) if split else None,
        "calinski_harabasz": clustering.calinski_harabasz(x, labels) if split else None,
        "bic": bic, "smallest": int(sizes.min()), "largest_share": float(sizes.max() / len(x)),
        "viable": bool(split and sizes.min() >= max(5, np.ceil(0.01 * len(x))) and sizes.max() <= 0.75 * len(x)),
        "jaccard": stable["jaccard"], "strength": float(np.mean(strengths)) if strengths else None,
    }


def fit_grid(spark: SparkSession, x: np.ndarray, groups: np.ndarray, grid: list[tuple[str, int, int]]) -> DataFrame:
    """A row of measures for each (method, k, seed); a task for each, the sample sent once to every executor."""
    shipped = spark.sparkContext.broadcast((x, groups))
    names = [c.split(" ")[0] for c in FIT.split(", ")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [measured(r.method, int(r.k), int(r.seed), *shipped.value) for r in part.itertuples()]
            yield pd.DataFrame(rows, columns=names)

    todo = spark.createDataFrame([(k, *g) for k, g in enumerate(grid)], "at int, method string, k int, seed int")
    return todo.repartitionByRange(len(grid), "at").select("method", "k", "seed").mapInPandas(run, FIT)


def weight_sensitivity(blocks: list[np.ndarray], weights: list[tuple[float, ...]], k: int, seed: int = 42) -> list[tuple[tuple[float, ...], float]]:
    """(weights, agreement) of clusterings of blocks of columns, each weighed: the adjusted Rand index with the first."""
    found = [lloyd(np.hstack([b * w for b, w in zip(blocks, ws, strict=True)]), k, seed) for ws in weights]
    return [(ws, clustering.rand_index(found[0], other)) for ws, other in zip(weights, found, strict=True)]
