"""Clustering of small tables, and measures of how good and how stable it is.

Methods that need all distances (medoids, linkage, scaling) check the number of rows first and fail above ``MAX_ROWS``;
the others are aggregates over any number of rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 4000


def matrix(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Columns of a small table on the driver, ordered by all of them; refuses more than MAX_ROWS rows."""
    rows = df.select(*columns).limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} rows; take representatives first")
    return np.array(sorted([tuple(r) for r in rows]), dtype=float).reshape(len(rows), len(columns))


# Measures on tables of any size ---------------------------------------------------------------------------------


def contingency(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """(ari, nmi, n): how two labellings agree, from one table of counts."""
    n = df.select(a.alias("a"), b.alias("b")).groupBy("a", "b").agg(F.count("*").cast("double").alias("n"))
    rows = n.groupBy("a").agg(F.sum("n").alias("s"))
    cols = n.groupBy("b").agg(F.sum("n").alias("s"))
    pairs = lambda c: c * (c - 1) / 2
    entropy_part = lambda c: F.sum(c * F.log(c))
    one = n.agg(F.sum(pairs(F.col("n"))).alias("s"), F.sum("n").alias("n"), entropy_part(F.col("n")).alias("h"))
    ra = rows.agg(F.sum(pairs(F.col("s"))).alias("sa"), entropy_part(F.col("s")).alias("ha"))
    cb = cols.agg(F.sum(pairs(F.col("s"))).alias("sb"), entropy_part(F.col("s")).alias("hb"))
    k = lambda df_: df_.withColumn("k", F.lit(1))
    x = k(one).join(k(ra), "k").join(k(cb), "k")
    total = pairs(F.col("n"))
    expected = F.col("sa") * F.col("sb") / total
    most = (F.col("sa") + F.col("sb")) / 2
    ari = F.when(most - expected == 0, 1.0).otherwise((F.col("s") - expected) / (most - expected))
    log_n = F.log("n")
    hu, hv = log_n - F.col("ha") / F.col("n"), log_n - F.col("hb") / F.col("n")
    mi = log_n + (F.col("h") - F.col("ha") - F.col("hb")) / F.col("n")
    nmi = F.when(hu + hv == 0, 1.0).otherwise(mi / ((hu + hv) / 2))
    return x.select(F.round(ari, 9).alias("ari"), F.round(nmi, 9).alias("nmi"), F.col("n").cast("long").alias("n"))


def viability(df: DataFrame, cluster: str) -> DataFrame:
    """(n_clusters, smallest, largest share, viable): no cluster tiny, none nearly everything."""
    sizes = df.groupBy(cluster).agg(F.count("*").alias("n"))
    total = F.sum("n")
    ok = (F.min("n") >= F.greatest(F.lit(5), F.ceil(0.01 * total))) & (F.max("n") / total <= 0.75)
    return sizes.agg(
        F.count("*").alias("n_clusters"), F.min("n").alias("smallest"), F.round(F.max("n") / total, 9).alias("largest_share"), ok.alias("viable")
    )


def quantile_levels(df: DataFrame, value: str, quarters: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows with the level of a value: one more than the quantiles it reaches; missing or single where there are none."""
    cuts = df.agg(F.percentile(value, F.array(*[F.lit(q) for q in quarters])).alias("cuts"))
    spread = df.agg((F.min(value) == F.max(value)).alias("single"))
    x = df.withColumn("_k", F.lit(1)).join(F.broadcast(cuts.withColumn("_k", F.lit(1))), "_k").join(F.broadcast(spread.withColumn("_k", F.lit(1))), "_k")
    above = F.size(F.filter("cuts", lambda c: c <= F.col(value))) + 1
    level = F.when(F.col(value).isNull(), "missing").when(F.col("single"), "single").otherwise(above.cast("string"))
    return x.withColumn("level", level).drop("_k", "cuts", "single")


def centroid_labels(df: DataFrame, vector: str, label: str, ident: str) -> DataFrame:
    """(ident, label, nearest): each row's nearest mean vector of a label; labels are few."""
    parts = df.select(label, F.posexplode(vector).alias("i", "x"))
    means = parts.groupBy(label, "i").agg(F.avg("x").alias("m"))
    centres = means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    every = centres.agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("l"), "c"))).alias("all")).withColumn("_k", F.lit(1))
    x = df.withColumn("_k", F.lit(1)).join(F.broadcast(every), "_k")
    gap = lambda c: F.aggregate(F.zip_with(vector, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    best = F.array_min(F.transform("all", lambda e: F.struct(F.round(gap(e["c"]), 6).alias("d"), e["l"].alias("l"))))
    return x.select(ident, label, best["l"].alias("nearest"))


# Methods on small tables ----------------------------------------------------------------------------------------


def gower_matrix(numbers: np.ndarray, categories: np.ndarray) -> np.ndarray:
    """Distances of all rows: NaN numbers are left out, categories differ or not."""
    n = len(numbers) if numbers.size else len(categories)
    total, valid = np.zeros((n, n)), np.zeros((n, n))
    for j in range(numbers.shape[1] if numbers.size else 0):
        x = numbers[:, j]
        span = np.nanmax(x) - np.nanmin(x) if np.isfinite(x).any() else 0.0
        d = np.abs(x[:, None] - x[None, :]) / (span if span > 0 else 1.0)
        known = np.isfinite(d)
        total += np.where(known, d, 0)
        valid += known
    for j in range(categories.shape[1] if categories.size else 0):
        x = categories[:, j]
        total += x[:, None] != x[None, :]
        valid += 1
    out = total / np.maximum(valid, 1)
    np.fill_diagonal(out, 0)
    return out


def pam(d: np.ndarray, k: int, weights: np.ndarray | None = None, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(labels, medoids) on a distance matrix: the weighted median first, then the farthest, then in turns until fixed."""
    w = np.ones(len(d)) if weights is None else weights
    medoids = [int(np.argmin(d @ w))]
    while len(medoids) < min(k, len(d)):
        gap = d[:, medoids].min(axis=1)
        gap[medoids] = -1
        medoids.append(int(np.argmax(gap)))
    medoids = np.array(medoids)
    labels = np.argmin(d[:, medoids], axis=1)
    for _ in range(rounds):
        new = medoids.copy()
        for c in range(len(medoids)):
            own = np.flatnonzero(labels == c)
            if len(own):
                new[c] = own[np.argmin(d[np.ix_(own, own)] @ w[own])]
            else:
                gap = d[:, new].min(axis=1)
                gap[new] = -1
                new[c] = int(np.argmax(gap))
        moved = np.argmin(d[:, new], axis=1)
        if (new == medoids).all() and (moved == labels).all():
            break
        medoids, labels = new, moved
    return labels, medoids


def average_linkage(d: np.ndarray, k: int) -> np.ndarray:
    """Labels of an average-link tree cut into k clusters, numbered by first member."""
    n = len(d)
    d = d.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size, alive, member = np.ones(n), np.ones(n, bool), np.arange(n)
    for _ in range(n - min(k, n)):
        i, j = np.unravel_index(np.argmin(d), d.shape)
        i, j = min(i, j), max(i, j)
        merged = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        merged[[i, j]] = np.inf
        d[i], d[:, i] = merged, merged
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        alive[j] = False
        member[member == j] = i
    return np.unique(member, return_inverse=True)[1]


def classical_mds(d: np.ndarray, dims: int = 20) -> np.ndarray:
    """Coordinates whose distances are near the given ones."""
    n = len(d)
    centre = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(-0.5 * centre @ (d * d) @ centre)
    order = np.argsort(values)[::-1][: min(dims, n)]
    return vectors[:, order] * np.sqrt(np.maximum(values[order], 0))


def silhouette(d: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """Mean of (b - a) / max(a, b); a cluster of one scores 0."""
    w = np.ones(len(d)) if weights is None else weights
    kinds, labels = np.unique(labels, return_inverse=True)
    sums = np.stack([d[:, labels == c].sum(axis=1) for c in range(len(kinds))], axis=1)
    sizes = np.bincount(labels)
    own = sizes[labels]
    a = sums[np.arange(len(d)), labels] / np.maximum(own - 1, 1)
    means = sums / sizes
    means[np.arange(len(d)), labels] = np.inf
    b = means.min(axis=1)
    s = np.where((own > 1) & np.isfinite(b), (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0)
    return float((s * w).sum() / w.sum())


def davies_bouldin(x: np.ndarray, labels: np.ndarray) -> float:
    kinds = np.unique(labels)
    centres = np.stack([x[labels == c].mean(axis=0) for c in kinds])
    spread = np.array([np.linalg.norm(x[labels == c] - m, axis=1).mean() for c, m in zip(kinds, centres, strict=True)])
    gap = np.linalg.norm(centres[:, None] - centres[None, :], axis=2)
    np.fill_diagonal(gap, np.inf)
    return float(((spread[:, None] + spread[None, :]) / gap).max(axis=1).mean())


def calinski_harabasz(x: np.ndarray, labels: np.ndarray) -> float:
    kinds, mean = np.unique(labels), x.mean(axis=0)
    between = sum((labels == c).sum() * ((x[labels == c].mean(axis=0) - mean) ** 2).sum() for c in kinds)
    within = sum(((x[labels == c] - x[labels == c].mean(axis=0)) ** 2).sum() for c in kinds)
    return float((between / (len(kinds) - 1)) / (within / (len(x) - len(kinds))))


class LatentClasses:
    """A mixture of independent categorical columns, by expectation-maximisation over weighted distinct rows."""

    def __init__(self, k: int, alpha: float = 0.5, rounds: int = 180, tolerance: float = 1e-6, starts: int = 6, seed: int = 42) -> None:
        self.k, self.alpha, self.rounds, self.tolerance, self.starts, self.seed = k, alpha, rounds, tolerance, starts, seed

    def _log_joint(self, x: np.ndarray) -> np.ndarray:
        out = np.log(self.prior)[None, :].repeat(len(x), axis=0)
        for j, p in enumerate(self.levels):
            out = out + np.log(p[x[:, j]])
        return out

    def _maximise(self, x: np.ndarray, w: np.ndarray, r: np.ndarray) -> None:
        wr = w[:, None] * r
        self.prior = (wr.sum(axis=0) + self.alpha) / (w.sum() + self.alpha * self.k)
        self.levels = []
        for j in range(x.shape[1]):
            p = np.zeros((self.sizes[j], self.k))
            np.add.at(p, x[:, j], wr)
            self.levels.append((p + self.alpha) / (p.sum(axis=0) + self.alpha * self.sizes[j]))

    def fit(self, x: np.ndarray, w: np.ndarray | None = None) -> LatentClasses:
        """x: level numbers; rows may be distinct ones with weights."""
        w = np.ones(len(x)) if w is None else w
        self.sizes, best = x.max(axis=0) + 1, None
        for s in range(self.starts):
            r = np.random.default_rng(self.seed + s).dirichlet(np.ones(self.k), len(x))
            before = -np.inf
            for _ in range(self.rounds):
                self._maximise(x, w, r)
                log = self._log_joint(x)
                top = log.max(axis=1, keepdims=True)
                norm = top[:, 0] + np.log(np.exp(log - top).sum(axis=1))
                r = np.exp(log - norm[:, None])
                now = float((w * norm).sum())
                if now - before < self.tolerance:
                    break
                before = now
            if best is None or now > best[0]:
                best = now, self.prior, self.levels, r
        self.likelihood, self.prior, self.levels, self.share = best
        n, self.parameters = w.sum(), (self.k - 1) + self.k * int((self.sizes - 1).sum())
        self.bic = -2 * self.likelihood + self.parameters * math.log(n)
        self.aic = -2 * self.likelihood + 2 * self.parameters
        mass = -(w[:, None] * self.share * np.log(self.share + 1e-12)).sum() / n
        self.entropy = 1 - mass / math.log(self.k) if self.k > 1 else 1.0
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self._log_joint(x).argmax(axis=1)

    def sample(self, n: int, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        z = rng.choice(self.k, n, p=self.prior)
        return np.stack([np.array([rng.choice(len(p), p=p[:, c]) for c in z]) for p in self.levels], axis=1)


def rand_index(a: np.ndarray, b: np.ndarray) -> float:
    """Adjusted Rand index."""
    _, a = np.unique(a, return_inverse=True)
    _, b = np.unique(b, return_inverse=True)
    n = np.zeros((a.max() + 1, b.max() + 1))
    np.add.at(n, (a, b), 1)
    pairs = lambda c: (c * (c - 1) / 2).sum()
    s, x, y, total = pairs(n), pairs(n.sum(axis=1)), pairs(n.sum(axis=0)), pairs(np.array([len(a)], float))
    expected, most = x * y / total, (x + y) / 2
    return 1.0 if most == expected else float((s - expected) / (most - expected))


def best_jaccard(reference: np.ndarray, other: np.ndarray) -> float:
    """Mean over reference clusters of the best overlap with another clustering's."""
    out = []
    for c in np.unique(reference):
        own = reference == c
        out.append(max(float((own & (other == k)).sum() / (own | (other == k)).sum()) for k in np.unique(other)))
    return float(np.mean(out))


def resampled_stability(x: np.ndarray, groups: np.ndarray, fit, rounds: int = 16, share: float = 0.8, seed: int = 42) -> dict[str, float]:
    """Refits on a share of the groups, drawn without replacement, and compares with the fit on all rows."""
    whole, kinds = fit(x), np.unique(groups)
    ari, overlap = [], []
    for s in range(rounds):
        kept = np.random.default_rng(seed + s).permutation(kinds)[: int(share * len(kinds))]
        rows = np.isin(groups, kept)
        part = fit(x[rows])
        ari.append(rand_index(whole[rows], part))
        overlap.append(best_jaccard(whole[rows], part))
    return {"ari": float(np.mean(ari)), "jaccard": float(np.mean(overlap))}


def grouped_folds(groups: np.ndarray, k: int) -> np.ndarray:
    """A fold for each row; whole groups, the largest first into the emptiest fold."""
    kinds, where, sizes = np.unique(groups, return_inverse=True, return_counts=True)
    load, fold = np.zeros(k), np.zeros(len(kinds), int)
    for g in np.argsort(-sizes, kind="stable"):
        fold[g] = int(np.argmin(load))
        load[fold[g]] += sizes[g]
    return fold[where]


def prediction_strength(assigned: np.ndarray, independent: np.ndarray) -> float:
    """The least share, over assigned clusters of two or more, of pairs that an independent fit keeps together."""
    out = []
    for c in np.unique(assigned):
        own = independent[assigned == c]
        if len(own) > 1:
            sizes = np.unique(own, return_counts=True)[1]
            out.append((sizes * (sizes - 1)).sum() / (len(own) * (len(own) - 1)))
    return float(min(out, default=1.0))


def bootstrap_test(x: np.ndarray, k: int, rounds: int = 12, seed: int = 42) -> tuple[float, float]:
    """(likelihood ratio, p) of k against k + 1 latent classes, by refitting samples drawn from the smaller model."""
    null = LatentClasses(k, starts=2).fit(x)
    observed = 2 * (LatentClasses(k + 1, starts=2).fit(x).likelihood - null.likelihood)
    above = 0
    for s in range(rounds):
        y = null.sample(len(x), seed + s)
        ratio = 2 * (LatentClasses(k + 1, starts=2).fit(y).likelihood - LatentClasses(k, starts=2).fit(y).likelihood)
        above += ratio >= observed
    return observed, (1 + above) / (rounds + 1)
