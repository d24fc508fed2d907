r"""Quality classifier by Bradley-Terry pairwise ranking.

A document's worth is a linear score of features of its text. It is learnt from preference pairs, a better with a worse
labelled document: the logistic loss of ``w . (x_better - x_worse)``, with a ridge, by Newton steps. Pairs match each
document with ``PARTNERS`` of the other class, dealt by a fixed stride, so they grow with the sample and not with its
square. The threshold is the quantile of training scores that leaves as many documents below as are labelled bad, and a
score is the logistic of the distance to it, in units that fit the labels; so 0.5 stands at the threshold.

Features are shares of kinds of bytes, lengths and repeats; each of these bends at quantiles of the sample, since quality
falls off at a level rather than evenly. Words and pairs of bytes, hashed into buckets, add what no such fact tells. They
are computed in numpy from whole texts, with no labels, language, source or id among them. Labels are read from at most
SAMPLE documents outside the held-out fold, chosen by a hash of the id: the one bound there is.

Defined cases: a null or blank text has the features of an empty one and a score; labels that disagree count as good if
most are; a document without labels, or a sample of one class only, gives scores of 0.5; an empty table gives no rows;
repeated rows and equal texts have equal scores. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, fresh, table
from .textbatch import U, Texts, join, slices

SAMPLE, PARTNERS, RIDGE, FOLDS, HELD_OUT = 20_000, 4, 1e-3, 3, 1
#: Buckets of hashed words and of hashed pairs of bytes, and the quantiles of the sample where facts bend.
WORDS, PAIRS, BENDS = 16, 16, (0.5, 0.9, 0.98)
#: Pairs of documents worked on at a time.
AT_ONCE = 8192
#: Byte classes that facts count.
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_HIGH = np.zeros(256, bool)
_HIGH[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 44, 46, 58, 59, 63]] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True
_MARK = ~(_UPPER | _LOWER | _HIGH | _DIGIT | _STOP)
_MARK[[9, 10, 11, 12, 13, 32]] = False
_SHOUT = np.zeros(256, bool)
_SHOUT[33] = True
KINDS = (_UPPER, _LOWER, _HIGH, _DIGIT, _STOP, _LINE, _MARK, _SHOUT)


def _count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def features(t: Texts) -> np.ndarray:
    """A row for each text: FACTS facts, then shares of buckets."""
    n = len(t)
    size = np.maximum(np.diff(t.offsets), 1).astype(float)
    words = np.diff(t.bounds).astype(float)
    some = np.maximum(words, 1)
    upper, lower, high, digit, stop, line, mark, shout = (_count(k[t.buf], t.offsets) for k in KINDS)
    letters = np.maximum(upper + lower + high, 1)
    h = t.hashes()
    doc = np.repeat(np.arange(n, dtype=U), np.diff(t.bounds))

    new_words = _distinct(h, doc, n)
    same = doc[2:] == doc[:-2] if len(doc) > 2 else np.zeros(0, bool)
    grams = join(h[:-2], h[1:-1], h[2:])[same] if len(doc) > 2 else h[:0]
    n_grams = np.bincount(doc[2:][same].astype(np.int64), minlength=n).astype(float) if len(doc) > 2 else np.zeros(n)
    new_grams = _distinct(grams, doc[2:][same], n) if len(doc) > 2 else np.zeros(n)
    repeat = 1 - new_grams / np.maximum(n_grams, 1)
    repeat[n_grams == 0] = 0
    length = _count(t.buf != 32, t.offsets) / some
    facts = [
        upper / letters, mark / size, shout / some, digit / size, stop / some, repeat, new_words / some,
        np.log1p(words), np.log1p(line), high / size, line / some, length,
    ]
    in_words = _shares((h % U(WORDS)).astype(np.int64), doc.astype(np.int64), n, WORDS)
    pair = _BUCKET[t.buf[:-1].astype(np.uint16) << 8 | t.buf[1:]]
    spans = zip(t.offsets[:-1].tolist(), t.offsets[1:].tolist(), strict=True)
    in_pairs = np.array([np.bincount(pair[a : max(b - 1, a)], minlength=PAIRS) for a, b in spans], float).reshape(n, PAIRS)
    in_pairs /= np.maximum(in_pairs.sum(axis=1, keepdims=True), 1)
    return np.column_stack([*facts, in_words, in_pairs])


FACTS = 12
#: The bucket of each pair of bytes.
_BUCKET = (np.arange(1 << 16, dtype=U) * U(0x9E3779B97F4A7C15) >> U(40)).astype(np.int64) % PAIRS


def _shares(bucket: np.ndarray, doc: np.ndarray, n: int, many: int) -> np.ndarray:
    out = np.bincount(doc * many + bucket, minlength=n * many).reshape(n, many).astype(float)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def _distinct(x: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    _, at = np.unique(join(doc, x), return_index=True)
    return np.bincount(doc[at].astype(np.int64), minlength=n).astype(float)


def all_features(texts: pa.Array) -> np.ndarray:
    parts = [features(t) for _, _, t in slices(texts)]
    return np.concatenate(parts) if parts else features(Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64)))


class Ranker:
    """Where facts bend, weights over scaled features, the threshold and the unit of scores."""

    def __init__(self, bends, mean, scale, weights, threshold: float, unit: float) -> None:
        self.bends, self.mean, self.scale, self.weights, self.threshold, self.unit = bends, mean, scale, weights, threshold, unit

    def worth(self, x: np.ndarray) -> np.ndarray:
        return scaled(bent(x, self.bends), self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.worth(x) - self.threshold) / self.unit, -30, 30)))


def bent(x: np.ndarray, bends: np.ndarray) -> np.ndarray:
    """Features, and for each fact what it has above each of its bends."""
    facts = x[:, :FACTS]
    return np.column_stack([x, *[np.maximum(facts - b, 0) for b in bends]])


def scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def pairs_of(good: np.ndarray, bad: np.ndarray, partners: int) -> tuple[np.ndarray, np.ndarray]:
    """(better, worse): each document of the larger class with partners of the other; turns move so that all take part."""
    many, few = (good, bad) if len(good) >= len(bad) else (bad, good)
    k = np.arange(len(many) * partners)
    i, j = np.repeat(many, partners), few[(k + k // len(few)) % len(few)]
    return (i, j) if many is good else (j, i)


def newton(z: np.ndarray, better: np.ndarray, worse: np.ndarray, ridge: float, rounds: int, enough: float = 1e-4) -> np.ndarray:
    """Weights of least mean logistic loss over pairs, with a ridge; some pairs at a time, so memory does not grow with them."""
    width, n = z.shape[1], len(better)
    w = np.zeros(width)
    for _ in range(rounds):
        gradient, curve = -ridge * w, ridge * np.eye(width)
        for lo in range(0, n, AT_ONCE):
            diff = z[better[lo : lo + AT_ONCE]] - z[worse[lo : lo + AT_ONCE]]
            p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
            gradient = gradient + diff.T @ (1 - p) / n
            curve = curve + (diff * (p * (1 - p))[:, None]).T @ diff / n
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < enough:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, partners: int = PARTNERS, ridge: float = RIDGE, rounds: int = 25) -> Ranker:
    """Learns from features and labels 0 or 1; without both labels all documents are worth the same."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        width = x.shape[1] + FACTS * len(BENDS)
        return Ranker(np.zeros((len(BENDS), FACTS)), np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    bends = np.quantile(x[:, :FACTS], BENDS, axis=0)
    x = bent(x, bends)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1
    z = scaled(x, mean, scale)
    w = newton(z, *pairs_of(good, bad, partners), ridge, rounds)
    s = z @ w
    # The threshold stands midway in the gap at the quantile.
    rank = np.sort(s)
    cut = min(max(len(bad), 1), len(rank) - 1)
    threshold = (rank[cut - 1] + rank[cut]) / 2
    unit = max(float(np.abs(s - threshold).mean()) / 3, 1e-9)
    return Ranker(bends, mean, scale, w, float(threshold), unit)


def _map_features(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = all_features(batch.column(0))
            yield pa.record_batch([pa.array(list(x), pa.list_(pa.float64())), *batch.columns[1:]], names=names)

    return run


def _map_scores(model: Ranker, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                s = model.score(all_features(part.column(0)))
                yield pa.record_batch([pa.array(s, pa.float64()), *part.columns[1:]], names=names)

    return run


def held_out(id_col: str, folds: int = FOLDS, fold: int = HELD_OUT):
    """Whether a document's labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def train(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, sample: int) -> Ranker:
    """Fits on the ``sample`` labelled documents of the learning folds that come first by a hash of their id."""
    judged = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    judged = judged.groupBy(F.col(id_col).alias("lid")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    chosen = judged.orderBy(F.xxhash64("lid"), "lid").limit(sample)
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    known = texts.join(F.broadcast(chosen), F.col("id") == F.col("lid")).select("text", "y")
    rows = bounded(known).mapInArrow(_map_features(["x", "y"]), "x array<double>, y int")
    # At most the sample's documents, a few hundred bytes each; repeated ids count once, and of more the first by hash stay.
    got = rows.distinct().orderBy(F.xxhash64("x", "y")).limit(sample).toArrow()
    if not len(got):
        return fit(np.zeros((0, features(Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))).shape[1])), np.zeros(0))
    x = np.array(got["x"].to_pylist())
    y = np.array(got["y"].to_pylist())
    order = np.lexsort((y, *x.T))
    return fit(x[order], y[order])


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> DataFrame:
    """All documents with score and predicted (named afresh on a clash)."""
    score, predicted = fresh(docs, "score", "predicted")
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, sample=sample)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    rows = docs.select(F.col(text_col), *[F.col(c) for c in docs.columns])
    out = bounded(rows).mapInArrow(_map_scores(model, [score, *docs.columns]), f"`{score}` double, {fields}")
    return out.select(*docs.columns, score).withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = classify(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
