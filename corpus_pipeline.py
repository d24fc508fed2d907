"""From raw documents to training tokens: five stages, each an operator of sparrowmill.llm.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns of documents; the last adds n_tokens, tokens (ids, four bytes each, little endian) and the digest of what they
decode to.

Defined cases are those of the operators: an empty table goes through as an empty table; null and empty texts leave at the
quality rules; very long texts are judged, compared and encoded whole; of repeated rows and of ties between copies the one
of the smallest id stays; input columns that clash with names of an operator pass through under their own names. What a
stage wrote is deleted once the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.llm import bpe, minhash, mixing, pairwise, weak_rules
from sparrowmill.llm.common import Scratch, fresh, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise classifier takes for good."""
    score, predicted = fresh(docs, "score", "predicted")
    judged = pairwise.classify(docs, table(spark, sf_dir, "labels"))
    return judged.where(F.col(predicted) == 1).drop(score, predicted)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are probably good by the weighed rules."""
    (kept,) = fresh(docs, "kept")
    return weak_rules.judge(docs).where(F.col(kept)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    *_, copies = fresh(docs, "size", "source_size", "target", "copies")
    return mixing.emit(mixing.mix(docs), copies, docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their tokens, and the SHA-256 of the bytes these decode to."""
    out = bpe.tokenize(docs, bpe.public_merges())
    (digest,) = fresh(out, "decoded_sha256")
    return out.withColumn(digest, F.sha2(out.columns[-1], 256)).drop(out.columns[-1])


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: Training a classifier and replaying merges are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.let_go(before)
    return STAGES[-1][1](spark, docs, sf_dir)
