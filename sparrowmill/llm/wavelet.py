r"""Ranked lexical search over dual-sorted wavelet trees, one for each shard of documents.

Terms are ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+`` with A-Z lower-cased. A shard is a run of documents of one input
partition, about GATHER bytes of text, numbered by their ids. Its postings stand in one sequence: term after term, and
within a term by falling impact. A pointerless wavelet tree over the documents' numbers keeps that sequence navigable by
document: at each node (a range of numbers) a term's postings are still one stretch, still by falling impact, so the
first of them bounds all that the term can give in the node's subtree.

A search starts at the root with all the item's terms and expands the nodes of highest bound first, a batch at a time. A
leaf's bound is its exact score. Nodes that can't reach the k-th best score found so far, in this shard or an earlier one
of the task, are dropped; the rest is expanded until none is left, so the k best are exact, ties included.

A score is the sum over an item's terms of w * impact; impact = 10^9 tf div (1000 tf + 8 m), m = 10 + (90 n N) div L and
w = floor(1000 ln((2N + 2) / (2 df + 1))) with N documents that have terms, L terms in all, n terms of the document, df
documents of the term. Items are packed into blocks of at most BLOCK bytes or ITEMS items; each block is sent to all
tasks and walks over all shards.

Defined cases: null texts have no terms and aren't counted; very long texts are a shard of their own; repeated rows are
documents of their own; equal scores rank by id, null first; rows of items with one id are one item with the terms of
all; an item without known terms, or a table without terms, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, looked_up, table, written
from .terms import GATHER, count, gathered, split, stops

STOP = stops((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: Bytes and items of a block of items; nodes expanded at a time.
BLOCK, ITEMS, BEAM = 8 << 20, 4096, 128


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        n = count(batch.column(0), STOP)
        docs += int(np.count_nonzero(n))
        terms += int(n.sum())
    yield pa.record_batch([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], names=["docs", "terms"])


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    m = 10 + 90 * n * docs // max(terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def depth(docs: int) -> int:
    return max(1, int(docs - 1).bit_length())


def planes(sequence: np.ndarray, levels: int) -> list[bytes]:
    """The bits of a wavelet tree, highest first; after each level zeros go before ones, in order."""
    out = []
    for level in range(levels - 1, -1, -1):
        bit = (sequence >> level & 1).astype(bool)
        out.append(np.packbits(bit).tobytes())
        sequence = np.concatenate([sequence[~bit], sequence[bit]])
    return out


def _build(docs: int, all_terms: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", shard_bytes):
            batch = batch.take(pa.compute.sort_indices(batch.column("id"), null_placement="at_start"))
            t = split(batch.column("text"), STOP)
            if not len(t.codes):
                continue
            pairs, tf = np.unique(t.doc() * len(t.known) + t.codes, return_counts=True)
            doc, code = pairs // len(t.known), pairs % len(t.known)
            value = impacts(tf, np.diff(t.bounds)[doc], docs, all_terms)
            order = np.lexsort((doc, -value, code))
            df = np.bincount(code, minlength=len(t.known))
            row = {
                "lists": np.append(0, np.cumsum(df)).astype(np.int32).tobytes(),
                "doc_ids": batch.column("id"),
                "bits": planes(doc[order], depth(batch.num_rows)),
                "impacts": value[order].astype(np.int32).tobytes(),
                "terms": t.known.cast(pa.string()),
                "df": df.astype(np.int32),
            }
            kinds = {"lists": pa.binary(), "impacts": pa.binary(), "doc_ids": pa.list_(pa.int64()), "bits": pa.list_(pa.binary()), "terms": pa.list_(pa.string()), "df": pa.list_(pa.int32())}
            columns = []
            for name, kind in kinds.items():
                v = row[name]
                if isinstance(v, (pa.Array, np.ndarray)):
                    v = pa.array(v) if isinstance(v, np.ndarray) else v
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(kind.value_type)))
                else:
                    columns.append(pa.array([v], kind))
            yield pa.record_batch(columns, names=list(kinds))

    return run


INDEX = "lists binary, impacts binary, doc_ids array<long>, bits array<binary>, terms array<string>, df array<int>"


class Tree:
    """A shard, unpacked: counts of ones before each place of each level, and the impacts in each level's order."""

    def __init__(self, lists: bytes, impact: bytes, bits: list[bytes], terms: pa.Array) -> None:
        self.lists = np.frombuffer(lists, np.int32).astype(np.int64)
        value = np.frombuffer(impact, np.int32)
        self.levels, n = len(bits), len(value)
        self.ones = np.zeros((self.levels, n + 1), np.int32)
        self.impact = np.zeros((self.levels + 1, n + 1), np.int32)
        self.zeros = np.zeros(self.levels, np.int64)
        self.impact[0, :n] = value
        for k, packed in enumerate(bits):
            bit = np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)
            np.cumsum(bit, out=self.ones[k, 1:])
            self.zeros[k] = n - int(self.ones[k, n])
            value = np.concatenate([value[~bit], value[bit]])
            self.impact[k + 1, :n] = value
        self.terms = terms

    def find(self, wanted: pa.Array) -> np.ndarray:
        """Of each wanted term its number here, or -1."""
        return pa.compute.fill_null(pa.compute.index_in(wanted, self.terms), -1).to_numpy(zero_copy_only=False)


class Best:
    """The k best (score, doc id) of an item so far; lower ids, null first, win ties."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    @property
    def floor(self) -> int:
        """What a node must reach to matter."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        rows = [*self.rows, *zip(scores.tolist(), ids, strict=True)]
        self.rows = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or 0))[: self.k]


def search(tree: Tree, codes: np.ndarray, weights: np.ndarray, doc_ids: list, best: Best) -> None:
    """Adds to ``best`` what this shard has among the k best documents."""
    low, high = tree.lists[codes][None, :], tree.lists[codes + 1][None, :]
    level, doc = np.zeros(1, np.int64), np.zeros(1, np.int64)
    bound = (tree.impact[0, low] * weights).sum(1)
    while len(level):
        live = bound >= best.floor
        if not live.all():
            level, doc, bound, low, high = level[live], doc[live], bound[live], low[live], high[live]
        if not len(level):
            return
        rest = None
        if len(level) > BEAM:
            order = np.argpartition(-bound, BEAM)
            top, rest = order[:BEAM], order[BEAM:]
            kept = (level[rest], doc[rest], bound[rest], low[rest], high[rest])
            level, doc, bound, low, high = level[top], doc[top], bound[top], low[top], high[top]
        at = level[:, None]
        one_low, one_high = tree.ones[at, low].astype(np.int64), tree.ones[at, high].astype(np.int64)
        zeros = tree.zeros[level][:, None]
        low = np.concatenate([low - one_low, zeros + one_low])
        high = np.concatenate([high - one_high, zeros + one_high])
        level, doc = np.concatenate([level, level]) + 1, np.concatenate([doc * 2, doc * 2 + 1])
        there = low < high
        bound = (np.where(there, tree.impact[level[:, None], low], 0) * weights).sum(1)
        live = bound >= best.floor
        leaf = live & (level == tree.levels)
        if leaf.any():
            best.add(bound[leaf], [doc_ids[k] for k in doc[leaf].tolist()])
        live &= level < tree.levels
        level, doc, bound, low, high = level[live], doc[live], bound[live], low[live], high[live]
        if rest is not None:
            level, doc, bound = (np.concatenate(p) for p in zip((level, doc, bound), kept[:3], strict=True))
            low, high = np.concatenate([low, kept[3]]), np.concatenate([high, kept[4]])


def _rank(shipped, k: int):
    """Of a block's items, the k best of the shards of this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, wanted, owner, weights = shipped.value
        wanted, best = pa.array(wanted, pa.string()), [Best(k) for _ in items]
        starts = np.searchsorted(owner, np.arange(len(items) + 1))
        for batch in batches:
            for row in range(batch.num_rows):
                bits = [x.as_py() for x in batch.column("bits")[row].values]
                lists, values = (batch.column(c)[row].as_py() for c in ("lists", "impacts"))
                tree = Tree(lists, values, bits, batch.column("terms")[row].values)
                codes, doc_ids = tree.find(wanted), batch.column("doc_ids")[row].as_py()
                for i in range(len(items)):
                    own = codes[starts[i] : starts[i + 1]]
                    here = own >= 0
                    if here.any():
                        search(tree, own[here].astype(np.int64), weights[starts[i] : starts[i + 1]][here], doc_ids, best[i])
        rows = [(item, doc, score) for item, b in zip(items, best, strict=True) for score, doc in b.rows]
        cols = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["item_id", "doc_id", "score"])

    return run


class Index:
    """Shards with their trees, as a table; N documents and L terms."""

    def __init__(self, shards: DataFrame, docs: int, terms: int) -> None:
        self.shards, self.docs, self.terms = shards, docs, terms


def build(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = GATHER) -> Index:
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sums = bounded(slim.select("text")).mapInArrow(_lengths, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    many, terms = sums[0] or 0, sums[1] or 0
    return Index(written(bounded(slim).mapInArrow(_build(many, terms, shard_bytes), INDEX), "wavelet"), many, terms)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches, "text"):
        t = split(batch.column("text"), STOP)
        pairs = np.unique(t.doc() * max(len(t.known), 1) + t.codes)
        doc, code = pairs // max(len(t.known), 1), pairs % max(len(t.known), 1)
        terms = t.known.cast(pa.string()).take(pa.array(code))
        yield pa.record_batch([batch.column("item_id").take(pa.array(doc)), terms], names=["item_id", "term"])


def top(index: Index, items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents."""
    spark = items.sparkSession
    slim = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    asked = written(bounded(slim).mapInArrow(_item_terms, "item_id long, term string").distinct(), "asked")
    held = index.shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    df = looked_up(held, asked.select("term").distinct(), ["term"]).groupBy("term").agg(F.sum("df").cast("long").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(index.docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = asked.join(df.withColumn("w", weight).where("w > 0"), "term")
    packed = weighed.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("terms"), F.sum(F.octet_length("term") + 16).alias("bytes"))
    # Blocks by the hash of the id: their number follows the items' bytes, and only one at a time is on the driver.
    packed = written(packed, "items")
    total = packed.agg(F.count("*"), F.sum("bytes")).first()
    blocks = max(1, -(-total[0] // ITEMS), -(-(total[1] or 0) // BLOCK))
    found = None
    for b in range(blocks):
        rows = packed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).select("item_id", "terms").collect()
        terms = [t.term for r in rows for t in r.terms]
        owner = np.repeat(np.arange(len(rows)), [len(r.terms) for r in rows])
        weights = np.array([t.w for r in rows for t in r.terms], np.int64)
        shipped = spark.sparkContext.broadcast(([r.item_id for r in rows], terms, owner, weights))
        part = index.shards.drop("df").mapInArrow(_rank(shipped, k), "item_id long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
a AS (SELECT count(*) AS docs, sum(len(ws)) AS terms FROM d WHERE len(ws) > 0),
tf AS (SELECT r, doc_id, len(ws) AS n, w, count(*) AS tf FROM (SELECT r, doc_id, ws, unnest(ws) AS w FROM d) GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
s AS (
    SELECT item_id, r, doc_id,
        sum(CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
            * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS score
    FROM i JOIN tf USING (w) JOIN df USING (w), a GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 10
"""
