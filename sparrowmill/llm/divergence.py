r"""Source divergence audit: two-dimensional group-block tiling over packed count vectors.

Documents are grouped by (lang, source). Terms are ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` with A-Z lower-cased; a language
keeps the terms of at least ``min_docs`` of its documents. With N the group's occurrences of kept terms and V the
language's kept terms, a term counted c times has p = 1 + floor(10^9 (c + 1) / (N + V)), and two groups differ by the sum
of floor((p - q)^2 / q) over all kept terms. Terms of a group stand out by the same measure against the language's p.

A language's groups are dealt to blocks of about BLOCK, its terms to chunks of about CHUNK by hash. The counts of a group
in a chunk are one packed row, sent to every tile (block by block) of its row and of its column; a tile walks over
successive chunks, holding two dense blocks of one chunk and its submatrix. SPAN chunks make a task, and tasks' submatrices
are added, so a large vocabulary spreads over the cluster. All arithmetic is in integers: fractions by steps of 1000,
exact for N + V below 9.2 * 10^15.

Defined cases: null text, lang and source count as ''; an empty text makes its group known and has no terms; very long
texts are counted whole, one at a time; repeated rows are documents of their own; ties rank by the item's UTF-8 bytes; a
language without kept terms has pairs of value 0 and no terms; one without a second source has no pairs; an empty table
gives no rows. Other columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, looked_up, table, written
from .terms import gathered, split, stops

STOP = stops((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
BLOCK, CHUNK, SPAN = 16, 2048, 16
SCALE = 1_000_000_000


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the texts gathered; a row without a term for each group."""
    names = ["lang", "source", "term", "n", "docs"]
    for batch in gathered(batches, "text"):
        langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        kinds, group = np.unique(group, return_inverse=True)
        t = split(batch.column("text"), STOP)
        doc, size = t.doc(), max(len(t.known), 1)
        pairs, n = np.unique(doc * size + t.codes, return_counts=True)
        key = group[pairs // size] * size + pairs % size
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        of = key[order][first]
        sums = np.add.reduceat(n[order], first) if len(first) else n
        docs = np.diff(np.append(first, len(order)))
        g = np.concatenate([kinds, kinds[of // size]])
        empty, zeros = pa.nulls(len(kinds), pa.large_string()), np.zeros(len(kinds), np.int64)
        columns = [
            langs.dictionary.take(pa.array(g // len(sources.dictionary))),
            sources.dictionary.take(pa.array(g % len(sources.dictionary))),
            pa.concat_arrays([empty, t.known.cast(pa.large_string()).take(pa.array(of % size))]),
            pa.array(np.concatenate([zeros, sums]), pa.int64()),
            pa.array(np.concatenate([zeros, docs]), pa.int64()),
        ]
        for lo in range(0, len(g), 1 << 16):
            part = [c[lo : lo + (1 << 16)] for c in columns]
            part[2] = part[2].cast(pa.string())
            yield pa.record_batch(part, names=names)


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 1) / total), by three steps of a thousand."""
    left, out = count + 1, F.lit(1).cast("long")
    for step in (1_000_000, 1_000, 1):
        left = left * 1000
        out = out + F.call_function("div", left, total) * step
        left = F.pmod(left, total)
    return out


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    left, out = counts + 1, np.ones_like(counts)
    for step in (1_000_000, 1_000, 1):
        left = left * 1000
        out += left // total * step
        left %= total
    return out


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _dense(rows: list[tuple], size: int) -> np.ndarray:
    counts = np.zeros((len(rows), size), np.int64)
    for k, (_, _, at, n) in enumerate(rows):
        if at is not None:
            counts[k, at] = n
    return _shares(counts, np.array([r[1] for r in rows], np.int64)[:, None])


def _submatrix(rows: list[tuple], columns: list[tuple], size: int) -> np.ndarray:
    out = np.zeros((len(rows), len(columns)), np.int64)
    if size:
        p, q = _dense(rows, size), _dense(columns, size)
        for k in range(len(rows)):
            d = p[k] - q
            out[k] = (d * d // q).sum(1)
    return out


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by tile, chunk, side and place; each tile's sums go out once its chunks of this span are through."""
    tile = chunk = total = None
    size = 0
    sides: tuple[list, list] = ([], [])

    def close() -> None:
        nonlocal total
        part = _submatrix(*sides, size)
        total = part if total is None else total + part

    def rows() -> pa.RecordBatch:
        of, to = ([r[0] for r in s] for s in sides)
        pairs = [(a, b, int(total[i, j])) for i, a in enumerate(of) for j, b in enumerate(to) if a != b]
        a, b, v = zip(*pairs, strict=True) if pairs else ((), (), ())
        cols = [pa.array([tile[0]] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(v, pa.int64())]
        return pa.record_batch(cols, names=["lang", "source", "item", "value"])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "bi", "bj", "span")), strict=True))
        more = list(zip(*(batch.column(c).to_pylist() for c in ("chunk", "side", "source", "total", "size")), strict=True))
        ats, ns = batch.column("ats"), batch.column("ns")
        for k, key in enumerate(keys):
            c, side, source, whole, wide = more[k]
            if tile is not None and (key, c) != (tile, chunk):
                close()
                if key != tile:
                    yield rows()
                    total = None
                sides = ([], [])
            tile, chunk, size = key, c, wide
            packed = (ats[k].values.to_numpy(), ns[k].values.to_numpy()) if ats[k].is_valid else (None, None)
            sides[side].append((source, whole, *packed))
    if tile is not None:
        close()
        yield rows()


def audit(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 3,
    top: int = 200,
) -> DataFrame:
    """(lang, source, part, item, value, rank): each other source of the language, and the terms that stand out."""
    slim = docs.select(
        F.col(text_col).alias("text"),
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
    )
    raw = bounded(slim).mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    counts = written(raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    known = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
    known = written(known.where(F.col("docs") >= min_docs).drop("docs"), "terms")
    langs = known.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("all_lang"))
    every = counts.where("term IS NULL").select("lang", "source")
    many = every.groupBy("lang").agg(F.count("*").alias("many"))
    langs = many.join(langs, "lang", "left").fillna(0)
    chunks = F.greatest(F.ceil(F.col("v") / CHUNK), F.lit(1)).cast("int")
    langs = written(langs.withColumn("chunks", chunks).withColumn("blocks", F.ceil(F.col("many") / BLOCK).cast("int")), "langs")

    spread = F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int")
    placed = looked_up(known, langs.select("lang", "chunks", (F.col("all_lang") + F.col("v")).alias("total_lang")), ["lang"])
    placed = placed.withColumn("chunk", spread)
    along = Window.partitionBy("lang", "chunk").orderBy("term")
    placed = placed.withColumn("at", F.row_number().over(along) - 1).drop("chunks")
    kept = written(counts.where("term IS NOT NULL").drop("docs").join(placed, ["lang", "term"]), "kept")
    sizes = kept.groupBy("lang", "chunk").agg((F.max("at") + 1).alias("size"))

    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = looked_up(every.join(sums, ["lang", "source"], "left").fillna(0), langs, ["lang"])
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    groups = written(groups.select("lang", "source", "blocks", "chunks", (F.col("n") + F.col("v")).alias("total"), block.alias("block")), "groups")

    # Terms
    judged = looked_up(kept, groups.select("lang", "source", "total"), ["lang", "source"])
    p, q = share(F.col("n"), F.col("total")), share(F.col("n_lang"), F.col("total_lang"))
    judged = judged.withColumn("p", p).withColumn("q", q).where("p > q")
    terms = judged.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # Pairs
    vectors = kept.groupBy("lang", "source", "chunk").agg(F.collect_list(F.struct("at", "n")).alias("packed"))
    slots = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    slots = slots.join(vectors, ["lang", "source", "chunk"], "left")
    slots = looked_up(slots, sizes, ["lang", "chunk"], "left").fillna(0, ["size"])
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiles = F.concat(
        F.transform(others, lambda x: F.struct(F.col("block").alias("bi"), x.alias("bj"), F.lit(0).alias("side"))),
        F.transform(others, lambda x: F.struct(x.alias("bi"), F.col("block").alias("bj"), F.lit(1).alias("side"))),
    )
    sent = slots.withColumn("tile", F.explode(tiles)).select(
        "lang", "tile.bi", "tile.bj", F.floor(F.col("chunk") / SPAN).cast("int").alias("span"), "chunk", "tile.side", "source",
        "total", "size", F.col("packed.at").alias("ats"), F.col("packed.n").alias("ns"),
    )
    key = ["lang", "bi", "bj", "span"]
    dealt = sent.repartition(*key).sortWithinPartitions(*key, "chunk", "side", "source")
    found = bounded(dealt).mapInArrow(_tiles, "lang string, source string, item string, value long")
    pairs = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


SQL = r"""
WITH base AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
    FROM documents),
tok AS (SELECT r, lang, source, unnest(ws) AS w FROM base),
c AS (SELECT lang, source, w, count(*) AS n FROM tok GROUP BY ALL),
kept AS (SELECT lang, w, count(*) AS n FROM tok GROUP BY ALL HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM base),
ls AS (SELECT lang, count(w) AS v, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang FROM g) LEFT JOIN kept USING (lang) GROUP BY lang),
dense AS (
    SELECT g.lang, g.source, k.w, coalesce(c.n, 0) AS n, k.n AS ln
    FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.w = k.w),
gs AS (SELECT lang, source, sum(n) AS n FROM dense GROUP BY ALL),
p AS (
    SELECT d.lang, d.source, d.w, d.n, 1 + (1000000000::HUGEINT * (d.n + 1)) // (gs.n + ls.v) AS p,
        1 + (1000000000::HUGEINT * (d.ln + 1)) // (ls.n + ls.v) AS q
    FROM dense d JOIN gs ON gs.lang = d.lang AND gs.source = d.source JOIN ls ON ls.lang = d.lang),
f AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.w = b.w AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, w AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
