"""Sharding by a minimax contiguous partition.

Atomic groups (equal texts) stand in the order of a hash of their text, and shards are contiguous runs of groups. The
largest shard shall be as small as can be: the capacity is binary-searched, and a capacity is feasible if greedy
filling needs no more than the wanted shards.

The order has as many groups as there are distinct texts, so the driver never sees it. It holds segments of the hash
range with their sums instead. Greedy filling over segments is bounded from both sides: a segment may be cut anywhere
(no real cut gets further), or nowhere (always possible). Both bounds give an interval for the capacity and, for each
shard, a stretch in which its end must lie; only segments there are split, FANOUT ways, by one aggregate. A few rounds
leave no divisible segment in any stretch; then both bounds agree and the cuts are exact. Each round brings at most a
few thousand sums to the driver, whatever the input.

Defined cases: a null text counts as empty (size 1) and is grouped with empty ones; a very long text is one group and may fill a shard; copies stay in one shard; with
fewer groups than shards the last shards are empty; an empty table gives no rows; slots within a shard follow the
group order, then the id. Other columns pass through.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, fresh, table

SHARDS, FIRST, FANOUT, SALTS = 16, 4096, 256, 16


@dataclass
class Segment:
    """The groups of one bucket of a level, from key lo to key hi; atomic if it is one group."""

    level: int
    bucket: int
    lo: int
    hi: int
    mass: int
    atomic: bool


def reach(ends: list[int], segments: list[Segment], start: int, capacity: int, whole: bool) -> int:
    """How far a shard from position ``start`` gets: to a position in summed sizes."""
    far = min(start + capacity, ends[-1])
    k = bisect.bisect_right(ends, far)  # segments before k end at or before far
    if k >= len(segments):
        return ends[-1]
    floor = ends[k - 1] if k else 0
    if whole or segments[k].atomic:
        return max(floor, start)
    return far


def fill(ends: list[int], segments: list[Segment], shards: int, capacity: int, whole: bool) -> list[int]:
    """The positions at which greedy shards end."""
    out, at = [], 0
    for _ in range(shards):
        at = reach(ends, segments, at, capacity, whole)
        out.append(at)
    return out


def least_capacity(ends: list[int], segments: list[Segment], shards: int, whole: bool) -> int:
    """Binary search for the least capacity with which greedy filling reaches the end."""
    total = ends[-1]
    lo, hi = -(-total // shards), total
    while lo < hi:
        mid = (lo + hi) // 2
        if fill(ends, segments, shards, mid, whole)[-1] == total:
            hi = mid
        else:
            lo = mid + 1
    return lo


def sums(segments: list[Segment]) -> list[int]:
    out, at = [], 0
    for s in segments:
        at += s.mass
        out.append(at)
    return out


def to_refine(segments: list[Segment], shards: int) -> list[int]:
    """The divisible segments in which the end of a shard may lie."""
    ends = sums(segments)
    low = least_capacity(ends, segments, shards, whole=False)
    high = least_capacity(ends, segments, shards, whole=True)
    near, far = fill(ends, segments, shards, low, True), fill(ends, segments, shards, high, False)
    out = set()
    for a, b in zip(near, far, strict=True):
        k = bisect.bisect_right(ends, a)
        while k < len(segments) and (ends[k - 1] if k else 0) <= b:
            if not segments[k].atomic:
                out.add(k)
            k += 1
    return sorted(out)


def at_level(groups: DataFrame, shift: int, level: int) -> list[Segment]:
    """Sums by the leading bits of the key, in the order of keys."""
    rows = (
        groups.groupBy(F.shiftright("k", shift).alias("b"))
        .agg(F.sum("mass").alias("mass"), F.min("k").alias("lo"), F.max("k").alias("hi"))
        .collect()
    )
    found = [Segment(level, r["b"], r["lo"], r["hi"], r["mass"], r["lo"] == r["hi"]) for r in rows]
    return sorted(found, key=lambda s: s.lo)


def refine(groups: DataFrame, segments: list[Segment], which: list[int], shifts: list[int]) -> list[Segment]:
    """Splits the named segments: one aggregate for each of their levels, over the groups inside them."""
    children: dict[tuple[int, int], list[Segment]] = {}
    for level in sorted({segments[k].level for k in which}):
        inside = [segments[k].bucket for k in which if segments[k].level == level]
        own = groups.where(F.shiftright("k", shifts[level]).isin(inside))
        for s in at_level(own, shifts[level + 1], level + 1):
            children.setdefault((level, s.bucket >> (shifts[level] - shifts[level + 1])), []).append(s)
    chosen, out = set(which), []
    for k, s in enumerate(segments):
        out += children[s.level, s.bucket] if k in chosen else [s]
    return out


def partition(groups: DataFrame, shards: int = SHARDS, first: int = FIRST, fanout: int = FANOUT) -> tuple[int, list[int]]:
    """Groups (k, mass) with distinct long keys -> the least capacity, and the largest key of each shard but the last.

    first and fanout are powers of two.
    """
    shifts = [64 - (first.bit_length() - 1)]
    while shifts[-1]:
        shifts.append(max(shifts[-1] - (fanout.bit_length() - 1), 0))
    segments = at_level(groups, shifts[0], 0)
    if not segments:
        return 0, []
    while which := to_refine(segments, shards):
        segments = refine(groups, segments, which, shifts)
    ends = sums(segments)
    capacity = least_capacity(ends, segments, shards, whole=True)
    keys = []
    for end in fill(ends, segments, shards, capacity, True)[:-1]:
        k = bisect.bisect_right(ends, end) - 1
        keys.append(segments[k].hi if k >= 0 else -(1 << 63))
    return capacity, keys


def shard(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
) -> DataFrame:
    """All documents with size, shard and slot (named afresh on a clash)."""
    size, shard_col, slot = fresh(docs, "size", "shard", "slot")
    key, piece, salt, start, n, s0, p0, t0 = fresh(docs, "_key", "_piece", "_salt", "_start", "_n", "_s0", "_p0", "_t0")
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.withColumn(size, (F.octet_length(text) + 1).cast("long")).withColumn(key, F.xxhash64(text))
    groups = cut(sized.select(F.col(key).alias("k"), F.col(size).alias("size")).groupBy("k").agg(F.sum("size").alias("mass")))
    _, keys = partition(groups, shards)
    at = F.lit(0)
    for i, k in enumerate(keys):
        at = F.when(F.col(key) > F.lit(k), F.lit(i + 1)).otherwise(at)
    placed = (
        sized.withColumn(shard_col, at.cast("int"))
        .withColumn(piece, F.shiftright(key, 64 - (FIRST.bit_length() - 1)))
        .withColumn(salt, F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int"))
    )
    # A slot is the count of rows in earlier pieces of the shard and the place in the own one. Pieces are bounded in
    # number; a hot group is dealt over salts.
    counts = cut(
        placed.groupBy(F.col(shard_col).alias(s0), F.col(piece).alias(p0), F.col(salt).alias(t0)).agg(F.count("*").alias(n))
    )
    along = Window.partitionBy(s0).orderBy(p0, t0).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(start, F.coalesce(F.sum(n).over(along), F.lit(0))).drop(n)
    within = Window.partitionBy(shard_col, piece, salt).orderBy(key, F.col(id_col).asc_nulls_first())
    ranked = placed.withColumn(slot, F.row_number().over(within).cast("long") - 1)
    joined = ranked.join(
        starts, (ranked[shard_col] == starts[s0]) & (ranked[piece] == starts[p0]) & (ranked[salt] == starts[t0])
    )
    return joined.withColumn(slot, F.col(slot) + F.col(start)).select(*docs.columns, size, shard_col, slot)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    out = shard(docs.withColumn("text_crc32", crc))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
