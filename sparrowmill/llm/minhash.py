r"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped candidate edges.

A document's set is its distinct shingles of ``width`` words (``[^\x20\x09-\x0D]+``, A-Z lower-cased); with fewer words
the whole sequence is its one shingle; without words the set is empty and linked with nothing. Documents of equal sets
are one node. One hash deals the shingles into bins and the least of each bin is kept; an empty bin takes the value of
a full one, which it finds through its own sequence of bins, the same for all documents. ``ROWS`` bins make a band key,
and nodes that share one meet in a bucket; there are as many bands as keep the chance that none meets, at the similarity
asked for, under MISSED.

In a bucket one node is the centre, the one whose buckets are fullest (an original meets each of its copies more often
than they meet each other), and every other member is a candidate of the centre: a bucket of n members gives n - 1
pairs. Candidates are confirmed on their full sets. Rounds follow: a centre has met its bucket and leaves it, and a bucket
whose other members are not all in one component gets a new centre, from the component with the fewest of them, which
meets all members of other components. A bucket of more than SHARE members is dealt in parts that its centre is sent to, and
the set of a centre of many pairs in as many copies. After ROUNDS of these, or one that confirms less than a pair in PAYING, the nodes
of all buckets still open go to an exact join: pairs of different components that share a shingle in their prefixes, rarest first. So no
pair of a bucket is left untested unless sizes, prefixes or components settle it. Components come from alternating
large-star and small-star steps.

Nodes with too few shingles to be alike without being equal take no part in the bands, as they would only be dealt bins
of one another.

Defined cases: a null text has no words; a very long text is worked on whole, alone; equal texts share a node; repeated rows have equal results; a component of
null ids only has a null id, and its rows are not kept; an empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bounded, fresh, table, written
from .textbatch import U, join, mix, slices

ROWS, MISSED = 8, 1e-6


def bands_for(similarity: float) -> int:
    """The least number of bands of which, at this similarity, none meets with a chance under MISSED."""
    meets = similarity**ROWS
    return 1 if meets >= 1 else math.floor(math.log(MISSED) / math.log1p(-meets)) + 1


#: Those of similarity 0.85.
BANDS = bands_for(0.85)
BINS = BANDS * ROWS
ROUNDS = 6
#: Slots in which the exact join counts shingles by hash.
SLOTS = 1 << 22
#: Stars go on while one pair in so many is confirmed; then the exact join costs less.
PAYING = 10
#: Members of a bucket, or pairs of a centre, that are dealt by one key; those of larger ones are dealt by parts.
SHARE = 256


def _plan(bins: int, tries: int = 64) -> np.ndarray:
    """The bins that an empty bin asks, by attempt."""
    i = np.arange(bins, dtype=U)[None, :]
    a = np.arange(tries, dtype=U)[:, None]
    return (mix(i * U(tries) + a + U(1)) % U(bins)).astype(np.int64)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Of each text, its shingles' hashes, ascending and distinct."""
    for _, _, t in slices(texts):
        h = t.hashes()
        many = len(h) - width + 1
        grams = join(*[h[k : many + k] for k in range(width)]) if many > 0 else h[:0]
        for a, b in zip(t.bounds[:-1], t.bounds[1:], strict=True):
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                yield join(U(b - a) + np.zeros(1, U), *[h[k : k + 1] for k in range(a, b)])
            else:
                yield h[:0]


def signatures(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One-permutation minima of ascending sets, densified: a row of ``bins`` values for each set."""
    sig = np.zeros((len(sets), bins), U)
    full = np.zeros((len(sets), bins), bool)
    for d, s in enumerate(sets):
        # High bits choose the bin, so bins come in order and the first of each is its least.
        b = ((s >> U(32)) * U(bins) >> U(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(b, prepend=-1))
        sig[d, b[first]] = s[first]
        full[d, b[first]] = True
    d, i = np.nonzero(~full)
    attempt, ask = 0, _plan(bins)
    while len(d):
        if attempt and attempt % len(ask) == 0:
            ask = (mix(ask.astype(U) + U(attempt) * U(bins)) % U(bins)).astype(np.int64)
        j = ask[attempt % len(ask), i]
        hit = full[d, j]
        sig[d[hit], i[hit]] = sig[d[hit], j[hit]]
        d, i = d[~hit], i[~hit]
        attempt += 1
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(len(sig), sig.shape[1] // ROWS, ROWS)
    key = np.broadcast_to(np.arange(rows.shape[1], dtype=U), rows.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * U(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key


def node_id(s: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    if not len(s):
        return b""
    a = np.bitwise_xor.reduce(mix(s + U(1)))
    b = np.add.reduce(mix(s ^ U(0xA5A5A5A5A5A5A5A5)))
    return np.array([join(np.array([a]), np.array([b]))[0], b], U).tobytes()


def least_size(similarity: float) -> int:
    """Unequal sets as alike as this have a union of at least so many shingles, and each set one less."""
    n = 1
    while (n - 1) / n < similarity:
        n += 1
    return n - 1


def _nodes(width: int, similarity: float, keep: list[str]):
    small, bins = least_size(similarity), bands_for(similarity) * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for lo in range(0, len(texts), 512):
                sets = list(shingle_sets(texts[lo : lo + 512], width))
                wide = [k for k, s in enumerate(sets) if len(s) >= small]
                keys = band_keys(signatures([sets[k] for k in wide], bins)).view(np.int64) if wide else None
                bands: list = [None] * len(sets)
                for row, k in enumerate(wide):
                    bands[k] = keys[row]
                cols = [c[lo : lo + 512] for c in batch.columns[1:]]
                yield pa.record_batch(
                    [
                        pa.array([node_id(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                        *cols,
                    ],
                    names=["node", "n_shingles", "bands", *keep],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                sets = [s.tobytes() for s in shingle_sets(part.column(0), width)]
                yield pa.record_batch([part.column(1), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _confirm(similarity: float):
    hundredths = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("xs"), batch.column("ys"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                short, long = (a, b) if len(a) <= len(b) else (b, a)
                at = np.searchsorted(long, short)
                both = int(np.count_nonzero(long[np.minimum(at, len(long) - 1)] == short))
                linked.append(100 * both >= hundredths * (len(a) + len(b) - both))
            yield pa.record_batch(
                [batch.column("x"), batch.column("y"), pa.array(linked, pa.bool_())], names=["x", "y", "linked"]
            )

    return run


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (x, y) -> (node, root): the least node of each component, for nodes that have an edge."""
    pairs = scratch.keep(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # Large star: every neighbour above a node is linked to the least node around.
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("c"), F.least("m", "u").alias("m")
        )
        large = (
            both.join(least, both["u"] == least["c"])
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        # Small star: a node and its neighbours below are linked to the least of these.
        under = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        small = (
            large.join(under, large["u"] == under["c"])
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        last, pairs = pairs, scratch.keep(small, "edges")
        scratch.let_go(last)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    ends = pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")))
    roots = scratch.keep(ends.distinct(), "roots")
    scratch.let_go(pairs)
    return roots


def part_of(node: str, parts: str | Column) -> Column:
    """The part of a bucket or centre that a node falls in."""
    return F.pmod(F.xxhash64(node), F.col(parts) if isinstance(parts, str) else parts).cast("int")


def in_parts(df: DataFrame, parts: str, part: str, first: int = 0) -> DataFrame:
    """Each row once a part, from part ``first``."""
    numbers = F.when(F.col(parts) > first, F.sequence(F.lit(first), F.col(parts) - 1)).otherwise(F.array().cast("array<int>"))
    return df.withColumn(part, F.explode(numbers))


def shares(n: Column) -> Column:
    return F.greatest(F.ceil(n / SHARE), F.lit(1)).cast("int")


def open_buckets(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members (key, node, n, fame, parts) of the buckets that hold several components, with the component's root."""
    if roots is None:
        rooted = members.withColumn("root", F.col("node"))
    else:
        named = roots.select(F.col("node").alias("rn"), "root")
        rooted = members.join(named, members["node"] == named["rn"], "left").select(
            "key", "node", "n", "fame", "parts", F.coalesce("root", "node").alias("root")
        )
    mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("parts").alias("ps")).where("lo <> hi")
    mixed = in_parts(mixed, "ps", "p").select(F.col("key").alias("k"), "p")
    return rooted.join(mixed, (F.col("key") == F.col("k")) & (part_of("node", "parts") == F.col("p")), "left_semi")


def centres(members: DataFrame) -> DataFrame:
    """(ck, cx, xr, xn, ps, spread) by bucket: the centre, of the component with the fewest members there, its root and size.

    ``ps`` are the bucket's parts; ``spread`` is in how many parts the pairs of all buckets of this centre are dealt.
    """
    order = F.struct("fame", F.xxhash64("node").alias("h"))
    best = members.groupBy("key", "root").agg(
        F.count("*").alias("many"), F.max_by(F.struct("node", "n"), order).alias("c"), F.max(order).alias("o"), F.max("parts").alias("ps")
    )
    first = F.struct((-F.col("many")).alias("few"), "o.fame", "o.h")
    centre = best.groupBy("key").agg(
        F.max_by(F.struct("c.node", "root", "c.n"), first).alias("c"), F.max("ps").alias("ps"), F.sum("many").alias("all")
    )
    spread = centre.groupBy(F.col("c.node").alias("sx")).agg(shares(F.sum("all")).alias("spread"))
    return centre.join(spread, F.col("c.node") == F.col("sx")).select(
        F.col("key").alias("ck"), F.col("c.node").alias("cx"), F.col("c.root").alias("xr"), F.col("c.n").alias("xn"), "ps", "spread"
    )


def stars(members: DataFrame, centre: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (x, y, xp, yp) of open buckets: each centre with the bucket's members of other components.

    Sets whose sizes alone rule the similarity out are no candidates. A centre meets the members in each part of its bucket;
    xp and yp say which copy of a centre's set a pair asks for, 0 for the other one.
    """
    share = round(similarity * 100)
    met = members.join(in_parts(centre, "ps", "p"), (F.col("key") == F.col("ck")) & (part_of("node", "parts") == F.col("p"))).where(
        (F.col("root") != F.col("xr")) & (100 * F.least("n", "xn") >= share * F.greatest("n", "xn"))
    )
    copy, lower = part_of("node", "spread"), F.col("cx") < F.col("node")
    return (
        met.select(
            F.least("cx", "node").alias("x"),
            F.greatest("cx", "node").alias("y"),
            F.when(lower, copy).otherwise(0).alias("xp"),
            F.when(lower, 0).otherwise(copy).alias("yp"),
        )
        .groupBy("x", "y")
        .agg(F.max("xp").alias("xp"), F.max("yp").alias("yp"))
    )


def _slot(s: np.ndarray) -> np.ndarray:
    return (mix(s) % U(SLOTS)).astype(np.int64)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for x in batch.column("shingles"):
            np.add.at(n, _slot(np.frombuffer(x.as_buffer(), U)), 1)
    at = np.flatnonzero(n)
    yield pa.record_batch([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["slot", "n"])


def prefix(s: np.ndarray, often: np.ndarray, hundredths: int) -> tuple[np.ndarray, int, int]:
    """(prefix, m, left): the rarest shingles of a set; a set as alike has one of them in its own prefix, and if this is not the
    longer of the two one of the first m. Of all its shingles, ``left`` may be in an overlap.

    ``often`` counts slots. A slot counted once is of a shingle that no other set has; it can't be in an overlap.
    """
    n, count = len(s), often[_slot(s)]
    some = np.flatnonzero(count > 1)
    some = some[np.lexsort((s[some], count[some]))]
    # Least overlaps: with any set, and with one that isn't shorter.
    as_long, as_short = -(-hundredths * n // 100), -(-2 * hundredths * n // (100 + hundredths))
    return s[some[: max(len(some) - as_long + 1, 0)]], max(len(some) - as_short + 1, 0), len(some)


def _prefixes(shipped, similarity: float):
    hundredths = round(similarity * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, row, short, left = [], [], [], []
            for k, x in enumerate(batch.column("shingles")):
                p, m, some = prefix(np.frombuffer(x.as_buffer(), U), shipped.value, hundredths)
                tokens.append(p)
                left.append(some - np.arange(len(p)))
                row.append(np.full(len(p), k))
                short.append(np.arange(len(p)) < m)
            if not tokens:
                continue
            at = pa.array(np.concatenate(row))
            cols = [batch.column(c).take(at) for c in ("node", "n", "root")]
            first = [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(short), pa.bool_())]
            rest = pa.array(np.concatenate(left), pa.int64())
            yield pa.record_batch([*first, rest, *cols], names=["token", "short", "left", "node", "n", "root"])

    return run


def remaining(live: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Candidate pairs (x, y) of different components among all nodes of open buckets: an exact prefix-filter join.

    Any order of shingles is exact, so they are counted in slots, a table of a fixed size. The shorter set of a pair
    needs a shorter prefix than the longer one. A pair comes up at a shingle that both prefixes hold if as many are left
    from there on as the overlap takes; equal pairs are put together before they are shuffled.
    """
    spark = live.sparkSession
    nodes = live.select(F.col("node").alias("on"), "n", "root").distinct()
    own = scratch.keep(sets.join(nodes, sets["node"] == nodes["on"]).select("node", "n", "root", "shingles"), "open")
    counts = bounded(own.select("shingles")).mapInArrow(_slot_counts, "slot long, n long")
    counts = counts.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    shipped = spark.sparkContext.broadcast(often)
    hundredths = round(similarity * 100)
    schema = "token long, short boolean, left long, node binary, n long, root binary"
    rows = scratch.keep(bounded(own).mapInArrow(_prefixes(shipped, similarity), schema), "prefixes")
    scratch.let_go(own)
    mixed = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    rows = rows.join(mixed.select(F.col("token").alias("t")), F.col("token") == F.col("t"), "left_semi")
    side = lambda k: [F.col(c).alias(k + c) for c in ("token", "left", "node", "n", "root")]
    x, y = rows.where("short").select(*side("x")), rows.select(*side("y"))
    longer = (F.col("xn") < F.col("yn")) | ((F.col("xn") == F.col("yn")) & (F.col("xnode") < F.col("ynode")))
    enough = (100 + hundredths) * F.least("xleft", "yleft") >= hundredths * (F.col("xn") + F.col("yn"))
    alike = 100 * F.col("xn") >= hundredths * F.col("yn")
    pairs = x.join(y, (F.col("xtoken") == F.col("ytoken")) & (F.col("xroot") != F.col("yroot")) & longer & alike & enough)
    return pairs.select(F.least("xnode", "ynode").alias("x"), F.greatest("xnode", "ynode").alias("y")).distinct()


class Clusters:
    """What dedup knows: rows (id, node, n_shingles) and, by node, the component's least id and the node that has it."""

    def __init__(self, rows: DataFrame, nodes: DataFrame) -> None:
        self.rows, self.nodes = rows, nodes


def cluster(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    similarity: float = 0.8,
    rounds: int = ROUNDS,
) -> Clusters:
    """Finds all components; the frames returned are ``rows`` (id, node, n_shingles) and ``nodes`` (node, comp, rep).

    Both are tables of their own; what the rounds write is deleted as soon as the next round has what it needs of it.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        return _cluster(docs, scratch, id_col, text_col, width, similarity, rounds)


def _cluster(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, width: int, similarity: float, rounds: int) -> Clusters:
    id_type = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(
        F.col(text_col).alias("text"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th")
    )
    schema = f"node binary, n_shingles long, bands array<long>, id {id_type}, th long"
    banding = scratch.keep(bounded(slim).mapInArrow(_nodes(width, similarity, ["id", "th"]), schema), "nodes")
    rows = written(banding.drop("bands"), "rows")
    # Equal sets are one node, known by the row of its least id.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th"))
    nodes = rows.where("n_shingles > 0").groupBy("node").agg(first.alias("row"), F.first("n_shingles").alias("n"))
    banded = banding.where("bands IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"), F.first("n_shingles").alias("n"))
    placed = banded.select("node", "n", F.explode("bands").alias("key"))
    sizes = placed.groupBy("key").agg(F.count("*").alias("in_bucket")).where("in_bucket > 1")
    sizes = sizes.select(F.col("key").alias("k"), "in_bucket")
    shared = scratch.keep(placed.join(sizes, placed["key"] == sizes["k"]).select("key", "node", "n", "in_bucket"), "buckets")
    scratch.let_go(banding)
    fame = shared.groupBy("node").agg(F.sum("in_bucket").alias("fame"))
    members = shared.select("key", "node", "n", shares(F.col("in_bucket")).alias("parts")).join(fame, "node")
    wanted = nodes.join(fame, "node", "left_semi").select("node", F.col("row.id").alias("wid"), F.col("row.th").alias("wth"))
    text = slim.join(wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth"))).select("text", "node")
    sets = scratch.keep(bounded(text).mapInArrow(_sets(width), "node binary, shingles binary").dropDuplicates(["node"]), "sets")
    live = scratch.keep(members.withColumn("root", F.col("node")), "live")
    scratch.let_go(shared)
    links, roots, tried = None, None, None

    def test(pairs: DataFrame, copies: DataFrame | None = None) -> bool:
        """Confirms what has not been tried yet; whether that paid. ``copies`` (cx, spread) says which sets pairs ask for in parts."""
        nonlocal links, roots, tried
        pairs = scratch.keep(pairs if tried is None else pairs.join(tried, ["x", "y"], "left_anti"), "pairs")
        found = scratch.keep(confirm(pairs, sets, similarity, copies), "links")
        tried = pairs.select("x", "y") if tried is None else tried.union(pairs.select("x", "y"))
        n_found = found.count()
        if n_found:
            links = found if links is None else links.union(found)
            before, roots = roots, components(links, scratch)
            scratch.let_go(before)
        return n_found * PAYING > pairs.count()

    for _ in range(rounds):
        centre = scratch.keep(centres(live), "centres")
        paid = test(stars(live, centre, similarity), centre.where("spread > 1").select("cx", "spread").distinct())
        met = centre.select(F.col("ck").alias("key"), F.col("cx").alias("node"))
        left = live.join(met, ["key", "node"], "left_anti").select("key", "node", "n", "fame", "parts")
        before, live = live, scratch.keep(open_buckets(left, roots), "live")
        scratch.let_go(before, centre)
        if not paid or live.isEmpty():
            break
    if not live.isEmpty():
        test(remaining(live, sets, similarity, scratch))

    if roots is None:
        alone = nodes.select("node", F.col("row.id").alias("comp"), F.col("node").alias("rep"))
        return Clusters(rows, written(alone, "classes"))
    rooted = nodes.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.struct("row.none", "row.id", "node").alias("best")
    )
    best = rooted.groupBy(F.col("root").alias("r")).agg(F.min("best").alias("best"))
    named = rooted.select("node", "root").join(best, F.col("root") == F.col("r"))
    return Clusters(rows, written(named.select("node", F.col("best.id").alias("comp"), F.col("best.node").alias("rep")), "classes"))


def confirm(pairs: DataFrame, sets: DataFrame, similarity: float, copies: DataFrame | None = None) -> DataFrame:
    """The pairs (x, y) whose full sets are alike.

    Where pairs have parts (xp, yp), a set stands ready once for each part that ``copies`` (cx, spread) gives it, so the pairs
    of a hot centre go to many tasks.
    """
    ready = sets.select("node", F.lit(0).alias("part"), "shingles")
    if copies is None:
        pairs = pairs.select("x", "y", F.lit(0).alias("xp"), F.lit(0).alias("yp"))
    else:
        again = sets.join(copies, sets["node"] == copies["cx"]).select("node", "spread", "shingles")
        ready = ready.unionByName(in_parts(again, "spread", "part", first=1).select("node", "part", "shingles"))
    ys = ready.select(F.col("node").alias("yn"), F.col("part").alias("yq"), F.col("shingles").alias("ys"))
    xs = ready.select(F.col("node").alias("xn"), F.col("part").alias("xq"), F.col("shingles").alias("xs"))
    both = pairs.join(ys, (pairs["y"] == ys["yn"]) & (pairs["yp"] == ys["yq"])).select("x", "y", "xp", "ys")
    both = both.join(xs, (both["x"] == xs["xn"]) & (both["xp"] == xs["xq"])).select("x", "y", "xs", "ys")
    checked = bounded(both).mapInArrow(_confirm(similarity), "x binary, y binary, linked boolean")
    return checked.where("linked").select("x", "y")


def report(found: Clusters) -> DataFrame:
    """(id, n_shingles, component_id, kept), a row for each document."""
    nodes = found.nodes.select(F.col("node").alias("cn"), "comp")
    key = F.when(F.col("n_shingles") > 0, F.col("node"))
    rows = found.rows.select("id", "n_shingles", key.alias("key"))
    out = rows.join(nodes, F.col("key") == F.col("cn"), "left")
    comp = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("comp"))
    return out.select("id", "n_shingles", comp.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    )


def _tag(width: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [node_id(s) for s in shingle_sets(batch.column(0), width)]
            yield pa.record_batch([pa.array(ids, pa.binary()), *batch.columns[1:]], names=names)

    return run


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each component, with the input's columns; documents without words all stay.

    The document of the least id stays, and of its repeated rows one.
    """
    found = cluster(docs, id_col=id_col, text_col=text_col, width=width, similarity=similarity)
    node, rid, rnode = fresh(docs, "_node", "_rid", "_rnode")
    tagged = docs.select(F.col(text_col), *[F.col(c) for c in docs.columns])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    tagged = bounded(tagged).mapInArrow(_tag(width, [node, *docs.columns]), f"`{node}` binary, {fields}")
    stay = found.nodes.where(F.col("node") == F.col("rep")).select(F.col("comp").alias(rid), F.col("node").alias(rnode))
    some = tagged.join(stay, (F.col(node) == F.col(rnode)) & F.col(id_col).eqNullSafe(F.col(rid)))
    some = some.dropDuplicates([node, id_col]).select(*docs.columns)
    return some.unionByName(tagged.where(F.length(node) == 0).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "documents"), width=3, similarity=0.85)
    return report(found).withColumnRenamed("id", "doc_id")
