r"""LM scoring by an interpolated modified Kneser-Ney model of order three (or two).

Tokens are the words ``[^\x20\x09-\x0D]+`` (A-Z lower-cased) of a text, then one end. Each token is predicted from the
two before it, the first from a start mark alone. Bigrams count by how many tokens they follow, those after the start
by how often they occur; single words by how many they follow.

Counting: each task counts the trigrams (u, v, w) of its texts and deals them over a grid of shards, by the range of
v's hash and of u's, in packed blocks. A shard merges its blocks, so it knows all of a context (u, v); it writes its
trigrams and passes on bigrams, dealt over a grid by both words, and what it knows of contexts that occur more than
once. The shards of bigrams do likewise and pass on what they know of single words (count, distinct predecessors,
followers by count), dealt by hash range. A frequent word thus spreads over a row or a column of each grid. Only a few
sums reach the driver. Shuffles go as soon as a merge is through. Files appear by renaming, so a task that runs again does no harm.

An n-gram is stored by 32 bits of its hash, after those that name its bucket in a sorted array (some 48 bits in all at
a million a shard), and a byte that names its facts among those of the shard.

Scoring: workers map the arrays into memory and look up the sorted hashes of a batch. Everything counted is in the
arrays, so they grow with the corpus; workers hold only the pages they touch.

Defined cases: a null or blank text is its end alone; a corpus without training texts gives every token probability 1;
unknown words share the mass of one more word; repeated rows count and score alike; texts of any length are whole; an
empty table gives no rows; an array that was written and is gone fails the scoring. Other columns pass through.
"""

from __future__ import annotations

import io
import itertools
import math
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, brief_shuffles, drop, fresh, shared_path, table
from .textbatch import BASE, U, Texts, join, mix, slices

FOLDS, HELD_OUT = 7, 2
#: Tokens before the one predicted, and that one.
ORDER = 3
#: Tokens that a task gathers before it packs their n-grams.
GATHER = 4_000_000
#: Stored input for each shard, where the session does not ask for more of them.
SHARD_BYTES = 16 << 20
END, START = U(0x6A09E667F3BCC909), U(0xBB67AE8584CAA73B)


# Shared files -----------------------------------------------------------------------------------------------------


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def put_array(folder: str, name: str, array: np.ndarray) -> None:
    """Writes folder/name.npy whole or not at all."""
    raw = io.BytesIO()
    np.save(raw, array)
    where = _local(folder)
    if where is not None:
        os.makedirs(where, exist_ok=True)
        draft = f"{where}/.{name}.{uuid.uuid4().hex}"
        with open(draft, "wb") as f:
            f.write(raw.getbuffer())
        os.replace(draft, f"{where}/{name}.npy")
        return
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    draft = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as f:
        f.write(raw.getbuffer())
    store.move(draft, f"{root}/{name}.npy")


def map_array(folder: str, name: str) -> np.ndarray:
    """Maps folder/name.npy into memory; from a remote store by way of a local copy that has no name any more."""
    where = _local(folder)
    if where is not None:
        return np.load(f"{where}/{name}.npy", mmap_mode="r")
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    with tempfile.NamedTemporaryFile(suffix=".npy") as copy:
        with store.open_input_stream(f"{root}/{name}.npy") as f:
            while part := f.read(1 << 22):
                copy.write(part)
        copy.flush()
        return np.load(copy.name, mmap_mode="r")


def pack(*columns: np.ndarray) -> bytes:
    """Columns, hashes first: ascending ones by their steps, in as few bytes as they need, byte by byte, compressed."""
    planes, steps = [], []
    for c in columns:
        up = bool((c[1:] >= c[:-1]).all())
        c = np.diff(c, prepend=c.dtype.type(0)) if up else c
        c = c.astype(np.min_scalar_type(int(c.max()) if len(c) else 0))
        planes.append(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T))
        steps.append(up)
    out = io.BytesIO()
    np.savez(out, np.array(steps), *planes)
    return pa.compress(out.getvalue(), codec="zstd", asbytes=True) + len(out.getvalue()).to_bytes(8, "little")


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[:-8], int.from_bytes(blob[-8:], "little"), codec="zstd", asbytes=True)
    with np.load(io.BytesIO(raw)) as z:
        steps, *planes = [z[k] for k in z.files]
    out = []
    for k, c in enumerate(planes):
        c = np.ascontiguousarray(c.T).view(f"u{c.shape[0]}").ravel().astype(np.int64 if k else U)
        out.append(np.cumsum(c, dtype=c.dtype) if steps[k] else c)
    return out


def pack_words(names: np.ndarray, ids: list[np.ndarray], *counts: np.ndarray) -> bytes:
    """N-grams as columns of numbers into ``names``, of which only those in use go along."""
    used = np.zeros(len(names), bool)
    for c in ids:
        used[c] = True
    place = np.cumsum(used) - 1
    return pack(names[used], *[place[c] for c in ids], *counts)


# Sorted arrays ----------------------------------------------------------------------------------------------------

PARTS = (np.uint32, np.uint32, np.uint8, np.uint32, np.uint32, np.int64)


def seal(key: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Distinct ascending hashes and their facts as one array of bytes; Sorted reads it.

    The leading bits of a hash name its bucket, the next 32 are stored. Facts are numbered by how often they occur;
    numbers from 255 on stand in a list of their own.
    """
    bits = max(1, len(key).bit_length() - 5)
    bucket = np.searchsorted((key >> U(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
    low = key << U(bits) >> U(32)
    columns = [c.astype(np.int64) for c in columns]
    alike = join(*[c.astype(U) for c in columns])
    _, first, number, often = np.unique(alike, return_index=True, return_inverse=True, return_counts=True)
    rank = np.argsort(-often, kind="stable")
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    code = place[number]
    where = np.flatnonzero(code >= 255)
    facts = np.stack([c[first[rank]] for c in columns], axis=1)
    parts = [bucket, low, np.minimum(code, 255), where, code[where], facts.ravel()]
    head = np.array([bits, len(columns), *[len(p) for p in parts]], np.int64)
    out = [head.tobytes()]
    for p, kind in zip(parts, PARTS, strict=True):
        raw = p.astype(kind).tobytes()
        out.append(raw + bytes(-len(raw) % 8))
    return np.frombuffer(b"".join(out), np.uint8)


class Sorted:
    """A sealed array, mapped."""

    def __init__(self, raw: np.ndarray) -> None:
        raw = raw.view(np.ndarray)
        self.bits, self.width, *sizes = raw[: 8 * (2 + len(PARTS))].view(np.int64).tolist()
        at, parts = 8 * (2 + len(PARTS)), []
        for size, kind in zip(sizes, PARTS, strict=True):
            n = size * np.dtype(kind).itemsize
            parts.append(raw[at : at + n].view(kind))
            at += n + -n % 8
        self.bucket, self.low, self.code, self.where, self.big, facts = parts
        self.facts = facts.reshape(-1, self.width)

    def find(self, key: np.ndarray) -> np.ndarray:
        """A row of facts for each hash, zeros for those not there."""
        n = len(self.low)
        if not n or not len(key):
            return np.zeros((len(key), self.width), np.int64)
        own = (key >> U(64 - self.bits)).astype(np.int64)
        want = (key << U(self.bits) >> U(32)).astype(np.uint32)
        lo, end = self.bucket[own].astype(np.int64), self.bucket[own + 1].astype(np.int64)
        hi = end
        for _ in range(int((hi - lo).max()).bit_length()):
            mid = (lo + hi) >> 1
            less = (lo < hi) & (self.low[np.minimum(mid, n - 1)] < want)
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
        at = np.minimum(lo, n - 1)
        hit = (lo < end) & (self.low[at] == want)
        code = self.code[at].astype(np.int64)
        rare = np.flatnonzero(hit & (code == 255))
        code[rare] = self.big[np.searchsorted(self.where, at[rare])]
        code[~hit] = 0
        out = self.facts[code]
        out[~hit] = 0
        return out


# Counting ---------------------------------------------------------------------------------------------------------


def tokens(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, document) of all predictions."""
    n = len(t)
    sizes = np.diff(t.bounds) + 1
    last = np.cumsum(sizes) - 1
    word = np.empty(int(sizes.sum()), U)
    is_end = np.zeros(len(word), bool)
    is_end[last] = True
    word[is_end] = END
    word[~is_end] = t.hashes()
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[last - sizes + 1] = START
    return context, word, np.repeat(np.arange(n), sizes)


def bands(h: np.ndarray, side: int) -> np.ndarray:
    """Which of ``side`` equal ranges a hash lies in."""
    return ((h >> U(32)) * U(side) >> U(32)).astype(np.int64)


def merged(key: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys ascending, where each first stands in the input, and the sums of its counts."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.diff(k, prepend=k[:1] ^ k.dtype.type(1))) if len(k) else np.zeros(0, np.int64)
    return k[first], order[first], [np.add.reduceat(c[order].astype(np.int64), first) if len(first) else c[:0] for c in counts]


def _distinct(first: np.ndarray, second: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with their counts; ``second`` is below ``size``, products beyond 63 bits are numbered."""
    known = None
    if len(first) and int(first.max()) >= (1 << 63) // size - 1:
        known, first = np.unique(first, return_inverse=True)
    key, n = np.unique(first * np.int64(size) + second, return_counts=True)
    first, second = key // size, key % size
    return (first if known is None else known[first]), second, n


def _count(side: int, order: int):
    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        context = np.concatenate([p[0] for p in parts])
        word = np.concatenate([p[1] for p in parts])
        names, ids = np.unique(np.append(word, START), return_inverse=True)
        start, w = ids[-1], ids[:-1]
        head = context == START
        v = np.roll(w, 1)
        v[head] = start
        many = len(names)
        if order == 3:
            u = np.roll(v, 1)
            u[head] = start
            pair, w, n = _distinct(u * many + v, w, many)
            grams = [pair // many, pair % many, w]
            across, down = grams[1], grams[0]
        else:
            v, w, n = _distinct(v, w, many)
            grams = [v, w]
            across, down = v, w
        shard = bands(names[across], side) * side + bands(names[down], side)
        by = np.argsort(shard, kind="stable")
        edge = np.searchsorted(shard[by], np.arange(side * side + 1))
        for s in np.flatnonzero(np.diff(edge)):
            a = by[edge[s] : edge[s + 1]]
            blob = pack_words(names, [g[a] for g in grams], n[a], *([] if order == 3 else [n[a]]))
            yield _out([(int(s), blob, 0, 0, 0, 0)], PASSED, PASSED_TYPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, _, t in slices(batch.column(0)):
                context, word, _ = tokens(t)
                parts.append((context, word))
                size += len(word)
                if size >= GATHER:
                    yield from flush(parts)
                    parts, size = [], 0
        if parts:
            yield from flush(parts)

    return run


def _by_shard(rows: Iterator[tuple]) -> Iterator[tuple[int, list[bytes]]]:
    """Blocks of one shard after the other; rows (shard, blob) come in the order of shards."""
    at, held = None, []
    for s, blob in rows:
        if s != at and held:
            yield at, held
            held = []
        at = s
        held.append(blob)
    if held:
        yield at, held


def _times(counts: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4)]


#: What one merge passes to the next: blocks by shard, or counts of counts under a number below 0.
PASSED = ["shard", "blob", "t1", "t2", "t3", "t4"]
PASSED_TYPES = [pa.int32(), pa.binary(), *[pa.int64()] * 4]
PASSED_SQL = "shard int, blob binary, t1 long, t2 long, t3 long, t4 long"
SUMS = ("n", "t1", "t2", "t3", "t4", "tokens", "distinct")
#: Of a bitmap that Spark gathers.
BITS = 32768


def present(rows: list, size: int) -> np.ndarray:
    """Which numbers below ``size`` the bitmaps (part, bits) of a kind of array hold; those have a file."""
    out = np.zeros(size + BITS, bool)
    for r in rows:
        bits = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
        first = (r["part"] - 1) * BITS
        out[first : first + len(bits)] |= bits[: len(out) - first].astype(bool)
    return out[:size]


def _out(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    return (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns], strict=True))


def _trigrams(folder: str, side: int):
    """Merges the blocks of a shard, writes its trigrams, and passes on bigrams and contexts by shard of bigrams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, blobs in _by_shard((r[0], r[1]) for r in _rows(batches)):
            parts = [unpack(b) for b in blobs]
            u, v, w = (np.concatenate([p[0][p[k]] for p in parts]) for k in (1, 2, 3))
            n = np.concatenate([p[4] for p in parts])
            del parts
            key, at, (n,) = merged(join(u, v, w), n)
            u, v, w = u[at], v[at], w[at]
            # After the start mark the bigram says all.
            inner = v != START
            put_array(folder, f"trigram-{s}", seal(key[inner], n[inner]))
            yield _out([(-1 - side * side - s, b"", *_times(n[inner]))], PASSED, PASSED_TYPES)
            names, ids = np.unique(np.concatenate([u, v, w]), return_inverse=True)
            iu, iv, iw = np.split(ids, 3)
            none = np.zeros(0, np.int64)
            _, at, (left, raw) = merged(iv * np.int64(len(names)) + iw, np.ones(len(n), np.int64), n)
            pv, pw = iv[at], iw[at]
            left = np.where(v[at] == START, raw, left)
            _, at, (total, n1, n2, n3) = merged((iu * np.int64(len(names)) + iv)[inner], *[c[inner] for c in (n, n == 1, n == 2, n >= 3)])
            more = total > 1
            at = np.flatnonzero(inner)[at[more]]
            # All contexts here share a band of u and of v: one shard of bigrams takes them.
            if len(at):
                to = int(bands(u[at[:1]], side)[0] * side + bands(v[at[:1]], side)[0])
                blob = pack_words(names, [none, none, iu[at], iv[at]], none, none, n1[more], n2[more], n3[more])
                yield _out([(to, blob, 0, 0, 0, 0)], PASSED, PASSED_TYPES)
            to = bands(names[pv], side) * side + bands(names[pw], side)
            for t in np.unique(to):
                a = np.flatnonzero(to == t)
                blob = pack_words(names, [pv[a], pw[a], none, none], left[a], raw[a], none, none, none)
                yield _out([(int(t), blob, 0, 0, 0, 0)], PASSED, PASSED_TYPES)

    return run


def _bigrams(folder: str, ranges: int, order: int):
    """Merges the blocks of a shard, writes its bigrams, and passes on blocks about single words by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, firsts = _rows(batches), []
        # Rows numbered below 0 come first and go on as they are.
        for r in rows:
            if r[0] >= 0:
                firsts.append(r[:2])
                break
            yield _out([r], PASSED, PASSED_TYPES)
        for s, blobs in _by_shard(itertools.chain(firsts, (r[:2] for r in rows))):
            parts = [unpack(b) for b in blobs]
            context, word = (np.concatenate([p[0][p[k]] for p in parts]) for k in (1, 2))
            skip = 2 if order == 3 else 0
            n, raw = (np.concatenate([p[k + skip] for p in parts]) for k in (3, 4))
            key, at, (n, raw) = merged(join(context, word), n, raw)
            context, word = context[at], word[at]
            facts = [n]
            if order == 3:
                # What follows a bigram: one token once, unless a block tells more; nothing follows an end.
                on = (word != END).astype(np.int64)
                follow = [on.copy(), np.zeros_like(on), np.zeros_like(on)]
                place = np.searchsorted(key, np.concatenate([join(p[0][p[3]], p[0][p[4]]) for p in parts]))
                for k, c in enumerate(follow):
                    c[place] = np.concatenate([p[7 + k] for p in parts])
                facts = [n, raw * on, *follow]
            del parts
            put_array(folder, f"bigram-{s}", seal(key, *facts))
            one = np.ones(len(n), np.int64)
            h1, _, (raw, preceding) = merged(word, raw, one)
            h2, _, (total, n1, n2, n3) = merged(context, n, n == 1, n == 2, n >= 3)
            zero1, zero2 = np.zeros(len(h1), np.int64), np.zeros(len(h2), np.int64)
            h = np.concatenate([h1, h2])
            facts = [
                np.concatenate(c)
                for c in ((raw, zero2), (preceding, zero2), (zero1, total), (zero1, n1), (zero1, n2), (zero1, n3))
            ]
            to = bands(h, ranges)
            by = np.lexsort((h, to))
            edge = np.searchsorted(to[by], np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(edge)):
                a = by[edge[r] : edge[r + 1]]
                yield _out([(int(r), pack(h[a], *[c[a] for c in facts]), 0, 0, 0, 0)], PASSED, PASSED_TYPES)
            yield _out([(-1 - s, b"", *_times(n))], PASSED, PASSED_TYPES)

    return run


def _words(folder: str, side: int):
    """Merges what is known of the words of a hash range and writes it."""
    names = ["kind", "shard", "n", "t1", "t2", "t3", "t4", "tokens", "distinct"]
    types = [pa.string(), *[pa.int64()] * 8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches)
        blocks, firsts = [], []
        # Sums over shards of n-grams are numbered below 0, so they come first.
        for s, blob, *times in rows:
            if s >= 0:
                firsts.append((s, blob))
                break
            long, shard = divmod(-1 - s, side * side)
            blocks.append(("trigram" if long else "bigram", shard, 0, *times, 0, 0))
        if blocks:
            yield _out(blocks, names, types)
        for s, blobs in _by_shard(itertools.chain(firsts, ((r[0], r[1]) for r in rows))):
            parts = [unpack(b) for b in blobs]
            h, *facts = (np.concatenate([p[k] for p in parts]) for k in range(7))
            del parts
            h, _, facts = merged(h, *facts)
            key = mix(h)  # a range shares the leading bits of its hashes, which seal() goes by
            by = np.argsort(key)
            put_array(folder, f"word-{s}", seal(key[by], *[c[by] for c in facts]))
            raw, preceding = facts[0], facts[1]
            yield _out([("word", s, int(preceding.sum()), *_times(preceding), int(raw.sum()), int((raw > 0).sum()))], names, types)

    return run


def discounts(t: list[int]) -> np.ndarray:
    """What is taken from counts 0, 1, 2 and 3 or more, by counts of counts; halves where those are too few to tell."""
    out = np.zeros(4)
    y = t[0] / (t[0] + 2 * t[1]) if t[0] + 2 * t[1] else 0.0
    for k in (1, 2, 3):
        d = k - (k + 1) * y * t[k] / t[k - 1] if t[k - 1] and t[k] else 0.5 * k
        out[k] = min(max(d, 0.05 * k), 0.95 * k)
    return out


class Settings:
    """Where the arrays are and the sums over all of them; this is all that tasks are sent."""

    def __init__(self, folder: str, side: int, ranges: int, order: int, rows: list) -> None:
        kinds = ("word", "bigram", "trigram")
        of = {kind: [r for r in rows if r["kind"] == kind] for kind in kinds}
        word, bigram, trigram = ({c: sum(r[c] for r in of[kind]) for c in SUMS} for kind in kinds)
        self.folder, self.side, self.ranges, self.order = folder, side, ranges, order
        # The manifest: which shards and ranges have arrays. One of these that is missing is an error, not an empty one.
        self.present = {kind: present(of[kind], ranges if kind == "word" else side * side) for kind in kinds}
        self.tokens, self.distinct, self.continuations = word["tokens"], word["distinct"], word["n"]
        self.word_times = [word[f"t{k}"] for k in (1, 2, 3, 4)]
        self.high = discounts([trigram[f"t{k}"] for k in (1, 2, 3, 4)])
        self.mid = discounts([bigram[f"t{k}"] for k in (1, 2, 3, 4)])
        self.low = discounts(self.word_times)


def train(docs: DataFrame, *, text_col: str = "text", order: int = ORDER) -> Settings:
    """Counts all texts and writes a model of order two or three to the shared folder."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = docs.sparkSession
    folder = shared_path(spark, "lm")
    # A shard is merged in one task's memory, so shards grow with the input where the session's partitions do not.
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0  # frames that cannot tell claim more than there is
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), known // SHARD_BYTES)
    side = max(4, math.isqrt(partitions))
    ranges = max(4, partitions // 2)
    blocks = bounded(docs.select(F.col(text_col).alias("text"))).mapInArrow(_count(side, order), PASSED_SQL)
    with brief_shuffles(spark):
        if order == 3:
            # Written, so that the trigrams' shuffle is gone before the bigrams are dealt.
            dealt = blocks.repartition(side * side, "shard").sortWithinPartitions("shard")
            merged_ = bounded(dealt).mapInArrow(_trigrams(folder, side), PASSED_SQL)
            merged_.write.option("compression", "none").parquet(f"{folder}-blocks")
            blocks = spark.read.schema(PASSED_SQL).parquet(f"{folder}-blocks")
        dealt = blocks.repartition(side * side, "shard").sortWithinPartitions("shard")
        facts = bounded(dealt).mapInArrow(_bigrams(folder, ranges, order), PASSED_SQL)
        sums = facts.repartition(ranges, "shard").sortWithinPartitions("shard").mapInArrow(
            _words(folder, side), "kind string, shard long, n long, t1 long, t2 long, t3 long, t4 long, tokens long, distinct long"
        )
        # A few sums, and a bit for each range and shard.
        number = F.col("shard") + 1
        rows = sums.groupBy("kind", F.bitmap_bucket_number(number).alias("part")).agg(
            *[F.sum(c).alias(c) for c in SUMS], F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
        ).collect()
    drop(spark, f"{folder}-blocks")
    return Settings(folder, side, ranges, order, rows)


# Scoring ----------------------------------------------------------------------------------------------------------


class Model:
    """The arrays of a model, mapped when first needed."""

    def __init__(self, settings: Settings) -> None:
        self.s, self.open = settings, {}
        c = max(settings.continuations, 1)
        t = settings.word_times
        more = max(settings.distinct - t[0] - t[1], 0)
        spare = (settings.low[1] * t[0] + settings.low[2] * t[1] + settings.low[3] * more) / c
        self.floor = (spare if settings.continuations else 1.0) / (settings.distinct + 1)
        self.unit = c

    def array(self, name: str) -> Sorted:
        if name not in self.open:
            self.open[name] = Sorted(map_array(self.s.folder, name))
        return self.open[name]

    def words(self, h: np.ndarray) -> np.ndarray:
        """Facts of distinct ascending hashes, zeros for unknown ones: raw, preceding, total, n1, n2, n3."""
        out = np.zeros((len(h), 6), np.int64)
        edge = np.searchsorted(bands(h, self.s.ranges), np.arange(self.s.ranges + 1))
        for r in np.flatnonzero(np.diff(edge)):
            if self.s.present["word"][r]:
                out[edge[r] : edge[r + 1]] = self.array(f"word-{r}").find(mix(h[edge[r] : edge[r + 1]]))
        return out.T

    def grams(self, kind: str, key: np.ndarray, across: np.ndarray, down: np.ndarray) -> np.ndarray:
        """Facts of n-grams, a row each; their shards go by the hashes ``across`` and ``down``."""
        side = self.s.side
        shard = bands(across, side) * side + bands(down, side)
        by = np.argsort(key)
        by = by[np.argsort(shard[by], kind="stable")]
        found, first = np.unique(shard[by], return_index=True)
        out = np.zeros((len(key), 5 if kind == "bigram" and self.s.order == 3 else 1), np.int64)
        if not len(key):
            return out
        for s, own in zip(found.tolist(), np.split(by, first[1:]), strict=True):
            if self.s.present[kind][s]:
                out[own] = self.array(f"{kind}-{s}").find(key[own])
        return out

    def score(self, t: Texts) -> list[np.ndarray]:
        """By text: n_tokens, n_known, base_score, score."""
        context, word, doc = tokens(t)
        names, where = np.unique(np.concatenate([context, word]), return_inverse=True)
        facts = self.words(names)
        c, w = where[: len(context)], where[len(context) :]
        raw, preceding = facts[0], facts[1]
        low = np.maximum(preceding - self.s.low[np.minimum(preceding, 3)], 0) / self.unit + self.floor
        total = facts[2]
        spare = _spare(self.s.mid, total, facts[3:].T)
        pair, back = np.unique(c * np.int64(len(names)) + w, return_inverse=True)
        pc, pw = pair // len(names), pair % len(names)
        key = join(names[pc], names[pw])
        known = self.grams("bigram", key, names[pc], names[pw])
        n = known[:, 0]
        p = (np.maximum(n - self.s.mid[np.minimum(n, 3)], 0) / np.maximum(total[pc], 1) + spare[pc] * low[pw])[back]
        if self.s.order == 3:
            # A token's context is the bigram before it; the first token of a text has none.
            on = np.flatnonzero(context != START)
            pre = back[on - 1]
            full, left = known[pre, 1], _spare(self.s.high, known[:, 1], known[:, 2:])[pre]
            n = np.zeros(len(on), np.int64)
            ask = np.flatnonzero((full > 0) & (known[back[on], 0] > 0))
            at = on[ask]
            gram = mix(key[pre[ask]] * U(BASE) + word[at])
            n[ask] = self.grams("trigram", gram, context[at], context[at - 1])[:, 0]
            p[on] = np.maximum(n - self.s.high[np.minimum(n, 3)], 0) / np.maximum(full, 1) + left * p[on]
        base = np.log10((raw + 1) / (self.s.tokens + self.s.distinct + 1))
        many = len(t)
        return [
            np.bincount(doc, minlength=many),
            np.bincount(doc, weights=raw[w] > 0, minlength=many).astype(np.int64),
            np.bincount(doc, weights=base[w], minlength=many),
            np.bincount(doc, weights=np.log10(p), minlength=many),
        ]


def _spare(cut: np.ndarray, total: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The share that contexts leave to the lower order; all of it where a context is unknown."""
    out = np.ones(len(total))
    seen = total > 0
    out[seen] = (times @ cut[1:])[seen] / total[seen]
    return out


def _score(settings: Settings, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(settings)
        for batch in batches:
            for i, j, t in slices(batch.column(0)):
                n, known, base, score = model.score(t)
                cols = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score)]
                yield pa.record_batch([*cols, *batch.slice(i, j - i).columns[1:]], names=names)

    return run


def score(docs: DataFrame, settings: Settings, *, text_col: str = "text") -> DataFrame:
    """All documents with n_tokens, n_known, train_tokens, base_score, score and perplexity (named afresh on a clash)."""
    n, known, total, base, full, perplexity = fresh(
        docs, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    rows = docs.select(F.col(text_col), *[F.col(c) for c in docs.columns])
    added = f"`{n}` long, `{known}` long, `{base}` double, `{full}` double"
    out = bounded(rows).mapInArrow(_score(settings, [n, known, base, full, *docs.columns]), f"{added}, {fields}")
    return out.withColumn(total, F.lit(settings.tokens).cast("long")).withColumn(
        perplexity, F.pow(F.lit(10.0), -F.col(full) / F.col(n))
    ).select(*docs.columns, n, known, total, base, full, perplexity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    settings = train(docs.where(fold != HELD_OUT))
    out = score(docs.withColumn("held_out", fold == HELD_OUT), settings)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
