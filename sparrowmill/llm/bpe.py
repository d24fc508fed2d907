r"""Byte-level BPE by corpus-level merge replay, and decoding.

1. Texts are cut into pieces by the pattern, in numpy over the bytes of many texts. About BLOCK bytes of text are a block: a
   list of its distinct pieces by hash and, by document, the numbers of its pieces in that list.
2. The distinct pieces of all blocks are dealt to shards by hash, so equal pieces of the corpus meet in one task. There the
   distinct ones are laid out as one sequence of symbols with links to neighbours. An inverted index leads from each
   merge, by rank, to the positions whose pair it joins; merges are replayed in rank order over all pieces at once, and
   a merge touches only its positions and their neighbours, whose new pairs enter the index. Within a piece this is the
   order of the reference algorithm: the lowest rank first, then the leftmost pair. Should a merge uncover a lower rank,
   the piece's other positions wait until that is done. A shard beyond REPLAYED bytes is taken in parts.
3. The ids go back to their blocks, which turn into documents' ids. What is shuffled is numbers of pieces and, once a block,
   distinct pieces: no group is larger than a block, however frequent a piece is.

Tokens are stored packed, four bytes each, little endian. Pieces are told apart within a block by 64-bit hashes.

Defined cases: a null or empty text has no tokens and decodes to nothing; control words of a tokenizer in a text are
plain text; repeated rows have equal tokens; texts and single pieces of any length are encoded whole; an empty table
gives no rows. Other columns pass through.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, fresh, table, written
from .textbatch import CHUNK, U, _power, mix

#: Bytes of text in a block (a longer text is one alone), and of distinct pieces that are replayed together.
BLOCK, REPLAYED = 1 << 22, 3 << 19
#: The pattern that is cut in numpy: contractions; letters, numbers or marks, with a space before; white space.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Batches of positions under this size are merged one by one.
FEW = 60


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# Pieces -----------------------------------------------------------------------------------------------------------


@lru_cache(1)
def kinds() -> np.ndarray:
    """Of each code point: 1 letter, 2 number, 3 white space, 0 anything else, as the pattern's classes have it."""
    out = np.zeros(0x110000, np.uint8)
    gap = 0xD800, 0x800  # surrogates are no characters
    every = "".join(map(chr, [*range(gap[0]), *range(sum(gap), len(out))]))
    for kind, cls in enumerate((r"\p{L}+", r"\p{N}+", r"\s+"), 1):
        for m in regex.finditer(cls, every):
            a, b = (x + gap[1] * (x > gap[0]) for x in m.span())
            out[a:b] = kind
    out[gap[0] : sum(gap)] = 0
    return out


def piece_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the matches of PATTERN begin in a buffer of UTF-8 texts. They leave no byte out."""
    n = len(buf)
    of = kinds()
    kind, head = of[buf], np.ones(n, bool)
    after = np.concatenate([buf, np.zeros(3, np.uint8)])
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        size = 2 + (buf[lead] >= 0xE0) + (buf[lead] >= 0xF0)
        point = buf[lead].astype(np.int32) & (0x7F >> size)
        for k in (1, 2, 3):
            point = np.where(k < size, point << 6 | (after[lead + k] & 63), point)
        for k in (0, 1, 2, 3):
            own = k < size
            kind[lead[own] + k] = of[point[own]]
            head[lead[own] + k] = k == 0
    first = np.zeros(n + 4, bool)  # of a text, or beyond the last
    first[offsets] = True
    first[n:] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    out = run.copy()
    # White space before something else gives up its last character: a space goes with what follows, others stand alone.
    last = np.flatnonzero(run[1:] & (kind[:-1] == 3) & ~first[1:n])
    at = last.copy()
    while (inside := ~head[at]).any():
        at[inside] -= 1
    out[at] = True
    out[last[buf[last] == 32] + 1] = False
    # A contraction starts a run of marks that no space precedes, and ends before the letters that are left.
    mark = np.flatnonzero((buf == 39) & run)
    mark = mark[first[mark] | (buf[mark - 1] != 32)]
    a, b = after[mark + 1], after[mark + 2]
    one = np.isin(a, list(b"stmd")) & ~first[mark + 1]
    two = (np.isin(a, list(b"rv")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))) & ~(first[mark + 1] | first[mark + 2])
    for hit, size in ((one, 2), (two, 3)):
        out[mark[hit] + 1] = False
        end = mark[hit] + size
        out[end[end < n]] = True
    return np.flatnonzero(out)


def cut_pieces(buf: np.ndarray, offsets: np.ndarray, pattern: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, edges of its pieces, of each text where its pieces begin) for a buffer of UTF-8 texts."""
    if pattern == PATTERN:
        starts = piece_starts(buf, offsets)
        return buf, np.append(starts, len(buf)), np.searchsorted(starts, offsets)
    raw, find = buf.tobytes(), regex.compile(pattern).findall
    found = [[w.encode() for w in find(raw[a:b].decode())] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    every = [w for ws in found for w in ws]
    edges = np.cumsum([0, *map(len, every)])
    return np.frombuffer(b"".join(every), np.uint8), edges, np.cumsum([0, *map(len, found)])


_BYTES = mix(np.arange(1, 257, dtype=U) * U(0xD1B54A32D192ED03))


def piece_hashes(buf: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.empty(len(edges) - 1, U)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(edges, edges[i] + CHUNK, "right")) - 1)
        part = buf[edges[i] : edges[j]]
        up, down = _power(len(part))
        total = np.zeros(len(part) + 1, U)
        np.cumsum(_BYTES[part] * up[: len(part)], out=total[1:])
        at = edges[i : j + 1] - edges[i]
        out[i:j] = mix((total[at[1:]] - total[at[:-1]]) * down[at[:-1]]) + (at[1:] - at[:-1]).astype(U)
        i = j
    return out


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``size`` steps, one stretch after the other."""
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Stretches of a buffer as an array of binaries."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a column of texts or binaries; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, where, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def distinct(buf: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(of each piece its number, the distinct pieces)."""
    coded = pa.array(piece_hashes(buf, edges)).dictionary_encode()
    code = coded.indices.to_numpy()
    first = np.empty(len(coded.dictionary), np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    size = edges[first + 1] - edges[first]
    return code, binary(buf[spread(edges[first], size)], size)


# Merges -----------------------------------------------------------------------------------------------------------


class Merges:
    """A vocabulary by rank: its bytes, and all pairs of tokens that join to one."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.width = max(ranks.values()) + 1
        sizes = np.zeros(self.width, np.int64)
        names: list[bytes] = [b""] * self.width
        for b, r in ranks.items():
            names[r], sizes[r] = b, len(b)
        self.sizes, self.bytes = sizes, np.frombuffer(b"".join(names), np.uint8)
        self.starts = np.cumsum(sizes) - sizes
        self.packed = "<u2" if self.width <= 1 << 16 else "<u4"
        self.symbols = np.array([ranks[bytes([b])] for b in range(256)])
        joined = {}
        for b, r in ranks.items():
            for k in range(1, len(b)):
                left, right = ranks.get(b[:k]), ranks.get(b[k:])
                if left is not None and right is not None:
                    joined[left * self.width + right] = r
        self.keys = np.array(sorted(joined))
        self.ranks = np.array([joined[k] for k in self.keys.tolist()])
        # Tokens that are part of one of lower rank: after making them, that one comes first.
        low = self.ranks < np.maximum(self.keys // self.width, self.keys % self.width)
        self.uncovers = np.zeros(self.width, bool)
        for part in (self.keys[low] // self.width, self.keys[low] % self.width):
            self.uncovers[part[part > self.ranks[low]]] = True

    @cached_property
    def table(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "_first")}

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of neighbours joined, or -1."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def replay(self, buf: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, one piece after the other; of each piece how many), by replaying all merges in rank order."""
        n, width = len(buf), self.width
        sizes = np.diff(edges)
        piece = np.repeat(np.arange(len(sizes)), sizes)
        symbol = self.symbols[buf]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[edges[1:][sizes > 0] - 1] = -1
        before[edges[:-1][sizes > 0]] = -1
        # The index: for each rank, the positions whose pair it joins. The rank of each position's pair is kept with it.
        rank = np.full(n, -1)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self._first[buf[inner], buf[inner + 1]]
        paired = np.flatnonzero(rank >= 0)
        paired = paired[np.argsort(rank[paired], kind="stable")]
        heap, starts = np.unique(rank[paired], return_index=True)
        heap = heap.tolist()
        given = dict(zip(heap, np.split(paired, starts[1:]), strict=True)) if heap else {}
        index: defaultdict[int, list[int]] = defaultdict(list)
        get, pop, push = self.table.get, heapq.heappop, heapq.heappush
        s, nx, pv, rk, pc = (memoryview(x) for x in (symbol, after, before, rank, piece))

        def enter(q: int, i: int) -> None:
            entries = index[q]
            if not entries:
                push(heap, q)
            entries.append(i)

        while heap:
            r = pop(heap)
            at, early = index.pop(r, []), given.pop(r, None)
            if early is not None:
                at = np.append(early, np.array(at, np.int64)) if at else early
            if len(at) < FEW:
                waiting = -1
                for i in sorted(at):
                    if rk[i] != r:
                        continue
                    w = pc[i]
                    if w == waiting:
                        enter(r, i)
                        continue
                    j = nx[i]
                    k = nx[j]
                    s[i], s[j], nx[i], rk[i], rk[j] = r, -1, k, -1, -1
                    if k >= 0:
                        pv[k] = i
                        q = get(r * width + s[k], -1)
                        if q >= 0:
                            rk[i] = q
                            enter(q, i)
                            if q < r:
                                waiting = w
                    h = pv[i]
                    if h >= 0:
                        q = get(s[h] * width + r, -1)
                        rk[h] = q
                        if q >= 0:
                            enter(q, h)
                            if q < r:
                                waiting = w
                continue
            at = np.unique(np.asarray(at))
            at = at[rank[at] == r]
            if self.uncovers[r]:
                # A piece's later positions wait for what its first one may uncover.
                own = piece[at]
                later = np.flatnonzero(own[1:] == own[:-1]) + 1
                if len(later):
                    given[r] = at[later]
                    push(heap, r)
                    at = np.delete(at, later)
            elif len(at) > 1 and (chained := after[at[:-1]] == at[1:]).any():
                # Pairs that overlap: every other one, from the left.
                link = np.append(False, chained)
                begin = np.maximum.accumulate(np.where(link, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - begin) % 2 == 0]
            j = after[at]
            k = after[j]
            symbol[at], symbol[j], after[at], rank[at], rank[j] = r, -1, k, -1, -1
            some = k >= 0
            before[k[some]] = at[some]
            right = at[some]
            left = before[at]
            left = left[left >= 0]
            touched = np.concatenate([right, left])
            # A neighbour on the left may be a position of this batch too; then it is looked at with its new symbol.
            q = self.joined(symbol[touched], symbol[after[touched]])
            rank[touched] = q
            hit = q >= 0
            for x, i in zip(q[hit].tolist(), touched[hit].tolist(), strict=True):
                entries = index[x]
                if not entries:
                    push(heap, x)
                entries.append(i)
        alive = symbol >= 0
        return symbol[alive].astype("<u4"), np.bincount(piece[alive], minlength=len(sizes))

    @cached_property
    def _first(self) -> np.ndarray:
        a, b = np.divmod(np.arange(65536), 256)
        return self.joined(self.symbols[a], self.symbols[b]).reshape(256, 256)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens, one after the other."""
        return self.bytes[spread(self.starts[ids], self.sizes[ids])]

    def encode(self, texts: list[str], pattern: str = PATTERN) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers; for texts that are at hand."""
        buf, edges, bounds = cut_pieces(*flat(pa.array(texts, pa.string())), pattern)
        code, pieces = distinct(buf, edges)
        data, at = flat(pieces)
        ids, sizes = self.replay(data, at)
        n = sizes[code]
        out = ids[spread((np.cumsum(sizes) - sizes)[code], n)]
        ends = np.append(0, np.cumsum(n))[bounds]
        return [out[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


# Blocks -----------------------------------------------------------------------------------------------------------


def pack(sizes: np.ndarray, data: np.ndarray) -> bytes:
    """Stretches of bytes, compressed: how many, whether a size takes four bytes, the length of it all, and that."""
    wide = int(sizes.max(initial=0)) > 255
    raw = sizes.astype("<u4" if wide else "u1").tobytes() + data.tobytes()
    return np.array([len(sizes), wide, len(raw)], "<u4").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, wide, size = np.frombuffer(blob[:12], "<u4").tolist()
    raw = np.frombuffer(pa.decompress(blob[12:], size, codec="zstd", asbytes=True), np.uint8)
    split = n * (4 if wide else 1)
    return raw[:split].view("<u4" if wide else "u1").astype(np.int64), raw[split:]


class Block:
    """Some documents: of each piece its number among the distinct ones, which stand by hash and so by shard."""

    def __init__(self, number: int, rows: pa.Table, pattern: str) -> None:
        self.number, self.rows = number, rows
        buf, edges, self.bounds = cut_pieces(*flat(rows.column(0)), pattern)
        coded = pa.array(piece_hashes(buf, edges)).dictionary_encode()
        code, names = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        first = np.empty(len(names), np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        order = np.argsort(names)
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        self.code, self.hashes, first = rank[code], names[order], first[order]
        self.starts, self.sizes = edges[first], edges[first + 1] - edges[first]
        self.buf = buf

    def mark(self, a: int, b: int) -> int:
        """A sum over hashes, by which both readings of a table are compared."""
        return int(self.hashes[a:b].sum(dtype=U).astype(np.int64))


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, most: int) -> Iterator[Block]:
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        _, offsets = flat(batch.column(0))
        i = 0
        while i < len(batch):
            j = max(i + (not held), int(np.searchsorted(offsets, offsets[i] + most - size, "right")) - 1)
            if j > i:
                held.append(batch.slice(i, j - i))
                size += int(offsets[j] - offsets[i])
                i = j
            if i < len(batch):
                yield Block(number, pa.Table.from_batches(held), pattern)
                number, held, size = number + 1, [], 0
    if held:
        yield Block(number, pa.Table.from_batches(held), pattern)


def _number(pattern: str, most: int, names: list[str]):
    """Texts and other columns -> a row (block, at, n pieces, null, others) a document, and (block, -1, mark, numbers, nulls) a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, pattern, most):
            n = len(b.rows)
            rest = [c.combine_chunks() for c in b.rows.columns[1:]]
            # Bytes of equal weight stand together: the high ones are mostly alike.
            planes = b.code.astype("<u4").view(np.uint8).reshape(-1, 4).T.copy()
            blob = pack(np.zeros(0, np.int64), planes)
            one = [pa.array([b.number]), pa.array([-1], pa.int32()), pa.array([b.mark(0, len(b.hashes))]), pa.array([blob], pa.binary())]
            yield pa.record_batch([*one, *[pa.nulls(1, c.type) for c in rest]], names=names)
            own = [pa.array(np.full(n, b.number)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.diff(b.bounds).astype(np.int64)), pa.nulls(n, pa.binary())]
            yield from pa.Table.from_arrays([*own, *rest], names=names).to_batches()

    return run


def _deal(pattern: str, most: int, shards: int):
    """Texts -> (shard, block, mark, distinct pieces)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, pattern, most):
            shard = ((b.hashes >> U(32)) * U(shards) >> U(32)).astype(np.int64)
            some, edge = np.unique(shard, return_index=True)
            edge = np.append(edge, len(shard)).tolist()
            spans = list(zip(edge[:-1], edge[1:], strict=True))
            blobs = [pack(b.sizes[i:j], b.buf[spread(b.starts[i:j], b.sizes[i:j])]) for i, j in spans]
            cols = [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), b.number)), pa.array([b.mark(i, j) for i, j in spans], pa.int64())]
            yield pa.record_batch([*cols, pa.array(blobs, pa.binary())], names=["shard", "block", "mark", "blob"])

    return run


def _replay(shipped, most: int):
    """(shard, block, mark, pieces), shard by shard -> (block, shard, mark, ids)."""

    def close(rows: list[tuple], merges: Merges) -> Iterator[pa.RecordBatch]:
        found = [unpack(r[3]) for r in rows]
        sizes, data = (np.concatenate(x) for x in zip(*found, strict=True))
        coded = binary(data, sizes).dictionary_encode()
        code = coded.indices.to_numpy()
        ids, many = merges.replay(*flat(coded.dictionary))
        ids = ids.astype(merges.packed)
        start = np.cumsum(many) - many
        edge = np.cumsum([0, *[len(s) for s, _ in found]]).tolist()
        for (shard, block, mark, _), a, b in zip(rows, edge[:-1], edge[1:], strict=True):
            own = code[a:b]
            blob = pack(many[own], ids[spread(start[own], many[own])])
            cols = [pa.array([block]), pa.array([shard], pa.int32()), pa.array([mark], pa.int64()), pa.array([blob], pa.binary())]
            yield pa.record_batch(cols, names=["block", "shard", "mark", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                raw = int.from_bytes(row[3][8:12], "little")
                if held and (size + raw > most if row[0] != held[-1][0] else size + raw > 2 * most):
                    yield from close(held, shipped.value)
                    held, size = [], 0
                held.append(row)
                size += raw
        if held:
            yield from close(held, shipped.value)

    return run


def _finish(shipped, names: list[str], every: list[str], decoded: bool):
    """A block's documents and the ids of its pieces -> documents with their ids."""

    def run(docs: pa.Table, pieces: pa.Table) -> pa.Table:
        merges = shipped.value
        docs = docs.sort_by("at")
        blob, mark = docs.column("blob")[0].as_py(), docs.column("n")[0].as_py()
        docs = docs.slice(1)
        _, planes = unpack(blob)
        code = planes.reshape(4, -1).T.copy().view("<u4").ravel()
        pieces = pieces.sort_by("shard")
        marks = np.array(pieces.column("mark").to_pylist(), np.int64)
        if int(marks.sum(dtype=np.int64)) != mark:
            raise RuntimeError("the table read differently the second time; write it before encoding it")
        found = [unpack(x) for x in pieces.column("blob").to_pylist()]
        many = np.concatenate([np.zeros(0, np.int64), *[s for s, _ in found]])
        ids = np.concatenate([np.zeros(0, np.uint8), *[d for _, d in found]]).view(merges.packed)
        start = np.cumsum(many) - many
        n = many[code]
        out = ids[spread(start[code], n)].astype("<u4")
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(docs.column("n").to_numpy()))]
        counts = np.diff(ends)
        cols = [pa.array(counts, pa.int64()), binary(out.view(np.uint8), 4 * counts)]
        if decoded:
            sizes = np.append(0, np.cumsum(merges.sizes[out]))[ends]
            cols.append(binary(merges.decode(out), np.diff(sizes)))
        return pa.table([*[docs.column(c) for c in every], *cols], names=[*every, *names])

    return run


def _rereads(df: DataFrame) -> bool:
    """Whether a frame comes from files or given rows by projections and filters alone, and so is the same each time it is read."""
    plan = df._jdf.queryExecution().optimizedPlan()
    steps = re.findall(r"^[\s:+-]*(\w+)", plan.toString(), re.M)
    return plan.deterministic() and set(steps) <= {"Project", "Filter", "Relation", "LocalRelation", "LogicalRDD"}


def tokenize(
    docs: DataFrame,
    merges: Merges,
    pattern: str = PATTERN,
    *,
    text_col: str = "text",
    keep: list[str] | None = None,
    decoded: bool = True,
) -> DataFrame:
    """All documents with n_tokens, tokens (packed ids) and, if asked for, decoded (bytes); named afresh on a clash.

    Of their columns those in ``keep`` are returned, by default all. Texts are read twice, once for their distinct pieces
    and once for their numbers, which takes less disk than to write what lies between; a table that may come in another
    order the second time is written first.
    """
    spark = docs.sparkSession
    kept = docs.columns if keep is None else keep
    names = fresh(docs, "n_tokens", "tokens", "decoded")[: 3 if decoded else 2]
    inner, made = [f"c{k}" for k in range(len(kept))], [f"t{k}" for k in range(len(names))]
    fields = "".join(f", {c} {docs.schema[k].dataType.simpleString()}" for c, k in zip(inner, kept, strict=True))
    rows = docs.select(F.col(text_col).alias("text"), *[F.col(k).alias(c) for c, k in zip(inner, kept, strict=True)])
    rows = bounded(rows if _rereads(docs) else written(rows, "texts"))
    # The vocabulary is of a fixed size.
    shipped = spark.sparkContext.broadcast(merges)
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("text").mapInArrow(_deal(pattern, BLOCK, shards), "shard int, block long, mark long, blob binary")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    ids = dealt.mapInArrow(_replay(shipped, REPLAYED), "block long, shard int, mark long, blob binary")
    head = ["block", "at", "n", "blob"]
    own = rows.mapInArrow(_number(pattern, BLOCK, [*head, *inner]), f"block long, at int, n long, blob binary{fields}")
    added = ", ".join(f"{c} {t}" for c, t in zip(made, ("long", "binary", "binary"), strict=False))
    whole = own.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(
        _finish(shipped, made, inner, decoded), f"{fields}, {added}".removeprefix(", ")
    )
    return whole.select(*[F.col(a).alias(b) for a, b in zip([*inner, *made], [*kept, *names], strict=True)])


def public_merges() -> Merges:
    """The merges of the installed public vocabulary."""
    import public_tokenizers

    return Merges(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokenize(docs, public_merges(), public_tokenizers.PATTERN, keep=["doc_id"])
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
