r"""Media columns: progressive JPEG, read into coefficients and full-resolution RGB tensors.

Reading: spectral-selection and successive-approximation scans are accumulated into one coefficient array a component;
the inverse transform is a matrix product in numpy, chroma is upsampled to the size of the image, and RGB tensors come
out. Huffman streams are read in lock-step: every restart interval of every image of a batch is a lane, and one numpy
step reads one symbol in all lanes. Correction bits of refinements need no step of their own: a symbol says how many
follow, and they are taken out together at the end of the scan.

Writing: a payload is stored losslessly as coefficients. Each 64 bytes, less 128, are one block in zigzag order, and
blocks fill the Y, then Cb, then Cr plane of a 4:2:0 image; unused blocks are zero. Quantisers are 1. Scans: DC without
its last bit, AC 1-5 and 6-63 of each component without theirs, then both refinements. The payload's length is in an
APP11 segment. Equal payloads give equal files.

Defined cases: a null text is an empty one, whose payload is 64 zero bytes; payloads are padded to a positive multiple
of 64; a very long text is one image of its own; a file that is damaged or no progressive
JPEG gets an error in place of pixels (helpers for a single file raise ValueError); an empty table gives no rows; repeated rows are separate
rows. Other columns pass through.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, fresh, table

#: MCUs in a restart interval, and payload bytes of a batch.
INTERVAL, CHUNK = 4, 1 << 20
U64 = np.uint64


@lru_cache
def zigzag() -> np.ndarray:
    """Natural position of each coefficient in zigzag order."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (sum(x), x[0] if sum(x) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


@lru_cache
def inverse_transform() -> np.ndarray:
    """64 zigzag coefficients times this are 64 samples."""
    k, x = np.arange(8)[:, None], np.arange(8)[None, :]
    one = np.cos((2 * x + 1) * k * math.pi / 16) * np.where(k == 0, math.sqrt(1 / 8), 0.5)
    return np.kron(one, one)[zigzag()].astype(np.float32)


# Huffman tables ---------------------------------------------------------------------------------------------------


def ac_lengths() -> dict[int, int]:
    """Four bits for coefficients without zeros before them, for the end of a block and for 16 zeros; nine for the rest."""
    short = [0x00, *range(1, 9), 0xF0]
    rest = [r << 4 | s for r in range(16) for s in range(11) if (r << 4 | s) not in short]
    return dict.fromkeys(short, 4) | dict.fromkeys(rest, 9)


def dc_lengths() -> dict[int, int]:
    return dict.fromkeys(range(12), 4)


def segment_of(lengths: dict[int, int]) -> bytes:
    """The counts by length and the symbols of a table."""
    symbols = sorted(lengths, key=lambda s: (lengths[s], s))
    return bytes(sum(1 for v in lengths.values() if v == n) for n in range(1, 17)) + bytes(symbols)


def codes(segment: bytes) -> Iterator[tuple[int, int, int]]:
    """(symbol, code, length) of a table."""
    code, at = 0, 16
    for n in range(1, 17):
        for _ in range(segment[n - 1]):
            yield segment[at], code, n
            code, at = code + 1, at + 1
        code <<= 1


@lru_cache(maxsize=64)
def writer(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    code, length = np.zeros(256, U64), np.zeros(256, np.int64)
    for s, c, n in codes(segment):
        code[s], length[s] = c, n
    return code, length


@lru_cache(maxsize=64)
def reader(segment: bytes) -> np.ndarray:
    """For 16 bits to come: length * 256 + symbol, 0 where no code fits."""
    out = np.zeros(1 << 16, np.int64)
    for s, c, n in codes(segment):
        out[c << (16 - n) : (c + 1) << (16 - n)] = n << 8 | s
    return out


# Writing ----------------------------------------------------------------------------------------------------------


def category(v: np.ndarray) -> np.ndarray:
    """Bits of the magnitude."""
    return np.frexp(np.abs(v).astype(np.float64))[1].astype(np.int64)


def magnitude(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(v >= 0, v, v + (np.int64(1) << size) - 1).astype(U64)


def pack_lanes(value: np.ndarray, length: np.ndarray, lane: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of elements in order, each lane filled up with ones to whole bytes: (bytes, first byte of each lane)."""
    bits = np.bincount(lane, weights=length, minlength=lanes).astype(np.int64)
    fill = -bits % 8
    size = (bits + fill) // 8
    start = np.concatenate([[0], np.cumsum(size)])
    before = np.cumsum(length) - length
    base = np.concatenate([[0], np.cumsum(bits)])
    at = before - base[lane] + start[lane] * 8
    end = np.flatnonzero(fill)
    at = np.concatenate([at, start[end] * 8 + bits[end]])
    value = np.concatenate([value, (U64(1) << fill[end].astype(U64)) - U64(1)])
    length = np.concatenate([length, fill[end]])
    word, shift = at >> 5, (64 - (at & 31) - length).astype(U64)
    v = value << shift
    n = int(start[-1]) // 4 + 3
    # Bits never overlap, so sums are unions; a float holds 32 bits exactly.
    high = np.bincount(word, weights=(v >> U64(32)).astype(np.float64), minlength=n)
    low = np.bincount(word + 1, weights=(v & U64(0xFFFFFFFF)).astype(np.float64), minlength=n + 1)[:n]
    out = (high.astype(np.int64) + low.astype(np.int64)).astype(">u4").view(np.uint8)[: start[-1]]
    return out, start


def with_markers(raw: np.ndarray, start: np.ndarray, last: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stuffs bytes 255 and puts a restart marker after each lane that isn't the last of its scan: (bytes, lane starts)."""
    full = raw == 255
    stuffed = np.concatenate([[0], np.cumsum(full)])
    marks = np.concatenate([[0], np.cumsum(~last) * 2])
    begin = start + stuffed[start] + marks
    out = np.zeros(int(begin[-1]), np.uint8)
    lane = np.repeat(np.arange(len(last)), np.diff(start))
    out[np.arange(len(raw)) + stuffed[:-1] + marks[lane]] = raw
    at = begin[1:][~last] - 2
    out[at] = 255
    out[at + 1] = 0xD0 + number[~last] % 8
    return out, begin


def lanes_of(sizes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strips of units cut into lanes: (lane of each unit, is last of its strip, number in the strip, first lane by strip)."""
    many = -(-sizes // step)
    first = np.concatenate([[0], np.cumsum(many)])
    unit = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    number = np.arange(int(first[-1])) - np.repeat(first[:-1], many)
    last = np.zeros(int(first[-1]), bool)
    last[first[1:] - 1] = True
    return np.repeat(first[:-1], sizes) + unit // step, last, number, first


def write_scan(value, length, lane, strips) -> list[bytes]:
    """The entropy-coded bytes of each strip."""
    _, last, number, first = strips
    some = np.flatnonzero(length)
    raw, start = pack_lanes(value[some], length[some].astype(np.int64), lane[some], len(last))
    out, begin = with_markers(raw, start, last, number)
    data = out.tobytes()
    edge = begin[first]
    return [data[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


def joined(value: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring cells of each row made one while 32 bits hold them: the same bits in fewer cells."""
    while value.shape[1] > 1:
        if value.shape[1] % 2:
            value, length = (np.pad(x, ((0, 0), (0, 1))) for x in (value, length))
        both = length[:, ::2] + length[:, 1::2]
        if both.max(initial=0) > 32:
            break
        value, length = value[:, ::2] << length[:, 1::2].astype(U64) | value[:, 1::2], both
    return value, length


@lru_cache(maxsize=64)
def cells(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For 256 times the zeros before a coefficient and its value as a byte: its bits and how many; none for 0."""
    code, bits = writer(segment)
    v = np.arange(256).astype(np.uint8).view(np.int8).astype(np.int64)
    size = category(v)
    symbol = np.arange(16)[:, None] << 4 | size
    value, length = code[symbol] << size.astype(U64) | magnitude(v, size), bits[symbol] + size
    return np.where(v == 0, U64(0), value).ravel(), np.where(v == 0, 0, length).ravel().astype(np.int8)


def ac_first(c: np.ndarray, low: int, high: int, shift: int, table_: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a first scan of 8-bit coefficients: a cell for each, with zeros before it, and one for the end."""
    code, bits = writer(table_)
    part = c[:, low : high + 1]
    v = (part + (part < 0) * np.int16((1 << shift) - 1) >> shift).astype(np.int8)
    width = v.shape[1]
    here = np.where(v != 0, np.arange(width, dtype=np.int8), np.int8(-1))
    run = np.empty_like(here)
    run[:, 0] = 0
    np.maximum.accumulate(here[:, :-1], axis=1, out=run[:, 1:])
    run[:, 1:] = np.arange(width - 1, dtype=np.int8) - run[:, 1:]
    at = (run & 15).astype(np.int64) << 8 | v.view(np.uint8)
    values, lengths = np.zeros((len(c), width + 1), U64), np.zeros((len(c), width + 1), np.int8)
    value, length = cells(table_)
    values[:, :width], lengths[:, :width] = value[at], length[at]
    row, k = np.nonzero((run > 15) & (v != 0))
    skip = run[row, k] >> 4
    for n in (3, 2, 1):
        r, x = row[skip >= n], k[skip >= n]
        values[r, x] |= code[0xF0] << lengths[r, x].astype(U64)
        lengths[r, x] += np.int8(bits[0xF0])
    open_ = v[:, -1] == 0
    values[open_, width], lengths[open_, width] = code[0], bits[0]
    return values, lengths


def ac_refine(c: np.ndarray, low: int, high: int, shift: int, table_: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a refinement: before each coefficient a cell for a symbol, and one for its correction bit."""
    code, bits = writer(table_)
    part = c[:, low : high + 1]
    a = np.abs(part) >> shift
    width = a.shape[1]
    old, new = a > 1, a == 1
    values, lengths = np.zeros((len(c), width, 2), U64), np.zeros((len(c), width, 2), np.int8)
    values[:, :, 1], lengths[:, :, 1] = a & old, old
    values[:, :, 1] &= U64(1)
    # Without a new coefficient a block's end comes first; the others are gone through.
    some = new.any(axis=1)
    values[~some, 0, 0], lengths[~some, 0, 0] = code[0], bits[0]
    at = np.flatnonzero(some)
    part, a, new = part[at], a[at], new[at]
    zero = a == 0
    # Zeros are counted from the last new coefficient on; every 16th ends a symbol if a new coefficient follows.
    count = np.cumsum(zero, axis=1)
    mark = np.where(new, count, 0)
    since = np.zeros_like(count)
    since[:, 1:] = np.maximum.accumulate(mark, axis=1)[:, :-1]
    run = count - since
    later = np.zeros_like(new)
    later[:, :-1] = np.maximum.accumulate(new[:, ::-1], axis=1)[:, ::-1][:, 1:]
    stop = new | (zero & (run % 16 == 0) & later)
    row, k = np.nonzero(stop)
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    start = np.zeros(len(row), np.int64)
    start[1:] = k[:-1] + 1
    start[first] = 0
    is_new = new[row, k]
    symbol = np.where(is_new, (run[row, k] % 16) << 4 | 1, 0xF0)
    value, length = code[symbol], bits[symbol].copy()
    sign = (part[row, k] > 0).astype(U64)
    value = np.where(is_new, value << U64(1) | sign, value)
    length += is_new
    values[at[row], start, 0], lengths[at[row], start, 0] = value, length
    end = np.where(stop, np.arange(width), -1).max(axis=1, initial=-1) + 1
    left = np.flatnonzero(end < width)
    values[at[left], end[left], 0], lengths[at[left], end[left], 0] = code[0], bits[0]
    return values.reshape(len(c), -1), lengths.reshape(len(c), -1)


def marker(kind: int, body: bytes) -> bytes:
    return bytes((255, kind)) + (len(body) + 2).to_bytes(2, "big") + body


def scan_head(components: tuple[int, ...], low: int, high: int, before: int, shift: int) -> bytes:
    ids = b"".join(bytes((i + 1, 0)) for i in components)
    return marker(0xDA, bytes((len(components),)) + ids + bytes((low, high, before << 4 | shift)))


BANDS = ((1, 5), (6, 63))


@lru_cache(maxsize=4096)
def mcu_order(wide: int, tall: int) -> np.ndarray:
    """Blocks of a 4:2:0 image (Y, Cb, Cr planes after each other) in the order of interleaved scans: (mcus, 6)."""
    n = wide * tall
    r, c = np.divmod(np.arange(n), wide)
    y = (2 * r) * (2 * wide) + 2 * c
    return np.stack([y, y + 1, y + 2 * wide, y + 2 * wide + 1, 4 * n + np.arange(n), 5 * n + np.arange(n)], axis=1)


def shape_of(blocks: int) -> tuple[int, int]:
    mcus = max(-(-blocks // 6), 1)
    wide = math.isqrt(mcus - 1) + 1
    return wide, -(-mcus // wide)


def write(payloads: list[np.ndarray]) -> list[bytes]:
    """A progressive JPEG for each payload (bytes in multiples of 64)."""
    ac, dc = segment_of(ac_lengths()), segment_of(dc_lengths())
    shapes = [shape_of(len(p) // 64) for p in payloads]
    sizes = np.array([w * t for w, t in shapes], np.int64)
    c = np.zeros((int(sizes.sum()) * 6, 64), np.int16)
    at = np.concatenate([[0], np.cumsum(sizes * 6)])
    for p, a in zip(payloads, at[:-1], strict=True):
        c[a : a + len(p) // 64] = p.reshape(-1, 64).astype(np.int16) - 128
    # DC: interleaved, differences within a lane and component.
    order = np.concatenate([mcu_order(*s) + a for s, a in zip(shapes, at[:-1], strict=True)])
    dc_strips = lanes_of(sizes, INTERVAL)
    lane = dc_strips[0]
    fresh_lane = np.ones(len(lane), bool)
    fresh_lane[1:] = lane[1:] != lane[:-1]
    v = c[order, 0].astype(np.int64) >> 1
    diff = v.copy()
    diff[:, 1:4] -= v[:, :3]
    diff[1:, 0] -= np.where(fresh_lane[1:], 0, v[:-1, 3])
    for k in (4, 5):
        diff[1:, k] -= np.where(fresh_lane[1:], 0, v[:-1, k])
    code, bits = writer(dc)
    size = category(diff)
    value = code[size] << size.astype(U64) | magnitude(diff, size)
    by_mcu = np.repeat(lane, 6)
    dc_first = write_scan(value.ravel(), (bits[size] + size).ravel(), by_mcu, dc_strips)
    dc_last = write_scan((c[order, 0] & 1).astype(U64).ravel(), np.ones(order.size, np.int64), by_mcu, dc_strips)
    # AC: planes are strips of their own, one after the other.
    planes = (sizes[:, None] * np.array([4, 1, 1])).ravel()
    strips = lanes_of(planes, INTERVAL)

    def coded(found) -> list[bytes]:
        values, lengths = joined(*found)
        return write_scan(values.ravel(), lengths.ravel(), np.repeat(strips[0], lengths.shape[1]), strips)

    firsts = [coded(ac_first(c, a, b, 1, ac)) for a, b in BANDS]
    lasts = coded(ac_refine(c, 1, 63, 0, ac))
    tables = marker(0xC4, b"\x00" + dc) + marker(0xC4, b"\x10" + ac)
    fixed = marker(0xDB, b"\x00" + b"\x01" * 64)
    out = []
    for d, (p, (wide, tall)) in enumerate(zip(payloads, shapes, strict=True)):
        frame = b"\x08" + (16 * tall).to_bytes(2, "big") + (16 * wide).to_bytes(2, "big") + b"\x03\x01\x22\x00\x02\x11\x00\x03\x11\x00"
        parts = [b"\xff\xd8", marker(0xEB, b"payload\x00" + len(p).to_bytes(8, "big")), fixed, marker(0xC2, frame), tables]
        parts += [marker(0xDD, INTERVAL.to_bytes(2, "big")), scan_head((0, 1, 2), 0, 0, 0, 1), dc_first[d]]
        for (a, b), data in zip(BANDS, firsts, strict=True):
            for k in range(3):
                parts += [scan_head((k,), a, b, 0, 1), data[3 * d + k]]
        for k in range(3):
            parts += [scan_head((k,), 1, 63, 1, 0), lasts[3 * d + k]]
        parts += [scan_head((0, 1, 2), 0, 0, 1, 0), dc_last[d], b"\xff\xd9"]
        out.append(b"".join(parts))
    return out


# Reading ----------------------------------------------------------------------------------------------------------


class Image:
    """What a file's markers say, and its coefficients: a (tall, wide, 64) array a component, in zigzag order."""

    def __init__(self, data: bytes) -> None:
        self.data, self.quantisers, self.scans, self.payload_bytes, self.interval = data, {}, [], None, 0
        self.components, self.ids = [], ()
        raw = np.frombuffer(data, np.uint8)
        ff = np.flatnonzero(raw[:-1] == 255)
        after = raw[ff + 1]
        real = ff[(after != 0) & ((after < 0xD0) | (after > 0xD7))].tolist()
        tables: tuple[tuple[int, bytes], ...] = ()
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        at = 2
        while at < len(data) - 1:
            kind = data[at + 1]
            if kind == 0xD9:
                break
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if kind == 0xC2:
                if self.components:
                    raise ValueError("several frames")
                self.__dict__.update(frame_of(body))
            elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not a progressive JPEG file")
            elif kind == 0xC4:
                while body:
                    n = 17 + sum(body[1:17])
                    tables = (*(x for x in tables if x[0] != body[0]), (body[0], body[1:n]))
                    body = body[n:]
            elif kind == 0xDB:
                while body:
                    wide = 2 if body[0] >> 4 else 1
                    self.quantisers[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.float32)
                    body = body[1 + 64 * wide :]
            elif kind == 0xDD:
                self.interval = int.from_bytes(body[:2], "big")
            elif kind == 0xEB and body[:8] == b"payload\x00":
                self.payload_bytes = int.from_bytes(body[8:16], "big")
            elif kind == 0xDA:
                end = real[bisect.bisect_left(real, at)]
                which, key = scan_of(body, self.ids, tables)
                self.scans.append({"which": which, "key": key, "start": at, "end": end, "interval": self.interval})
                at = end
        if not self.components:
            raise ValueError("not a progressive JPEG file")

    def order(self, which: tuple[int, ...]) -> tuple[np.ndarray, tuple[int, ...]]:
        """Blocks in scan order (units, blocks of a unit), and which of the scan's components each column is."""
        if which not in self.orders:
            parts = tuple((c["start"], c["h"], c["v"], c["own"], c["blocks"]) for c in (self.components[w] for w in which))
            self.orders[which] = scan_order(self.mcus, parts)
        return self.orders[which]

    def passes(self) -> list[list[dict]]:
        """Scans that follow each other, are read alike and share no component are read in one pass."""
        out: list[list[dict]] = []
        for s in self.scans:
            if out and out[-1][0]["key"] == s["key"] and not any(set(s["which"]) & set(x["which"]) for x in out[-1]):
                out[-1].append(s)
            else:
                out.append([s])
        return out

    def shape(self) -> tuple:
        """What images that are transformed together have in common."""
        return self.body, tuple((k, q.tobytes()) for k, q in sorted(self.quantisers.items()))

    def planes(self, coefficients: np.ndarray) -> list[np.ndarray]:
        """Samples of each component, 8 bits; like all of these for one image or a stack of the same shape."""
        out = []
        for c in self.components:
            wide, tall = c["blocks"]
            own = coefficients[..., c["start"] : c["start"] + wide * tall, :].astype(np.float32)
            if (q := self.quantisers.get(c["q"])) is not None and q.max() > 1:
                own *= q
            x = own @ inverse_transform()
            x += 128.5
            np.clip(x, 0, 255, out=x)
            stack = x.shape[:-2]
            out.append(x.astype(np.uint8).reshape(*stack, tall, wide, 8, 8).swapaxes(-3, -2).reshape(*stack, tall * 8, wide * 8))
        return out

    def full_size(self, plane: np.ndarray, component: dict) -> np.ndarray:
        """A plane at the image's resolution, each sample repeated."""
        for axis, n in ((-2, self.most_v // component["v"]), (-1, self.most_h // component["h"])):
            if n > 1:
                plane = np.repeat(plane, n, axis=axis)
        return plane[..., : self.tall, : self.wide]

    def channels(self, coefficients: np.ndarray) -> np.ndarray:
        """The image at full resolution: (3, tall, wide), 8 bits."""
        planes = self.planes(coefficients)
        y = self.full_size(planes[0], self.components[0])
        if len(planes) < 3:
            return np.repeat(y[..., None, :, :], 3, axis=-3)
        blue, red = self.components[1], self.components[2]
        b, r = planes[1].astype(np.float32) - 128, planes[2].astype(np.float32) - 128
        out = np.empty((*y.shape[:-2], 3, self.tall, self.wide), np.uint8)
        y = y.astype(np.int16)
        if (blue["h"], blue["v"]) != (red["h"], red["v"]):
            b, r = self.full_size(b, blue), self.full_size(r, red)
            blue = red = self.components[0]
        # Luma is whole, so chroma's part can be rounded before it is upsampled.
        for k, part in enumerate((1.402 * r, -0.344136 * b - 0.714136 * r, 1.772 * b)):
            part = self.full_size(np.floor(part + 0.5).astype(np.int16), blue)
            out[..., k, :, :] = np.clip(y + part, 0, 255)
        return out

    def rgb(self, coefficients: np.ndarray) -> np.ndarray:
        """The image at full resolution: (tall, wide, 3), 8 bits."""
        return np.moveaxis(self.channels(coefficients), -3, -1)


@lru_cache(maxsize=4096)
def frame_of(body: bytes) -> dict:
    """What a frame's segment says; images of equal ones share it and its orders."""
    tall, wide, components = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"), []
    for k in range(body[5]):
        i, hv, q = body[6 + 3 * k : 9 + 3 * k]
        components.append({"id": i, "h": hv >> 4, "v": hv & 15, "q": q})
    most_h, most_v = max(c["h"] for c in components), max(c["v"] for c in components)
    mcus, start = (-(-wide // (8 * most_h)), -(-tall // (8 * most_v))), 0
    for c in components:
        # Blocks that scans of the component alone hold, and all that MCUs hold.
        c["own"] = -(-wide * c["h"] // (8 * most_h)), -(-tall * c["v"] // (8 * most_v))
        c["blocks"] = mcus[0] * c["h"], mcus[1] * c["v"]
        c["start"] = start
        start += c["blocks"][0] * c["blocks"][1]
    return {
        "body": body, "tall": tall, "wide": wide, "components": components, "ids": tuple(c["id"] for c in components), "most_h": most_h,
        "most_v": most_v, "mcus": mcus, "n_blocks": start, "orders": {},
    }


@lru_cache(maxsize=4096)
def scan_of(body: bytes, ids: tuple[int, ...], tables: tuple[tuple[int, bytes], ...]) -> tuple[tuple[int, ...], tuple]:
    """Which components a scan holds, and how it is read."""
    n, known = body[0], dict(tables)
    which = tuple(ids.index(body[1 + 2 * i]) for i in range(n))
    low, high, hl = body[1 + 2 * n : 4 + 2 * n]
    used = tuple((known.get(body[2 + 2 * i] >> 4), known.get(16 | body[2 + 2 * i] & 15)) for i in range(n))
    return which, (n, low, high, hl >> 4, hl & 15, used)


@lru_cache(maxsize=8192)
def scan_order(mcus: tuple[int, int], parts: tuple) -> tuple[np.ndarray, tuple[int, ...]]:
    if len(parts) == 1:
        start, _, _, (wide, tall), blocks = parts[0]
        r, k = np.divmod(np.arange(wide * tall), wide)
        return (start + r * blocks[0] + k)[:, None], (0,)
    r, k = np.divmod(np.arange(mcus[0] * mcus[1]), mcus[0])
    out, column = [], []
    for i, (start, h, v, _, blocks) in enumerate(parts):
        for y in range(v):
            for x in range(h):
                out.append(start + (r * v + y) * blocks[0] + k * h + x)
                column.append(i)
    return np.stack(out, axis=1), tuple(column)


class Bits:
    """Entropy-coded bytes of several scans: stuffing and markers taken out, lanes by restart markers."""

    def __init__(self, parts: list[bytes]) -> None:
        raw = np.frombuffer(b"".join(parts), np.uint8)
        edge = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        full = np.flatnonzero(raw[:-1] == 255) if len(raw) > 1 else np.zeros(0, np.int64)
        after = raw[full + 1]
        keep = np.ones(len(raw), bool)
        keep[full[after == 0] + 1] = False
        marks = full[(after >= 0xD0) & (after <= 0xD7)]
        keep[marks] = keep[marks + 1] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        begin = np.sort(np.concatenate([edge[:-1], marks]))
        self.first = kept[begin] * 8
        """Of each lane, its first bit."""
        self.lanes = np.diff(np.searchsorted(begin, edge))
        """Of each part, how many lanes it has."""
        self.raw = np.concatenate([raw[keep], np.zeros(8, np.uint8)])

    @cached_property
    def window(self) -> np.ndarray:
        """40 bits from each byte on."""
        b, n = self.raw.astype(U64), len(self.raw) - 4
        return b[:n] << U64(32) | b[1 : n + 1] << U64(24) | b[2 : n + 2] << U64(16) | b[3 : n + 3] << U64(8) | b[4 : n + 4]

    @cached_property
    def short(self) -> np.ndarray:
        """24 bits from each byte on."""
        b = self.raw.astype(np.int64)
        return b[:-2] << 16 | b[1:-1] << 8 | b[2:]

    @cached_property
    def single(self) -> np.ndarray:
        return np.unpackbits(self.raw)

    def peek(self, at: np.ndarray) -> np.ndarray:
        """32 bits from each position on."""
        return (self.window[np.minimum(at >> 3, len(self.window) - 1)] >> (8 - (at & 7)).astype(U64)).astype(np.int64) & 0xFFFFFFFF

    def bit(self, at: np.ndarray) -> np.ndarray:
        return self.single.take(at, mode="clip")


def extend(extra: np.ndarray, size: np.ndarray) -> np.ndarray:
    one = np.int64(1)
    return np.where((size > 0) & (extra < one << np.maximum(size - 1, 0)), extra - (one << size) + 1, extra)


def read_symbol(bits: Bits, at: np.ndarray, table_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, length of its code, 32 bits from its start)."""
    ahead = bits.peek(at)
    found = table_[ahead >> 16]
    if not found.all():
        raise ValueError("broken entropy-coded data")
    return found & 255, found >> 8, ahead


@lru_cache(maxsize=64)
def whole_codes(segment: bytes) -> np.ndarray:
    """For 16 bits to come that hold all of a coefficient, of 16 zeros or of a block's end: value, end, zeros and length; else 0."""
    found, ahead = reader(segment), np.arange(1 << 16)
    symbol, length = found & 255, found >> 8
    run, size = symbol >> 4, symbol & 15
    total = length + size
    value = extend(ahead >> np.maximum(16 - total, 0) & (1 << size) - 1, size)
    fits = (length > 0) & (total <= 16) & ((size > 0) | (run == 15) | (run == 0))
    return np.where(fits, value << 16 | (symbol == 0) << 12 | run << 8 | total, 0)


def read_dc(bits: Bits, c: np.ndarray, block: np.ndarray, count: np.ndarray, column: tuple[int, ...], key: tuple) -> None:
    """block: blocks of all lanes in order; count: how many each lane has; column: their components, in turn."""
    _, _, _, before, shift, used = key
    start = np.concatenate([[0], np.cumsum(count)])
    if before:
        at = np.repeat(bits.first, count) + np.arange(len(block)) - np.repeat(start[:-1], count)
        c[block, 0] |= bits.bit(at).astype(np.int16) << shift
        return
    at, guess = bits.first.copy(), np.zeros((len(count), len(used)), np.int64)
    for k in range(int(count.max(initial=0))):
        on = np.flatnonzero(count > k)
        i = column[k % len(column)]
        size, length, ahead = read_symbol(bits, at[on], reader(used[i][0]))
        extra = ahead >> (32 - length - size) & (np.int64(1) << size) - 1
        guess[on, i] += extend(extra, size)
        at[on] += length + size
        c[block[start[on] + k], 0] = guess[on, i] << shift


def read_ac_first(bits: Bits, c: np.ndarray, block: np.ndarray, count: np.ndarray, key: tuple) -> None:
    _, low, high, _, shift, used = key
    table_, quick = reader(used[0][1]), whole_codes(used[0][1])
    start = np.concatenate([[0], np.cumsum(count)])
    at, skip = bits.first.copy(), np.zeros(len(count), np.int64)
    for n in range(int(count.max(initial=0))):
        on = np.flatnonzero(count > n)
        idle = skip[on] > 0
        skip[on[idle]] -= 1
        on = on[~idle]
        k, pos, row = np.full(len(on), low, np.int64), at[on], block[start[on] + n]
        while len(on):
            found = quick[bits.short.take(pos >> 3, mode="clip") >> 8 - (pos & 7) & 0xFFFF]
            if found.all():
                pos += found & 255
                k += found >> 8 & 15
                value, end = found >> 16, found & 4096 > 0
                if value.all():
                    c[row, k] = value << shift
                else:
                    put = np.flatnonzero(value)
                    c[row[put], k[put]] = value[put] << shift
                k += 1
                done = end | (k > high)
                if done.any():
                    at[on[done]] = pos[done]
                    left = ~done
                    on, k, pos, row = on[left], k[left], pos[left], row[left]
                continue
            symbol, length, ahead = read_symbol(bits, pos, table_)
            run, size = symbol >> 4, symbol & 15
            end = (size == 0) & (run < 15)
            wide = np.where(end, run, size)
            extra = ahead >> (32 - length - wide) & (np.int64(1) << wide) - 1
            pos += length + wide
            k += run
            put = np.flatnonzero(size)
            c[row[put], k[put]] = extend(extra[put], size[put]) << shift
            k += 1
            done = end | (k > high)
            if done.any():
                ended = np.flatnonzero(end)
                skip[on[ended]] = (np.int64(1) << run[ended]) + extra[ended] - 1
                at[on[done]] = pos[done]
                left = ~done
                on, k, pos, row = on[left], k[left], pos[left], row[left]


def read_ac_refine(bits: Bits, c: np.ndarray, block: np.ndarray, count: np.ndarray, key: tuple) -> None:
    _, low, high, _, shift, used = key
    table_ = reader(used[0][1])
    start = np.concatenate([[0], np.cumsum(count)])
    width = high - low + 1
    part = c[block, low : high + 1]
    old = part != 0
    olds = np.zeros((len(block), width + 1), np.int16)
    np.cumsum(old, axis=1, out=olds[:, 1:])
    zeros = np.arange(width + 1, dtype=np.int16) - olds
    # Where each block's zeros are, in order; past the last of them stands the end.
    row, k = np.nonzero(~old)
    where = np.full((len(block), width + 17), width, np.int16)
    where[row, zeros[row, k]] = k
    flat = np.concatenate([[0], np.cumsum(olds[:, -1], dtype=np.int64)])
    at, skip = bits.first.copy(), np.zeros(len(count), np.int64)
    events: list[tuple] = []
    fresh_row, fresh_k, fresh_v = [], [], []
    for n in range(int(count.max(initial=0))):
        on = np.flatnonzero(count > n)
        r = start[on] + n
        k, pos = np.zeros(len(on), np.int64), at[on]
        closing = skip[on] > 0
        while len(on):
            active = np.flatnonzero(~closing)
            if len(active):
                symbol, length, ahead = read_symbol(bits, pos[active], table_)
                run, size = symbol >> 4, symbol & 15
                end = (size == 0) & (run < 15)
                wide = np.where(end, run, np.minimum(size, 1))
                extra = ahead >> (32 - length - wide) & (np.int64(1) << wide) - 1
                pos[active] += length + wide
                ended = active[end]
                skip[on[ended]] = (np.int64(1) << run[end]) + extra[end]
                closing[ended] = True
                go = active[~end]
                run, size, extra = run[~end], size[~end], extra[~end]
                to = where[r[go], np.minimum(zeros[r[go], k[go]] + run, width + 16)]
                a, b = olds[r[go], k[go]], olds[r[go], to]
                events.append((flat[r[go]] + a, (b - a).astype(np.int64), pos[go].copy()))
                pos[go] += b - a
                put = (size > 0) & (to < width)
                fresh_row.append(block[r[go[put]]])
                fresh_k.append(to[put] + low)
                fresh_v.append(np.where(extra[put] > 0, 1, -1) << shift)
                k[go] = to + 1
            shut = np.flatnonzero(closing)
            if len(shut):
                kk = np.minimum(k[shut], width)
                a, b = olds[r[shut], kk], olds[r[shut], width]
                events.append((flat[r[shut]] + a, (b - a).astype(np.int64), pos[shut].copy()))
                pos[shut] += b - a
                skip[on[shut]] -= 1
                k[shut] = width
            done = k >= width
            at[on[done]] = pos[done]
            left = ~done
            on, r, k, pos, closing = on[left], r[left], k[left], pos[left], closing[left]
    if events:
        first, many, pos = (np.concatenate([e[i] for e in events]) for i in range(3))
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        bit = np.zeros(int(flat[-1]), np.int16)
        bit[np.repeat(first, many) + step] = bits.bit(np.repeat(pos, many) + step)
        v = part[old]
        part[old] = v + np.sign(v) * (bit << shift)
        c[block, low : high + 1] = part
    if fresh_row:
        c[np.concatenate(fresh_row), np.concatenate(fresh_k)] = np.concatenate(fresh_v)


def read(files: list[bytes]) -> tuple[list[Image], list[np.ndarray]]:
    """Images and their coefficients (blocks of all components, 64)."""
    images = [Image(f) for f in files]
    at = np.concatenate([[0], np.cumsum([i.n_blocks for i in images])]).astype(np.int64)
    c = np.zeros((int(at[-1]), 64), np.int16)
    passes = [i.passes() for i in images]
    for s in range(max(map(len, passes), default=0)):
        groups: dict[tuple, list[tuple[int, dict]]] = {}
        for d, image in enumerate(images):
            for scan in passes[d][s] if s < len(passes[d]) else ():
                groups.setdefault((scan["key"], image.order(scan["which"])[1]), []).append((d, scan))
        for (key, column), scans in groups.items():
            bits = Bits([images[d].data[x["start"] : x["end"]] for d, x in scans])
            blocks, sizes, steps = [], [], []
            for d, scan in scans:
                order = images[d].order(scan["which"])[0]
                blocks.append(order.ravel() + at[d])
                sizes.append(len(order))
                steps.append(scan["interval"] or len(order))
            sizes, steps = np.array(sizes), np.array(steps)
            lanes = -(-sizes // steps)
            if (lanes != bits.lanes).any():
                raise ValueError("restart markers are missing")
            count = np.repeat(steps, lanes)
            count[np.cumsum(lanes) - 1] = sizes - (lanes - 1) * steps
            block, count = np.concatenate(blocks), count * len(column)
            if key[1] == 0:
                read_dc(bits, c, block, count, column, key)
            elif key[3] == 0:
                read_ac_first(bits, c, block, count, key)
            else:
                read_ac_refine(bits, c, block, count, key)
    return images, [c[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def payload_of(image: Image, coefficients: np.ndarray) -> bytes:
    blocks = coefficients[: image.payload_bytes // 64]
    return (blocks + 128).astype(np.uint8).tobytes()


def features(channels: np.ndarray) -> list[str]:
    """Size, mean and spread of the channels of each image of a stack."""
    _, _, tall, wide = channels.shape
    x, n, out = channels.reshape(*channels.shape[:2], -1), tall * wide, []
    for total, square in zip(x.sum(axis=2, dtype=np.int64).tolist(), np.multiply(x, x, dtype=np.uint16).sum(axis=2, dtype=np.int64).tolist(), strict=True):
        facts = (f"{t / n:.4f}/{math.sqrt(max(s / n - (t / n) ** 2, 0)):.4f}" for t, s in zip(total, square, strict=True))
        out.append(f"{wide}x{tall}:" + ",".join(facts))
    return out


def padded(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw + bytes(-len(raw) % 64 or (0 if raw else 64)), np.uint8)


def _batches(column: pa.Array) -> Iterator[tuple[int, int, list]]:
    """(first, last + 1, values) of slices of about CHUNK bytes."""
    first, size, held = 0, 0, []
    for i, v in enumerate(column):
        raw = v.as_buffer().to_pybytes() if v.is_valid else None
        held.append(raw)
        size += len(raw or b"") + 256
        if size >= CHUNK:
            yield first, i + 1, held
            first, size, held = i + 1, 0, []
    if held:
        yield first, len(column), held


def store(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All documents with n_bytes and media, the file that holds the text (named afresh on a clash)."""
    names = fresh(docs, "n_bytes", "media")
    every = [*names, *docs.columns]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw in _batches(batch.column(0).cast(pa.large_binary())):
                files = write([padded(r or b"") for r in raw])
                cols = [pa.array([len(r or b"") for r in raw], pa.int64()), pa.array(files, pa.binary())]
                yield pa.record_batch([*cols, *batch.slice(i, j - i).columns[1:]], names=every)

    rows = docs.select(F.col(text_col), *[F.col(c) for c in docs.columns])
    return bounded(rows).mapInArrow(run, f"`{names[0]}` long, `{names[1]}` binary, {fields}").select(*docs.columns, *names)


def decode(images: list[Image], coefficients: list[np.ndarray], tensors: bool) -> list[list]:
    """Payload, feature and the rest of each image; images of one shape are transformed as a stack."""
    alike: dict[tuple, list[int]] = {}
    for d, image in enumerate(images):
        alike.setdefault(image.shape(), []).append(d)
    out: list[list] = [[] for _ in images]
    for docs in alike.values():
        channels = images[docs[0]].channels(np.stack([coefficients[d] for d in docs]))
        for d, feature, own in zip(docs, features(channels), channels, strict=True):
            image = images[d]
            out[d] = [payload_of(image, coefficients[d]) if image.payload_bytes is not None else None, feature]
            if tensors:
                out[d] += [image.wide, image.tall, np.moveaxis(own, 0, -1).tobytes()]
    return out


def decode_all(raw: list[bytes | None], tensors: bool) -> list[list]:
    """(error, payload, feature and the rest) of each file; where one of a batch is damaged, each is read by itself."""
    nothing = [None] * (5 if tensors else 2)
    some = [r for r in raw if r is not None]
    try:
        got = iter([[None, *x] for x in decode(*read(some), tensors)] if some else [])
        return [["no file", *nothing] if r is None else next(got) for r in raw]
    except Exception as e:  # whatever a damaged file leads to is said of that file
        if len(raw) == 1:
            return [[f"{type(e).__name__}: {e}"[:200], *nothing]]
        return [row for r in raw for row in decode_all([r], tensors)]


def load(files: DataFrame, *, media_col: str = "media", tensors: bool = True) -> DataFrame:
    """All files with error, payload, feature and, if asked for, width, height and rgb (bytes, rows of pixels).

    A null or damaged file has an error and nulls else; a file without a payload of ours a null payload.
    """
    wanted = fresh(files, "error", "payload", "feature", "width", "height", "rgb")[: 6 if tensors else 3]
    every = [*wanted, *files.columns]
    kinds = ("string", "binary", "string", "int", "int", "binary")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    added = ", ".join(f"`{n}` {t}" for n, t in zip(wanted, kinds, strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw in _batches(batch.column(0).cast(pa.large_binary())):
                types = [pa.string(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
                out = zip(*decode_all(raw, tensors), strict=True)
                cols = [pa.array(v, t) for v, t in zip(out, types, strict=False)]
                yield pa.record_batch([*cols, *batch.slice(i, j - i).columns[1:]], names=every)

    rows = files.select(F.col(media_col), *[F.col(c) for c in files.columns])
    return bounded(rows).mapInArrow(run, f"{added}, {fields}").select(*files.columns, *wanted)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = store(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "media")
    read_ = load(stored, tensors=False)
    return read_.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
