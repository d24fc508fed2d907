"""Words of many texts at once, in numpy.

A batch of texts is one UTF-8 buffer. Words are runs of bytes other than space and 9 to 13 (such bytes never occur
inside a character of several bytes); A-Z count as a-z. A word's hash is a polynomial of its bytes modulo 2^64, taken
as a difference of prefix sums and mixed, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text worked on at a time; a longer text is worked on alone.
CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them well."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def join(*parts: np.ndarray) -> np.ndarray:
    """One hash of several, in order."""
    out = mix(parts[0] + U(0x632BE59BD9B4E019))
    for p in parts[1:]:
        out = mix(out * U(BASE) + p)
    return out


_letters = mix(np.arange(1, 257, dtype=U) * U(0xD1B54A32D192ED03))
_letters[65:91] = _letters[97:123]
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            p = np.full(max(n, CHUNK), base, U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


class Texts:
    """A slice of texts: ``buf`` and ``offsets`` (one more than texts); words: ``starts``, ``ends``, ``doc``."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray) -> None:
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        inside = ~SPACE[buf]
        start = inside.copy()
        end = inside.copy()
        if n:
            start[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            heads = offsets[:-1]
            heads = heads[heads < n]
            start[heads] = inside[heads]
            tails = heads[heads > 0] - 1
            end[tails] = inside[tails]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        """Of each text, where its words begin."""

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        """Of each word, in order."""
        up, down = _power(len(self.buf))
        total = np.zeros(len(self.buf) + 1, U)
        np.cumsum(_letters[self.buf] * up[: len(self.buf)], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts])


def slices(texts: pa.Array | pa.ChunkedArray, most: int = CHUNK) -> Iterator[tuple[int, int, Texts]]:
    """(first, last + 1, Texts) over whole texts, about ``most`` bytes at a time; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, Texts(every[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j
