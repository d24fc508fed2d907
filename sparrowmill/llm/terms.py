"""Terms of many texts at once: one pass over bytes, then a dictionary of the distinct terms by Arrow.

A term is a maximal run of bytes outside ``stop``, with A-Z as a-z. Bytes of characters beyond ASCII are never stops, so
runs never cut a character. Terms become codes of a dictionary without one Python object for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text gathered before they are worked on; a longer text is worked on alone.
GATHER = 8 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def stops(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of the bytes that end a term, from inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


@dataclass
class Terms:
    """``codes`` into ``known`` (distinct terms) for each term of the texts in order; ``bounds``: where each text's begin."""

    known: pa.Array
    codes: np.ndarray
    bounds: np.ndarray

    def doc(self) -> np.ndarray:
        """Of each term, the number of its text."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def _starts(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offsets[:-1]
    heads = heads[heads < len(inside)]
    start[heads] = inside[heads]
    return np.flatnonzero(start)


def count(texts: pa.Array, stop: np.ndarray) -> np.ndarray:
    """Of each text, how many terms it has."""
    raw, offsets = _parts(texts)
    return np.diff(np.searchsorted(_starts(~stop[raw], offsets), offsets))


def split(texts: pa.Array, stop: np.ndarray) -> Terms:
    raw, offsets = _parts(texts)
    inside = ~stop[raw]
    starts = _starts(inside, offsets)
    letters = _LOWER[raw[inside]]
    ends = np.append((np.cumsum(inside)[starts] - 1) if len(starts) else np.zeros(0, np.int64), len(letters))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return Terms(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, offsets))


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int = GATHER, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Batches put together until a column of texts holds ``most`` bytes, or ``rows`` rows are there."""
    held: list[pa.RecordBatch] = []
    size = many = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        many += batch.num_rows
        if size >= most or many >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size, many = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
