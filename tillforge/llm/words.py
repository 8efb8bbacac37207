"""Words of whole Arrow text columns, found and hashed without a loop over rows.

ASCII letters are lower-cased and separators turned into blanks by one byte table;
bytes of multi-byte characters are never separators, so word borders are those of the
characters. All work is on slices of bounded size; one row may be larger than a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_table(separators) -> bytes:
    """Lower-cases A-Z and maps every byte of ``separators`` to a blank."""
    table = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        table[upper] = upper + 32
    for code in separators:
        table[code] = 32
    return bytes(table)


#: Words of letters, digits and anything beyond ASCII: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
PLAIN = byte_table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Words between ASCII white space: ``[^\x20\x09-\x0D]+``.
SPACED = byte_table([0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some rows: ``first[r]:first[r + 1]`` are those of row ``r``."""

    data: bytes
    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lengths[i]]


def text_bytes(text: pa.Array) -> tuple[memoryview, np.ndarray]:
    """UTF-8 bytes of all rows and the n + 1 row borders; null is empty."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    _, offsets, data = text.buffers()
    borders = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    whole = memoryview(data) if data is not None else memoryview(b"")
    return whole[borders[0] : borders[-1]] if len(text) else whole[:0], borders - borders[0] if len(text) else np.zeros(1, np.int64)


def slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; one row at least."""
    if not len(text):
        return
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at, total = np.cumsum(sizes), 0, 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, total + limit, side="right")))
        yield at, to
        total, at = int(ends[to - 1]), to


def words_of(text: pa.Array, table: bytes) -> Words:
    data, borders = text_bytes(text)
    data = bytes(data).translate(table)
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(len(borders), np.int64), np.zeros(0, np.uint64))
    raw = np.frombuffer(data, np.uint8)
    inside = raw != 32
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[borders[:-1][borders[:-1] < n]] = False
    starts = np.flatnonzero(inside & ~before)
    goes_on = np.empty(n, bool)
    goes_on[-1] = False
    np.logical_and(inside[1:], before[1:], out=goes_on[:-1])
    lengths = np.flatnonzero(inside & ~goes_on) + 1 - starts
    first = np.searchsorted(starts, borders)
    if not len(starts):
        return Words(data, starts, lengths, first, np.zeros(0, np.uint64))
    packed = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(packed, lengths)
    powers = np.full(int(lengths.max()), BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.add.reduceat((raw[inside].astype(np.uint64) + np.uint64(1)) * powers[place], packed)
    return Words(data, starts, lengths, first, mix(sums + lengths.astype(np.uint64) * BASE))
