"""Words of UTF-8 texts as NumPy arrays: where they start and end, and a 64-bit hash of each, without a Python object per word.

All separators are ASCII, so that cutting at bytes and cutting at code points are the same. A null text is an empty one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE, _GOLD = 0x9E3779B97F4A7C55, 0x9E3779B97F4A7C15
_powers = np.ones(1, U)
_inverses = np.ones(1, U)

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def byte_set(held) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(held)] = True
    return table


#: Bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = ~byte_set([0x20, *range(0x09, 0x0E)])
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
LETTER_OR_DIGIT = ~byte_set([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts (one more at the end)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.full(size, _BASE, U), np.full(size, inverse, U)
        up[0] = down[0] = 1
        _powers, _inverses = np.cumprod(up), np.cumprod(down)
    return _powers[:n], _inverses[:n]


class Spans(NamedTuple):
    """`first[i]` is the index of the first span of row i; spans of a row are `first[i]:first[i + 1]`."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def spans(data: np.ndarray, offsets: np.ndarray, held: np.ndarray) -> Spans:
    """Maximal runs of bytes of `held` inside each row."""
    inside = held[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[1:], before[0] = inside[:-1], False
        after[:-1], after[-1] = inside[1:], False
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Spans(starts, ends, np.searchsorted(starts, offsets))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which `hashes` takes the hash of any run of bytes."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    return sums


def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes; equal runs have equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * U(_GOLD))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of `values[first[i]:first[i + 1]]` for each i."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype != bool else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def hash_word(word: bytes) -> int:
    """The hash that `hashes` gives to this run of bytes."""
    data = np.frombuffer(word, np.uint8)
    return int(hashes(prefix_sums(data), np.array([0]), np.array([len(data)]))[0])
