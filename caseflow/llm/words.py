"""Words of Arrow text columns as 64-bit hashes, computed with NumPy inside tasks.

A word is a run of word bytes; which bytes those are is the caller's choice. Letters A-Z hash like
a-z. Equal words have equal hashes; different words differ but for a chance of about 2**-60.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20
BATCH_BYTES = 1 << 22
_ODD = U64(0x9E3779B97F4A7C15)


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 flags: True for the bytes of words, False for the given ranges."""
    table = np.ones(256, bool)
    for low, high in excluded:
        table[low : high + 1] = False
    return table


#: Everything but white space.
NON_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Letters, digits and everything beyond ASCII.
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(1)
def _letter_values() -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(20240517)).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
    values[65:91] = values[97:123]
    return values


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse."""
    base = int(_ODD)
    up, down = np.empty(n, U64), np.empty(n, U64)
    up[0] = down[0] = 1
    up[1:], down[1:] = U64(base), U64(pow(base, -1, 1 << 64))
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each text starts (one entry more than texts). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return flat, at - at[0]


def _cut(is_word: np.ndarray, start: int) -> int:
    """The end of a chunk that starts at ``start`` and does not end inside a word."""
    end = start + CHUNK_BYTES
    while end < len(is_word):
        gap = np.flatnonzero(~is_word[end : end + CHUNK_BYTES])
        if len(gap):
            return end + int(gap[0])
        end += CHUNK_BYTES
    return len(is_word)


def word_hashes(column: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words start (one entry more than texts)."""
    data, at = text_bytes(column)
    is_word = word_bytes[data]
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:], after[:-1] = is_word, is_word
    before[at], after[at] = False, False  # words end with their text
    starts = np.flatnonzero(is_word & ~before[:-1])
    ends = np.flatnonzero(is_word & ~after[1:]) + 1
    values, hashes, low, first = _letter_values(), np.empty(len(starts), U64), 0, 0
    while low < len(data):
        high = _cut(is_word, low)
        last = first + int(np.searchsorted(starts[first:], high))
        up, down = _powers(1 << max(high - low, CHUNK_BYTES + 65536).bit_length())
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(values[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        hashes[first:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * _ODD
        low, first = high, last
    return mix(hashes), np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; texts are not told apart, so the caller drops runs across their ends."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    total = np.full(n, size * 0x9E3779B9, U64)
    for k in range(size):
        total = (total ^ hashes[k : k + n]) * U64(0xD6E8FEB86659FD93)
        total ^= total >> U64(32)
    return mix(total)


def give_back() -> None:
    """Freed memory goes back to the system, so that workers hold little while other steps run."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text, so that what a task derives from them stays small.

    What earlier tasks left, and after each batch what was derived from it, goes back to the system where it is free.
    """
    give_back()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        total, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < batch.num_rows:
            done = int(total[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + most, "right")))
            yield batch.slice(first, last - first)
            first = last
        del batch, sizes, total
        give_back()
