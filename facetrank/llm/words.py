"""Hashes of the words of many texts at once.

Works on the bytes of a whole Arrow batch, without an object per word: A-Z are
lowered, texts are split at ASCII white space, and each word's bytes are folded
into 64 bits. Words of over ``LONG`` bytes are hashed one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

LONG = 64

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_is_word = np.ones(256, bool)
_is_word[[9, 10, 11, 12, 13, 32]] = False
# A random number for each byte, so that words are not sums of small numbers.
_numbers = np.random.default_rng(77).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def spread(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and where each value starts and ends."""
    wide = column.type in (pa.large_binary(), pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, at - at[0]


def hashes_between(
    data: np.ndarray, at: np.ndarray, lower: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and words per piece; ``at`` are the pieces' edges."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    inside = _is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(data)]  # a piece's first byte may start a word
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = at[1:][at[1:] > 0] - 1
    last[ends_at] = inside[ends_at]
    lengths = np.flatnonzero(last) + 1 - starts
    lowered = _lower[data] if lower else data
    hashes = lengths.astype(np.uint64)
    active = np.flatnonzero(lengths <= LONG)
    step = 0
    while len(active):
        hashes[active] = hashes[active] * _FACTOR + _numbers[lowered[starts[active] + step]]
        step += 1
        active = active[lengths[active] > step]
    hashes = spread(hashes)
    for i in np.flatnonzero(lengths > LONG):
        word = lowered[starts[i] : starts[i] + lengths[i]].tobytes()
        hashes[i] = xxhash.xxh3_64_intdigest(word)
    return hashes, np.diff(np.searchsorted(starts, at))


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in order, and the number of words per text."""
    return hashes_between(*bytes_of(column), lower)


def parts_of(batch: pa.RecordBatch, column: int, size: int):
    """Slices of a batch with at most ``size`` bytes of a binary column, or one row."""
    _, at = bytes_of(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last
