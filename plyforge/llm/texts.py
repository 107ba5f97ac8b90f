"""Hashes of the words of whole texts, taken from Arrow string buffers with numpy.

Texts are handled in groups of at most `SEGMENT` bytes; a longer text is cut between words, hashed piece by piece and put
together again, so that memory follows the number of words and not several copies of the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(values: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values evenly over 64 bits."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _codes() -> np.ndarray:
    """A 64-bit number for each byte; A-Z count as a-z."""
    byte = np.arange(256)
    byte[65:91] += 32
    return mix(byte.astype(np.uint64) * np.uint64(_BASE) + np.uint64(1))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    inverse = pow(_BASE, -1, 1 << 64)
    both = []
    for factor in (_BASE, inverse):
        steps = np.full(size, factor, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


@cache
def breaks_at_space() -> np.ndarray:
    """Bytes that end a word: blank and 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[32, *range(9, 14)]] = True
    return table


@cache
def breaks_at_symbols() -> np.ndarray:
    """Every ASCII byte but letters and digits ends a word."""
    table = np.ones(256, bool)
    table[128:] = False
    for first, last in ((48, 57), (65, 90), (97, 122)):
        table[first:last + 1] = False
    return table


class Words(NamedTuple):
    """Words of the texts `first` to `last` - 1: the text of each, its hash, and the hash of its first bytes."""

    first: int
    last: int
    text: np.ndarray
    hash: np.ndarray
    head: np.ndarray | None


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of a string column."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _hashed(data: np.ndarray, at: np.ndarray, breaks: np.ndarray, head: int) -> tuple[np.ndarray, ...]:
    """Words of `data`, in which texts start at `at`."""
    size = len(data)
    gap = breaks[data]
    before, after = np.ones(size, bool), np.ones(size, bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    inner = at[(at > 0) & (at < size)]
    before[inner], after[inner - 1] = True, True
    start, end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    power, inverse = _powers(max(SEGMENT, 1 << size.bit_length()))
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_codes()[data] * power[:size], out=sums[1:])

    def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((sums[b] - sums[a]) * inverse[a])

    return (np.searchsorted(at, start, "right") - 1, between(start, end),
            between(start, np.minimum(start + head, end)) if head else None)


def _cuts(data: np.ndarray, start: int, end: int, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about `SEGMENT` bytes that end between words."""
    while end - start > SEGMENT:
        ahead = start + SEGMENT
        found = -1
        while found < 0 and ahead < end:
            stop = min(ahead + 4096, end)
            hits = np.flatnonzero(breaks[data[ahead:stop]])
            found, ahead = (ahead + int(hits[0]), ahead) if len(hits) else (-1, stop)
        if found < 0:
            break
        yield start, found
        start = found
    yield start, end


def words(column: pa.Array, breaks: np.ndarray, head: int = 0, lower: bool = False) -> Iterator[Words]:
    """Word hashes of a column of texts, a group of texts at a time; every text is in exactly one group.

    A-Z always count as a-z; with `lower`, so do the capitals of other scripts.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, count = 0, len(column)
    while first < count:
        before = int(ends[first - 1]) if first else 0
        last = min(max(int(np.searchsorted(ends, before + SEGMENT, "right")), first + 1), count)
        # Only the group at hand is copied, so that memory does not follow the size of a batch.
        own = pc.fill_null(column.slice(first, last - first).cast(pa.large_string()), "")
        at, data = buffers(pc.utf8_lower(own) if lower else own)
        low, high = int(at[0]), int(at[-1])
        if last - first > 1 or high - low <= SEGMENT:  # lower case can be longer than the text
            text, hashes, heads = _hashed(data[low:high], at[:-1] - low, breaks, head)
        else:
            parts = [_hashed(data[a:b], np.zeros(1, np.int64), breaks, head) for a, b in _cuts(data, low, high, breaks)]
            text, hashes = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            heads = np.concatenate([p[2] for p in parts]) if head else None
        yield Words(first, last, text + first, hashes, heads)
        first = last
    pa.default_memory_pool().release_unused()


def word_hashes(text: str, breaks: np.ndarray, head: int = 0) -> Words:
    """The words of one text."""
    return next(iter(words(pa.array([text], pa.string()), breaks, head, lower=True)))
