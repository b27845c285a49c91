"""Hashes of all words of an Arrow text column, by array arithmetic on its bytes.

A word's hash is a polynomial in an odd number, modulo 2 ** 64, over random values of its bytes; prefix sums give all
words' polynomials at once, and a finaliser mixes them. A-Z have the values of a-z. Texts are taken in segments of
bounded size, cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quayside.llm.common import mix

SEGMENT = 1 << 21  # bytes hashed at once
_RANDOM = np.random.default_rng(20)
VALUES = _RANDOM.integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
VALUES[65:91] = VALUES[97:123]
BASE = 0x9E3779B97F4A7C15
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, SEGMENT)
        _POWERS[:] = [np.cumprod(np.full(n, x, np.uint64)) for x in (BASE, pow(BASE, -1, 1 << 64))]
    return _POWERS


def _segment(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte positions of the words in ``data``; texts begin and end at ``bounds``."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(len(data))
    gap = SEPARATOR[data]
    before, after = np.empty_like(gap), np.empty_like(gap)
    before[0] = after[-1] = True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after)
    sums = VALUES[data]
    sums *= up[:len(data)]
    np.cumsum(sums, out=sums)
    total = sums[ends]
    first = starts[starts > 0]
    total[len(starts) - len(first):] -= sums[first - 1]
    return mix(total * down[starts]), starts


def column_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts (first, past the last), the hashes of their words in order, and the number of words of each.

    A run has about SEGMENT bytes; a longer text is a run of its own, hashed in segments. A null has no words.
    """
    column = pc.fill_null(column, "") if column.null_count else column
    n = len(column)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SEGMENT, "right")) - 1)
        bounds = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        if len(part) <= SEGMENT:
            hashes, starts = _segment(part, bounds)
            at = np.searchsorted(bounds, starts, "right") - 1
            yield first, last, hashes, np.bincount(at, minlength=last - first)
        else:
            found = [_segment(x, np.zeros(0, np.int64))[0] for x in _between_words(part)]
            hashes = np.concatenate(found)
            yield first, last, hashes, np.array([len(hashes)])
        first = last


def _between_words(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in segments that end before a separator."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + SEGMENT)
        if end < len(data):
            gaps = np.flatnonzero(SEPARATOR[data[begin + 1:end]])
            if len(gaps):
                end = begin + 1 + int(gaps[-1])
            else:  # a word longer than a segment
                rest = np.flatnonzero(SEPARATOR[data[end:]])
                end = end + int(rest[0]) if len(rest) else len(data)
        yield data[begin:end]
        begin = end
