"""Counts of words and of adjacent words, exchanged as packed blocks.

Nearly all pairs of a corpus are rare, and yet each must be met with its like to be counted. As rows they take more
room than the texts. Here a task counts a million words at a time and sends a block per bucket of pairs: its different
words once, pairs as places among them, all compressed. Words that are usual at the head of the table have numbers that
all tasks know, and are not spelled at all; which words these are changes the size of the blocks and nothing else. All
other words are spelled, so the counts are exact; the hash only picks the bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

COUNTED_WORDS = 1_000_000  # that a task counts at once
HEAD_ROWS, HEAD_WORDS = 1_000, 400  # rows at the head, and words of each, that are looked at for usual words
MAX_USUAL = 65_536
BUCKET_MB = 32  # of input at most: some 6 million pairs
FIELDS = ("text", "lengths", "first", "second", "times")
SCHEMA = "bucket int, " + ", ".join(f"{c} binary" for c in FIELDS)
_VALUES = np.random.default_rng(21).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array, and the places where its words begin and the last one ends."""
    _, ends, data = words.buffers()
    if not len(words) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(words) + 1, np.int64)
    ends = np.frombuffer(ends, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def _hashes(words: pa.Array) -> np.ndarray:
    data, ends = _bytes(words)
    sizes = np.diff(ends)
    powers = np.cumprod(np.full(sizes.max(initial=0) + 1, _BASE))
    sums = np.cumsum(_VALUES[data] * powers[np.arange(len(data)) - np.repeat(ends[:-1], sizes)])
    sums = np.concatenate([np.zeros(1, np.uint64), sums])
    return _mix(sums[ends[1:]] - sums[ends[:-1]])


def _packed(numbers: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes as the largest needs, first all lowest bytes, compressed."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    planes = np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(len(numbers), kind.itemsize).T)
    return bytes([kind.itemsize]) + len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    size, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], size * n, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(f"u{size}").reshape(n)


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    if ends[-1] >= 1 << 31:
        raise ValueError("the words of a bucket take more than 2 GB; more shuffle partitions make smaller ones")
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))


def _usual(lists: pa.Array) -> pa.Array:
    """The words that occur more than once, the most frequent first."""
    counts = pc.value_counts(lists.flatten().cast(pa.string()).drop_null())
    often = counts.filter(pc.greater(counts.field("counts"), 1))
    return often.field("values").take(pc.array_sort_indices(often.field("counts"), "descending")[:MAX_USUAL])


def _distinct(code: np.ndarray, words: pa.Array, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs by first and second, a second being a code plus 1 or 0 for none, and how often each occurs."""
    there = words.is_valid().to_numpy(zero_copy_only=False)
    pair = there[1:] & there[:-1] & (row[:-1] == row[1:])
    pair &= pc.fill_null(pc.binary_length(words), 0).to_numpy()[1:] > 0  # an empty word is none
    keys = code[:-1][pair].astype(np.int64)
    keys <<= 32
    keys += code[1:][pair]
    keys += 1
    keys.sort()
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    times = np.diff(starts, append=len(keys)).astype(np.int32)
    alone = np.bincount(code[there])
    keys = np.concatenate([keys[starts], np.flatnonzero(alone) << 32])
    times = np.concatenate([times, alone[alone > 0].astype(np.int32)])
    order = np.argsort(keys, kind="stable")  # two sorted runs
    keys, times = keys[order], times[order]
    return (keys >> 32).astype(np.int32), keys.astype(np.int32), times


def _buckets(a: np.ndarray, b: np.ndarray, hashes: np.ndarray, usual: int, buckets: int) -> np.ndarray:
    """By both words; but a word beside usual ones goes by its own, so that one block spells it for all of these pairs."""
    mixed = hashes[a]
    own = (b <= usual) & (a >= usual)
    second = np.append(np.uint64(0), hashes)[b]
    mixed[~own] *= _BASE
    mixed[~own] += second[~own]
    np.copyto(mixed, second, where=(b > usual) & (a < usual))
    return (_mix(mixed) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))


def _blocks(words: pa.Array, row: np.ndarray, buckets: int, usual: pa.Array) -> Iterator[tuple]:
    """A bucket, and the FIELDS of its block, of some rows' words in order; ``row`` tells which belong together.

    A word's place is 1 to n for the n usual words, and goes on with those that the block spells. A pair's second is 0
    for none: that counts the first word alone.
    """
    coded = words.dictionary_encode()
    known, n = pc.index_in(coded.dictionary, value_set=usual), len(usual)
    other = known.is_null().to_numpy(zero_copy_only=False)
    spelled = coded.dictionary.filter(pa.array(other))
    order = pc.sort_indices(spelled).to_numpy()
    names = pa.concat_arrays([usual, spelled.take(pa.array(order))])
    rank = np.append(known.fill_null(0).to_numpy(), 0).astype(np.int32)
    rank[np.flatnonzero(other)[order]] = np.arange(n, len(names))
    a, b, times = _distinct(rank[coded.indices.fill_null(0).to_numpy()], words, row)
    bucket = _buckets(a, b, _hashes(names), n, buckets)
    order = np.argsort(bucket, kind="stable")
    a, b, times, bucket = a[order], b[order], times[order], bucket[order]
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else []
    data, ends = _bytes(names)
    place = np.arange(len(names) + 1)
    used = np.zeros(len(names) + 1, bool)
    for start, end in zip(cuts, cuts[1:]):
        first, after = a[start:end] + 1, b[start:end]
        used[first] = used[after] = True
        used[:n + 1] = False
        own = np.flatnonzero(used)
        used[own] = False
        place[own] = np.arange(n + 1, n + 1 + len(own))
        sizes = ends[own] - ends[own - 1]
        at = np.arange(sizes.sum()) + np.repeat(ends[own - 1] - np.cumsum(sizes) + sizes, sizes)
        numbers = (sizes, np.diff(place[first], prepend=1), place[after], times[start:end])
        yield int(bucket[start]), _packed(data[at]), *map(_packed, numbers)


def _chunks(columns: Iterator[pa.Array], change: Callable | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of COUNTED_WORDS or somewhat more, as long as there are so many, and the row of each."""
    held, n, row = [], 0, 0
    for lists in columns:
        ends, start = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), dtype=np.int64), 0
        while start < len(lists):
            most = (ends[start - 1] if start else 0) + COUNTED_WORDS - n
            end = min(int(np.searchsorted(ends, most)) + 1, len(lists))
            part = lists.slice(start, end - start)
            part = change(part) if change else part
            sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy()
            held.append((part.flatten().cast(pa.string()), np.repeat(np.arange(row + start, row + end), sizes)))
            n += len(held[-1][0])
            start = end
            if n >= COUNTED_WORDS:
                yield pa.concat_arrays([w for w, _ in held]), np.concatenate([r for _, r in held])
                held, n = [], 0
        row += len(lists)
    if n:
        yield pa.concat_arrays([w for w, _ in held]), np.concatenate([r for _, r in held])


def _counted(blocks: pa.Table, least: float, usual: pa.Array) -> pa.Table:
    """Of all blocks of a bucket: the words and pairs that occur ``least`` times, and how many different ones there are."""
    held = [tuple(map(_unpacked, block)) for block in zip(*(blocks[c].to_pylist() for c in FIELDS))]
    coded = _strings(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])).dictionary_encode()
    names, n = pa.concat_arrays([usual, coded.dictionary]), len(usual)
    code = np.concatenate([np.arange(-1, n), coded.indices.to_numpy().astype(np.int64) + n])
    start, keys = 0, []
    for _, sizes, first, second, _ in held:
        a, b = np.cumsum(first, dtype=np.int64) + 1, second.astype(np.int64)
        a, b = (code[np.where(x > n, x + start, x)] for x in (a, b))
        keys.append((a << 32) + b + 1)
        start += len(sizes)
    keys, times = np.concatenate(keys), np.concatenate([h[4] for h in held])
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    times = np.add.reduceat(times[order], starts, dtype=np.int64)
    hit = times >= least
    a, b = keys[starts[hit]] >> 32, keys[starts[hit]] & 0xFFFFFFFF
    return pa.table({
        "a": pa.concat_arrays([names.take(pa.array(a)), pa.nulls(1, pa.string())]),
        "b": pa.concat_arrays([names.take(pa.array(b - 1, mask=b == 0)), pa.nulls(1, pa.string())]),
        "n": np.append(times[hit], len(starts)),
    })


def count_pairs(df: DataFrame, tokens: str, least: float, change: Callable[[pa.Array], pa.Array] | None = None) -> DataFrame:
    """(a, b, n): n times b next to a, n times a where b is null; and, where a is null, n different words and pairs.

    Words and pairs that occur less than ``least`` times are only in the last, which has a row per bucket. An empty
    word is no second, nulls separate words. ``change`` maps lists of words to those that are counted.
    """
    words = df.select(F.col(tokens).cast("array<string>").alias("words"))
    spark = df.sparkSession
    head = words.select(F.slice("words", 1, HEAD_WORDS)).take(HEAD_ROWS)
    head = pa.array([r[0] for r in head], pa.list_(pa.string()))
    usual = _usual(change(head) if change else head)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  math.ceil(words.rdd.getNumPartitions() * split / (BUCKET_MB << 20)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, row in _chunks((b.column(0) for b in batches), change):
            columns = list(zip(*_blocks(chunk, row, buckets, usual)))
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                    names=["bucket", *FIELDS])

    def add(blocks: pa.Table) -> pa.Table:
        return _counted(blocks, least, usual)

    return words.mapInArrow(count, SCHEMA).groupBy("bucket").applyInArrow(add, "a string, b string, n long")
