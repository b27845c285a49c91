"""SimHash near-duplicates by pivot distance tables.

A fingerprint is compared with many reference fingerprints (the pivots), and its Hamming distance to each is kept block
by block: the bits are cut into a few blocks, and the distances inside the blocks add up to the whole one. By the
triangle inequality no coordinate of two fingerprints differs by more than their distance. So, where at most ``differ``
bits are unequal, all coordinates are equal in all blocks but ``differ``; fingerprints meet where their coordinates in
so many blocks are the same, pairs with a whole coordinate that differs by more than ``differ`` are discarded, and the
survivors are verified bit by bit.

Equal fingerprints are one row of the table, however many documents have them. A meeting place with very many
fingerprints is dealt in pairs of bounded blocks, and a task passes on at most one link per fingerprint and place.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import lower_words, mix
from quayside.llm.graph import components
from quayside.sources.tables import stored

SEED = 42
AT_ONCE = 1 << 16  # shingles hashed at once
MOST_MET = 2048  # fingerprints of one place that one block holds
PIVOTS = np.random.default_rng(64).integers(0, 1 << 64, 24, dtype=np.uint64, endpoint=False)


def simhash(words: list[bytes], width: int) -> int:
    """Bit k is 1 if it is 1 in over half of the XXH64 hashes of the word shingles, repeats included; 0 for no words."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, AT_ONCE):
        some = [digest(text[s:e], SEED) for s, e in zip(starts[i:i + AT_ONCE], ends[i:i + AT_ONCE])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and print (64 bits as a signed number) of every row of ``docs``."""
    def run(batches):
        for b in batches:
            prints = np.array([simhash(lower_words(t), width) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, print long")


def block_masks(blocks: int) -> np.ndarray:
    """64 bits cut into ``blocks`` parts of nearly equal size."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return np.array([(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])], np.uint64)


def pivot_distances(prints: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Coordinates (print, block, pivot): the bits of a block in which a print and a pivot differ."""
    unequal = prints[:, None] ^ PIVOTS[None, :]
    return np.stack([np.bitwise_count(unequal & mask) for mask in masks], axis=1)


def blocks_alike(prints: int, differ: int) -> int:
    """How many blocks are required to be alike: the fewest, 2 at least, for which meeting places hold few prints.

    There are ``differ`` blocks more. It changes the number and the size of the places and never the links.
    """
    alike = 2
    while prints > 2 ** (64 * alike / (alike + differ)) and alike < 64 - differ:
        alike += 1
    return alike


def meeting_places(prints: DataFrame, alike: int, differ: int) -> DataFrame:
    """(place, print): a place for every choice of ``alike`` blocks, named by a hash of the coordinates there."""
    masks = block_masks(alike + differ)
    choices = list(combinations(range(len(masks)), alike))

    def run(batches):
        for b in batches:
            values = b.column(0).to_numpy()
            at = pivot_distances(values.view(np.uint64), masks).astype(np.uint64)
            name = np.zeros(at.shape[:2], np.uint64)
            for k in range(at.shape[2]):
                name = mix(name + at[:, :, k] + np.uint64(k + 1))
            for number, choice in enumerate(choices):
                place = np.full(len(values), number, np.uint64)
                for block in choice:
                    place = mix(place + name[:, block])
                yield pa.RecordBatch.from_arrays([pa.array(place.view(np.int64)), pa.array(values)],
                                                 names=["place", "print"])

    return prints.select("print").mapInArrow(run, "place long, print long")


def dealt_units(met: DataFrame, most: int) -> DataFrame:
    """(place, unit, print): the prints of a place are one unit, or one for each pair of blocks where they are many."""
    sizes = met.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select(
        "place", F.ceil(F.col("n") / most).alias("blocks"))
    block = F.pmod(F.xxhash64("print"), F.col("blocks"))
    unit = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda other: F.least(block, other) * F.col("blocks") + F.greatest(block, other)))
    return met.join(sizes, "place", "left").select("place", F.explode(unit).alias("unit"), "print")


def unit_links(unit: np.ndarray, prints: np.ndarray, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """For prints of numbered units, those that hang together in their unit with another one, and that other one.

    Prints are sorted by their distance from the first pivot, and a print is compared with the next one, the one after
    it and so on, as long as the distances allow a link. Pairs that hang together already are not compared again.
    """
    at = pivot_distances(prints, block_masks(1))[:, 0, :].astype(np.int16)
    order = np.lexsort((prints, at[:, 0], unit))
    unit, prints, at = unit[order], prints[order], at[order]
    root = np.arange(len(prints))
    active, step = root, 0
    while len(active):
        step += 1
        active = active[:np.searchsorted(active, len(prints) - step)]
        active = active[(unit[active] == unit[active + step])
                        & (at[active + step, 0] - at[active, 0] <= differ)]
        i = active[root[active] != root[active + step]]
        for k in range(1, at.shape[1]):
            if len(i):
                i = i[np.abs(at[i, k] - at[i + step, k]) <= differ]
        i = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= differ]
        j = i + step
        while len(i):
            low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            open_ = root[i] != root[j]
            i, j = i[open_], j[open_]
    linked = np.flatnonzero(root != np.arange(len(root)))
    return prints[linked], prints[root[linked]]


def pivot_links(prints: DataFrame, differ: int = 3, alike: int | None = None, most: int = MOST_MET) -> DataFrame:
    """Links (a, b) that hold together all distinct ``print`` values with at most ``differ`` unequal bits."""
    alike = blocks_alike(prints.count(), differ) if alike is None else alike
    units = dealt_units(meeting_places(prints, alike, differ), most)

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        for b in batches:
            held = [np.concatenate([x, c.to_numpy()]) for x, c in zip(held, b.columns)]
            place, unit, _ = held
            last = np.flatnonzero((place != place[-1]) | (unit != unit[-1]))
            whole = last[-1] + 1 if len(last) else 0  # the last unit may go on in the next batch
            if whole:
                yield links([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if len(held[0]):
            yield links(held)

    def links(columns):
        place, unit, values = columns
        number = np.cumsum(np.concatenate([[0], (place[1:] != place[:-1]) | (unit[1:] != unit[:-1])]))
        often = np.bincount(number)[number] > 1
        a, b = unit_links(number[often], values[often].view(np.uint64), differ)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    dealt = units.repartition("place", "unit").sortWithinPartitions("place", "unit")
    return dealt.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, width: int = 3, differ: int = 3) -> DataFrame:
    """One row per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links lead to.

    Two rows link if their fingerprints have at most ``differ`` unequal bits. Texts of fewer than ``width`` words are
    one shingle; a null text, or one without words, has fingerprint zero, which links like any other. Texts of any
    length are hashed whole. Equal texts, and rows with the same id, stay rows of their own; a null id stays null and
    is never the smallest (a component without any id has null). Ids may be of any type with an order. Other columns
    are ignored, whatever their names; an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, width), "prints")
    distinct = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    joined = components(pivot_links(distinct, differ), "print-links")
    of = distinct.join(joined, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    firsts = of.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(of.join(firsts, "root").select("print", "component_id"), "print-classes")
    return rows.join(classes, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
