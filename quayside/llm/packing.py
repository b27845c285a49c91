"""Best-fit packing of token sequences with exact complements.

What packing needs of a document is its length. Whole sequences of a long document are sequences of their own; what is
left over, at most ``width - 1`` lengths with counts, is planned on the driver: a table bounded by the width, not by
the data. Gaps are filled exactly first, by one length, a pair or a triple whose sum is looked up, as often as all of
them are available and the rest does not miss them; then what is left goes best-fit. The plan says for each length which of its pieces go where; pieces
are numbered inside their length (in hashed blocks, so that no length is hot) and look up their place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quayside.llm.common import numbered

Recipe = tuple[tuple[int, ...], int]  # lengths that make one sequence, and how many such sequences


class Tokens:
    """Ids of a byte-level BPE vocabulary. The rank file of the same vocabulary gives the ids of ``tokenizers`` several
    times faster; the special token's string is that token, as it is there by default."""

    def __init__(self, path: str):
        from base64 import b64decode

        import public_tokenizers
        import tiktoken
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.special = {"<|endoftext|>": len(ranks)}
        self.model = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens=self.special)

    def encode(self, text: str) -> np.ndarray:
        return self.model.encode_to_numpy(text, allowed_special=set(self.special), disallowed_special=())


_TOKENS: dict[str, Tokens] = {}  # one per worker process and vocabulary


def tokens(path: str) -> Tokens:
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


PIECES = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]


def cut_pieces(docs: DataFrame, path: str, width: int = 1024, end: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document's ids and ``end`` after them are one piece if they fit, else pieces of ``width``, the first of which has
    what is left over. A null text is empty and has the end id only.
    """
    def run(batches):
        coder = tokens(path)
        last = np.array([end], "<u4")
        for b in batches:
            docs, rows = [], []
            for i, text in enumerate(b.column(1)):
                ids = np.concatenate([coder.encode(text.as_py() or "").astype("<u4"), last])
                first = len(ids) % width or width
                cuts = [0, *range(first, len(ids), width), len(ids)]
                for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    docs.append(i)
                    rows.append((k, x, y - x, zlib.crc32(ids[x:y].tobytes())))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(docs, pa.int64())), pa.array(columns[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in columns[1:]]], names=["doc_id", *[n for n, _ in PIECES]])

    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, t) for n, t in PIECES]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(counts: dict[int, int], width: int) -> list[Recipe]:
    """The longest length first takes, again and again, the largest length that fits its gap."""
    left, lengths, recipes = dict(counts), sorted(counts), []
    while lengths:
        parts, gap = [lengths[-1]], width - lengths[-1]
        i = bisect_right(lengths, gap) - 1
        while i >= 0:
            n = lengths[i]
            fits = min(left[n] - (n == parts[0]), gap // n)
            parts += [n] * fits
            gap -= n * fits
            i = min(i, bisect_right(lengths, gap)) - 1
        need = Counter(parts)
        times = min(left[n] // k for n, k in need.items())
        recipes.append((tuple(parts), times))
        for n, k in need.items():
            left[n] -= times * k
            if not left[n]:
                lengths.remove(n)
    return recipes


def fill_exactly(left: Counter, width: int, tops: list[int], parts: int) -> list[Recipe]:
    """Take from ``left`` sequences of one of ``tops`` and ``parts`` lengths, none above it, that fill its gap exactly.

    A sum is taken as often as there are pieces for all of it. Of the sums of a gap those of the most equal lengths go
    first, since short pieces are the ones that fill other gaps.
    """
    have = np.zeros(width + 1, bool)
    have[[n for n in left if n <= width]] = True
    recipes: list[Recipe] = []

    def pairs(gap: int, top: int):
        a = np.arange((gap + 1) // 2, min(gap - 1, top) + 1)
        return a[have[a] & have[gap - a]].tolist()

    def fills(top: int, gap: int):
        if parts == 1 and have[gap] and gap <= top:
            yield (gap,)
        elif parts == 2:
            yield from ((a, gap - a) for a in pairs(gap, top))
        elif parts == 3:
            for c in np.flatnonzero(have[:gap // 3 + 1])[::-1].tolist():  # the smallest of three
                yield from ((a, gap - c - a, c) for a in pairs(gap - c, top) if gap - c - a >= c)

    for top in tops:
        for fill in fills(top, width - top) if top < width else [()] if parts == 1 else []:
            if not left[top]:
                break
            if not all(map(left.__getitem__, fill)):
                continue
            need = Counter((top, *fill))
            times = min(left[n] // k for n, k in need.items())
            if times:
                recipes.append(((top, *fill), times))
                for n, k in need.items():
                    left[n] -= times * k
                    have[n] = left[n] > 0
    return recipes


def plan_recipes(counts: dict[int, int], width: int) -> list[Recipe]:
    """Sequences of at most ``width`` for so many pieces of each length.

    Gaps are filled exactly by one length, then by pairs, then by triples; the rest goes best-fit. A sum wastes nothing
    itself, but may use up short pieces that the rest misses: sums are taken for a range of the longest lengths only
    if the plan with the rest packed best-fit is then no longer than before; else for each half of the range alone.
    """
    left = Counter({n: c for n, c in counts.items() if c > 0})
    recipes = fill_exactly(left, width, sorted(left, reverse=True), 1)

    def rest(counts: Counter) -> int:
        return sum(times for _, times in best_fit(+counts, width))

    for parts in (2, 3):
        ranges, now = [sorted(+left, reverse=True)], rest(left)
        while ranges:
            tops, trial = ranges.pop(), left.copy()
            sums = fill_exactly(trial, width, tops, parts)
            if not sums:
                continue
            after = rest(trial)
            if sum(times for _, times in sums) + after <= now:
                recipes += sums
                left, now = trial, after
            elif len(tops) > 1:
                ranges += [tops[len(tops) // 2:], tops[:len(tops) // 2]]
    return recipes + best_fit(+left, width)


def places(recipes: list[Recipe]) -> pd.DataFrame:
    """For each length the runs of its pieces: from piece number ``first`` on, the next sequences take one each."""
    rows, used, sequence = [], Counter(), 0
    for parts, times in recipes:
        offset = 0
        for n in parts:
            rows.append((n, used[n], sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    table = pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"])
    return table.sort_values(["length", "first"], ignore_index=True)


def pack_pieces(pieces: DataFrame, width: int = 1024, block_rows: int = 100_000) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece, length and ids_crc32; every length is 1 to ``width``.

    The rows are read four times, so they should be stored. Columns of these names are replaced; equal rows get
    places of their own; an empty table gives no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("_n"))
    counts = {row["length"]: row["_n"] for row in sizes.collect()}  # at most width rows
    plan = places(plan_recipes(counts, width))
    at = {n: (g["first"].to_numpy(), g["sequence"].to_numpy(), g["offset"].to_numpy())
          for n, g in plan.groupby("length")}

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), np.int64)
        for n, rows in length.groupby(length).groups.items():
            first, sequence, offset = at[n]
            mine = number.loc[rows].to_numpy()
            run = np.searchsorted(first, mine, "right") - 1
            where = length.index.get_indexer(rows)
            out[where, 0] = sequence[run] + mine - first[run]
            out[where, 1] = offset[run]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    ties = ["doc_id", "piece", "ids_crc32"]
    rows = numbered(pieces.select(F.struct("*").alias("row"), "length", *ties), "length", sizes, ties, "number", block_rows)
    return rows.withColumn("place", place("length", "number")).select("row.*", "place.sequence_id", "place.offset")
