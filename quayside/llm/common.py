"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: ASCII capitals and their small letters; no other letter is lower-cased anywhere in this subpackage.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; ``bytes.split`` cuts at exactly these characters."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased; ``bytes.lower`` changes ASCII letters only."""
    return text.encode().lower().split() if text else []


def crc_class(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod


def list_column(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """Slices of one array as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def joined(column) -> np.ndarray:
    """All values of an Arrow list column as one array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False)


def list_sizes(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.diff(column.offsets.to_numpy())


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (unsigned, wrapping): every input bit changes every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbered(df: DataFrame, key: str, sizes: DataFrame, ties: list[str], out: str,
             block_rows: int = 100_000) -> DataFrame:
    """Add a gapless number from 0 inside each value of ``key``, in no particular order.

    ``sizes`` has ``key`` and ``_n``, the rows of each value, and as many rows as the caller can bound; it is
    broadcast. A value with many rows is cut by a hash of ``ties`` into blocks of about ``block_rows``, so that no
    task holds a hot value; the blocks' counts are added up in a table of one row per block. A column named ``out`` is
    replaced, all others are kept whatever their names.
    """
    own = df.select(F.struct(*[c for c in df.columns if c != out]).alias("row"), F.col(key).alias("key"),
                    F.struct(*ties).alias("ties"), F.xxhash64(*ties).alias("hash"))
    times = F.broadcast(sizes.select(F.col(key).alias("key"), F.col("_n").alias("n")))
    block = F.pmod("hash", F.ceil(F.col("n") / block_rows).cast("bigint"))
    rows = own.join(times, "key").select("row", "key", "ties", block.alias("block"))
    before = W.partitionBy("key").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = (rows.groupBy("key", "block").agg(F.count(F.lit(1)).alias("m"))
              .select("key", "block", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start")))
    inside = F.row_number().over(W.partitionBy("key", "block").orderBy("ties")) - 1
    return (rows.withColumn("inside", inside).join(starts, ["key", "block"])
            .select("row.*", (F.col("start") + F.col("inside")).alias(out)))


def most_frequent(counts: DataFrame, most: int) -> pa.Table:
    """The rows with the largest ``n``: the smallest count is taken that leaves at most ``most`` of them.

    ``counts`` is read twice, so it should be stored.
    """
    falling = W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, W.currentRow)  # over one row per count
    cuts = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).select("n", F.sum("k").over(falling).alias("k"))
    cut = cuts.filter(F.col("k") <= most).agg(F.min("n")).first()[0]
    return counts.filter(F.col("n") >= cut if cut is not None else F.lit(False)).toArrow()
