"""Ordered computations that never put a whole group into one task.

A window partitioned by a key is one task per key, so a key (or a table without a key) that holds a third of
the rows becomes a third of the work in one task. So rows are first cut into *ordered blocks* at the quantiles of
the order column. The window then runs per ``(keys, block)``, and one summary row per ``(keys, block)`` carries the
state from block to block. No block holds more than about ``1 / blocks`` of the rows, whatever the keys look like;
the window over summaries sees at most ``blocks`` rows per key (and a few more where a single order value is itself
hot). This is the only path, for tables of any size; the number of blocks is the number of shuffle partitions unless
``blocks`` gives another (1 is a window per key).

A row with a null key or a null order value has no place in an order: it stays, and what is computed is null.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

BLOCK = "_block"
_POS = "_pos"
_INF = float("inf")


def blocks_for(df: DataFrame) -> int:
    """One block per shuffle partition."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def as_position(df: DataFrame, name: str) -> Column:
    """The order column as a double that keeps its order and its ties (micros for times, days for dates)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        # Field by field, because a cast to TIMESTAMP would follow the session time zone and its clock changes.
        c = F.col(name)
        seconds = F.unix_date(c.cast("date")) * F.lit(86400) + F.hour(c) * 3600 + F.minute(c) * 60
        micros = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("double")
        return seconds.cast("double") * 1e6 + micros
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.NumericType):
        return F.nanvl(F.col(name).cast("double"), F.lit(_INF))  # NaN is the largest number to Spark
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # The first six bytes as a number. Texts that agree in them stand at one place, so they stay in one block.
        head = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int").cast("double")
    raise TypeError(f"order column {name} can't be ordered: {kind.simpleString()}")


def _bounds(df: DataFrame, name: str, blocks: int) -> list[float]:
    """At most ``blocks - 1`` approximate quantiles of one column, with repeats."""
    probs = [i / blocks for i in range(1, blocks)]
    found = df.select(as_position(df, name).alias(_POS)).approxQuantile(_POS, probs, 1 / (2 * blocks))
    return [b for b in found if math.isfinite(b)]


def _bucket(df: DataFrame, name: str, bounds: list[float], out: str) -> DataFrame:
    if not bounds:
        return df.withColumn(out, F.lit(0.0))
    splits = [-_INF, *sorted(set(bounds)), _INF]
    placed = df.withColumn(_POS, as_position(df, name))
    return Bucketizer(splits=splits, inputCol=_POS, outputCol=out).transform(placed).drop(_POS)


def ordered_blocks(df: DataFrame, order: list[str], blocks: int,
                   sample_from: DataFrame | None = None) -> DataFrame:
    """Add ``_block``, a number that never falls along ``order``.

    A value of the first column that fills a whole block by itself shows up as a repeated quantile. Its rows
    are cut again at the quantiles of the second column. ``sample_from`` is a cheaper frame with the same
    order columns to take the quantiles from (for example the rows before a group-by).
    """
    source = df if sample_from is None else sample_from
    bounds = _bounds(source, order[0], blocks)
    out = _bucket(df, order[0], bounds, BLOCK).withColumn(BLOCK, F.col(BLOCK).cast("bigint"))
    hot = sorted(b for b, n in Counter(bounds).items() if n > 1)
    if len(order) == 1 or not hot:
        return out
    place = as_position(df, order[0])
    inner = _bounds(source.filter(as_position(source, order[0]).isin(hot)), order[1], blocks)
    out = _bucket(out, order[1], inner, "_inner")
    # A hot value opens its bucket (it is a split), so its pieces come first and the rest of the bucket last.
    piece = F.when(place.isin(hot), F.col("_inner")).otherwise(F.lit(blocks + 1)).cast("bigint")
    return out.withColumn(BLOCK, F.col(BLOCK) * (blocks + 2) + piece).drop("_inner")


def _prepare(df: DataFrame, keys: list[str], order: list[str], blocks: int | None,
             sample_from: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[str], bool]:
    """Rows with a place in the order, the other rows, the columns to partition by, and whether those are blocks."""
    placed = F.lit(True)
    for name in [*keys, order[0]]:
        placed = placed & F.col(name).isNotNull()
    rows, rest = df.filter(placed), df.filter(~placed)
    blocks = blocks_for(df) if blocks is None else blocks
    if blocks == 1:
        return rows, rest, list(keys), False
    return ordered_blocks(rows, order, blocks, sample_from), rest, [*keys, BLOCK], True


def running_total(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, Column],
                  blocks: int | None = None, sample_from: DataFrame | None = None) -> DataFrame:
    """Add running sums per key. ``order`` must not have ties inside a key."""
    keep = [c for c in df.columns if c not in totals]
    rows, rest, part, cut = _prepare(df.withColumns(totals), keys, order, blocks, sample_from)
    rest = rest.select(*keep, *[F.lit(None).cast(rest.schema[name].dataType).alias(name) for name in totals])
    upto = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = rows.withColumns({name: F.sum(name).over(upto) for name in totals})
    if not cut:
        return running.select(*keep, *totals).unionByName(rest)
    before = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    carry = (rows.groupBy(*part).agg(*[F.sum(name).alias(name) for name in totals])
             .select(*part, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_carry_{name}")
                              for name in totals]))
    return (running.join(carry, part)
            .select(*keep, *[(F.col(name) + F.col(f"_carry_{name}")).alias(name) for name in totals])
            .unionByName(rest))


def row_rank(df: DataFrame, keys: list[str], order: list[str], out: str,
             blocks: int | None = None) -> DataFrame:
    """Add the 1-based row number per key."""
    return running_total(df, keys, order, {out: F.lit(1).cast("bigint")}, blocks)


def previous_value(df: DataFrame, keys: list[str], order: list[str], col: str, out: str,
                   blocks: int | None = None) -> DataFrame:
    """Add the value of ``col`` on the row before, per key (null on the first row)."""
    rows, rest, part, cut = _prepare(df, keys, order, blocks)
    rest = rest.withColumn(out, F.lit(None).cast(df.schema[col].dataType))
    inside = W.partitionBy(*part).orderBy(*order)
    before = rows.withColumn(out, F.lag(col).over(inside))
    if not cut:
        return before.select(*df.columns, out).unionByName(rest)
    over_blocks = W.partitionBy(*keys).orderBy(BLOCK)
    carry = (rows.groupBy(*part).agg(F.max_by(F.struct(col), F.struct(*order)).alias("_last"))
             .select(*part, F.lag("_last").over(over_blocks).getField(col).alias("_carry")))
    return (before.withColumn("_first", F.row_number().over(inside) == 1)
            .join(carry, part)
            .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out)))
            .select(*df.columns, out).unionByName(rest))


def last_known(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
               blocks: int | None = None) -> DataFrame:
    """Replace each null of ``cols`` by the last non-null value before it, per key."""
    rows, rest, part, cut = _prepare(df, keys, order, blocks)
    upto = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in cols})
    if not cut:
        return filled.select(*df.columns).unionByName(rest)
    before = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    at = F.struct(*order)
    carry = (rows.groupBy(*part)
             .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in cols])
             .select(*part, *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}")
                              for c in cols]))
    return (filled.join(carry, part)
            .withColumns({c: F.coalesce(F.col(c), F.col(f"_carry_{c}")) for c in cols}).select(*df.columns)
            .unionByName(rest))
