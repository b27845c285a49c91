"""Sharding along a Hilbert curve: rows that are near in several metadata columns come into the same file.

Each column is cut at its quantiles (numbers at approximate ones, texts at exact ones of the ranks of their whole values),
the cell's place on the curve is found with a table of states, and the rows in curve order are cut into runs. The curve has ``2 ** (bits * columns)`` cells whatever the table's size, so
the cells' counts are a small table; rows are numbered inside their cell in hashed blocks, never in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from quayside.llm.common import numbered
from quayside.sources.tables import stored


def curve_states(dims: int) -> tuple[list[int], list[int]]:
    """Next state and digit for ``state * 2**dims + corner``, by the entry and direction of each sub-cube.

    A state is ``entry * dims + direction``; a corner has one bit per column. (Hamilton and Rau-Chaplin, 2008.)
    """
    size, mask = 1 << dims, (1 << dims) - 1

    def turned(x: int, by: int) -> int:  # to the left
        by %= dims
        return ((x << by) | (x >> (dims - by))) & mask

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    rank = {gray(i): i for i in range(size)}

    def entry_of(w: int) -> int:
        return 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def ones(x: int) -> int:  # low bits that are set
        return (~x & (x + 1)).bit_length() - 1

    def direction_of(w: int) -> int:
        return 0 if w == 0 else (ones(w - 1) if w % 2 == 0 else ones(w)) % dims

    following, digits = [], []
    for entry in range(size):
        for direction in range(dims):
            for corner in range(size):
                w = rank[turned(corner ^ entry, -(direction + 1))]
                digits.append(w)
                after = entry ^ turned(entry_of(w), direction + 1)
                following.append(after * dims + (direction + direction_of(w) + 1) % dims)
    return following, digits


def curve_index(cells: list[Column], bits: int) -> Column:
    """The place on the curve of a cell given by one whole number of ``bits`` bits per column."""
    dims = len(cells)
    following, digits = curve_states(dims)
    following, digits = F.array(*map(F.lit, following)), F.array(*map(F.lit, digits))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("index"), F.array(*cells).alias("cell"))

    def step(at: Column, level: Column) -> Column:
        corner = reduce(lambda a, b: a + b, [
            F.call_function("shiftright", at["cell"][i], level).bitwiseAND(F.lit(1)) * (1 << i) for i in range(dims)])
        spot = at["state"] * (1 << dims) + corner + 1
        return F.struct(F.element_at(following, spot).alias("state"),
                        (at["index"] * (1 << dims) + F.element_at(digits, spot)).alias("index"),
                        at["cell"].alias("cell"))

    levels = F.array(*[F.lit(i) for i in reversed(range(bits))])
    return F.aggregate(levels, start, step, lambda at: at["index"])


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType))


def position(df: DataFrame, name: str) -> Column:
    """A number in the order of the column, null for a value that is no number; texts have none."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        c = F.unix_date(c).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp")).cast("double")
    else:
        c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return F.coalesce(c, F.lit(float("-inf")))


def text_cuts(df: DataFrame, name: str, parts: int) -> list[bytes | None]:
    """The values, as bytes, at which the rows in order of a text column are cut into ``parts``; null is the lowest.

    Equal values are counted, the counts are dealt by ranges of the whole value, and running counts inside a range
    start from those of the ranges before it.
    """
    counts = stored(df.groupBy(F.col(f"`{name}`").cast("binary").alias("v")).agg(F.count(F.lit(1)).alias("n")), "values")
    ranges = stored(counts.repartitionByRange("v").withColumn("range", F.spark_partition_id()), "ranges")
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # over one row per range
    starts = ranges.groupBy("range").agg(F.sum("n").alias("m")).select(
        "range", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("range").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = (ranges.withColumn("upto", F.sum("n").over(inside)).join(F.broadcast(starts), "range")
              .withColumn("upto", F.col("start") + F.col("upto")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    ranks = sorted({-(-total * i // parts) for i in range(1, parts)}) if total else []
    held = [(F.col("upto") >= r) & (F.col("upto") - F.col("n") < r) for r in ranks]
    found = ranked.filter(reduce(lambda a, b: a | b, held, F.lit(False))).select("v").collect()  # one row per cut at most
    return [None if r["v"] is None else bytes(r["v"]) for r in found]


def with_curve(df: DataFrame, columns: list[str], bits: int = 4, accuracy: int = 1000) -> DataFrame:
    """Add ``curve``, the index of each row's cell; the cuts are quantiles over all rows, ``2**bits - 1`` per column:
    approximate for numbers, exact for texts, whose whole value decides. A null or a value that is no number is below
    everything. ``df`` is read once for the numbers and once per text column, so it should be stored."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [name for name in columns if not is_text(df, name)]
    found = df.agg(*[F.percentile_approx(position(df, name), shares, accuracy).alias(f"c{i}")
                     for i, name in enumerate(numbers)]).first() if numbers else []
    numeric = dict(zip(numbers, found))
    cells = []
    for name in columns:
        if is_text(df, name):
            c = F.col(f"`{name}`").cast("binary")
            over = [c.isNotNull() if b is None else F.coalesce(c > F.lit(b), F.lit(False))
                    for b in text_cuts(df, name, 1 << bits)]
        else:
            over = [position(df, name) > F.lit(b) for b in sorted(set(numeric[name] or []))]
        cells.append(reduce(lambda a, b: a + b, [o.cast("int") for o in over], F.lit(0)))
    return df.withColumn("curve", curve_index(cells, bits))


def cut_runs(rows: DataFrame, shards: int, ties: list[str], block_rows: int = 100_000) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0) in the order of ``curve``; shards differ by one row
    at most.

    ``rows`` is read four times, so it should be narrow and stored. Columns of these names are replaced. Ties and
    repeated rows each get a slot, an empty table gives no rows.
    """
    rows = rows.drop("shard", "slot")
    before = W.orderBy("curve").rowsBetween(W.unboundedPreceding, -1)  # over one row per cell
    sizes = rows.groupBy("curve").agg(F.count(F.lit(1)).alias("_n"))
    cells = sizes.select("curve", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
                         F.sum("_n").over(W.partitionBy(F.lit(0))).alias("_all"))
    placed = numbered(rows, "curve", sizes, ties, "_at", block_rows).join(F.broadcast(cells), "curve")
    first = F.expr(f"(shard * _all + {shards - 1}) div {shards}")  # the smallest rank in the shard
    return (placed.withColumn("shard", F.expr(f"(_first + _at) * {shards} div _all"))
            .withColumn("slot", F.col("_first") + F.col("_at") - first)
            .withColumn("shard", F.col("shard").cast("int")).drop("_first", "_all", "_at"))


def hilbert_shards(df: DataFrame, columns: list[str], shards: int, ties: list[str], bits: int = 4,
                   block_rows: int = 100_000) -> DataFrame:
    """Add ``curve``, ``shard`` and ``slot`` to every row of a narrow table; it is written once with the curve."""
    return cut_runs(stored(with_curve(df, columns, bits), "curve"), shards, ties, block_rows)


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard; rows of a shard are in order of the curve, so readers can skip files by any column."""
    (df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
