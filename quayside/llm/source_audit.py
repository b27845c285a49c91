"""Source divergence audit: how far the term shares of each source lie from those of each other source of its language.

The table behind it has a row per term and a column per source, and nearly all of its cells are zero. A term that two
sources do not have adds the same to their value whatever the term is, and one that only one of them has adds what
depends on its count there; so these parts come from the counts' frequencies alone. What is left, a correction per
term that both have, comes from a frequent-pattern tree: each term row is the path of its nonzero cells in the order of
the sources, equal rows are one path with a multiplicity, and rows with equal beginnings share the nodes there. Every
node is combined once with each of its ancestors, and the correction counts as often as rows pass the node.

The tree is never in one place: paths are sorted and dealt by range, and each task builds the branches of its range
batch by batch. A node at the edge of two batches is two nodes, whose multiplicities add up.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quayside.llm.terms import separators, terms_of
from quayside.sources.tables import stored

MOST_HELD = 300_000  # counts that a task holds before it passes them on
COMBINED = 500_000  # pairs of a node and an ancestor that are worked out at once
SCALE = 1_000_000_000
LETTERS = separators(digits=False)


def source_rows(docs: DataFrame) -> DataFrame:
    """lang, source and text of all rows; a null is an empty text."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_counts(rows: DataFrame) -> DataFrame:
    """One row (lang, source, term, n, docs) per term of a source: its occurrences and the documents that have it.

    Each task adds up its own documents; one row per task, source and term goes through the shuffle.
    """
    names = ["lang", "source", "term", "n", "docs"]

    def batch(group, times: Counter, docs: Counter) -> pa.RecordBatch:
        terms, k = list(times), len(times)
        return pa.RecordBatch.from_arrays(
            [pa.array([group[0]] * k, pa.string()), pa.array([group[1]] * k, pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(times.values()), pa.int64()),
             pa.array([docs[t] for t in terms], pa.int64())], names=names)

    def count(batches):
        times, docs = defaultdict(Counter), defaultdict(Counter)
        for b in batches:
            for lang, source, text in zip(*[c.to_pylist() for c in b.columns]):
                found = terms_of(text, LETTERS)
                times[lang, source].update(found)
                docs[lang, source].update(set(found))
            if sum(map(len, times.values())) > MOST_HELD:
                yield from (batch(g, times[g], docs[g]) for g in times)
                times.clear()
                docs.clear()
        yield from (batch(g, times[g], docs[g]) for g in times)

    parts = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column) -> Column:
    """1 + floor(10^9 * (n + 1) / total) without overflow; null for a total of 0."""
    product = F.lit(SCALE).cast("decimal(12,0)") * (n + 1).cast("decimal(20,0)")
    return 1 + F.call_function("div", product, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_table(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per source of a language: its number there, its total, its share of a term that it doesn't have, the
    language's total and its number of kept terms. Sources without a kept term are there too."""
    places = W.partitionBy("lang").orderBy("source")  # over one row per source
    groups = rows.select("lang", "source").distinct().withColumn("place", F.row_number().over(places) - 1)
    n = (kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("n")))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("lang_n"))
    zero, size = F.lit(0).cast("bigint"), F.coalesce("size", F.lit(0).cast("bigint"))
    return (groups.join(langs, "lang", "left").join(n, ["lang", "source"], "left")
            .select("lang", "source", "place", size.alias("size"), (F.coalesce("n", zero) + size).alias("total"),
                    (F.coalesce("lang_n", zero) + size).alias("lang_total"))
            .withColumn("none", share(zero, F.col("total"))))


def branch_corrections(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The tree of a batch of sorted paths: corrections per pair of places, (lang, a, b, value)."""
    langs = batch.column("lang").dictionary_encode()
    lang, names = langs.indices.to_numpy().astype(np.int64), langs.dictionary
    path, times = batch.column("path"), batch.column("times").to_numpy()
    offsets = path.offsets.to_numpy().astype(np.int64)
    cells = path.flatten()
    place, p, none = [cells.field(i).to_numpy().astype(np.int64) for i in range(3)]
    offsets = offsets - offsets[0]
    first, size = offsets[:-1], np.diff(offsets)
    width = int(place.max()) + 1 if len(place) else 1

    shared = np.zeros(len(lang), np.int64)  # cells that a path begins with as the path before does
    alive = np.flatnonzero(lang[1:] == lang[:-1]) + 1
    depth = 0
    while len(alive):
        alive = alive[(size[alive] > depth) & (size[alive - 1] > depth)]
        here, there = first[alive] + depth, first[alive - 1] + depth
        alive = alive[(place[here] == place[there]) & (p[here] == p[there])]
        depth += 1
        shared[alive] = depth

    found = []
    for depth in range(1, int(size.max(initial=0))):
        rows = np.flatnonzero(size > depth)
        new = np.flatnonzero(shared[rows] <= depth)  # where a node of this depth begins; the first row always is one
        passing = np.add.reduceat(times[rows], new)
        node = rows[new]
        step = max(1, COMBINED // depth)
        for i in range(0, len(node), step):
            some, weight = node[i:i + step], passing[i:i + step, None]
            below = first[some][:, None] + depth
            above = first[some][:, None] + np.arange(depth)
            pa_, za, pb, zb = p[above], none[above], p[below], none[below]

            def gain(x, x0, y, y0):
                return ((x - y) ** 2 // y - (x - y0) ** 2 // y0 - (x0 - y) ** 2 // y + (x0 - y0) ** 2 // y0) * weight

            base = lang[some][:, None] * width
            there, here = place[above], place[below]
            key = np.concatenate([((base + there) * width + here).ravel(), ((base + here) * width + there).ravel()])
            value = np.concatenate([gain(pa_, za, pb, zb).ravel(), gain(pb, zb, pa_, za).ravel()])
            found.append(summed(key, value))
    if not found:
        key = value = np.zeros(0, np.int64)
    else:
        key, value = summed(*[np.concatenate(x) for x in zip(*found)])
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(key // (width * width))).cast(pa.string()), pa.array((key // width % width).astype(np.int32)),
         pa.array((key % width).astype(np.int32)), pa.array(value)], names=["lang", "a", "b", "value"])


def summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number sums per key."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[starts], np.add.reduceat(value[order], starts)


def tree_corrections(cells: DataFrame) -> DataFrame:
    """Per pair of sources what the terms that both have add beyond what each adds alone: (lang, a, b, value).

    ``cells`` has a row per nonzero cell: lang, term, place, p and none.
    """
    paths = (cells.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("place", "p", "none"))).alias("path"))
             .filter(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times")))
    dealt = stored(paths, "paths").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")

    def build(batches):
        yield from (branch_corrections(b) for b in batches if b.num_rows)

    return dealt.mapInArrow(build, "lang string, a int, b int, value long")


def pair_values(sources: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each source and each other source of its language."""
    own = sources.select("lang", F.col("place").alias("a"), "source", F.col("none").alias("za"), "size")
    other = sources.select("lang", F.col("place").alias("b"), F.col("source").alias("item"), F.col("none").alias("zb"))
    base = own.join(other, "lang").filter("a <> b").select(
        "lang", "a", "b", "source", "item",
        F.coalesce(F.col("size") * distance(F.col("za"), F.col("zb")), F.lit(0)).alias("value"))
    # Terms that one of the two has, as if the other one had them not.
    p, za, zb, n = F.col("p"), F.col("none"), F.col("zb"), F.col("n")
    steps = cells.groupBy("lang", "place", "p", "none").agg(F.count(F.lit(1)).alias("n")).join(other, "lang")
    single = steps.filter("place <> b").select("lang", F.inline(F.array(
        F.struct(F.col("place").alias("a"), "b", (n * (distance(p, zb) - distance(za, zb))).alias("value")),
        F.struct(F.col("b").alias("a"), F.col("place").alias("b"),
                 (n * (distance(zb, p) - distance(zb, za))).alias("value")))))
    unnamed = single.unionByName(tree_corrections(cells)).select(
        "lang", "a", "b", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("item"), "value")
    return (base.unionByName(unnamed).groupBy("lang", "a", "b")
            .agg(F.max("source").alias("source"), F.max("item").alias("item"),
                 F.sum(F.col("value").cast("decimal(20,0)")).cast("bigint").alias("value"))
            .select("lang", "source", "item", "value"))


def audit_sources(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has a source's distance from each other source of its
    language, part ``term`` the ``top`` terms that it has more of than the language as a whole.

    A language keeps the terms that at least ``least_docs`` of its rows have. A source's share of a term is
    1 + floor(10^9 * (count + 1) / (total + number of kept terms)), the distance of p from q is floor((p - q)^2 / q),
    summed over all kept terms for a pair. Ranks go by value, then by item in byte order.

    Null lang, source or text count as empty; rows are documents, so repeated rows count each time; a language without
    kept terms has pairs of value 0 and no terms; an empty table gives no rows. Texts of any length are counted whole.
    Other columns are ignored, whatever their names.
    """
    rows = source_rows(docs)
    kept = stored(term_counts(rows).groupBy("lang", "term")
                  .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"),
                       F.collect_list(F.struct("source", "n")).alias("cells"))
                  .filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    sources = stored(source_table(rows, kept), "sources")
    cells = stored(kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("cells"))
                   .join(sources, ["lang", "source"])
                   .withColumns({"p": share(F.col("n"), F.col("total")),
                                 "q": share(F.col("lang_n"), F.col("lang_total"))})
                   .select("lang", "source", "term", "place", "p", "none", "q"), "cells")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (cells.filter("p > q").select("lang", "source", F.col("term").alias("item"),
                                          distance(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    pairs = pair_values(sources, cells).withColumn("rank", F.row_number().over(order))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*names)
            .unionByName(terms.withColumn("part", F.lit("term")).select(*names)))
