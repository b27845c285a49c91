"""Connected components of a table of links, by star contraction: no node's links are ever gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quayside.sources.tables import stored


def all_stars(edges: DataFrame) -> bool:
    """Whether no node of the distinct edges (u, v) has two roots v and no root hangs below another."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                   F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = (edges.select(F.explode(ends).alias("e")).groupBy("e.node")
             .agg(F.sum("e.up").alias("roots"), F.min("e.up").alias("leaf")))
    return not nodes.agg(F.count_if((F.col("roots") > 1) | (F.col("roots") > F.col("leaf")))).first()[0]


def components(links: DataFrame, name: str = "links", rounds: int = 100) -> DataFrame:
    """One row (node, root) per node of the links (a, b); the root is the component's smallest node.

    Each round lets every node point its larger neighbours, then its smaller ones, to the smallest node it knows
    (Kiveris et al., 2014); it ends when only stars are left, after a number of rounds of the order of the square of the
    logarithm of the size, and raises if ``rounds`` are not enough. Self links and repeats don't matter; no links give no
    rows.
    """
    both = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")  # v < u
    edges = stored(links.filter(F.col("a") != F.col("b")).select(*both).distinct(), name)
    for _ in range(rounds):
        # Of a node's neighbours only smaller ones can be below it. The plan reads the links four times, not sixteen: the
        # driver plans each round anew, and its memory goes with the size of the plan.
        least = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = edges.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(large.join(low, "u").select(F.explode(ends).alias("e")).select("e.*").filter("u != v").distinct(),
                       name)
        if all_stars(edges):
            break
    else:
        raise RuntimeError(f"components: no end after {rounds} rounds")
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")),
                   F.struct(F.col("v").alias("node"), F.col("v").alias("root")))
    return stored(edges.select(F.explode(ends).alias("e")).select("e.*").distinct(), name)
