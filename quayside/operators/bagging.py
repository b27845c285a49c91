"""Forests whose bootstrap samples are known, and scores from the trees that haven't seen a row.

A row's weight in the sample of a tree is a Poisson number with mean 1, drawn from a hash of its key and the tree's
number, so that any task can tell which trees have not seen it; nothing about the samples is stored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from quayside.functions.scalars import stable_hash
from quayside.operators.forest import Tree, grow_forest
from quayside.operators.metrics import classification_metrics
from quayside.plans.sums import matrix
from quayside.sources import stored, to_features

#: P(X <= k) of a Poisson number with mean 1, up to where a 52-bit number can't tell it from 1.
POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(17)]


def with_bags(df: DataFrame, key: str, trees: int, seed: int, out: str = "bag") -> DataFrame:
    """Add how often the row is in each tree's bootstrap sample, an array with a number per tree.

    Equal keys are drawn together.
    """
    draws = F.array(*[stable_hash(F.col(key), f"{seed}.{t}") / F.lit(float(2 ** 52)) for t in range(trees)])
    upto = F.array(*[F.lit(p) for p in POISSON])
    return df.withColumn(out, F.transform(draws, lambda u: F.size(F.filter(upto, lambda p: p <= u))))


def fit_bagged(rows: DataFrame, label: str, trees: int, seed: int, max_depth: int, weight: str | None,
               chosen=map) -> list[Tree]:
    """A tree per sample, on rows with ``features`` and ``bag``; all grow in the same passes over the rows.

    ``chosen(fn, numbers)`` maps over the numbers of the trees that are wanted, all by default. A split looks at the
    square root of the number of features. An empty sample is an error.
    """
    numbers = list(chosen(lambda t: t, range(trees)))
    width = rows.select(F.max(F.size("bag"))).first()[0] or 0
    return grow_forest(rows, label, weight, numbers, seed, max_depth, None,
                       lambda batch: matrix(batch.column(3), width)[:, numbers], ["bag"])


def out_of_bag(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    """Add ``votes``, the number of trees that haven't seen the row, ``score``, their mean probability of class 1, and
    ``prediction``. A row that all trees have seen has no score and no prediction."""
    shares = [t.shares[:, 1] for t in trees]

    @F.pandas_udf("votes int, score double")
    def judge(features: pd.Series, bags: pd.Series) -> pd.DataFrame:
        votes, total = np.zeros(len(features), np.int32), np.zeros(len(features))
        if len(features):
            x, unseen = np.stack(features.to_numpy()).astype(float), np.stack(bags.to_numpy()) == 0
            for t, share in zip(trees, shares):
                here = np.flatnonzero(unseen[:, t.number])
                votes[here] += 1
                total[here] += share[t.leaves(x[here])]
        return pd.DataFrame({"votes": votes, "score": total / np.maximum(votes, 1)})

    judged = rows.withColumn("judged", judge(vector_to_array("features"), "bag"))
    score = F.when(F.col("judged.votes") > 0, F.col("judged.score"))
    return (judged.withColumns({"votes": F.col("judged.votes"), "score": score})
            .withColumn("prediction", (F.col("score") > 0.5).cast("double")).drop("judged"))


def oob_rows(df: DataFrame, features: list[str], label: str, key: str, trees: int, weight: str | None, seed: int,
             max_depth: int) -> DataFrame:
    """The labelled rows of ``df`` as (key, label, votes, score, prediction), one of a forest that is fitted on them."""
    used = [c for c in (key, label, weight) if c is not None]
    rows = stored(with_bags(to_features(df.filter(F.col(label).isNotNull()), features).withColumn(
        label, F.col(label).cast("double")), key, trees, seed).select("features", "bag", *used), "bags")
    found = fit_bagged(rows, label, trees, seed, max_depth, weight)
    return stored(out_of_bag(rows, found).select(key, label, "votes", "score", "prediction"), "oob")


def oob_metrics(scored: DataFrame, label: str) -> DataFrame:
    """Metrics of the rows with a score, with the numbers of all rows and of those."""
    sizes = scored.agg(F.struct(F.count(F.lit(1)).alias("n_rows"), F.count("score").alias("n_scored")).alias("n"))
    return (classification_metrics(scored.filter("votes > 0"), label, "prediction", "score")
            .withColumn("n", sizes.scalar()).select("n.n_rows", "n.n_scored", "*").drop("n"))
