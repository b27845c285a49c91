"""Quality rules: two fixed rules, and an isolation forest on the rules' statistics with a calibrated threshold.

All labelled rows take part. The forest's trees are random cuts of the ranges that the labelled rows have, drawn without
looking at a row; one pass counts the clean rows in each cell. Random cuts part odd rows from the clean ones early, so the
mean depth of a row over all trees tells how odd it is. The threshold is the one that the labels ask for, where a rejected
clean row costs as much as ``clean_cost`` kept bad ones, found among all scores by running totals. Then every row is
judged by itself, in one pass over the texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from quayside.llm.stats import COUNTS, SHARES, frame, text_stats
from quayside.plans.blocks import row_rank, running_total
from quayside.plans.sums import keyed_sums, matrix
from quayside.sources import stored

MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: What the forest looks at: all statistics, counts as shares. Which of them tell, the labels decide.
RULE_COLUMNS = list(SHARES)


def base_failed(stats: pd.DataFrame) -> pd.Series:
    return (stats.n_words < MIN_WORDS) | (100 * stats.n_repeat_words > MAX_REPEAT_PERCENT * stats.n_words)


def expected_depth(n: float) -> float:
    """Mean depth of an unsuccessful search in a random binary tree of n rows."""
    if n <= 1:
        return 0.0
    # The formula is for whole numbers from 3 on; between 1 and 3 the depth rises from 0 to 1 and on.
    return max(min(n - 1.0, 1.0), 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n)


@dataclass(frozen=True)
class IsolationForest:
    """Per tree and node: the column (-1 in a leaf), the cut, the two children, the depth that a leaf stands for."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    tree_rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean depth / expected depth): near 1 for a row that is soon alone, below 0.5 for a common one."""
        if not len(x):
            return np.zeros(0)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for column, cut, left, right, depth in zip(self.column, self.cut, self.left, self.right, self.depth):
            at = np.zeros(len(x), np.int32)
            while True:
                inner = column[at] >= 0
                if not inner.any():
                    break
                low = x[rows, np.maximum(column[at], 0)] < cut[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += depth[at]
        return np.exp2(-total / len(self.column) / max(expected_depth(self.tree_rows), 1e-9))


def random_cuts(low: np.ndarray, high: np.ndarray, trees: int, max_depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Column and cut of each inner node of full trees, a row per tree; the children of place i are 2i+1 and 2i+2.

    A node cuts a random column, of those with a range, uniformly in what is left of its range. Ranges may be wider than
    those of the rows that are counted: a row in an empty cell is odd although the column never varied in the rows.
    """
    rng, wide = np.random.default_rng(seed), np.flatnonzero(low < high)
    column, cut = np.full((trees, 2 ** max_depth - 1), -1, np.int32), np.zeros((trees, 2 ** max_depth - 1))
    for t in range(trees if len(wide) else 0):
        lows, highs = low[None, :].astype(float), high[None, :].astype(float)
        for depth in range(max_depth):
            c, each = rng.choice(wide, len(lows)), np.arange(len(lows))
            at = rng.uniform(lows[each, c], highs[each, c])
            column[t, 2 ** depth - 1:2 ** (depth + 1) - 1], cut[t, 2 ** depth - 1:2 ** (depth + 1) - 1] = c, at
            lows, highs = np.repeat(lows, 2, axis=0), np.repeat(highs, 2, axis=0)
            highs[2 * each, c], lows[2 * each + 1, c] = at, at
    return column, cut


def cell_counts(x: np.ndarray, column: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """How many rows are in each cell at the bottom, a row per tree."""
    inner, rows = column.shape[1], np.arange(len(x))
    out = np.zeros((len(column), inner + 1))
    for t in range(len(column)):
        at = np.zeros(len(x), np.int64)
        for _ in range(int(inner + 1).bit_length() - 1):
            at = 2 * at + 2 - (x[rows, column[t, at]] < cut[t, at])
        out[t] = np.bincount(at - inner, minlength=inner + 1)
    return out


def counted_forest(column: np.ndarray, cut: np.ndarray, counts: np.ndarray, tree_rows: int) -> IsolationForest:
    """The forest of given cuts and cells; a cell is not cut further where ``tree_rows`` of all rows would leave one."""
    trees, inner = column.shape
    rows = np.concatenate([np.zeros((trees, inner)), counts], axis=1)
    for i in range(inner - 1, -1, -1):
        rows[:, i] = rows[:, 2 * i + 1] + rows[:, 2 * i + 2]
    tree_rows = int(min(tree_rows, rows[0, 0]))
    mass = rows * (tree_rows / rows[:, :1])
    level = np.frexp(np.arange(1, 2 * inner + 2).astype(float))[1] - 1
    cuts = (mass[:, :inner] > 1) & (column >= 0)
    kept = np.zeros(mass.shape, bool)
    kept[:, 0] = True
    for i in range(inner):
        kept[:, 2 * i + 1] = kept[:, 2 * i + 2] = kept[:, i] & cuts[:, i]
    size = kept.sum(axis=1).max()
    nodes = [np.full((trees, size), -1, np.int32), np.zeros((trees, size)), np.zeros((trees, size), np.int32),
             np.zeros((trees, size), np.int32), np.zeros((trees, size))]
    for t in range(trees):
        old = np.flatnonzero(kept[t])
        place = np.cumsum(kept[t]) - 1
        split = np.append(cuts[t], np.zeros(inner + 1, bool))[old]
        here, up = np.flatnonzero(split), old[split]
        nodes[0][t, here], nodes[1][t, here] = column[t, up], cut[t, up]
        nodes[2][t, here], nodes[3][t, here] = place[2 * up + 1], place[2 * up + 2]
        nodes[4][t, :len(old)] = level[old] + np.array([expected_depth(m) for m in mass[t, old]])
    return IsolationForest(*nodes, tree_rows)


def fit_isolation_forest(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = 100, tree_rows: int = 256,
                         max_depth: int = 12, seed: int = 7) -> IsolationForest:
    """The same of rows at hand."""
    column, cut = random_cuts(low, high, trees, max_depth, seed)
    return counted_forest(column, cut, cell_counts(x, column, cut), tree_rows)


def calibrated(scored: DataFrame, clean_cost: float = 20.0) -> float:
    """The cut with the least cost of bad rows below and good rows at or above it, of rows with ``score`` and ``good``.

    Cuts lie between different scores and at the ends; of several best ones it is the middle one.
    """
    by_score = stored(scored.groupBy("score").agg(F.count_if(~F.col("good")).alias("bad"), F.count_if("good").alias("good")),
                      "scores")
    total = by_score.agg(F.sum("good").alias("good"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    upto = running_total(by_score, [], ["score"], {"bad": F.col("bad"), "good": F.col("good")})
    cost = F.col("bad") + F.lit(clean_cost) * (F.lit(total.good) - F.col("good"))
    costs = stored(upto.select("score", cost.alias("cost")), "costs")  # of a cut just above the score
    first = clean_cost * total.good  # of the cut at the lowest score
    least = min(first, costs.agg(F.min("cost")).first()[0])
    best = costs.filter(F.col("cost") == least)
    n = best.count()
    middle = (n + (first == least)) // 2 - (first == least)
    if middle < 0:
        return float(total.low)
    below = row_rank(best, [], ["score"], "place").filter(F.col("place") == middle + 1).first().score
    above = by_score.filter(F.col("score") > below).agg(F.min("score")).first()[0]
    return float(total.high + 1 if above is None else (below + above) / 2)


@dataclass(frozen=True)
class QualityRules:
    """Fitted rules; without a forest (too few labelled rows, or of one kind only) the base rules alone decide."""

    forest: IsolationForest | None
    threshold: float

    def judge(self, stats: pd.DataFrame) -> pd.DataFrame:
        failed = base_failed(stats)
        odd = (self.forest.scores(stats[RULE_COLUMNS].to_numpy(float)) if self.forest else np.zeros(len(stats)))
        return pd.DataFrame({"base_failed": failed, "anomaly": odd, "kept": ~failed & (odd < self.threshold)})


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(good, x) of every labelled document that the base rules keep, x being the values of RULE_COLUMNS; stored.

    Rows of ``labels`` without id or quality are ignored; of repeated ids the best label and one row count. The statistics
    of all texts are taken where the texts are, and only these numbers are joined.
    """
    chosen = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    stats = (docs.filter(F.col("doc_id").isNotNull()).select("doc_id", text_stats("text").alias("s"))
             .select("doc_id", F.struct("s.n_words", "s.n_repeat_words", F.array(*[F.col(f"s.{c}") for c in RULE_COLUMNS]).alias("x")).alias("s")))
    one = stored(stats, "statistics").groupBy("doc_id").agg(F.min("s").alias("s"))
    rows = one.join(chosen, "doc_id").select("good", "s.*").filter(
        ~((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))
    return stored(rows.select("good", "x"), "labelled")


def fit_quality_rules(docs: DataFrame, labels: DataFrame, trees: int = 100, tree_rows: int = 256,
                      clean_cost: float = 20.0, max_depth: int = 12, seed: int = 7) -> QualityRules:
    rows, width = labelled_rows(docs, labels), len(RULE_COLUMNS)
    found = rows.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"),
                     F.array(*[F.min(F.col("x")[i]) for i in range(width)]).alias("low"),
                     F.array(*[F.max(F.col("x")[i]) for i in range(width)]).alias("high")).first()
    if not found.good or not found.bad:
        return QualityRules(None, 1.0)
    column, cut = random_cuts(np.array(found.low, float), np.array(found.high, float), trees, max_depth, seed)
    if (column < 0).any():  # no column varies
        counts = np.zeros((trees, column.shape[1] + 1))
        counts[:, 0] = found.good
    else:
        sums = keyed_sums(rows.filter("good").select("x"), lambda batch: enumerate(
            cell_counts(matrix(batch.column(0), width), column, cut)))
        counts = np.stack([sums[t] for t in range(trees)])
    forest = counted_forest(column, cut, counts, tree_rows)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(forest.scores(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

    return QualityRules(forest, calibrated(rows.select(score("x").alias("score"), "good"), clean_cost))


JUDGED = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]
                      + [T.StructField("base_failed", T.BooleanType()), T.StructField("anomaly", T.DoubleType()),
                         T.StructField("kept", T.BooleanType())])


def judge_documents(docs: DataFrame, rules: QualityRules) -> DataFrame:
    """Add a struct ``rules`` with the counts, base_failed, anomaly (0 to 1) and kept to every row.

    A null or empty text has no words and fails the first rule. Rows are judged one by one: ties, repeats and other
    columns don't matter, an earlier column ``rules`` is replaced, an empty table gives no rows.
    """
    @F.pandas_udf(JUDGED)
    def judged(texts: pd.Series) -> pd.DataFrame:
        stats = frame(texts)
        return pd.concat([stats[list(COUNTS)], rules.judge(stats)], axis=1)

    return docs.drop("rules").withColumn("rules", judged("text"))
