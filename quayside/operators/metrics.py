"""Evaluation tables from (label, prediction, score) rows, as plain aggregates."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, Window as W, functions as F

from quayside.functions.distributions import chi_square_p
from quayside.plans.blocks import running_total


def _by_score(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """Per distinct score: positives and negatives, and their numbers up to and including it."""
    positive = (F.col(label) == 1).cast("bigint")
    rows = df.select(*keys, F.col(score).cast("double").alias("_s"), positive.alias("_p"))
    per_score = rows.groupBy(*keys, "_s").agg(F.sum("_p").alias("pos"), F.sum(1 - F.col("_p")).alias("neg"))
    return running_total(per_score, keys, ["_s"], {"pos_upto": F.col("pos"), "neg_upto": F.col("neg")},
                         sample_from=rows)


def roc_auc(df: DataFrame, label: str, score: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Share of (positive, negative) pairs that the score orders rightly, ties counting half."""
    ranked = _by_score(df, list(keys), label, score)
    below = F.col("neg_upto") - F.col("neg")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    return ranked.groupBy(*keys).agg(F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def classification_metrics(df: DataFrame, label: str, pred: str, score: str | None = None,
                           keys: tuple[str, ...] = ()) -> DataFrame:
    """accuracy, balanced accuracy, F1, weighted F1, precision, recall and, with a score, ROC AUC.

    Labels are 0 and 1. One row, or one per key. A rate without any row to judge is 0.
    """
    y, p = F.col(label) == 1, F.col(pred) == 1
    counts = df.groupBy(*keys).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                                   F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def rate(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    recall, specificity = rate(tp, tp + fn), rate(tn, tn + fp)
    f1, f0 = rate(2 * tp, 2 * tp + fp + fn), rate(2 * tn, 2 * tn + fp + fn)
    out = {"accuracy": rate(tp + tn, n), "balanced_accuracy": (recall + specificity) / 2, "f1": f1,
           "weighted_f1": (f1 * (tp + fn) + f0 * (tn + fp)) / n, "precision": rate(tp, tp + fp),
           "recall": recall}
    result = counts.select(*keys, *[c.alias(name) for name, c in out.items()])
    if score is None:
        return result
    auc = roc_auc(df, label, score, keys)
    return result.join(auc, list(keys)) if keys else result.withColumn("roc_auc", auc.scalar())


MAX_CELLS = 1_000_000


def _cells(df: DataFrame, row: str, col: str, count: str, square: bool = False) -> DataFrame:
    """Counts of every (row, col) pair of values, pairs that do not occur as 0.

    One scan; the counted cells are fetched behind a size check, and the missing ones are added. A ``square`` table
    has the values of both columns in its rows and in its columns.
    """
    counted = (df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
               .groupBy(row, col).agg(F.count(F.lit(1)).alias(count)))
    found = {(r[0], r[1]): r[2] for r in counted.limit(MAX_CELLS + 1).collect()}
    rows, cols = sorted({r for r, _ in found}), sorted({c for _, c in found})
    if square:
        rows = cols = sorted({*rows, *cols})
    if len(rows) * len(cols) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of {row} and {col}")
    return df.sparkSession.createDataFrame([(r, c, found.get((r, c), 0)) for r, c in product(rows, cols)],
                                           counted.schema)


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows per (actual, predicted), with the cells that do not occur as 0."""
    found = df.select(F.col(label).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted"))
    return _cells(found, "actual", "predicted", "n", square=True)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr, chance) per distinct score, rows at or above the threshold being positive."""
    ranked = _by_score(df, [], label, score)
    total = df.agg(F.struct(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n"))
                   .alias("t")).scalar()
    t = ranked.withColumn("_t", total)
    fpr = F.try_divide(F.col("_t.n") - F.col("neg_upto") + F.col("neg"), F.col("_t.n"))
    tpr = F.try_divide(F.col("_t.p") - F.col("pos_upto") + F.col("pos"), F.col("_t.p"))
    return t.select(F.col("_s").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"), fpr.alias("chance"))


def majority_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Metrics of always predicting the most frequent training label."""
    sizes = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.agg(F.max_by(label, F.struct("n", F.col(label))).alias("m")).scalar()
    return classification_metrics(test.withColumn("_majority", common), label, "_majority")


def regression_metrics(df: DataFrame, label: str, pred: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Explained variance, R2 and negative mean squared error. One row, or one per key."""
    error = F.col(label) - F.col(pred)
    spread = F.var_pop(label)
    mse = F.avg(error * error)
    return df.groupBy(*keys).agg(
        (1 - F.try_divide(F.var_pop(error), spread)).alias("explained_variance"),
        (1 - F.try_divide(mse, spread)).alias("r2"), (-mse).alias("neg_mean_squared_error"))


def contingency(df: DataFrame, row: str, col: str) -> DataFrame:
    """Observed and expected counts of every (row, col) cell, zero cells included."""
    # The windows are over the table of cells, whose size _cells has checked.
    n = F.col("observed")
    by_row, by_col = F.sum(n).over(W.partitionBy(row)), F.sum(n).over(W.partitionBy(col))
    return _cells(df, row, col, "observed").withColumn(
        "expected", by_row * by_col / F.sum(n).over(W.partitionBy()))


def chi_square_2x2(df: DataFrame, row: str, col: str, correction: bool = True) -> DataFrame:
    """Chi-square test of independence of two category columns: statistic, dof, p_value.

    With one degree of freedom and ``correction`` each difference shrinks by up to 0.5 (Yates).
    """
    gap = F.abs(F.col("observed") - F.col("expected"))
    shrunk = gap - F.least(F.lit(0.5), gap)
    dof = (F.count_distinct(row) - 1) * (F.count_distinct(col) - 1)
    sums = contingency(df, row, col).agg(
        F.sum(F.try_divide(gap * gap, F.col("expected"))).alias("plain"),
        F.sum(F.try_divide(shrunk * shrunk, F.col("expected"))).alias("yates"), dof.alias("dof"))
    use_yates = (F.col("dof") == 1) & F.lit(correction)
    return (sums.select(F.when(use_yates, F.col("yates")).otherwise(F.col("plain")).alias("statistic"), "dof")
            .withColumn("p_value", chi_square_p("statistic", "dof")))
