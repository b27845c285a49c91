"""Quality classifier: a sparse ensemble of rules, compiled into one Spark column expression.

Shallow trees over text statistics are grown with Spark ML; every path from a root is a conjunction of conditions.
A logistic regression with a lasso penalty then weighs the rules, most weights are zero, and the rest is the model.
Scoring is arithmetic on columns, so a table of any size is scored in the pass that computes the statistics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from quayside.llm.stats import SHARES, text_stats

Condition = tuple[str, str, float]  # column, "<=" or ">", cut

_LINE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_paths(debug: str, columns: list[str]) -> list[tuple[Condition, ...]]:
    """The conditions on the way to every node of every tree, from a model's ``toDebugString``."""
    paths, stack = set(), []
    for line in debug.splitlines():
        if found := _LINE.match(line):
            depth, (_, _, column, sign, cut) = len(found[1]), found.groups()
            while stack and stack[-1][0] >= depth:
                stack.pop()
            stack.append((depth, (columns[int(column)], sign, float(cut))))
            paths.add(_tightest(c for _, c in stack))
        elif "Tree" in line:
            stack = []
    return sorted(paths)


def _tightest(conditions) -> tuple[Condition, ...]:
    """One bound a side for each column."""
    kept: dict = {}
    for column, sign, cut in conditions:
        old = kept.get((column, sign))
        kept[column, sign] = cut if old is None else min(old, cut) if sign == "<=" else max(old, cut)
    return tuple(sorted((c, s, v) for (c, s), v in kept.items()))


def rule_column(rule: tuple[Condition, ...]) -> Column:
    """1.0 where all conditions hold, else 0.0."""
    holds = F.lit(True)
    for name, sign, cut in rule:
        holds = holds & (F.col(name) <= cut if sign == "<=" else F.col(name) > cut)
    return F.when(holds, 1.0).otherwise(0.0)


@dataclass(frozen=True)
class RuleEnsemble:
    """Rules with weights that are not zero, and the intercept."""

    rules: tuple[tuple[tuple[Condition, ...], float], ...]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1, over columns named like the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + rule_column(rule) * weight
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_rule_ensemble(docs: DataFrame, labels: DataFrame, max_sample: int = 20_000, trees: int = 12, depth: int = 3,
                      penalty: float = 0.002, seed: int = 5) -> RuleEnsemble:
    """Fit on at most ``max_sample`` labelled documents, drawn by a hash of the id.

    Rows of ``labels`` without id or quality are ignored; of repeated ids one row counts. Without rows, or with rows of
    one kind only, there are no rules, and the score is the smoothed share of label 1.
    """
    chosen = (labels.select("doc_id", "quality").dropna().dropDuplicates(["doc_id"])
              .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_sample rows of two numbers
    stats = (rows.select("doc_id", "quality", text_stats("text").alias("s"))
             .select("doc_id", (F.col("quality") > 0).cast("double").alias("label"), "s.*")
             .dropDuplicates(["doc_id"]).orderBy("doc_id").limit(max_sample))
    columns = list(SHARES)
    spark = docs.sparkSession
    local = stats.select("label", *columns).toPandas()  # at most max_sample rows; the fits below read them many times
    n, ones = len(local), float(local.label.sum())
    if not 0 < ones < n:
        return RuleEnsemble((), float(_logit((ones + 0.5) / (n + 1))))
    sample = spark.createDataFrame(local).repartition(4).cache()
    vector = VectorAssembler(inputCols=columns, outputCol="x")
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, seed=seed,
                                    featureSubsetStrategy="onethird").fit(vector.transform(sample))
    rules = tree_paths(forest.toDebugString, columns)
    if not rules:
        sample.unpersist()
        return RuleEnsemble((), float(_logit(ones / n)))
    met = sample.select("label", *[rule_column(r).alias(f"r{i}") for i, r in enumerate(rules)])
    met = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(met)
    lasso = LogisticRegression(labelCol="label", featuresCol="x", regParam=penalty, elasticNetParam=1.0, maxIter=100,
                               standardization=False).fit(met.select("label", "x"))
    sample.unpersist()
    weights = lasso.coefficients.toArray()
    kept = tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9)
    return RuleEnsemble(kept, float(lasso.intercept))


def _logit(p: float) -> float:
    from math import log
    return log(p / (1 - p))


def score_documents(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to every row.

    A null or empty text has all statistics zero and is scored like any other. Rows are scored one by one: ties,
    repeats and other columns don't matter, columns of these names are replaced, an empty table gives no rows.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(F.struct(*keep).alias("_row"), text_stats("text").alias("_s")).select("_row", "_s.*")
    return (rows.select("_row", model.score().alias("score")).select("_row.*", "score")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
