"""The quality rules learn from all labelled rows."""
import numpy as np
from pyspark.sql import functions as F

from quayside.llm import quality_rules as Q
from tests.llm.helpers import documents, prose


def brute(scores, good, clean_cost):
    values = np.unique(scores)
    cuts = np.concatenate([[values[0]], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    cost = np.array([(scores[~good] < c).sum() + clean_cost * (scores[good] >= c).sum() for c in cuts])
    best = np.flatnonzero(cost == cost.min())
    return cuts[best[len(best) // 2]]


def test_threshold_is_the_best_of_all_scores(spark):
    rng = np.random.default_rng(2)
    for n, cost, kinds in ((400, 20.0, 1000), (300, 1.0, 12), (5, 3.0, 3), (40, 1000.0, 1), (60, 0.0, 30)):
        scores, good = rng.integers(0, kinds, n) / kinds, rng.random(n) < 0.7
        good[:2] = [True, False]
        rows = spark.createDataFrame([(float(s), bool(g)) for s, g in zip(scores, good)], "score double, good boolean")
        assert Q.calibrated(rows, cost) == brute(scores, good, cost)


def test_all_labelled_rows_count(spark):
    """Every row of the clean ones is in a cell, and one odd row in 12,000 widens the ranges."""
    few = documents(spark, [prose(20 + i % 30, i) for i in range(60)] + [" ".join(["12345"] * 3 + prose(30).split())])
    docs = few.join(spark.range(200).withColumnRenamed("id", "k")).withColumn("doc_id", F.col("k") * 1000 + F.col("doc_id"))
    labels = docs.select("doc_id", (F.col("doc_id") % 1000 < 60).cast("int").alias("quality"))
    rows = Q.labelled_rows(docs, labels)
    assert rows.count() == 12_200 and rows.filter("good").count() == 12_000
    rules = Q.fit_quality_rules(docs, labels, trees=20)
    kept = Q.judge_documents(few, rules).select("doc_id", "rules.kept").collect()
    assert {r.doc_id for r in kept if not r.kept} == {60}


def test_cells_and_masses():
    x = np.random.default_rng(0).normal(size=(900, 3))
    column, cut = Q.random_cuts(x.min(0), x.max(0), 4, 5, 1)
    counts = Q.cell_counts(x, column, cut)
    assert counts.shape == (4, 32) and (counts.sum(axis=1) == 900).all()
    forest = Q.counted_forest(column, cut, counts, 64)
    whole = Q.counted_forest(column, cut, counts, 10_000)
    assert forest.tree_rows == 64 and whole.tree_rows == 900 and forest.column.shape[1] <= whole.column.shape[1]
