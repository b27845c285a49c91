"""Forests that grow all trees in the same passes."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside import sources
from quayside.operators import bagging as B, forest as R, models as L

NAMES = ["a", "b", "step"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 600))
    y = ((a + 0.5 * b + rng.normal(size=600) * 0.4) > 0).astype(int)
    return spark.createDataFrame([(i, float(a[i]), float(b[i]), float(i % 3), int(y[i])) for i in range(600)],
                                 "id long, a double, b double, step double, y int").cache()


def jobs_of(spark, name, fn):
    spark.sparkContext.setJobGroup(name, "forest")
    try:
        return fn(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_jobs_do_not_grow_with_the_trees(spark, rows):
    few, n = jobs_of(spark, "few", lambda: L.forest_oob_score(rows, NAMES, "y", "id", trees=4).collect())
    many, m = jobs_of(spark, "many", lambda: L.forest_oob_score(rows, NAMES, "y", "id", trees=40).collect())
    assert m <= n + 5 and many[0].roc_auc > 0.85


def test_big_nodes_split_by_sums_as_in_one_task(rows, monkeypatch):
    whole = L.fit_forest(rows, NAMES, "y", trees=5, max_depth=9)
    assert whole.totalNumNodes > 100
    monkeypatch.setattr(R, "IN_ONE", 40)
    split = L.fit_forest(rows, NAMES, "y", trees=5, max_depth=9)
    for s, w in zip(split.trees, whole.trees):
        assert s.id.tolist() == w.id.tolist() and s.feature.tolist() == w.feature.tolist()
        assert np.allclose(s.threshold, w.threshold) and np.allclose(s.weights, w.weights)


def test_a_split_is_the_best_of_all(rows):
    data = rows.select(*NAMES, "y").toPandas()
    held = B.with_bags(sources.to_features(rows, NAMES), "id", 1, 2).withColumn("bag", F.array(F.lit(1)))
    tree = B.fit_bagged(held.select("features", "bag", "y"), "y", 1, 4, 1, None)[0]
    gini = lambda y: 1 - y.mean() ** 2 - (1 - y).mean() ** 2
    looked = R._subsets(4, np.array([1]), 3, 2)[0]
    best = max(gini(data.y) - sum(len(p) / 600 * gini(p) for p in (data.y[data[NAMES[f]] <= v], data.y[data[NAMES[f]] > v]))
               for f in looked for v in data[NAMES[f]].unique()[:-1] if (data[NAMES[f]] > v).any())
    assert tree.fall[0] == pytest.approx(best, abs=0.003)  # 600 values in 256 bins
    went = data[NAMES[tree.feature[0]]] <= tree.threshold[0]
    assert tree.weights[1:].sum(axis=1).tolist() == [went.sum(), (~went).sum()]


def test_rare_levels_keep_their_bin(spark):
    df = spark.range(3000).selectExpr("double(if(id < 2, 0, if(id < 4, 1, 2))) v", "int(id in (2, 3)) y")
    model = L.fit_forest(df, ["v"], "y", trees=20)
    top = L.predict_new(model, df, ["v"]).groupBy("v").agg(F.avg("score").alias("s")).collect()
    assert max(top, key=lambda r: r.s).v == 1.0


def test_odd_inputs_of_forests(spark, rows):
    with pytest.raises(ValueError):
        L.fit_forest(rows.limit(0), NAMES, "y", trees=2)
    with pytest.raises(ValueError):
        L.fit_forest(rows.withColumn("y", F.col("y") + 0.5), NAMES, "y", trees=2)
    three = L.fit_forest(rows.withColumn("y", F.col("step").cast("int")), NAMES, "y", trees=8)
    found = three.transform(sources.to_features(rows, NAMES))
    assert found.filter("prediction != step").count() < 20
    assert np.argmax(three.featureImportances.toArray()) == 2
