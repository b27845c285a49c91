"""Invariants of splits, metrics and fits."""
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quayside import sources
from quayside.catalog import QUERIES
from quayside.operators import bagging as B, clusters as K, features as X, logistic as G, metrics as M, models as L


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] * 2 - x[:, 1] + 0.5 * rng.normal(size=240) > 0).astype(int)
    data = [(i, *[float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, a double, b double, noise double, y int").cache()


NAMES = ["a", "b", "noise"]


def test_split_is_disjoint_complete_and_balanced(rows):
    for label in (None, "y"):
        train, test = X.split_random(rows, "id", 0.25, label=label)
        a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
        assert not a & b and len(a | b) == 240
    sizes = dict(rows.groupBy("y").count().collect())
    assert dict(test.groupBy("y").count().collect()) == {k: int(n * 0.25 + 0.5) for k, n in sizes.items()}


def test_folds_are_even_per_label(rows):
    counts = X.fold_assign(rows, "id", 5, "y").groupBy("y", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r.y == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert X.fold_assign(rows, "id", 5).select("fold").distinct().count() == 5


def test_weights_level_the_classes(rows):
    total = {r.y: r.w for r in X.class_weights(rows, "y").groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    assert total[0] == pytest.approx(total[1]) == pytest.approx(120)


def test_one_hot_and_multi_hot(spark):
    df = spark.createDataFrame([(1, "b", ["x", "y"]), (2, None, []), (3, "a", ["x", "x"])],
                               "id int, c string, l array<string>")
    hot = X.multi_hot(X.one_hot(df, "c", "c_"), "l", "l_").orderBy("id").collect()
    assert [(r.c_a, r.c_b, r.l_x, r.l_y) for r in hot] == [(0, 1, 1, 1), (0, 0, 0, 0), (1, 0, 1, 0)]


def test_hot_vectors(spark):
    df = spark.createDataFrame([(1, "b", ["x", "y"]), (2, None, None), (3, "a", ["x", None]), (4, "b", [])],
                               "id int, c string, l array<string>")
    one, levels = X.one_hot_vector(df, "c", "v")
    assert levels == ["b", "a"] and [list(r.v) for r in one.orderBy("id").collect()] == [[1, 0], [0, 0], [0, 1], [1, 0]]
    many, words = X.multi_hot_vector(df, "l", "v")
    assert words == ["x", "y"] and [list(r.v) for r in many.orderBy("id").collect()] == [[1, 1], [0, 0], [1, 0], [0, 0]]


def test_confusion_has_the_values_of_both_columns(spark):
    df = spark.createDataFrame([(0, 2), (1, 1)], "y int, p int")
    assert M.confusion_matrix(df, "y", "p").count() == 9


def test_metrics_with_ties_and_one_label(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.9), (1, 0, 0.2), (0, 0, 0.2)], "y int, p int, s double")
    got = M.classification_metrics(df, "y", "p", "s").first()
    assert (got.accuracy, got.balanced_accuracy, got.f1, got.roc_auc) == (0.5, 0.5, 0.5, 0.5)
    only = M.classification_metrics(df.filter("y = 1"), "y", "p", "s").first()
    assert only.roc_auc is None and only.recall == 0.5
    moved = M.roc_auc(df.withColumn("s", F.exp("s")), "y", "s").first().roc_auc
    assert moved == 0.5
    curve = M.roc_curve(df, "y", "s").orderBy("threshold").collect()
    assert [(r.fpr, r.tpr) for r in curve] == [(1.0, 1.0), (0.5, 0.5)]


def test_confusion_keeps_zero_cells(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 1)], "y int, p int")
    assert sorted(tuple(r) for r in M.confusion_matrix(df, "y", "p").collect()) == [
        (0, 0, 0), (0, 1, 2), (1, 0, 0), (1, 1, 1)]


def test_chi_square(spark):
    def table(*cells):
        data = [(r, c) for r, row in enumerate(cells) for c, n in enumerate(row) for _ in range(n)]
        return spark.createDataFrame(data, "r int, c int")
    got = M.chi_square_2x2(table([10, 20], [30, 40]), "r", "c").first()
    assert got.statistic == pytest.approx(0.44642857142857145) and got.p_value == pytest.approx(0.5040358664525046)
    plain = M.chi_square_2x2(table([10, 20], [30, 40]), "r", "c", correction=False).first()
    assert plain.statistic == pytest.approx(0.7936507936507936) and plain.p_value == pytest.approx(0.3729984836134872)
    zero = M.chi_square_2x2(table([5, 0], [5, 10]), "r", "c", correction=False).first()
    assert zero.statistic == pytest.approx(20 / 3) and zero.dof == 1


def test_logistic_and_tables(rows):
    model = L.fit_logistic(rows, NAMES, "y", C=1.0)
    table = L.coefficient_table(model, NAMES).collect()
    assert [r.feature for r in table] == ["a", "b", "noise"] and [r.direction for r in table[:2]] == ["+", "-"]
    assert table[0].odds_ratio == pytest.approx(np.exp(table[0].coefficient))
    sparse = L.fit_logistic(rows, NAMES, "y", C=0.02, penalty="l1")
    assert sparse.coefficients[2] == 0.0 and abs(sparse.coefficients[0]) > 0
    ends = L.odds_ratio_by_family(L.coefficient_table(model, NAMES), "n", k=1).collect()
    assert {(r.end, r.level) for r in ends} == {("top", "oise"), ("bottom", "oise")}


def test_searches(rows):
    table, best = L.grid_search(rows, NAMES, "y", {"C": [0.001, 1.0], "penalty": ["l2"]}, "f1", "id", k=2, max_iter=20)
    assert [r["rank"] for r in table.collect()] == [1, 2] and best.numFeatures == 3
    folds = L.cross_validate(rows, NAMES, "y", lambda: LogisticRegression(labelCol="y", maxIter=10), "id", k=2)
    assert folds.count() == 2 and L.mean_over_folds(folds).first().roc_auc > 0.9
    scores, ranking, chosen = L.recursive_elimination(rows, NAMES, "y", "roc_auc", "id", k=2, max_iter=10)
    assert sorted(r.n_features for r in scores.collect()) == [1, 2, 3] and "a" in chosen
    assert {r.feature: r["rank"] for r in ranking.collect()}["a"] == 1
    single = {r.feature: r.mean_score for r in L.single_feature_scores(rows, ["a", "noise"], "y", "roc_auc", "id", 2, 10).collect()}
    assert single["a"] > single["noise"] and set(single) == {"a", "noise", "all features"}
    both = L.feature_cost_choice(rows, rows, NAMES, ["a", "b"], "y", max_iter=10).collect()
    assert [(r.model, r.n_features) for r in both] == [("all", 3), ("chosen", 2)]


def test_grid_search_query_has_the_operator_s_iterations(spark, folder, monkeypatch):
    given = {}
    monkeypatch.setattr(L, "grid_search", lambda *args, **more: given.update(more) or (args[0], None))
    QUERIES["grid_search"](spark, folder)
    assert given.get("max_iter", 100) >= 100


def test_regression_over_folds(rows):
    folds = L.cross_validate(rows.withColumn("t", 3 * F.col("a") - F.col("b") + 1), ["a", "b"], "t",
                             lambda: LinearRegression(labelCol="t"), "id", k=3, judge=L.judge_numbers, stratify=False)
    assert folds.count() == 3 and folds.first().r2 == pytest.approx(1.0, abs=1e-6)


def test_forest_contributions_add_up(rows):
    model = L.fit_forest(X.class_weights(rows, "y"), NAMES, "y", trees=5, weight="weight", max_depth=4)
    scored = L.forest_contributions(model, L.predict_new(model, rows, NAMES), NAMES).collect()
    for r in scored:
        assert r.prior + sum(r.contributions) == pytest.approx(r.score, abs=1e-9)
    assert L.forest_importances(model, NAMES).first().feature == "a"


def test_kmeans(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(v) for v in rng.normal(c, 0.1, 2)]) for i, c in enumerate([0, 5, 10] * 20)]
    df = L.array_features(spark.createDataFrame(data, "id long, v array<double>"), "v")
    sweep = {r.k: r for r in L.kmeans_sweep(df, "features", [2, 3, 4]).collect()}
    assert sweep[2].inertia > sweep[3].inertia >= sweep[4].inertia
    assert max(sweep.values(), key=lambda r: r.silhouette).k == 3
    model = L.fit_kmeans(df, "features", 3)
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                    "id int, centre array<double>")
    both = L.kmeans_assign(L.label_segments(model, df, "seg"), "v", centres, "mine").collect()
    assert all(r.seg == r.mine for r in both)


def test_fit_or_load(spark, rows, tmp_path):
    calls = []

    def fit():
        calls.append(1)
        return L.fit_logistic(rows, NAMES, "y")

    path = str(tmp_path / "model")
    first = sources.fit_or_load(spark, path, fit, LogisticRegressionModel.load)
    again = sources.fit_or_load(spark, path, fit, LogisticRegressionModel.load)
    assert len(calls) == 1 and list(first.coefficients) == list(again.coefficients)

def test_many_fits_are_those_of_spark(rows, monkeypatch):
    """Penalties, folds and feature sets together, against one converged fit each; at most 100 passes."""
    passes, sums = [], G.keyed_sums
    monkeypatch.setattr(G, "keyed_sums", lambda *args: passes.append(1) or sums(*args))
    data = G.arrayed(X.fold_assign(rows, "id", 3, "y"), NAMES, "y", "fold").cache()
    fits = [G.Fit(5.0, "l1", 0, (0, 1, 2)), G.Fit(0.05, "l1", None, (0, 2)), G.Fit(5.0, "l2", None, (2,)),
            G.Fit(0.05, "l2", 0, (0, 1, 2)), G.Fit(0.05, "l1", 0, (0, 1, 2))]
    found = G.fit_many(data, fits, 3)
    assert found.shape == (5, 4) and len(passes) <= 100
    for fit, b in zip(fits, found):
        seen = data.filter(F.lit(True) if fit.fold is None else F.col("fold") != fit.fold)
        chosen = sources.to_features(seen.select("y", *[F.col("x")[i].alias(f"x{i}") for i in fit.used]),
                                     [f"x{i}" for i in fit.used])
        spark_fit = LogisticRegression(labelCol="y", maxIter=2000, tol=1e-14, standardization=False,
                                       regParam=1 / (fit.C * seen.count()),
                                       elasticNetParam=1.0 if fit.penalty == "l1" else 0.0).fit(chosen)
        want = np.zeros(4)
        want[[0, *[1 + i for i in fit.used]]] = [spark_fit.intercept, *spark_fit.coefficients]
        assert b == pytest.approx(want, abs=1e-5)
        assert all(b[1 + i] == 0 for i in range(3) if i not in fit.used)


def test_many_fits_score_as_the_rows_say(rows):
    data = G.arrayed(X.fold_assign(rows, "id", 3, "y"), NAMES, "y", "fold").cache()
    fits = [G.Fit(1.0, "l2", fold, used) for fold in range(3) for used in ((0,), (0, 1, 2))]
    b = G.fit_many(data, fits, 3)
    local = data.toPandas()
    for score in ("accuracy", "f1", "roc_auc"):
        for fit, c, got in zip(fits, b, G.score_many(data, fits, b, score)):
            part = local[local["fold"] == fit.fold]
            y, margin = part["y"].to_numpy(), np.stack(part["x"]) @ c[1:] + c[0]
            pos, neg = margin[y == 1], margin[y == 0]
            tp, wrong = ((margin > 0) & (y == 1)).sum(), ((margin > 0) != (y == 1)).sum()
            want = {"accuracy": 1 - wrong / len(y), "f1": 2 * tp / (2 * tp + wrong),
                    "roc_auc": (pos[:, None] > neg[None, :]).mean()}[score]
            assert got == pytest.approx(want, abs=1e-12)
    with pytest.raises(ValueError):
        G.score_many(data, fits, b, "guess")


def test_many_fits_of_odd_tables(spark):
    odd = spark.createDataFrame([(i, None if i % 5 else 1.0 * i, 0.0, i % 2) for i in range(30)],
                                "id long, a double, zero double, y int")
    data = G.arrayed(odd.withColumn("fold", F.lit(0)), ["a", "zero"], "y", "fold")
    b = G.fit_many(data, [G.Fit(1.0, p, fold, (0, 1)) for p in ("l1", "l2") for fold in (0, None)], 2)
    assert np.isfinite(b).all() and (b[:, 2] == 0).all() and (b[[0, 2]] == 0).all()  # a fit that sees no row is zero
    apart = spark.createDataFrame([(i, float(i), int(i > 9)) for i in range(20)], "id long, a double, y int")
    c = G.fit_many(G.arrayed(apart, ["a"], "y", None), [G.Fit(1e9, "l2", None, (0,))], 1)[0]
    assert np.isfinite(c).all() and -c[0] / c[1] == pytest.approx(9.5, abs=0.5)  # separable, hardly penalised
    assert G.fit_many(data.limit(0), [G.Fit(1.0, "l2", None, (0,))], 2).tolist() == [[0, 0, 0]]
    table, best = L.grid_search(apart, ["a"], "y", {"C": [1.0], "penalty": ["l1"]}, "accuracy", "id", k=2)
    scored = best.transform(sources.to_features(apart, ["a"])).collect()
    assert table.first().mean_score > 0.8 and all((r.score > 0.5) == (r.prediction == 1) for r in scored)


def test_kmeans_sweep_in_one_pass(spark, monkeypatch):
    passes, sums = [], K.keyed_sums
    monkeypatch.setattr(K, "keyed_sums", lambda *args: passes.append(1) or sums(*args))
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.3, (40, 3)) for c in (0, 4, 9)])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)] + [(-1, None)],
                               "id long, v array<double>").repartition(4)
    found = {r.k: r for r in L.kmeans_sweep(df, "v", range(2, 9), max_iter=10).collect()}
    assert sorted(found) == list(range(2, 9)) and len(passes) <= 12
    assert max(found.values(), key=lambda r: r.silhouette).k == 3
    rows = K.point_rows(df, "v")
    centres = K.fit_many_kmeans(rows, K.first_centres(rows, [3, 5], 48))
    for k in (3, 5):  # centres are the means of the rows nearest to them
        near = ((points[:, None, :] - centres[k][None]) ** 2).sum(axis=2)
        own = near.argmin(axis=1)
        assert centres[k] == pytest.approx(np.stack([points[own == i].mean(axis=0) for i in range(k)]), abs=1e-3)
        vectors = L.array_features(df.filter("v IS NOT NULL"), "v").withColumn("segment", F.lit(0))
        label = spark.createDataFrame([(i, int(s)) for i, s in enumerate(own)], "id long, segment int")
        judged = ClusteringEvaluator(predictionCol="segment").evaluate(vectors.drop("segment").join(label, "id"))
        row = L.kmeans_judge(df, "v", {k: centres[k]}).first()
        assert row.silhouette == pytest.approx(judged, abs=1e-9)
        assert row.inertia == pytest.approx(near.min(axis=1).sum(), rel=1e-9)


def test_kmeans_of_odd_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "id long, v array<double>")
    rows = L.kmeans_sweep(same, "v", [1, 3]).collect()  # one different row: one centre, whatever k
    assert [(r.k, r.inertia) for r in rows] == [(1, 0.0), (3, 0.0)] and all(np.isnan(r.silhouette) for r in rows)
    assert L.kmeans_sweep(same.limit(0), "v", [2]).count() == 0
    far = L.kmeans_judge(same, "v", {2: np.array([[1.0, 2.0], [50.0, 50.0]])}).first()  # a centre without rows
    assert far.inertia == 0.0 and np.isnan(far.silhouette)
    alone = spark.createDataFrame([([0.0],), ([0.0],), ([5.0],)], "v array<double>")
    assert L.kmeans_judge(alone, "v", {2: np.array([[0.0], [5.0]])}).first().silhouette == pytest.approx(2 / 3)


def test_out_of_bag_votes_tree_by_tree(rows):
    """Each tree's sample and vote by hand: a row's score is the mean vote of the trees that don't have it."""
    held = B.with_bags(sources.to_features(rows, NAMES), "id", 6, 5).withColumn("y", F.col("y").cast("double")).cache()
    trees = B.fit_bagged(held, "y", 6, 5, 4, None, lambda fn, items: [fn(i) for i in items])
    bags = {r.id: r.bag for r in held.collect()}
    counts = Counter(n for bag in bags.values() for n in bag)
    assert 0.3 < counts[0] / 1440 < 0.44 and 0.9 < sum(n * k for n, k in counts.items()) / 1440 < 1.1
    votes = [{r.id: r[f"tree_{t}"][1] for r in tree.transform(held).collect()} for t, tree in enumerate(trees)]
    for r in B.out_of_bag(held, trees).collect():
        unseen = [votes[t][r.id] for t in range(6) if bags[r.id][t] == 0]
        assert r.votes == len(unseen)
        assert (r.score is None and r.prediction is None) if not unseen else (
            r.score == pytest.approx(np.mean(unseen), abs=1e-12) and r.prediction == (r.score > 0.5))
    for t in (0, 3):  # rows that are not in a sample don't move its tree
        alone = held.filter(F.col("bag")[t] > 0)
        again = B.fit_bagged(alone, "y", t + 1, 5, 4, None, lambda fn, items: [fn(t)])[0]
        assert {r.id: r[f"tree_{t}"][1] for r in again.transform(held).collect()} == votes[t]


def test_out_of_bag_score(rows):
    noisy = rows.withColumn("coin", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int"))
    fit = {"trees": 12, "max_depth": 8}
    good = L.forest_oob_score(X.class_weights(noisy, "y"), NAMES, "y", "id", weight="weight", **fit).first()
    guess = L.forest_oob_score(noisy, NAMES, "coin", "id", **fit).first()
    assert good.n_rows == 240 and 230 <= good.n_scored <= 240 and good.roc_auc > 0.85
    assert 0.3 < guess.roc_auc < 0.7  # a deep forest knows its own rows by heart, but not by these votes
    few = L.forest_oob_rows(noisy.withColumn("y", F.when(F.col("id") > 9, F.col("y"))), NAMES, "y", "id", 1, max_depth=2)
    some = few.collect()
    assert len(some) == 230 and {r.votes for r in some} == {0, 1} and all((r.score is None) == (not r.votes) for r in some)


def test_rows_without_a_vector_have_no_centre(spark):
    df = spark.createDataFrame([(0, [0.0, 1.0]), (1, None), (2, [9.0, None]), (3, [9.0, 9.0])], "id long, v array<double>")
    centres = spark.createDataFrame([(7, [0.0, 0.0]), (4, [9.0, 9.0])], "id int, centre array<double>")
    got = {r.id: r.segment for r in L.kmeans_assign(df, "v", centres).collect()}
    assert got == {0: 7, 1: None, 2: None, 3: 4}
