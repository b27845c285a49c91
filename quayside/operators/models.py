"""Model fits with Spark ML and tables about them.

Loops here run over parameter sets, folds, features or cluster numbers, never over data; each turn is a
distributed fit. The input of a loop is cached and released.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quayside.functions.scalars import str_startswith
from quayside.operators.bagging import POISSON, oob_metrics, oob_rows
from quayside.operators.clusters import first_centres, fit_many_kmeans, judge_centres, point_rows
from quayside.operators.features import fold_assign, split_random
from quayside.operators.forest import Forest, grow_forest, poisson_bags
from quayside.operators.logistic import Fit, Fitted, arrayed, fit_many, score_many
from quayside.operators.metrics import classification_metrics, regression_metrics
from quayside.operators.sampling import top_bottom_k
from quayside.operators.windows import rank_results
from quayside.sources import stored, to_features

SEED = 48


@contextmanager
def _cached(df: DataFrame):
    """The rows in memory, in partitions of the advised size: many passes pay for each partition again."""
    df = df.hint("rebalance").cache()
    try:
        yield df
    finally:
        df.unpersist()


def _at_once(fn: Callable, items, parallelism: int) -> list:
    """``fn`` of each item, several at a time; each is a few Spark jobs, which share the cluster."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(fn), list(items), chunksize=1)


def _logistic(label: str, c: float, penalty: str, n_rows: int, max_iter: int, features: str = "features"):
    """C weighs the summed loss against the penalty; Spark weighs the penalty against the mean loss."""
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, standardization=False,
                              regParam=1.0 / (c * n_rows), elasticNetParam=1.0 if penalty == "l1" else 0.0)


def fit_logistic(train: DataFrame, features: list[str], label: str, C: float = 1.0, penalty: str = "l2",
                 max_iter: int = 1000):
    """Logistic regression model with an L1 or L2 penalty of strength 1/C."""
    data = to_features(train, features).select("features", label)
    with _cached(data) as data:
        return _logistic(label, C, penalty, data.count(), max_iter).fit(data)


def predict_new(model, df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Add prediction and, for a classifier, the score of class 1."""
    scored = model.transform(df if features is None else to_features(df, features))
    if "probability" in scored.columns:
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability")


def _folded(df: DataFrame, features: list[str], label: str, k: int, key: str, stratify: bool = True) -> DataFrame:
    folds = fold_assign(df, key, k, label if stratify else None, SEED)
    return to_features(folds, features).withColumn(label, F.col(label).cast("double"))


def grid_search(df: DataFrame, features: list[str], label: str, grid: dict[str, list], score: str, key: str,
                k: int = 5, max_iter: int = 100) -> tuple[DataFrame, object]:
    """Cross-validated score of every (C, penalty) pair, ranked; and the best model fitted on all rows.

    All settings and folds are fitted together, in at most ``max_iter`` passes over the rows; so are the models on
    all rows, of which the best setting's is returned. ``score`` is a column of
    ``classification_metrics``.
    """
    pairs = [(c, p) for c in grid["C"] for p in grid["penalty"]]
    every = tuple(range(len(features)))
    fits = [Fit(float(c), p, fold, every) for c, p in pairs for fold in [*range(k), None]]
    tested = [i for i, f in enumerate(fits) if f.fold is not None]
    with _cached(arrayed(fold_assign(df, key, k, label, SEED), features, label, "fold")) as rows:
        coefficients = fit_many(rows, fits, len(features), max_iter)
        found = score_many(rows, [fits[i] for i in tested], coefficients[tested], score)
    per_pair = np.array(found).reshape(len(pairs), k)
    mean, std = per_pair.mean(axis=1), per_pair.std(axis=1)
    best = max(range(len(pairs)), key=lambda i: (mean[i], -i))
    b = coefficients[(k + 1) * best + k]
    table = df.sparkSession.createDataFrame(
        [(float(c), p, float(m), float(s)) for (c, p), m, s in zip(pairs, mean, std)],
        "C double, penalty string, mean_score double, std_score double")
    return rank_results(table, "mean_score"), Fitted(list(features), float(b[0]), DenseVector(b[1:]))


def _judge_classes(scored: DataFrame, label: str) -> DataFrame:
    return classification_metrics(scored, label, "prediction", "score", ("fold",))


def judge_numbers(scored: DataFrame, label: str) -> DataFrame:
    return regression_metrics(scored, label, "prediction", ("fold",))


def cross_validate(df: DataFrame, features: list[str], label: str, make_estimator: Callable, key: str,
                   k: int = 5, judge: Callable = _judge_classes, stratify: bool = True, parallelism: int = 5
                   ) -> DataFrame:
    """All metrics per fold. ``make_estimator()`` gives an unfitted estimator.

    ``judge(scored, label)`` gives one row per fold, the classification metrics by default; for a regression it is
    ``judge_numbers``, with ``stratify=False``, since folds are then not dealt label by label.
    """
    data = _folded(df, features, label, k, key, stratify)
    with _cached(data) as data:
        data.count()
        models = _at_once(lambda fold: make_estimator().fit(data.filter(F.col("fold") != fold)), range(k), parallelism)
        scored = None
        for fold, model in enumerate(models):
            part = predict_new(model, data.filter(F.col("fold") == fold))
            part = part.select([c for c in ("fold", label, "prediction", "score") if c in part.columns])
            scored = part if scored is None else scored.unionByName(part)
        table = judge(scored, label)
        rows = table.collect()  # one row per fold, taken while the input is cached
    return df.sparkSession.createDataFrame(rows, table.schema)


def mean_over_folds(folds: DataFrame) -> DataFrame:
    names = [c for c in folds.columns if c != "fold"]
    return folds.agg(*[F.avg(c).alias(c) for c in names])


def coefficient_table(model, features: list[str]) -> DataFrame:
    """feature, coefficient, magnitude, direction, odds ratio; largest magnitude first."""
    spark = SparkSession.active()
    rows = [(f, float(c)) for f, c in zip(features, model.coefficients.toArray())]
    c = F.col("coefficient")
    direction = F.when(c > 0, "+").when(c < 0, "-").otherwise("0")
    return (spark.createDataFrame(rows, "feature string, coefficient double")
            .withColumns({"magnitude": F.abs(c), "direction": direction, "odds_ratio": F.exp(c)})
            .orderBy(F.desc("magnitude"), "feature"))


def odds_ratio_by_family(coefs: DataFrame, prefix: str, descriptions: DataFrame | None = None, k: int = 10
                         ) -> DataFrame:
    """The k highest and k lowest odds ratios of the features that start with ``prefix``.

    ``descriptions`` has (level, description); the level is the feature name without the prefix.
    """
    family = coefs.filter(str_startswith(F.col("feature"), prefix)).withColumn(
        "level", F.expr(f"substring(feature, {len(prefix) + 1})"))
    ends = top_bottom_k(family.select("feature", "level", "odds_ratio"), "odds_ratio", k, ["feature"])
    return ends if descriptions is None else ends.join(descriptions, "level", "left")


def recursive_elimination(df: DataFrame, features: list[str], label: str, score: str, key: str, k: int = 5,
                          max_iter: int = 100) -> tuple[DataFrame, DataFrame, list[str]]:
    """Scores per number of features, a ranking of the features, and the features of the best number.

    The elimination is run anew on each fold's training part, so a score never sees its own test rows: the feature with
    the smallest coefficient leaves. The parts and the whole go step by step together, each step beginning with the
    coefficients of the one before. On a tie the smaller number wins. Rank 1 marks the chosen features.
    """
    with _cached(arrayed(fold_assign(df, key, k, label, SEED), features, label, "fold")) as rows:
        left = {fold: tuple(range(len(features))) for fold in [*range(k), None]}
        fits, coefficients, start = [], [], None
        for _ in features:
            step = [Fit(1.0, "l2", fold, used) for fold, used in left.items()]
            start = fit_many(rows, step, len(features), max_iter, start=start)
            fits += step
            coefficients.append(start)
            for (fold, used), b in zip(left.items(), start):
                smallest = used[int(np.argmin(np.abs(b[[1 + i for i in used]])))]
                left[fold] = tuple(i for i in used if i != smallest)
        tested = [i for i, f in enumerate(fits) if f.fold is not None]
        found = score_many(rows, [fits[i] for i in tested], np.concatenate(coefficients)[tested], score)
    scores: dict[int, list[float]] = {}
    for i, value in zip(tested, found):
        scores.setdefault(len(fits[i].used), []).append(value)
    path = [[features[i] for i in f.used] for f in fits if f.fold is None]
    best = max(sorted(scores), key=lambda size: np.mean(scores[size]))
    chosen = next(used for used in path if len(used) == best)
    spark = df.sparkSession
    table = spark.createDataFrame([(n, float(np.mean(s)), float(np.std(s)), n == best) for n, s in scores.items()],
                                  "n_features int, mean_score double, std_score double, best boolean")
    # The feature that left when n features were in use gets rank n - best + 1.
    last_used = {f: min(len(used) for used in path if f in used) for f in features}
    ranks = [(f, f in chosen, max(1, last_used[f] - best + 1)) for f in features]
    ranking = spark.createDataFrame(ranks, "feature string, support boolean, rank int")
    return table, ranking, chosen


def single_feature_scores(df: DataFrame, features: list[str], label: str, score: str, key: str, k: int = 5,
                          max_iter: int = 100) -> DataFrame:
    """Mean cross-validated score of a model per single feature, and of one on all of them; all fitted together."""
    sets = [*[(f, (i,)) for i, f in enumerate(features)], ("all features", tuple(range(len(features))))]
    fits = [Fit(1.0, "l2", fold, used) for _, used in sets for fold in range(k)]
    with _cached(arrayed(fold_assign(df, key, k, label, SEED), features, label, "fold")) as rows:
        found = score_many(rows, fits, fit_many(rows, fits, len(features), max_iter), score)
    values = np.array(found).reshape(len(sets), k)
    table = [(name, float(v.mean()), float(v.std())) for (name, _), v in zip(sets, values)]
    return df.sparkSession.createDataFrame(table, "feature string, mean_score double, std_score double")


def feature_cost_choice(train: DataFrame, test: DataFrame, features: list[str], chosen: list[str], label: str,
                        **fit) -> DataFrame:
    """Test metrics of a model on all features beside one fitted on the chosen features."""
    out = None
    for name, used in [("all", features), ("chosen", chosen)]:
        # The counts and the ranking of the scores read them several times, and not the test rows each time.
        scored = stored(predict_new(fit_logistic(train, used, label, **fit), test, used)
                        .select(label, "prediction", "score"), "scored")
        row = classification_metrics(scored, label, "prediction", "score").select(
            F.lit(name).alias("model"), F.lit(len(used)).alias("n_features"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def fit_forest(train: DataFrame, features: list[str], label: str, trees: int = 100, weight: str | None = None,
               seed: int = SEED, max_depth: int = 30):
    """Random forest classifier, with row weights if a weight column is named. All trees grow in the same passes.

    Each tree takes a row as often as a Poisson number with mean 1 says, and at each split looks at the square root of the
    number of features (a single tree at all).
    """
    used = [label] if weight is None else [label, weight]
    rows = stored(to_features(train, features).select("features", *used, F.monotonically_increasing_id().alias("_row")),
                  "forest-rows")
    numbers = list(range(trees))
    found = grow_forest(rows, label, weight, numbers, seed, max_depth, len(features) if trees == 1 else None,
                        lambda batch: poisson_bags(batch.column(3).to_numpy(), numbers, seed, POISSON), ["_row"])
    return Forest(found, len(features))


def forest_importances(model, features: list[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def forest_holdout_score(df: DataFrame, features: list[str], label: str, key: str, trees: int = 100,
                         weight: str | None = None, **fit) -> DataFrame:
    """Metrics of a forest on a quarter of the rows that it did not see."""
    train, test = split_random(df, key, 0.25, SEED, label)
    model = fit_forest(train, features, label, trees, weight, **fit)
    return classification_metrics(predict_new(model, test, features), label, "prediction", "score")


def forest_oob_rows(df: DataFrame, features: list[str], label: str, key: str, trees: int = 100,
                    weight: str | None = None, seed: int = SEED, max_depth: int = 30) -> DataFrame:
    """(key, label, votes, score, prediction) of each labelled row, from the trees of a forest that haven't seen it.

    ``key`` names the rows: those with the same key are in the same samples. A row that every tree has seen, which with
    few trees happens, has 0 votes and no score.
    """
    return oob_rows(df, features, label, key, trees, weight, seed, max_depth)


def forest_oob_score(df: DataFrame, features: list[str], label: str, key: str, trees: int = 100,
                     weight: str | None = None, **fit) -> DataFrame:
    """Out-of-bag metrics of a forest: each row is judged by the trees whose bootstrap sample doesn't have it.

    One row; ``n_scored`` of the ``n_rows`` labelled rows have such trees and count.
    """
    return oob_metrics(forest_oob_rows(df, features, label, key, trees, weight, **fit), label)


def forest_nodes(model) -> DataFrame:
    """The nodes of a forest as rows: tree, id, left, right, feature, threshold, share of class 1."""
    table = pd.concat([pd.DataFrame({
        "tree": t.number, "id": np.arange(len(t.id)), "left": t.left, "right": t.right, "feature": t.feature,
        "threshold": t.threshold, "share": t.shares[:, 1]}) for t in model.trees])
    return SparkSession.active().createDataFrame(
        table, "tree int, id int, left int, right int, feature int, threshold double, share double")


def forest_contributions(model, df: DataFrame, features: list[str]) -> DataFrame:
    """Add ``prior`` and ``contributions`` (one number per feature): prior + contributions = score of class 1.

    Every step of a row down a tree changes the share of class 1; the change belongs to the feature that was
    split on. The trees (sized by the model, not by the data) go to the tasks; the rows stay where they are.
    """
    shape = [{"left": t.left, "right": t.right, "feature": t.feature, "threshold": t.threshold, "share": t.shares[:, 1]}
             for t in model.trees]
    prior = float(np.mean([t["share"][0] for t in shape]))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def walk(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        out = np.zeros(x.shape)
        for t in shape:
            at = np.zeros(len(x), dtype=int)
            rows = np.arange(len(x))[t["left"][at] >= 0]
            while len(rows):
                node = at[rows]
                f = t["feature"][node]
                down = np.where(x[rows, f] <= t["threshold"][node], t["left"][node], t["right"][node])
                out[rows, f] += (t["share"][down] - t["share"][node]) / len(shape)
                at[rows] = down
                rows = rows[t["left"][down] >= 0]
        return pd.Series(list(out))

    return df.withColumns({"prior": F.lit(prior), "contributions": walk(*[F.col(c).cast("double") for c in features])})


def mean_contributions(df: DataFrame, features: list[str]) -> DataFrame:
    """Average and average size of each feature's contribution over all rows."""
    each = {f: F.col("contributions")[i] for i, f in enumerate(features)}
    long = df.select(*[c.alias(f) for f, c in each.items()]).unpivot([], list(features), "feature", "c")
    return long.groupBy("feature").agg(F.avg("c").alias("mean_contribution"),
                                       F.avg(F.abs("c")).alias("mean_size"))


def fit_linear(train: DataFrame, features: list[str], label: str):
    """Ordinary least squares."""
    return LinearRegression(featuresCol="features", labelCol=label, standardization=False).fit(
        to_features(train, features).select("features", label))


def linear_table(model, features: list[str]) -> DataFrame:
    rows = [("intercept", float(model.intercept))]
    rows += [(f, float(c)) for f, c in zip(features, model.coefficients.toArray())]
    return SparkSession.active().createDataFrame(rows, "term string, value double")


def fit_kmeans(df: DataFrame, features: str, k: int, seed: int = SEED):
    """k-means model on a vector column."""
    return KMeans(featuresCol=features, k=k, seed=seed, predictionCol="segment").fit(df)


def array_features(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def label_segments(model, df: DataFrame, out: str = "segment") -> DataFrame:
    """Add the segment number to every row."""
    return model.transform(df).withColumnRenamed("segment", out)


def kmeans_sweep(df: DataFrame, features: str, ks, seed: int = SEED, max_iter: int = 20) -> DataFrame:
    """Inertia and silhouette for each number of clusters; all runs share the passes over the rows.

    The first centres are a k-means++ sequence over a bounded sample, of which each run takes its first ones. Rows
    without features take no part; without rows there is no result.
    """
    with _cached(point_rows(df, features)) as rows:
        found = judge_centres(rows, fit_many_kmeans(rows, first_centres(rows, list(ks), seed), max_iter))
    return df.sparkSession.createDataFrame(found, "k int, inertia double, silhouette double")


def kmeans_judge(df: DataFrame, features: str, centres: dict[int, np.ndarray]) -> DataFrame:
    """The same for given centres: a matrix with a row per centre, by a number for each set of them."""
    with _cached(point_rows(df, features)) as rows:
        found = judge_centres(rows, {k: np.asarray(c, float) for k, c in centres.items()})
    return df.sparkSession.createDataFrame(found, "k int, inertia double, silhouette double")


def kmeans_assign(df: DataFrame, features: str, centres: DataFrame, out: str = "segment") -> DataFrame:
    """Add the id of the nearest centre (the lowest id on a tie); ``centres`` has (id, centre array).

    A row whose array is null or has a null has no centre. The centres are k rows; more than 10,000 are refused. The distances are one matrix product per batch.
    """
    rows = centres.select("id", "centre").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 centres")
    rows = sorted(rows, key=lambda r: r.id)
    ids = np.array([r.id for r in rows])
    points = np.array([r.centre for r in rows], dtype=float)

    @F.pandas_udf(T.LongType())
    def nearest(col: pd.Series) -> pd.Series:
        known = col.notna().to_numpy()
        x = np.array(col[known].tolist(), dtype=float).reshape(-1, points.shape[1])
        squares = (points * points).sum(axis=1)[None, :] - 2.0 * x @ points.T
        found = pd.Series([None] * len(col), dtype="Int64")
        found[known] = ids[np.argmin(squares, axis=1)]
        return found

    whole = F.col(features).isNotNull() & ~F.coalesce(F.exists(features, lambda v: v.isNull()), F.lit(False))
    return df.withColumn(out, nearest(F.when(whole, F.col(features))))
