"""Model fits. Results depend on the optimiser, so most have no SQL; tests check their invariants."""

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quayside.catalog.fixtures import FEATURES, labelled_once, scaled_labelled
from quayside.catalog.registry import query
from quayside.operators import features as X, models as L, sampling as P
from quayside.sources import read_table, stored


def _split(spark, sf):
    """Train and test rows, both scaled by the statistics of the train rows.

    The ranking that splits them is run once for each part, not anew for each pass of a fit.
    """
    parts = X.split_random(labelled_once(spark, sf), "doc_id", 0.25, label="quality")
    parts = [stored(part, name) for part, name in zip(parts, ("train", "test"))]
    params = stored(X.z_score_params(parts[0], FEATURES), "scales")
    return [X.z_score(part, FEATURES, params).fillna(0.0, subset=FEATURES) for part in parts]


#: The settings that the surveyed searches use.
GRID = {"C": [10.0, 4.0, 2.0, 1.0, 0.5, 0.1, 0.01, 0.001], "penalty": ["l1", "l2"]}


# A fit on one 0/1 feature, hardly penalised, has the log odds ratio of the 2x2 table as its coefficient.
@query("fit_logistic_odds", """
WITH t AS (SELECT quality, CASE WHEN n_chars >= 300 THEN 1 ELSE 0 END AS long
  FROM labels JOIN documents USING (doc_id)),
c AS (SELECT count(*) FILTER (WHERE long = 1 AND quality = 1)::DOUBLE AS a,
  count(*) FILTER (WHERE long = 1 AND quality = 0) AS b, count(*) FILTER (WHERE long = 0 AND quality = 1) AS c,
  count(*) FILTER (WHERE long = 0 AND quality = 0) AS d FROM t)
SELECT 'long' AS feature, ln(a * d / (b * c)) AS coefficient, CASE WHEN a * d > b * c THEN '+' ELSE '-' END AS direction
FROM c""", {"coefficient": 2})
def _(spark, sf):
    rows = read_table(spark, sf, "labels").join(read_table(spark, sf, "documents").select(
        "doc_id", (F.col("n_chars") >= 300).cast("double").alias("long")), "doc_id")
    return L.coefficient_table(L.fit_logistic(rows, ["long"], "quality", C=1e9), ["long"]).select(
        "feature", "coefficient", "direction")


@query("fit_logistic")
def _(spark, sf):
    train, test = _split(spark, sf)
    model = L.fit_logistic(train, FEATURES, "quality", C=0.1)
    return L.predict_new(model, test, FEATURES).select("doc_id", "quality", "prediction", "score")


@query("predict_new")
def _(spark, sf):
    rows = scaled_labelled(spark, sf)
    model = L.fit_logistic(rows, FEATURES, "quality")
    made_up = P.sample_columns_independently(rows, FEATURES, 20, "doc_id", 48)
    return L.predict_new(model, made_up, FEATURES).select("row", "prediction", "score")


@query("coefficient_table")
def _(spark, sf):
    rows = scaled_labelled(spark, sf)
    return L.coefficient_table(L.fit_logistic(rows, FEATURES, "quality", C=0.1), FEATURES)


@query("odds_ratio_by_family")
def _(spark, sf):
    rows = X.one_hot(scaled_labelled(spark, sf), "source", "source_")
    names = [c for c in rows.columns if c.startswith("source_")]
    coefs = L.coefficient_table(L.fit_logistic(rows, [*FEATURES, *names], "quality"), [*FEATURES, *names])
    about = read_table(spark, sf, "documents").groupBy(F.col("source").alias("level")).agg(
        F.count(F.lit(1)).alias("n_documents"))
    return L.odds_ratio_by_family(coefs, "source_", about, 2)


@query("grid_search")
def _(spark, sf):
    return L.grid_search(scaled_labelled(spark, sf), FEATURES, "quality", GRID, "roc_auc", "doc_id")[0]


# Whatever the penalty, a model of one feature orders the rows as the feature does, or the other way round.
ONE_FEATURE = """
WITH t AS (SELECT doc_id, quality, n_chars, (row_number() OVER (PARTITION BY quality ORDER BY
    ('0x' || substr(md5(doc_id || '|48'), 1, 13))::BIGINT, doc_id) - 1) % 5 AS fold
  FROM labels JOIN documents USING (doc_id)),
signs AS (SELECT k.fold, sign(covar_pop(quality, n_chars)) AS s
  FROM (SELECT DISTINCT fold FROM t) k JOIN t ON t.fold <> k.fold GROUP BY 1),
r AS (SELECT t.fold, quality, rank() OVER (PARTITION BY t.fold ORDER BY s * n_chars)
    + (count(*) OVER (PARTITION BY t.fold, n_chars) - 1) / 2.0::DOUBLE AS place FROM t JOIN signs USING (fold)),
auc AS (SELECT fold, (sum(place) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 1)
    * (count(*) FILTER (WHERE quality = 1) + 1) / 2.0::DOUBLE)
    / (count(*) FILTER (WHERE quality = 1) * count(*) FILTER (WHERE quality = 0)) AS auc FROM r GROUP BY 1),
means AS (SELECT avg(auc) AS mean_score, stddev_pop(auc) AS std_score FROM auc)
"""


def one_feature(spark, sf):
    return X.z_score(read_table(spark, sf, "labels").join(
        read_table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double")), "doc_id"), ["n_chars"])


@query("grid_search_one_feature", ONE_FEATURE + """
SELECT C, penalty, mean_score, std_score, 1 AS rank
FROM means, (VALUES (1e4::DOUBLE), (1e3::DOUBLE)) c(C), (VALUES ('l1'), ('l2')) p(penalty)""",
       {"mean_score": 8, "std_score": 8})
def _(spark, sf):
    grid = {"C": [1e4, 1e3], "penalty": ["l1", "l2"]}
    return L.grid_search(one_feature(spark, sf), ["n_chars"], "quality", grid, "roc_auc", "doc_id")[0]


# The second feature is nearly without weight, so it leaves first and changes no order.
@query("recursive_elimination_one_feature", ONE_FEATURE + """
SELECT CAST(n AS INTEGER) AS n_features, mean_score, std_score, n = 1 AS best FROM means, (VALUES (1), (2)) v(n)""",
       {"mean_score": 8, "std_score": 8})
def _(spark, sf):
    rows = one_feature(spark, sf).withColumn("nothing", F.lit(0.0))
    return L.recursive_elimination(rows, ["n_chars", "nothing"], "quality", "roc_auc", "doc_id")[0]


@query("cross_validate")
def _(spark, sf):
    return L.cross_validate(scaled_labelled(spark, sf), FEATURES, "quality",
                            lambda: LogisticRegression(labelCol="quality"), "doc_id")


@query("cross_validate_numbers", """
WITH f AS (SELECT *, ('0x' || substr(md5(l_orderkey || '|48'), 1, 13))::BIGINT % 5 AS fold FROM lineitem),
fit AS (SELECT k.fold, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
  FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY 1),
e AS (SELECT f.fold, l_extendedprice AS y, l_extendedprice - a - b * l_quantity AS e FROM f JOIN fit USING (fold))
SELECT CAST(fold AS INTEGER) AS fold, 1 - var_pop(e) / var_pop(y) AS explained_variance,
  1 - avg(e * e) / var_pop(y) AS r2, -avg(e * e) AS neg_mean_squared_error FROM e GROUP BY 1""",
       {"explained_variance": 7, "r2": 7, "neg_mean_squared_error": 1})
def _(spark, sf):
    rows = read_table(spark, sf, "lineitem")
    return L.cross_validate(rows, ["l_quantity"], "l_extendedprice",
                            lambda: LinearRegression(labelCol="l_extendedprice", solver="normal"), "l_orderkey",
                            judge=L.judge_numbers, stratify=False)


@query("recursive_elimination")
def _(spark, sf):
    return L.recursive_elimination(scaled_labelled(spark, sf), FEATURES, "quality", "f1", "doc_id")[0]


@query("single_feature_scores")
def _(spark, sf):
    return L.single_feature_scores(scaled_labelled(spark, sf), FEATURES, "quality", "f1", "doc_id")


@query("single_feature_auc", ONE_FEATURE + """
SELECT f AS feature, mean_score, std_score FROM means, (VALUES ('n_chars'), ('all features')) v(f)""",
       {"mean_score": 8, "std_score": 8})
def _(spark, sf):
    return L.single_feature_scores(one_feature(spark, sf), ["n_chars"], "quality", "roc_auc", "doc_id")


@query("feature_cost_choice")
def _(spark, sf):
    train, test = _split(spark, sf)
    chosen = L.recursive_elimination(train, FEATURES, "quality", "f1", "doc_id")[2]
    return L.feature_cost_choice(train, test, FEATURES, chosen, "quality")


@query("fit_forest")
def _(spark, sf):
    train, _test = _split(spark, sf)
    model = L.fit_forest(X.class_weights(train, "quality"), FEATURES, "quality", weight="weight")
    return L.forest_importances(model, FEATURES)


@query("forest_holdout_score")
def _(spark, sf):
    return L.forest_holdout_score(scaled_labelled(spark, sf), FEATURES, "quality", "doc_id")


@query("forest_oob_score")
def _(spark, sf):
    rows = X.class_weights(scaled_labelled(spark, sf), "quality")
    return L.forest_oob_score(rows, FEATURES, "quality", "doc_id", weight="weight")


# A tree that may not split votes with the share of class 1 in its sample.
@query("forest_oob_rows", """
WITH t AS (SELECT CAST(range AS INTEGER) AS tree FROM range(12)),
p AS (SELECT k, sum(exp(-1) / f) OVER (ORDER BY k) AS upto FROM (SELECT range AS k, factorial(CAST(range AS INTEGER))
  AS f FROM range(17))),
draws AS (SELECT doc_id, quality, tree,
  ('0x' || substr(md5(doc_id || '|48.' || tree), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM labels, t),
bags AS (SELECT *, (SELECT count(*) FROM p WHERE upto <= u) AS n FROM draws),
shares AS (SELECT tree, sum(n * quality) / sum(n)::DOUBLE AS share FROM bags GROUP BY 1)
SELECT doc_id, quality::DOUBLE AS quality, CAST(count(*) FILTER (WHERE n = 0) AS INTEGER) AS votes,
  avg(share) FILTER (WHERE n = 0) AS score, avg((share)) FILTER (WHERE n = 0) > 0.5 AS prediction
FROM bags JOIN shares USING (tree) GROUP BY 1, 2""", {"score": 9})
def _(spark, sf):
    rows = read_table(spark, sf, "labels").withColumn("nothing", F.lit(0.0))
    return L.forest_oob_rows(rows, ["nothing"], "quality", "doc_id", 12, max_depth=0).withColumn(
        "prediction", F.col("prediction") == 1)


def contributed(spark, sf):
    rows = scaled_labelled(spark, sf)
    model = L.fit_forest(rows, FEATURES, "quality")
    return L.forest_contributions(model, L.predict_new(model, rows, FEATURES), FEATURES)


@query("forest_contributions", """
SELECT doc_id, true AS adds_up FROM labels""")
def _(spark, sf):
    total = F.aggregate("contributions", F.col("prior"), lambda a, c: a + c)
    return contributed(spark, sf).select("doc_id", (F.abs(total - F.col("score")) < 1e-9).alias("adds_up"))


@query("mean_contributions")
def _(spark, sf):
    return L.mean_contributions(contributed(spark, sf), FEATURES)


@query("fit_linear", """
SELECT 'intercept' AS term, regr_intercept(l_extendedprice, l_quantity) AS value FROM lineitem
UNION ALL SELECT 'l_quantity', regr_slope(l_extendedprice, l_quantity) FROM lineitem""", {"value": 3})
def _(spark, sf):
    model = L.fit_linear(read_table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    return L.linear_table(model, ["l_quantity"])


def points(spark, sf):
    return L.array_features(read_table(spark, sf, "embeddings"), "embedding")


@query("fit_kmeans", "SELECT CAST(count(*) AS BIGINT) AS n_rows, 10::BIGINT AS n_segments FROM embeddings")
def _(spark, sf):
    rows = points(spark, sf)
    segments = L.label_segments(L.fit_kmeans(rows, "features", 10), rows)
    return segments.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("segment").alias("n_segments"))


@query("kmeans_sweep")
def _(spark, sf):
    return L.kmeans_sweep(points(spark, sf), "features", range(2, 50))


# Silhouettes from all pairs of rows, which the sums of the clusters stand for.
@query("kmeans_judge", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
runs AS (SELECT k, c.vec_id AS id, c.x AS c FROM (VALUES (2), (3), (7), (12)) r(k) JOIN e c ON c.vec_id < k),
away AS (SELECT k, e.vec_id, id, list_distance(x, c) ** 2 AS d FROM e, runs),
near AS (SELECT k, vec_id, arg_min(id, d) AS own, min(d) AS d FROM away GROUP BY 1, 2),
sizes AS (SELECT k, own, count(*) AS n FROM near GROUP BY 1, 2),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.x, b.x) ** 2 AS d FROM e a, e b),
means AS (SELECT near.k, a, near.own, sum(pairs.d) AS total FROM pairs JOIN near ON near.vec_id = b GROUP BY 1, 2, 3),
sides AS (SELECT m.k, m.a, max(CASE WHEN m.own = o.own THEN total / greatest(n - 1, 1) END) AS inside,
  min(CASE WHEN m.own <> o.own THEN total / n END) AS outside, max(CASE WHEN m.own = o.own THEN n END) AS n
  FROM means m JOIN sizes s ON s.k = m.k AND s.own = m.own JOIN near o ON o.k = m.k AND o.vec_id = m.a GROUP BY 1, 2)
SELECT CAST(k AS INTEGER) AS k, (SELECT sum(d) FROM near WHERE near.k = sides.k) AS inertia,
  avg(CASE WHEN n > 1 THEN (outside - inside) / greatest(inside, outside) ELSE 0 END) AS silhouette
FROM sides GROUP BY k""", {"inertia": 6, "silhouette": 8})
def _(spark, sf):
    rows = read_table(spark, sf, "embeddings")
    first = rows.filter("vec_id < 12").orderBy("vec_id").select("embedding").collect()
    centres = np.array([r.embedding for r in first], dtype=float)
    return L.kmeans_judge(rows, "embedding", {k: centres[:k] for k in (2, 3, 7, 12)})


@query("label_segments", "SELECT vec_id, label, true AS is_nearest FROM embeddings")
def _(spark, sf):
    rows = points(spark, sf)
    model = L.fit_kmeans(rows, "features", 5)
    centres = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.clusterCenters())],
                                    "id int, centre array<double>")
    both = L.kmeans_assign(L.label_segments(model, rows), "embedding", centres, "nearest")
    return both.select("vec_id", "label", (F.col("segment") == F.col("nearest")).alias("is_nearest"))


CENTRES = """
parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centres AS (SELECT label AS id, list(m ORDER BY i) AS centre FROM (
  SELECT label, i, avg(x) AS m FROM parts GROUP BY 1, 2) GROUP BY 1)
"""


def label_means(rows):
    parts = rows.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(F.col("label").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("i", "m"))).getField("m").alias("centre"))


@query("kmeans_assign", f"""
WITH {CENTRES}
SELECT vec_id, CAST(arg_min(id, d) AS BIGINT) AS segment FROM (
  SELECT vec_id, id, list_distance(embedding::DOUBLE[], centre) AS d FROM embeddings, centres) GROUP BY 1""")
def _(spark, sf):
    rows = read_table(spark, sf, "embeddings")
    return L.kmeans_assign(rows, "embedding", label_means(rows)).select("vec_id", "segment")


# A row without a vector has no segment.
@query("kmeans_assign_null", f"""
WITH {CENTRES}
SELECT vec_id, CASE WHEN vec_id % 3 <> 0 THEN CAST(arg_min(id, d) AS BIGINT) END AS segment FROM (
  SELECT vec_id, id, list_distance(embedding::DOUBLE[], centre) AS d FROM embeddings, centres) GROUP BY 1""")
def _(spark, sf):
    rows = read_table(spark, sf, "embeddings")
    holed = rows.withColumn("embedding", F.when(F.col("vec_id") % 3 != 0, F.col("embedding")))
    return L.kmeans_assign(holed, "embedding", label_means(rows)).select("vec_id", "segment")
