"""Encoding, scaling, splits, evaluation tables."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quayside.catalog.fixtures import (
    JUDGED, NUMBERS, SERIES, VIOLATIONS, VISITS, judged, normal_tail_sql, price_series, visits,
)
from quayside.catalog.q_aggregates import rolled
from quayside.catalog.q_windows import HASH52
from quayside.catalog.registry import query
from quayside.operators import features as X, metrics as M, sampling as P
from quayside.sources import read_table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS \"prio_{p}\"" for p in PRIORITIES) + " FROM orders")
def _(spark, sf):
    return X.one_hot(read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                     "prio_").drop("o_orderpriority")


@query("multi_hot", f"""
WITH {VIOLATIONS}
SELECT inspection, CAST(max(CASE WHEN code = 'A' THEN 1 ELSE 0 END) AS INTEGER) AS "violation_A",
  CAST(max(CASE WHEN code = 'N' THEN 1 ELSE 0 END) AS INTEGER) AS "violation_N",
  CAST(max(CASE WHEN code = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS "violation_R" FROM violations GROUP BY 1""")
def _(spark, sf):
    rows = rolled(spark, sf).select("inspection", F.col("violation_codes.code").alias("codes"))
    return X.multi_hot(rows, "codes", "violation_").drop("codes")


SCALED = ", ".join(f"({c} - (SELECT min({c}) FROM lineitem)) / ((SELECT max({c}) FROM lineitem) - "
                   f"(SELECT min({c}) FROM lineitem)) AS {c}" for c in NUMBERS)
EIGHT = {c: 8 for c in NUMBERS}


@query("min_max_scale", f"SELECT l_orderkey, {SCALED} FROM lineitem", EIGHT)
def _(spark, sf):
    return X.min_max_scale(read_table(spark, sf, "lineitem").select("l_orderkey", *NUMBERS), NUMBERS)[0]


@query("z_score", "SELECT l_orderkey, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem) AS {c}"
    for c in NUMBERS) + " FROM lineitem", EIGHT)
def _(spark, sf):
    return X.z_score(read_table(spark, sf, "lineitem").select("l_orderkey", *NUMBERS), NUMBERS)


@query("columns_out_of_unit", """
SELECT * FROM (SELECT 'l_quantity' AS variable, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice) FROM lineitem
UNION ALL SELECT 'l_discount', min(l_discount), max(l_discount) FROM lineitem
UNION ALL SELECT 'l_tax', min(l_tax), max(l_tax) FROM lineitem) WHERE lo < 0 OR hi > 1""")
def _(spark, sf):
    return X.columns_out_of_unit(read_table(spark, sf, "lineitem"), NUMBERS)


@query("auto_category", """
SELECT 'o_orderstatus' AS variable, CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS n_distinct FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders""")
def _(spark, sf):
    return X.auto_category(read_table(spark, sf, "orders"))


def _parts(train, test):
    return P.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test")))


@query("split_random", f"""
SELECT doc_id, CASE WHEN {HASH52.format(key="doc_id", seed=48)} % 10000 < 2500 THEN 'test' ELSE 'train' END AS part
FROM labels""")
def _(spark, sf):
    return _parts(*X.split_random(read_table(spark, sf, "labels").select("doc_id"), "doc_id"))


@query("split_stratified", f"""
SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY {HASH52.format(key="doc_id", seed=48)},
  doc_id) <= round(count(*) OVER (PARTITION BY quality) * 0.2) THEN 'test' ELSE 'train' END AS part FROM labels""")
def _(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    return _parts(*X.split_random(labels, "doc_id", 0.2, label="quality"))


@query("split_time", f"""
WITH {SERIES},
d AS (SELECT ds, row_number() OVER (ORDER BY ds) AS r FROM (SELECT DISTINCT ds FROM series)),
cut AS (SELECT max(ds) AS last FROM d WHERE r <= round((SELECT count(*) FROM d) * 0.8))
SELECT series, ds, CASE WHEN ds <= last THEN 'train' ELSE 'test' END AS part FROM series, cut""")
def _(spark, sf):
    return _parts(*X.split_time(price_series(spark, sf).select("series", "ds"), "ds"))


@query("fold_assign", f"""
SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY
  {HASH52.format(key="doc_id", seed=48)}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels""")
def _(spark, sf):
    return X.fold_assign(read_table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", 5, "quality")


@query("class_weights", """
SELECT doc_id, quality, (SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * n) AS weight
FROM labels JOIN (SELECT quality, count(*) AS n FROM labels GROUP BY 1) USING (quality)""", {"weight": 8})
def _(spark, sf):
    return X.class_weights(read_table(spark, sf, "labels").select("doc_id", "quality"), "quality")


# --- evaluation ----------------------------------------------------------------------------------------

COUNTS = """
c AS (SELECT count(*) FILTER (WHERE quality = 1 AND prediction = 1)::DOUBLE AS tp,
  count(*) FILTER (WHERE quality = 0 AND prediction = 1)::DOUBLE AS fp,
  count(*) FILTER (WHERE quality = 1 AND prediction = 0)::DOUBLE AS fn,
  count(*) FILTER (WHERE quality = 0 AND prediction = 0)::DOUBLE AS tn FROM judged)
"""
AUC = """
ranks AS (SELECT quality, (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0) AS r
          FROM judged),
auc AS (SELECT (sum(r) FILTER (WHERE quality = 1) - p * (p + 1) / 2) / (p * n) AS roc_auc FROM ranks,
  (SELECT count(*) FILTER (WHERE quality = 1)::DOUBLE AS p, count(*) FILTER (WHERE quality = 0)::DOUBLE AS n
   FROM judged) GROUP BY p, n)
"""
METRICS = ["accuracy", "balanced_accuracy", "f1", "weighted_f1", "precision", "recall"]


@query("classification_metrics", f"""
WITH {JUDGED}, {COUNTS}, {AUC}
SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy,
  2 * tp / (2 * tp + fp + fn) AS f1, (2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp))
  / (tp + fp + fn + tn) AS weighted_f1, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, roc_auc
FROM c, auc""", {c: 8 for c in [*METRICS, "roc_auc"]})
def _(spark, sf):
    return M.classification_metrics(judged(spark, sf), "quality", "prediction", "score")


@query("confusion_matrix", f"""
WITH {JUDGED}, v AS (SELECT DISTINCT quality AS x FROM judged UNION SELECT DISTINCT prediction FROM judged)
SELECT a.x AS actual, b.x AS predicted, CAST(count(quality) AS BIGINT) AS n FROM v a CROSS JOIN v b
LEFT JOIN judged ON quality = a.x AND prediction = b.x GROUP BY 1, 2""")
def _(spark, sf):
    return M.confusion_matrix(judged(spark, sf), "quality", "prediction")


@query("roc_curve", f"""
WITH {JUDGED}, t AS (SELECT DISTINCT score AS threshold FROM judged),
n AS (SELECT count(*) FILTER (WHERE quality = 1)::DOUBLE AS p, count(*) FILTER (WHERE quality = 0)::DOUBLE AS n FROM judged)
SELECT threshold, any_value(count_fp / n) AS fpr, any_value(count_tp / p) AS tpr, any_value(count_fp / n) AS chance
FROM (SELECT threshold, count(*) FILTER (WHERE quality = 0 AND score >= threshold) AS count_fp,
        count(*) FILTER (WHERE quality = 1 AND score >= threshold) AS count_tp FROM t, judged GROUP BY 1), n GROUP BY 1""",
       {"threshold": 6, "fpr": 8, "tpr": 8, "chance": 8})
def _(spark, sf):
    return M.roc_curve(judged(spark, sf), "quality", "score")


@query("majority_baseline", """
WITH m AS (SELECT quality AS common FROM labels GROUP BY 1 ORDER BY count(*) DESC, quality DESC LIMIT 1),
c AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE quality = 1)::DOUBLE AS p, any_value(common) AS common
      FROM labels, m)
SELECT CASE common WHEN 1 THEN p / n ELSE 1 - p / n END AS accuracy, 0.5::DOUBLE AS balanced_accuracy,
  CASE common WHEN 1 THEN 2 * p / (p + n) ELSE 0 END AS f1,
  CASE common WHEN 1 THEN 2 * p / (p + n) * p / n ELSE 2 * (n - p) / (2 * n - p) * (n - p) / n END AS weighted_f1,
  CASE common WHEN 1 THEN p / n ELSE 0 END AS precision, CASE common WHEN 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS recall FROM c""",
       {c: 8 for c in METRICS})
def _(spark, sf):
    labels = read_table(spark, sf, "labels")
    return M.majority_baseline(labels, labels, "quality")


@query("regression_metrics", """
SELECT 1 - var_pop(l_extendedprice - 1500 * l_quantity) / var_pop(l_extendedprice) AS explained_variance,
  1 - avg((l_extendedprice - 1500 * l_quantity) ** 2) / var_pop(l_extendedprice) AS r2,
  -avg((l_extendedprice - 1500 * l_quantity) ** 2) AS neg_mean_squared_error FROM lineitem""",
       {"explained_variance": 8, "r2": 8, "neg_mean_squared_error": 1})
def _(spark, sf):
    li = read_table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 1500)
    return M.regression_metrics(li, "l_extendedprice", "guess")


CHI = """
cells AS (SELECT r.test, c.converted, count(v.ts) AS o FROM (SELECT DISTINCT test FROM visits) r
  CROSS JOIN (SELECT DISTINCT converted FROM visits) c
  LEFT JOIN visits v ON v.test = r.test AND v.converted = c.converted GROUP BY 1, 2),
e AS (SELECT *, sum(o) OVER (PARTITION BY test) * sum(o) OVER (PARTITION BY converted) / (sum(o) OVER ())::DOUBLE AS x
      FROM cells)
"""


@query("chi_square_2x2", f"""
WITH {VISITS}, {CHI}
SELECT statistic, 1::BIGINT AS dof, {normal_tail_sql("sqrt(statistic)")} AS p_value
FROM (SELECT sum((abs(o - x) - least(0.5, abs(o - x))) ** 2 / x) AS statistic FROM e)""", {"statistic": 8, "p_value": 6})
def _(spark, sf):
    return M.chi_square_2x2(visits(spark, sf), "test", "converted")


@query("chi_square_expected", f"""
WITH {VISITS}, {CHI} SELECT test, converted, CAST(o AS BIGINT) AS observed, x AS expected FROM e""", {"expected": 6})
def _(spark, sf):
    return M.contingency(visits(spark, sf), "test", "converted")


@query("chi_square_by_priority", """
WITH cells AS (SELECT o_orderpriority, o_orderstatus, count(*) AS o FROM orders GROUP BY 1, 2),
e AS (SELECT *, sum(o) OVER (PARTITION BY o_orderpriority) * sum(o) OVER (PARTITION BY o_orderstatus)
  / (sum(o) OVER ())::DOUBLE AS x FROM cells)
SELECT sum((o - x) ** 2 / x) AS statistic, CAST((count(DISTINCT o_orderpriority) - 1)
  * (count(DISTINCT o_orderstatus) - 1) AS BIGINT) AS dof FROM e""", {"statistic": 8})
def _(spark, sf):
    return M.chi_square_2x2(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus").drop("p_value")


@query("one_hot_vector", """
SELECT c_custkey, segment, CASE WHEN segment IS NULL THEN 0 ELSE 1 END AS ones FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment FROM customer)""")
def _(spark, sf):
    rows = read_table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"))
    hot, levels = X.one_hot_vector(rows, "segment", "hot")
    ones = vector_to_array("hot")
    named = F.filter(F.transform(ones, lambda v, i: F.when(v == 1, F.get(F.array(*map(F.lit, levels)), i))),
                     lambda v: v.isNotNull())
    return hot.select("c_custkey", F.get(named, 0).alias("segment"), F.size(named).alias("ones"))


@query("multi_hot_vector", """
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY 1""")
def _(spark, sf):
    rows = read_table(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    hot, levels = X.multi_hot_vector(rows, "kinds", "hot")
    named = F.transform(vector_to_array("hot"), lambda v, i: F.when(v == 1, F.get(F.array(*map(F.lit, levels)), i)))
    return hot.select("user_id", F.array_join(F.sort_array(F.filter(named, lambda v: v.isNotNull())), ",").alias("kinds"))


@query("z_score_new_rows", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d FROM orders WHERE o_orderkey % 2 = 0)
SELECT o_orderkey, (o_totalprice - m) / d AS o_totalprice FROM orders, s WHERE o_orderkey % 2 = 1""",
       {"o_totalprice": 8})
def _(spark, sf):
    rows = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    even = F.col("o_orderkey") % 2 == 0
    return X.z_score(rows.filter(~even), ["o_totalprice"], X.z_score_params(rows.filter(even), ["o_totalprice"]))
