"""What many passes read is computed once: the parts of a split, and the scores that are judged."""

import numpy as np
import pytest

from quayside.catalog import q_models
from quayside.operators import metrics as M, models as L


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_passes_over_a_part_do_not_rank_all_rows_again(spark, folder):
    train, test = q_models._split(spark, folder)
    assert "Window" not in plan(train) + plan(test)
    sizes = spark.read.parquet(f"{folder}/labels.parquet").join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id"), "doc_id").groupBy("quality").count().collect()
    assert {r.quality: r["count"] for r in test.groupBy("quality").count().collect()} == {
        r.quality: int(r["count"] * 0.25 + 0.5) for r in sizes}
    assert train.join(test, "doc_id", "left_semi").isEmpty()
    scale = train.selectExpr("avg(n_words) AS mean", "stddev(n_words) AS std").first()
    assert scale.mean == pytest.approx(0, abs=1e-9) and scale.std == pytest.approx(1)


def test_feature_cost_choice_scores_the_test_rows_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    data = [(float(a), float(b), int(a + b / 2 + rng.normal() > 0)) for a, b in rng.normal(size=(200, 2))]
    rows = spark.createDataFrame(data, "a double, b double, y int")
    judged = []

    def metrics(df, *args):
        judged.append(plan(df))
        return M.classification_metrics(df, *args)

    monkeypatch.setattr(L, "classification_metrics", metrics)
    got = L.feature_cost_choice(rows, rows, ["a", "b"], ["a"], "y", max_iter=20).collect()
    assert len(judged) == 2 and not any("UDF" in p for p in judged) and all("parquet" in p for p in judged)
    for row, used in zip(got, (["a", "b"], ["a"])):
        scored = L.predict_new(L.fit_logistic(rows, used, "y", max_iter=20), rows, used)
        want = M.classification_metrics(scored, "y", "prediction", "score").first()
        assert [row[c] for c in want.asDict()] == pytest.approx(list(want))
