import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tablewright.operators import evaluate, ordering
from tablewright.operators.score import score_linear, threshold_predict


def expand(spark, tn, fp, fn, tp):
    cells = [(0, 0.0, tn), (0, 1.0, fp), (1, 0.0, fn), (1, 1.0, tp)]
    rows = [(t, p) for t, p, n in cells for _ in range(n)]
    return spark.createDataFrame(rows, "target int, prediction double")


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    rows = []
    for model, digits in (("coarse", 1), ("fine", 6)):
        for _ in range(1500):
            label = int(rng.random() < 0.3)
            value = round(min(max(rng.normal(0.35 + 0.3 * label, 0.2), 0.0), 1.0), digits)
            rows.append((model, label, value, 1.0 if value > 0.5 else 0.0))
    return spark.createDataFrame(rows, "model string, label int, score double, prediction double")


def test_known_confusion(spark):
    rows = expand(spark, 65, 24, 13, 109)
    confusion = evaluate.confusion_matrix(rows, "target", "prediction")
    assert [tuple(r) for r in confusion.collect()] == [
        (0, 0.0, 65),
        (0, 1.0, 24),
        (1, 0.0, 13),
        (1, 1.0, 109),
    ]
    one = evaluate.class_metrics(confusion).filter("class = 1").first()
    assert round(one["precision"], 4) == 0.8195
    assert round(one["recall"], 4) == 0.8934
    assert round(one["f1"], 4) == 0.8549
    counts = evaluate.error_counts(rows, "target", "prediction").first()
    assert tuple(counts) == (109, 24, 65, 13)
    dense = evaluate.confusion_dense(rows, "target", "prediction")
    assert [tuple(r) for r in dense.collect()] == [(0, 65, 24), (1, 13, 109)]


def test_dense_confusion_fills_empty_cells(spark):
    dense = evaluate.confusion_dense(expand(spark, 3, 0, 2, 0), "target", "prediction")
    assert [tuple(r) for r in dense.collect()] == [(0, 3, 0), (1, 2, 0)]


def test_never_predicted_class_has_no_precision(spark):
    rows = expand(spark, 3, 0, 2, 0).withColumn("model", F.lit("m")).withColumn("score", F.lit(0.1))
    got = evaluate.evaluate_model(rows, "target", "prediction", "score").collect()
    metrics = {r["metric"]: r["value"] for r in got}
    assert metrics["accuracy"] == pytest.approx(0.6)
    assert metrics["weightedPrecision"] == pytest.approx(0.6 * 0.6)
    assert metrics["areaUnderROC"] == 0.5


def test_metrics_equal_evaluators(spark, scored):
    ours = {
        (r["model"], r["metric"]): r["value"]
        for r in evaluate.evaluate_model(scored, "label", "prediction", "score").collect()
    }
    for model in ("coarse", "fine"):
        rows = scored.filter(F.col("model") == model).withColumn("label", F.col("label").cast("double"))
        for metric in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
            evaluator = MulticlassClassificationEvaluator(metricName=metric)
            assert ours[model, metric] == pytest.approx(evaluator.evaluate(rows), abs=1e-12)
        area = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
        assert ours[model, "areaUnderROC"] == pytest.approx(area.evaluate(rows), abs=1e-12)
        assert ours[model, "weightedRecall"] == pytest.approx(ours[model, "accuracy"], abs=1e-15)


def test_weighted_metrics_agree_with_one_pass(spark, scored):
    confusion = evaluate.confusion_matrix(scored, "label", "prediction", ["model"])
    one_pass = evaluate.evaluate_model(scored, "label", "prediction", "score")
    wide = one_pass.groupBy("model").pivot("metric").agg(F.first("value"))
    for function, column, metric in (
        (evaluate.accuracy, "accuracy", "accuracy"),
        (evaluate.weighted_precision, "weighted_precision", "weightedPrecision"),
        (evaluate.weighted_recall, "weighted_recall", "weightedRecall"),
        (evaluate.weighted_f1, "weighted_f1", "f1"),
    ):
        ours = {r["model"]: r[column] for r in function(confusion, ["model"]).collect()}
        for row in wide.collect():
            assert ours[row["model"]] == pytest.approx(row[metric], abs=1e-12)


def test_area_of_reversed_score(spark, scored):
    forward = evaluate.auc_roc(scored, "label", "score", ["model"])
    reverse = evaluate.auc_roc(scored.withColumn("score", -F.col("score")), "label", "score", ["model"])
    back = {r["model"]: r["auc"] for r in reverse.collect()}
    for row in forward.collect():
        assert row["auc"] + back[row["model"]] == pytest.approx(1.0, abs=1e-12)


def test_area_does_not_depend_on_bins_or_partitions(spark, scored, monkeypatch):
    expected = sorted(evaluate.auc_roc(scored, "label", "score", ["model"]).collect())
    for bins in (2, 5, 700):
        monkeypatch.setattr("tablewright.operators.order_bins.bin_count", lambda _, b=bins: b)
        again = sorted(evaluate.auc_roc(scored.repartition(11), "label", "score", ["model"]).collect())
        for a, b in zip(expected, again):
            assert a["auc"] == pytest.approx(b["auc"], abs=1e-12)


def test_area_needs_both_classes(spark):
    rows = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert evaluate.auc_roc(rows, "label", "score").first()["auc"] is None


def test_compare_and_best(spark):
    metrics = spark.createDataFrame(
        [("LR", "f1", 0.7), ("RF", "f1", 0.8), ("DT", "f1", 0.8), ("LR", "auc", 0.9), ("RF", "auc", 0.6)],
        "model string, metric string, value double",
    )
    wide = evaluate.compare_models(metrics, ["LR", "RF", "DT"])
    rows = {r["metric"]: (r["LR"], r["RF"], r["DT"]) for r in wide.collect()}
    assert rows == {"f1": (0.7, 0.8, 0.8), "auc": (0.9, 0.6, None)}
    best = {r["metric"]: (r["model"], r["value"]) for r in ordering.best_model_per_metric(metrics).collect()}
    assert best == {"f1": ("DT", 0.8), "auc": ("LR", 0.9)}


def test_best_ignores_missing_values(spark):
    metrics = spark.createDataFrame(
        [("A", "auc", None), ("B", "auc", 0.4)], "model string, metric string, value double"
    )
    assert [tuple(r) for r in ordering.best_model_per_metric(metrics).collect()] == [("auc", "B", 0.4)]


def test_linear_score(spark):
    rows = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    got = threshold_predict(score_linear(rows, {"a": 0.5, "b": -1.0}, 0.25), "score").first()
    assert got["score"] == pytest.approx(1 / (1 + math.exp(1.25)))
    assert got["prediction"] == 0.0


def test_coefficient_reports(spark):
    table = spark.createDataFrame(
        [("a", -2.0), ("b", 1.0), ("c", 1.5), ("intercept", 9.0)], "feature string, coefficient double"
    )
    assert [r["feature"] for r in ordering.rank_coefficients(table).collect()] == ["a", "b", "c"]
    features = table.filter("feature <> 'intercept'")
    top = ordering.top_k_abs(features, "coefficient", ["feature"], 2).collect()
    assert [r["feature"] for r in top] == ["a", "c"]


def test_parts_of_a_ranking_grow_in_number(spark, scored, monkeypatch):
    want = {r["model"]: r["auc"] for r in evaluate.auc_roc(scored, "label", "score", ["model"]).collect()}
    monkeypatch.setattr(evaluate, "TASK_ROWS", 100)
    cells = evaluate._ranked_cells(scored, "label", "prediction", "score", ["model"])
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "model#" in plan and "_score_bin" in plan and ", 30), REPARTITION_BY_NUM" in plan
    got = {r["model"]: r["auc"] for r in evaluate.auc_roc(scored, "label", "score", ["model"]).collect()}
    assert got == pytest.approx(want)
