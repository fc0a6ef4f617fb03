import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from tablewright.operators import evaluate, joins, score, split, train
from tablewright.operators.evaluate import auc_roc
from tablewright.operators.features import fit_stages, table_stages, text_stages
from tablewright.plans import comments, income, risk
from tablewright.session import materialize
from tablewright.plans.standins import (
    INCOME_CATEGORICAL,
    INCOME_NUMERIC,
    RISK_FEATURES,
    income_rows,
    labeled_texts,
    line_keys,
    risk_rows,
)

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def risk_result(spark):
    return risk.fit_risk(
        risk_rows(spark, FOLDER), RISK_FEATURES, "target", line_keys(), regParam=0.01
    )


def test_split_is_exact_and_stable(spark):
    rows = risk_rows(spark, FOLDER)
    a, b = split.split_train_test(rows, line_keys(), 80, 47)
    assert a.count() + b.count() == rows.count()
    assert 0.75 < a.count() / rows.count() < 0.85
    again, _ = split.split_train_test(rows.repartition(5), line_keys(), 80, 47)
    assert sorted(a.collect()) == sorted(again.collect())
    assert a.join(b, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]).count() == 0


def test_folds_and_samples(spark):
    rows = spark.range(3000)
    folds = split.kfold_assign(rows, ["id"], 3)
    sizes = {r["fold"]: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert set(sizes) == {0, 1, 2} and min(sizes.values()) > 900
    assert 1100 < split.sample_fraction(rows, ["id"], 40).count() < 1300


def test_risk_model(spark, risk_result):
    metrics = {r["metric"]: r["value"] for r in risk_result.metrics.collect()}
    assert set(metrics) == {"areaUnderROC", "precision", "recall", "f1"}
    assert metrics["areaUnderROC"] > 0.95
    names = [r["feature"] for r in risk_result.coefficients.collect()]
    assert names == [*RISK_FEATURES, "intercept"]
    risks = risk_result.predictions.select(F.min("risk"), F.max("risk")).first()
    assert 0.0 <= risks[0] <= risks[1] <= 1.0
    assert risk_result.confusion.agg(F.sum("count")).first()[0] == risk_result.predictions.count()


@pytest.mark.parametrize("reg_param", [0.01, 0.1])
def test_fit_is_the_optimum(spark, reg_param):
    """At the optimum of a convex loss the gradient is zero in every direction."""
    rows = risk_rows(spark, FOLDER)
    vectors = fit_stages(table_stages([], RISK_FEATURES), rows).transform(rows)
    model = train.fit_logreg(vectors.select("features", "target"), "target", regParam=reg_param, tol=1e-10)
    weights = dict(zip(RISK_FEATURES, model.coefficients))
    scored = score.score_linear(rows, weights, model.intercept)
    error = F.col("score") - F.col("target")
    sums = scored.agg(
        F.avg(error).alias("intercept"),
        *[(F.avg(error * F.col(c)) / F.stddev_samp(c)).alias(c) for c in RISK_FEATURES],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in RISK_FEATURES],
    ).first()
    assert abs(sums["intercept"]) < 1e-6
    for c in RISK_FEATURES:
        assert abs(sums[c] + reg_param * sums[f"{c}_std"] * weights[c]) < 1e-6


def test_linear_score_equals_model(spark, risk_result):
    """Scoring from the coefficient table gives the model's probabilities."""
    weights, intercept = score.weights_of(risk_result.coefficients)
    rows = score.score_linear(risk_result.predictions, weights, intercept)
    assert rows.filter(F.abs(F.col("score") - F.col("risk")) > 1e-9).count() == 0


def test_chained_labels_equal_joined_labels(spark):
    rows = labeled_texts(spark, FOLDER)
    labels = ["toxic", "quality"]
    known = rows.filter("toxic is not null")
    prepared = fit_stages(text_stages("text", 500), known)
    vectors = prepared.transform(known).select("features", *labels).cache()
    models = train.fit_multilabel(vectors, labels)
    test = materialize(
        prepared.transform(rows.filter("toxic is null")).select("doc_id", "features"), "test"
    )
    chained = score.score_multilabel(models, test).drop("features")
    apart = [
        score.score_multilabel({label: models[label]}, test).drop("features") for label in labels
    ]
    joined = joins.multi_label_fan_in(test.select("doc_id"), apart, "doc_id")
    assert sorted(chained.collect()) == sorted(joined.select(chained.columns).collect())
    assert "Join" not in chained._jdf.queryExecution().optimizedPlan().toString()


def test_comments_end_to_end(spark):
    rows = labeled_texts(spark, "/root/testdata/sf0.01")
    known, held_out = split.split_train_test(rows.filter("toxic is not null"), ["doc_id"], 80, 47)
    fitted, labels = comments.clean_train(known, "doc_id", "text")
    assert labels == ["toxic", "quality"]
    scored = comments.predict_labels(
        fitted, held_out.select("doc_id", "text"), labels, "doc_id", "text"
    )
    truth = scored.join(held_out.select("doc_id", *labels), "doc_id").cache()
    for label in labels:
        assert auc_roc(truth, label, f"proba_{label}").first()["auc"] > 0.6


def test_cross_validation_equals_spark(spark):
    rows = split.kfold_assign(income_rows(spark, FOLDER), line_keys(), 3).select(
        *INCOME_CATEGORICAL, *INCOME_NUMERIC, "label", "fold"
    ).cache()
    stages = table_stages(INCOME_CATEGORICAL, INCOME_NUMERIC)
    estimator = train.logreg("label", maxIter=20)
    grid = train.param_grid(estimator, [0.01, 0.2])
    ours = train.cross_validate(rows, stages, estimator, grid)
    assert ours.count() == 6
    theirs = CrossValidator(
        estimator=Pipeline(stages=[*stages, estimator]),
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol="label"),
        numFolds=3,
        foldCol="fold",
    ).fit(rows)
    means = {r["reg_param"]: r["mean_auc"] for r in train.best_params(ours).collect()}
    assert [means[0.01], means[0.2]] == pytest.approx(theirs.avgMetrics, abs=1e-4)


def test_scores_of_a_grid_are_shuffled_once(spark, monkeypatch):
    """The ranks of all folds and grid points need no shuffle by anything but bins, before the few sums of the bins."""
    plans = []

    def ranked(df, label, score, by):
        plans.append(evaluate._ranked_cells(df, label, None, score, by)._jdf.queryExecution().executedPlan().toString())
        return auc_roc(df, label, score, by)

    monkeypatch.setattr(train, "auc_roc", ranked)
    rows = spark.range(600).selectExpr("cast(id % 7 as double) a", "cast(id % 5 < 2 as double) label", "cast(id % 3 as int) fold")
    estimator = train.logreg("label", maxIter=3)
    found = train.cross_validate(rows.cache(), table_stages([], ["a"]), estimator, train.param_grid(estimator, (0.01, 0.2)))
    assert sorted((r["reg_param"], r["fold"]) for r in found.collect()) == [(p, k) for p in (0.01, 0.2) for k in range(3)]
    after = plans[0].split("REPARTITION_BY_")[0]
    assert "REPARTITION_BY_" in plans[0] and "Exchange" not in after.rsplit("Exchange", 1)[0]


def test_income_models(spark):
    rows = income_rows(spark, FOLDER)
    task = (rows, INCOME_CATEGORICAL, INCOME_NUMERIC, "label", line_keys())
    tuned = income.fit_tuned_logreg(*task, reg_params=(0.01, 0.2), max_iter=20)
    assert tuned.best.first()["reg_param"] == tuned.model.getRegParam()
    values = {r["metric"]: r["value"] for r in tuned.metrics.collect()}
    assert values["areaUnderROC"] > 0.95
    assert values["weightedRecall"] == pytest.approx(values["accuracy"])
    names = [r["feature"] for r in tuned.coefficients.collect()]
    assert "p_type_vec_ECONOMY" in names and names[-1] == "intercept"

    trees = income.compare_trees(*task, trees=10)
    areas = {
        r["model"]: r["value"] for r in trees.metrics.filter("metric = 'areaUnderROC'").collect()
    }
    assert set(areas) == {"RF", "DT"} and min(areas.values()) > 0.9
    raw = {
        r["model"]: r["value"] for r in trees.raw_metrics().filter("metric = 'areaUnderROC'").collect()
    }
    assert raw["DT"] < areas["DT"]


def test_trees_learn_from_parts_of_few_rows(spark, monkeypatch):
    """A fit of trees gets parts of a bounded number of rows, every row once, however few bytes they take."""
    seen = {}

    def noting(name, fit):
        def noted(df, *args, **params):
            seen[name] = [len(part) for part in df.rdd.glom().collect()]
            return fit(df, *args, **params)

        return noted

    monkeypatch.setattr(train, "TREE_TASK_BYTES", 100 * 200, raising=False)  # a row takes 152 bytes
    monkeypatch.setattr(income, "fit_random_forest", noting("RF", income.fit_random_forest))
    monkeypatch.setattr(income, "fit_decision_tree", noting("DT", income.fit_decision_tree))
    rows = spark.range(3000).selectExpr(
        "id", "concat('c', id % 11) c", "cast(id % 17 as double) x", "cast(id % 17 < 9 as int) label"
    )
    result = income.compare_trees(rows.coalesce(2), ["c"], ["x"], "label", ["id"], trees=2)
    learned = rows.filter(split.in_train(["id"], 80, income.SPLIT_SEED)).count()
    for parts in (seen["RF"], seen["DT"]):
        assert sum(parts) == learned and max(parts) <= 131  # the limit for 152 bytes a row
    assert result.scored.count() == 2 * (3000 - learned)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == spark.newSession().conf.get("spark.sql.files.openCostInBytes")


def test_heart_rows_with_nulls_go(spark):
    from tablewright.sources import HEART

    rng = np.random.default_rng(1)
    rows = [tuple(float(v) for v in rng.integers(0, 2, 14)) for _ in range(20)]
    rows.append((None, *rows[0][1:]))
    cleaned = risk.clean_heart(spark.createDataFrame(rows, HEART.schema))
    assert cleaned.count() == 20
    assert dict(cleaned.dtypes)["age"] == "float" and dict(cleaned.dtypes)["target"] == "int"
