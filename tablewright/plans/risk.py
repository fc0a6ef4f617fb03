"""Risk score from numeric measurements, with coefficients and an evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.clean import cast_columns
from tablewright.operators.evaluate import auc_roc, class_metrics, confusion_matrix
from tablewright.operators.features import fit_stages, table_stages
from tablewright.operators.score import risk_score, score
from tablewright.operators.split import split_train_test
from tablewright.operators.train import coefficients_table, fit_logreg
from tablewright.session import materialize
from tablewright.sources.layouts import HEART

# Fixed value: seed of the train/test split of this task.
SPLIT_SEED = 1234


@dataclass(frozen=True)
class RiskResult:
    model: Model
    coefficients: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    confusion: DataFrame


def clean_heart(df: DataFrame) -> DataFrame:
    """Typed measurements; rows with a missing value cannot be used and go."""
    whole = [c for c in HEART.columns if c not in HEART.fractional]
    named = df.select(*HEART.columns)
    return cast_columns(named, {"float": HEART.fractional, "int": whole}).na.drop("any")


def class_one_metrics(predictions: DataFrame, target: str, prediction: str, risk: str) -> DataFrame:
    """``(metric, value)``: exact AUC, and precision, recall and F1 of class 1."""
    confusion = confusion_matrix(predictions, target, prediction)
    one = class_metrics(confusion).filter(F.col("class") == 1.0)
    counted = one.select("precision", "recall", "f1").unpivot(
        [], ["precision", "recall", "f1"], "metric", "value"
    )
    area = auc_roc(predictions, target, risk).select(
        F.lit("areaUnderROC").alias("metric"), F.col("auc").alias("value")
    )
    return counted.unionByName(area)


def fit_risk(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence | None = None,
    report: Sequence[str] | None = None,
    seed: int = SPLIT_SEED,
    **params,
) -> RiskResult:
    """Split, fit, score the held-out rows and evaluate them.

    Without ``keys`` the split hashes the feature row, so copies of a row share a side.
    The scored rows are written once; evaluation and reports read that table.
    """
    train, test = split_train_test(df, list(keys or features), 80, seed)
    assembled = fit_stages(table_stages([], features), train)
    vectors = materialize(assembled.transform(train).select("features", target), "risk-train")
    model = fit_logreg(vectors, target, **params)
    scored = risk_score(score(model, assembled.transform(test)))
    predictions = materialize(
        scored.select(*(report or features), target, "prediction", "risk"), "risk-scored"
    )
    return RiskResult(
        model=model,
        coefficients=coefficients_table(model, vectors),
        predictions=predictions,
        metrics=class_one_metrics(predictions, target, "prediction", "risk"),
        confusion=confusion_matrix(predictions, target, "prediction"),
    )
