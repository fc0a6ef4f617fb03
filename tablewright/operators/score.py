"""Scoring rows with fitted models or with tables of weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import sigmoid, vector_element
from tablewright.operators.features import sum_columns
from tablewright.operators.joins import lookup_hot_keys


def score(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def risk_score(df: DataFrame, probability: str = "probability", name: str = "risk") -> DataFrame:
    """Add the probability of class 1 as a number."""
    return df.withColumn(name, vector_element(probability, 1))


def score_multilabel(models: Mapping[str, Model], df: DataFrame) -> DataFrame:
    """Add ``proba_<label>`` and ``pred_<label>`` of every model in one pass.

    The models are chained on one frame: no join and no second pass over the features.
    """
    out = df
    for model in models.values():
        out = model.transform(out)
    added = [
        column
        for label in models
        for column in (
            vector_element(f"probability_{label}", 1).alias(f"proba_{label}"),
            F.col(f"pred_{label}"),
        )
    ]
    return out.select(*df.columns, *added)


def score_linear(
    df: DataFrame, weights: Mapping[str, float], intercept: float = 0.0, name: str = "score"
) -> DataFrame:
    """Add ``sigmoid(intercept + sum of weight * column)`` as one SQL expression."""
    terms = [F.lit(float(w)) * F.col(c).cast("double") for c, w in weights.items()]
    return df.withColumn(name, sigmoid(sum_columns([F.lit(float(intercept)), *terms])))


def weights_of(coefficients: DataFrame) -> tuple[dict[str, float], float]:
    """Weights and intercept of a coefficient table, for :func:`score_linear`.

    The table has a row per feature of a fitted model, which is on the driver anyway.
    """
    found = {r["feature"]: r["coefficient"] for r in coefficients.select("feature", "coefficient").collect()}
    intercept = found.pop("intercept", 0.0)
    return found, intercept


def score_linear_long(
    values: DataFrame, weights: DataFrame, key: str, feature: str, value: str, intercept: float
) -> DataFrame:
    """The same score from a long ``(key, feature, value)`` table: ``(key, z, score)``.

    ``weights`` holds ``(feature, weight)``; features without a weight add nothing.  As in
    :func:`score_linear`, a null value of a weighted feature makes the score null.  Features that
    many rows share are not shuffled; products are summed per task before the shuffle by key.
    """
    joined = lookup_hot_keys(values, weights, feature, how="left")
    product = F.when(F.col("weight").isNotNull(), F.col(value) * F.col("weight")).otherwise(F.lit(0.0))
    unknown = F.max(F.col("weight").isNotNull() & F.col(value).isNull())
    z = F.when(~unknown, F.lit(float(intercept)) + F.sum(product))
    return joined.groupBy(key).agg(z.alias("z")).withColumn("score", sigmoid("z"))


def threshold_predict(
    df: DataFrame, score: str, threshold: float = 0.5, name: str = "prediction"
) -> DataFrame:
    """Add 1.0 where the score exceeds the threshold, else 0.0."""
    return df.withColumn(name, F.when(F.col(score) > threshold, 1.0).otherwise(0.0))
