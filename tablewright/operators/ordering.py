"""Sorted results and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort(df: DataFrame, *columns) -> DataFrame:
    return df.orderBy(*columns)


def head_n(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """The first ``n`` rows in a stated order (a per-task top-k, no full sort)."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, columns: Sequence[str], order: Sequence, n: int = 20) -> DataFrame:
    """The rows a report prints: some columns of the first ``n`` rows."""
    return head_n(df, n, order).select(*columns)


def rank_coefficients(coefficients: DataFrame) -> DataFrame:
    """Feature weights from most negative to most positive, without the intercept."""
    return coefficients.filter(F.col("feature") != "intercept").orderBy("coefficient", "feature")


def top_k_abs(df: DataFrame, value: str, order: Sequence, k: int = 15) -> DataFrame:
    """The ``k`` rows of largest absolute value, then sorted by signed value."""
    return df.orderBy(F.abs(value).desc(), *order).limit(k).orderBy(value, *order)


def best_model_per_metric(metrics: DataFrame) -> DataFrame:
    """For each metric of a long metric table the best model; ties go to the first name.

    A metric that is null for a model, as AUC is without both classes, does not compete.
    """
    return metrics.filter(F.col("value").isNotNull()).groupBy("metric").agg(
        F.min_by("model", F.struct(-F.col("value"), F.col("model"))).alias("model"),
        F.max("value").alias("value"),
    )
