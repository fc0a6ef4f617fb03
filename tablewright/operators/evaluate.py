"""Evaluation of scored tables, as aggregations.

Input is a table with a label, a predicted class and, for ranking metrics, a score.
Any number of models can be evaluated together through the ``by`` columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.joins import TASK_ROWS
from tablewright.operators.order_bins import MOST_BINS, add_order_bins, bin_count
from tablewright.operators.profile import histogram
from tablewright.session import materialize

#: Bins of a ranking per task, so that hashing them to tasks evens out.
BINS_PER_TASK = 16

# --- confusion -------------------------------------------------------------


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """``(*by, target, prediction, count)``, sorted."""
    return (
        df.groupBy(*by, F.col(label).alias("target"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(*by, "target", "prediction")
    )


def confusion_dense(
    df: DataFrame, label: str, prediction: str, classes: Sequence = (0, 1)
) -> DataFrame:
    """One row per actual class and one ``pred_<class>`` column each, zeros filled in."""
    cells = [
        F.sum(F.when((F.col(label) == a) & (F.col(prediction) == p), 1).otherwise(0))
        .cast("bigint")
        .alias(f"c{i}_{j}")
        for i, a in enumerate(classes)
        for j, p in enumerate(classes)
    ]
    rows = [
        F.struct(
            F.lit(a).alias("target"),
            *[
                F.coalesce(F.col(f"c{i}_{j}"), F.lit(0)).cast("bigint").alias(f"pred_{p}")
                for j, p in enumerate(classes)
            ],
        )
        for i, a in enumerate(classes)
    ]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def error_counts(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """``(*by, tp, fp, tn, fn)`` for class 1."""

    def cell(actual: int, predicted: int) -> Column:
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        return F.sum(F.when(hit, 1).otherwise(0)).cast("bigint")

    return df.groupBy(*by).agg(
        cell(1, 1).alias("tp"),
        cell(0, 1).alias("fp"),
        cell(0, 0).alias("tn"),
        cell(1, 0).alias("fn"),
    )


# --- metrics from counts ---------------------------------------------------


def _ratio(a: Column, b: Column) -> Column:
    """``a / b``, and 0 where ``b`` is 0."""
    return F.when(b == 0, 0.0).otherwise(a.cast("double") / F.nullif(b, F.lit(0)))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def class_metrics(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Support, precision, recall and F1 of every class, from a confusion table."""
    same = F.col("target").cast("double") == F.col("prediction").cast("double")
    actual = F.struct(
        F.col("target").cast("double").alias("class"),
        F.col("count").alias("support"),
        F.lit(0).cast("bigint").alias("predicted"),
        F.when(same, F.col("count")).otherwise(0).alias("hits"),
    )
    guess = F.struct(
        F.col("prediction").cast("double").alias("class"),
        F.lit(0).cast("bigint").alias("support"),
        F.col("count").alias("predicted"),
        F.lit(0).cast("bigint").alias("hits"),
    )
    totals = (
        confusion.select(*by, F.inline(F.array(actual, guess)))
        .groupBy(*by, "class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("hits").alias("hits"),
        )
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return totals.select(
        *by,
        "class",
        "support",
        "hits",
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def _weighted(confusion: DataFrame, metric: str, name: str, by: Sequence[str]) -> DataFrame:
    per_class = class_metrics(confusion, by)
    value = F.sum(F.col("support") * F.col(metric)) / F.sum("support")
    return per_class.groupBy(*by).agg(value.alias(name))


def accuracy(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    hit = F.col("target").cast("double") == F.col("prediction").cast("double")
    value = F.sum(F.when(hit, F.col("count")).otherwise(0)) / F.sum("count")
    return confusion.groupBy(*by).agg(value.alias("accuracy"))


def weighted_precision(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _weighted(confusion, "precision", "weighted_precision", by)


def weighted_recall(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _weighted(confusion, "recall", "weighted_recall", by)


def weighted_f1(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _weighted(confusion, "f1", "weighted_f1", by)


# --- ranking ---------------------------------------------------------------


def _ranked_cells(
    df: DataFrame, label: str, prediction: str | None, score: str, by: Sequence[str]
) -> DataFrame:
    """``(*by, _score_bin, target, prediction, count, p, n, pairs)``: all that the metrics need, in one pass.

    Scores are cut into bins of rising score; p and n are a bin's positives and negatives, pairs those of its
    pairs that are ordered right.  Rows go to their bin in a single shuffle, to parts whose number grows with
    the rows, as each task sorts its part.  Scores that many rows share show
    up as repeated cut points; only those, and the rows that do not rank, are merged per task first.  Ties
    count half.
    """
    value = F.col(label).cast("double")
    number = F.col(score).cast("double")
    ranks = value.isin(0.0, 1.0) & number.isNotNull() & ~F.isnan(number)
    target, guess = (F.col(label), F.col(prediction)) if prediction else (F.lit(None), F.lit(None))
    rows = df.select(
        *by,
        F.when(ranks, number).alias("_score"),
        F.when(ranks, value).alias("_class"),
        target.alias("target"),
        guess.alias("prediction"),
    )
    spark = df.sparkSession
    parts = ceil(df.count() / TASK_ROWS)
    bins = BINS_PER_TASK * max(bin_count(spark), min(MOST_BINS, parts))
    binned, common = add_order_bins(rows, ["_score"], bins=bins, common=True)
    keys = [*by, "_score_bin", "_score", "target", "prediction", "_class"]
    often = F.col("_score").isNull() | F.col("_score").isin(common)
    merged = binned.filter(often).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    lone = binned.filter(~often).withColumn("count", F.lit(1).cast("bigint"))
    # From here on everything of a bin is in one task: no further shuffle.
    few = parts <= min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = lone.unionByName(merged)  # Spark's own number of parts is enough for few rows
    cells = cells.repartition(*by, "_score_bin") if few else cells.repartition(parts, *by, "_score_bin")
    cells = cells.select(
        *[k for k in keys if k != "_class"],
        "count",
        F.when(F.col("_class") == 1, F.col("count")).otherwise(0).alias("p"),
        F.when(F.col("_class") == 0, F.col("count")).otherwise(0).alias("n"),
    )
    inside = Window.partitionBy(*by, "_score_bin").orderBy("_score")
    up_to = F.sum("n").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ties = F.sum("n").over(inside.rangeBetween(Window.currentRow, Window.currentRow))
    cells = cells.withColumn("pairs", F.col("p").cast("double") * (up_to - ties / 2))
    return cells.groupBy(*by, "_score_bin", "target", "prediction").agg(*[F.sum(c).alias(c) for c in ("count", "p", "n", "pairs")])


def _areas(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, auc)`` from ranked cells; a group without a ranked pair has a null.

    Bins are summed up first: ``BINS_PER_TASK`` per task and group reach the sorted window.
    """
    bins = cells.groupBy(*by, "_score_bin").agg(*[F.sum(c).alias(c) for c in ("p", "n", "pairs")])
    up_to = F.sum("n").over(Window.partitionBy(*by).orderBy("_score_bin"))
    lower = F.col("p").cast("double") * (up_to - F.col("n"))
    bins = bins.withColumn("pairs", F.col("pairs") + lower)
    sums = bins.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("p", "n", "pairs")])
    return sums.select(*by, _area().alias("auc"))


def _area(p: str = "p", n: str = "n", pairs: str = "pairs") -> Column:
    return F.col(pairs) / F.nullif(F.col(p).cast("double") * F.col(n), F.lit(0.0))


def auc_roc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve: share of (1, 0) pairs ranked right, ties half.

    Rows with another label, or without a score (null or NaN), do not take part.  ``df`` is read for the
    cut points and again for the ranking, so it should be a written table if it is costly.
    """
    return _areas(_ranked_cells(df, label, None, score, by), by)


def evaluate_model(
    df: DataFrame, label: str, prediction: str, score: str, by: Sequence[str] = ("model",)
) -> DataFrame:
    """All five metrics of classifiers: ``(*by, metric, value)``.

    Accuracy, precision, recall and F1 count every row with a label, over all classes; a missing
    prediction is an error.  The area under the ROC curve is that of class 1 against class 0.
    Classes and ranks are counted in the same pass, and only the counts are written.  ``df`` is read for
    the cut points and again for the counts, so it should be a written table if it is costly.
    """
    labeled = df.filter(F.col(label).isNotNull())
    cells = materialize(_ranked_cells(labeled, label, prediction, score, by), "evaluated")
    counts = cells.groupBy(*by, "target", "prediction").agg(F.sum("count").alias("count"))

    def weighted(metric: str) -> Column:
        return F.sum(F.col("support") * F.col(metric)) / F.sum("support")

    names = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
    values = [F.sum("hits") / F.sum("support"), *[weighted(m) for m in ("precision", "recall", "f1")]]
    # One aggregation over the classes gives the four metrics of the confusion.
    wide = class_metrics(counts, by).groupBy(*by).agg(*[v.alias(n) for v, n in zip(values, names, strict=True)])
    area = _areas(cells, by).select(*by, F.lit("areaUnderROC").alias("metric"), F.col("auc").alias("value"))
    return wide.unpivot(list(by), names, "metric", "value").unionByName(area)


def compare_models(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per metric, one column per model."""
    return metrics.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))


def risk_distribution_by_class(
    df: DataFrame, label: str, score: str, bins: int = 20
) -> DataFrame:
    """Histogram of the score within 0..1 for each actual class."""
    return histogram(df, score, bins, 0.0, 1.0, by=label)
