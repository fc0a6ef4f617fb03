"""Fitting models with ``pyspark.ml``.

Feature tables passed in should be written tables (see ``session.materialize``) or
cached: every fit reads them more than once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import vector_element
from tablewright.operators import forest
from tablewright.operators.evaluate import auc_roc
from tablewright.operators.features import feature_names, fit_stages
from tablewright.operators.joins import union_all
from tablewright.operators.slots import ENTRY_BYTES, ROW_BYTES, Slots, SlotStages
from tablewright.session import discard, materialize

# Regularization of the text models, the grid searched and the iteration
# limit for the income model, the size of the forest.
TEXT_REG_PARAM = 0.1
REG_PARAMS = (0.01, 0.1, 0.2)
CV_MAX_ITER = 110
TREES = 100

# Bytes of memory for the rows that one task of a fit of trees keeps.
TREE_TASK_BYTES = 128 * 1024 * 1024


def logreg(label: str, features: str = "features", **params) -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label, **params)


def fit_logreg(train: DataFrame, label: str, features: str = "features", **params) -> Model:
    """Logistic regression; without parameters it is not regularized."""
    return logreg(label, features, **params).fit(train)


def fit_logreg_l2(
    train: DataFrame, label: str, reg_param: float = TEXT_REG_PARAM, **params
) -> Model:
    return fit_logreg(train, label, regParam=reg_param, **params)


def _in_threads(tasks: Sequence, parallelism: int, spark) -> list:
    """Run independent Spark jobs side by side, results in order."""
    pool = ThreadPool(processes=max(1, min(parallelism, len(tasks))))
    try:
        return pool.map(lambda t: inheritable_thread_target(spark)(t)(), tasks)
    finally:
        pool.close()


def fit_multilabel(
    train: DataFrame,
    labels: Sequence[str],
    reg_param: float = TEXT_REG_PARAM,
    parallelism: int = 4,
    **params,
) -> dict[str, Model]:
    """One independent model per label on shared features.

    Each model writes columns of its own, so all can score one frame without a join.
    """

    def fit(label: str) -> Model:
        return fit_logreg(
            train,
            label,
            regParam=reg_param,
            rawPredictionCol=f"raw_{label}",
            probabilityCol=f"probability_{label}",
            predictionCol=f"pred_{label}",
            **params,
        )

    fits = [partial(fit, label) for label in labels]
    return dict(zip(labels, _in_threads(fits, parallelism, train.sparkSession)))


def tree_table(df: DataFrame, label: str, trees: int = TREES) -> DataFrame:
    """``(features, <label>)`` as a written table for a fit of trees, dealt to tasks that grow in number and not in size.

    A fit keeps a whole number per slot and per tree for every row, many times the size of the written vector,
    which is all that Spark could go by: tables of few bytes would be few tasks, too few to keep all cores busy,
    each with more rows than fit in memory.
    """
    row_bytes = 100 + 4 * (len(feature_names(df)) + trees)
    return materialize(df.select("features", label), "tree-table", max(1, TREE_TASK_BYTES // row_bytes))


def fit_random_forest(
    train: DataFrame, label: str, trees: int = TREES, seed: int = 47, **params
) -> Model:
    """A forest as that of ``pyspark.ml``, counted block by block where ``forest`` knows the parameters."""
    estimator = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, seed=seed, **params
    )
    return forest.fit(estimator, train) if forest.takes(estimator, train) else estimator.fit(train)


def fit_decision_tree(train: DataFrame, label: str, seed: int = 47, **params) -> Model:
    return DecisionTreeClassifier(
        featuresCol="features", labelCol=label, seed=seed, **params
    ).fit(train)


# --- cross-validation ------------------------------------------------------


def param_grid(estimator: LogisticRegression, reg_params: Sequence[float] = REG_PARAMS) -> list:
    return ParamGridBuilder().addGrid(estimator.regParam, list(reg_params)).build()


def feature_table(prepared: PipelineModel | Slots, df: DataFrame, *keep: str) -> DataFrame:
    """``(features, *keep)`` as a written table."""
    if isinstance(prepared, Slots):  # these write their vectors themselves
        inputs = dict.fromkeys([*prepared.stages.categorical, *prepared.stages.numeric, *keep])
        return prepared.transform(df.select(*inputs)).select("features", *keep)
    return materialize(prepared.transform(df).select("features", *keep), "feature-table")


def storage_bytes(spark: SparkSession) -> int:
    """Memory of all executors in which Spark may keep tables."""
    context = spark.sparkContext._jsc.sc()
    kept = {}
    found = context.getExecutorMemoryStatus().iterator()
    while found.hasNext():
        executor = found.next()
        kept[executor._1()] = executor._2()._1()
    if len(kept) > 1:  # else the driver runs the tasks
        kept.pop(context.env().blockManager().blockManagerId().hostPort(), None)
    return sum(kept.values())


def fits_at_once(train: DataFrame, fits: int) -> int:
    """How many of these fits fit in memory side by side, as each keeps all rows of ``train``; at least one."""
    entries = F.size(F.unwrap_udt("features")["values"])
    sums = train.agg(F.count(F.lit(1)).alias("rows"), F.sum(entries).alias("entries")).first()
    kept = sums["rows"] * ROW_BYTES + (sums["entries"] or 0) * ENTRY_BYTES
    return max(1, min(fits, storage_bytes(train.sparkSession) // max(1, kept)))


def cross_validate(
    df: DataFrame,
    stages: Sequence | SlotStages | None,
    estimator: LogisticRegression,
    grid: Sequence[dict],
    fold: str = "fold",
    folds: int = 3,
    parallelism: int = 8,
) -> DataFrame:
    """``(reg_param, fold, auc)`` for every grid point and fold, with the exact area.

    ``stages`` are stages of ``pyspark.ml``, or :class:`SlotStages`, or what these have fitted per fold, or None if
    ``df`` is a written table that holds the vectors.  Stages are fitted on the training rows of each fold only, once
    per fold rather than once per fit; all grid points share the fold's feature table.  Slots without a least count
    are the same for all folds but for categories that a fold does not train on.  Those never vary there, so their
    weight is 0, as if they had no slot: all folds share one feature table.
    A fit is a chain of short jobs, so up to ``parallelism`` of them run
    side by side, but no more than find memory for the rows they keep.  Folds follow each other, and a feature table goes when it is done: only scores are
    kept, and all areas come from one aggregation over them.
    """
    spark = df.sparkSession
    label = estimator.getLabelCol()
    scores = []
    shared = df if stages is None else None
    if isinstance(stages, SlotStages) and stages.least_count <= 1:
        shared = feature_table(stages.fit(df), df, label, fold)
    elif isinstance(stages, SlotStages):
        stages = stages.fit_folds(df, fold, folds)
    fitted = stages if stages and shared is None and isinstance(stages[0], Slots) else None
    for k in range(folds):
        train, valid = df.filter(F.col(fold) != k), df.filter(F.col(fold) == k)
        if fitted or shared is not None:  # the vectors of both sides are one table
            table = shared if shared is not None else feature_table(fitted[k], df, label, fold)
            train, valid = table.filter(F.col(fold) != k).drop(fold), table.filter(F.col(fold) == k).drop(fold)
        else:
            prepared = fit_stages(stages, train)
            train = table = feature_table(prepared, train, label)
            valid = prepared.transform(valid).select("features", label)
        fits = [partial(estimator.copy(params).fit, train) for params in grid]
        models = _in_threads(fits, min(parallelism, fits_at_once(train, len(fits))), spark)
        scored = valid
        points = []
        for i, (params, model) in enumerate(zip(grid, models, strict=True)):
            model = model.copy()
            model.setRawPredictionCol(f"raw_{i}").setProbabilityCol(f"proba_{i}").setPredictionCol(f"pred_{i}")
            scored = model.transform(scored)
            # A number, as Spark would shuffle once more for the fractions of a key.
            points.append(F.struct(F.lit(i).alias("point"), vector_element(f"raw_{i}", 1).alias("score")))
        scored = scored.select(F.lit(k).alias("fold"), label, F.inline(F.array(*points)))
        # Scoring keeps nothing, so it needs no small parts, and many small files would cost more than they hold.
        scores.append(materialize(scored.coalesce(max(1, spark.sparkContext.defaultParallelism)), "fold-scores"))
        if shared is None:
            discard(table)
    if shared is not None and shared is not df:
        discard(shared)
    areas = auc_roc(union_all(*scores), label, "score", ["point", "fold"]).collect()
    for table in scores:
        discard(table)
    rows = [(float(grid[r["point"]][estimator.regParam]), r["fold"], r["auc"]) for r in areas]
    return spark.createDataFrame(rows, "reg_param double, fold int, auc double")


def best_params(cv: DataFrame) -> DataFrame:
    """Mean and spread of the metric per grid point, best first; ties go to the smaller value."""
    return (
        cv.groupBy("reg_param")
        .agg(F.avg("auc").alias("mean_auc"), F.stddev_samp("auc").alias("std_auc"))
        .orderBy(F.col("mean_auc").desc(), "reg_param")
    )


# --- interpretation --------------------------------------------------------


def coefficients_table(model: Model, scored_schema: DataFrame) -> DataFrame:
    """``(feature, coefficient)`` with an ``intercept`` row, named by the feature vector.

    ``scored_schema`` is any frame whose feature column carries the slot names.
    """
    names = feature_names(scored_schema, model.getFeaturesCol())
    weights = [float(w) for w in model.coefficients]
    rows = [*zip(names, weights), ("intercept", float(model.intercept))]
    return scored_schema.sparkSession.createDataFrame(rows, "feature string, coefficient double")
