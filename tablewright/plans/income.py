"""Classification on mixed columns: tuned logistic regression and tree models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import vector_element
from tablewright.operators.clean import CleanSpec, clean_table
from tablewright.operators.evaluate import evaluate_model
from tablewright.operators.features import fit_stages, table_stages
from tablewright.operators.joins import union_all
from tablewright.operators.slots import SlotStages
from tablewright.operators.split import in_train, kfold_assign
from tablewright.operators.train import (
    CV_MAX_ITER,
    REG_PARAMS,
    TREES,
    best_params,
    cross_validate,
    feature_table,
    fit_decision_tree,
    fit_logreg,
    fit_random_forest,
    logreg,
    param_grid,
    tree_table,
)
from tablewright.session import materialize
from tablewright.sources.layouts import CENSUS

# Fixed value: seed of the train/test split and the folds of this task.
SPLIT_SEED = 47

CENSUS_SPEC = CleanSpec(
    label=CENSUS.label,
    negative=CENSUS.negative,
    positive=CENSUS.positive,
    drop=CENSUS.unused,
    missing=CENSUS.missing,
    numeric=CENSUS.numeric,
)


@dataclass(frozen=True)
class TunedResult:
    model: Model
    grid: DataFrame
    best: DataFrame
    coefficients: DataFrame
    scored: DataFrame
    metrics: DataFrame


@dataclass(frozen=True)
class ComparedResult:
    models: Mapping[str, Model]
    label: str
    scored: DataFrame
    metrics: DataFrame

    def raw_metrics(self) -> DataFrame:
        """The same metrics with rows ranked by raw scores, for comparison only."""
        return evaluate_model(self.scored, self.label, "prediction", "raw_score")


def clean_census(*files: DataFrame) -> DataFrame:
    """Clean each input file on its own, then put their rows together."""
    return union_all(*[clean_table(f, CENSUS_SPEC) for f in files])


def score_models(models: Mapping[str, Model], df: DataFrame, label: str) -> DataFrame:
    """``(model, <label>, prediction, score, raw_score)`` of all models in one pass.

    ``score`` is the probability of class 1.  ``raw_score`` is the model's raw value,
    for a single tree the number of training rows in the leaf: a poor ranking.
    """
    out = df
    results = []
    for i, (name, model) in enumerate(models.items()):
        raw, probability, prediction = f"raw_{i}", f"probability_{i}", f"prediction_{i}"
        model = model.copy()
        model.setRawPredictionCol(raw)
        model.setProbabilityCol(probability)
        model.setPredictionCol(prediction)
        out = model.transform(out)
        results.append(
            F.struct(
                F.lit(name).alias("model"),
                F.col(prediction).alias("prediction"),
                vector_element(probability, 1).alias("score"),
                vector_element(raw, 1).alias("raw_score"),
            )
        )
    return out.select(label, F.inline(F.array(*results)))


def _split_table(
    df: DataFrame, columns: Sequence[str], keys: Sequence, folds: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Training rows with their fold, and held-out rows, from one written table.

    The input may be a join; it runs once.
    """
    folded = kfold_assign(df, keys, folds, seed)
    fold = F.when(in_train(keys, 80, seed), F.col("fold")).otherwise(-1)
    marked = folded.select(*columns, fold.alias("fold"))
    table = materialize(marked, "income-rows")
    return table.filter(F.col("fold") >= 0), table.filter(F.col("fold") < 0).drop("fold")


def fit_tuned_logreg(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    keys: Sequence,
    reg_params: Sequence[float] = REG_PARAMS,
    folds: int = 3,
    seed: int = SPLIT_SEED,
    max_iter: int = CV_MAX_ITER,
    parallelism: int = 8,
    least_count: int = 1,
) -> TunedResult:
    """Choose the regularization by cross-validation, refit on all training rows, evaluate.

    Categories stay in written tables; those of fewer than ``least_count`` rows share a slot per column.
    """
    train, test = _split_table(df, [*categorical, *numeric, label], keys, folds, seed)
    stages = SlotStages(tuple(categorical), tuple(numeric), least_count)
    # One table for all folds and the last fit, unless rare categories differ by fold.
    fitted = [stages.fit(train)] if least_count <= 1 else stages.fit_folds(train, "fold", folds)
    prepared = fitted[-1]  # on all training rows
    vectors = feature_table(prepared, train, label, "fold")
    estimator = logreg(label, maxIter=max_iter)
    rows, stages = (vectors, None) if least_count <= 1 else (train, fitted)
    grid = cross_validate(rows, stages, estimator, param_grid(estimator, reg_params), "fold", folds, parallelism)
    best = best_params(grid)
    reg_param = best.first()["reg_param"]
    model = fit_logreg(vectors, label, maxIter=max_iter, regParam=reg_param)
    scored = materialize(
        score_models({"LR": model}, feature_table(prepared, test, label), label), "income-scored"
    )
    return TunedResult(
        model=model,
        grid=grid,
        best=best,
        coefficients=prepared.coefficients(model),
        scored=scored,
        metrics=evaluate_model(scored, label, "prediction", "score"),
    )


def compare_trees(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    keys: Sequence,
    trees: int = TREES,
    seed: int = SPLIT_SEED,
    **params,
) -> ComparedResult:
    """Fit a random forest and a decision tree on the same features and evaluate both.

    Trees read from the columns' metadata which slots are categories, so they use the stages of ``pyspark.ml``.
    """
    train, test = _split_table(df, [*categorical, *numeric, label], keys, 1, seed)
    prepared = fit_stages(table_stages(categorical, numeric), train)
    vectors = tree_table(prepared.transform(train), label, trees)
    models = {
        "RF": fit_random_forest(vectors, label, trees, seed, **params),
        "DT": fit_decision_tree(vectors, label, seed, **params),
    }
    scored = materialize(score_models(models, prepared.transform(test), label), "income-scored")
    return ComparedResult(
        models=models,
        label=label,
        scored=scored,
        metrics=evaluate_model(scored, label, "prediction", "score"),
    )
