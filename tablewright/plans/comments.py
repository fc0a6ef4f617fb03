"""Multi-label text classification: TF-IDF features and one model per label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tablewright.operators.clean import (
    cast_columns,
    columns_except,
    drop_null_subset,
    filter_not_equal,
)
from tablewright.operators.features import TEXT_FEATURES, text_stages
from tablewright.operators.score import score_multilabel
from tablewright.operators.train import TEXT_REG_PARAM, fit_multilabel
from tablewright.session import materialize
from tablewright.sources.layouts import COMMENTS


def clean_train(df: DataFrame, key: str, text: str) -> tuple[DataFrame, list[str]]:
    """Rows with text and whole-number labels, and the label names.

    Every column that is neither key nor text is a label.
    """
    labels = columns_except(df, key, text)
    return drop_null_subset(cast_columns(df, {"int": labels}), [text, *labels]), labels


def clean_test(df: DataFrame, text: str) -> DataFrame:
    """Rows to score: those with a text that is not just a stray quote."""
    return filter_not_equal(df, text, COMMENTS.junk_text)


def predict_labels(
    train: DataFrame,
    test: DataFrame,
    labels: Sequence[str],
    key: str = COMMENTS.key,
    text: str = COMMENTS.text,
    size: int = TEXT_FEATURES,
    reg_param: float = TEXT_REG_PARAM,
    parallelism: int = 4,
    **params,
) -> DataFrame:
    """``(key, proba_<label>, pred_<label>, ...)`` for every row of ``test``.

    The training texts are read once: their word counts are written as sparse vectors,
    and the document frequencies and all models are fitted from those.
    """
    words, counts, weights = text_stages(text, size)
    counted = PipelineModel([words, counts])
    table = materialize(
        counted.transform(train.select(text, *labels)).select(counts.getOutputCol(), *labels),
        "word-counts",
    )
    idf_model = weights.fit(table)
    features = idf_model.transform(table).select(weights.getOutputCol(), *labels)
    models = fit_multilabel(features, labels, reg_param, parallelism, **params)
    prepared = PipelineModel([words, counts, idf_model]).transform(test.select(key, text))
    scored = score_multilabel(models, prepared.select(key, weights.getOutputCol()))
    return scored.drop(weights.getOutputCol())
