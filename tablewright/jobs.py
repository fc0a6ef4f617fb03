"""Command line: run one task on its CSV files and write its result tables.

    spark-submit --py-files tablewright.zip tablewright/jobs.py risk heart.csv --out results

Paths may be any URI that Spark can read and write.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import profile
from tablewright.operators.evaluate import compare_models
from tablewright.operators.joins import union_all
from tablewright.operators.ordering import best_model_per_metric, preview, top_k_abs
from tablewright.operators.split import sample_fraction
from tablewright.plans import comments, income, risk
from tablewright.session import get_session, materialize
from tablewright.sources import (
    CENSUS,
    COMMENTS,
    HEART,
    read_metrics,
    scan_csv_header,
    scan_csv_headerless,
    scan_csv_text,
    write_coefficients,
    write_confusion,
    write_metrics,
    write_predictions,
    write_report,
)


def run_comments(spark: SparkSession, train: str, test: str, out: str) -> DataFrame:
    labeled = scan_csv_text(spark, train)
    rows, labels = comments.clean_train(labeled, COMMENTS.key, COMMENTS.text)
    unlabeled = comments.clean_test(scan_csv_text(spark, test), COMMENTS.text)
    write_predictions(comments.predict_labels(rows, unlabeled, labels), f"{out}/predictions")
    written = spark.read.parquet(f"{out}/predictions")
    return sample_fraction(written, [COMMENTS.key], 40).orderBy(COMMENTS.key).limit(50)


def run_risk(spark: SparkSession, path: str, out: str) -> DataFrame:
    rows = risk.clean_heart(scan_csv_header(spark, path, HEART.schema))
    result = risk.fit_risk(rows, HEART.features, HEART.target, report=HEART.report)
    write_coefficients(result.coefficients, f"{out}/coefficients")
    write_metrics(result.metrics.withColumn("model", F.lit("LR")), f"{out}/metrics")
    write_confusion(result.confusion, f"{out}/confusion")
    write_predictions(result.predictions, f"{out}/predictions")
    columns = [*HEART.report, HEART.target, "prediction", "risk"]
    return preview(result.predictions, columns, columns, 20)


def _census(spark: SparkSession, train: str, test: str) -> DataFrame:
    files = [scan_csv_headerless(spark, p, CENSUS.columns) for p in (train, test)]
    # A row whose label or number does not parse cannot be trained on.
    return income.clean_census(*files).na.drop("any")


_CENSUS_KEYS = [*CENSUS.categorical, *CENSUS.numeric]


def run_income_logreg(spark: SparkSession, train: str, test: str, out: str) -> DataFrame:
    result = income.fit_tuned_logreg(
        _census(spark, train, test), CENSUS.categorical, CENSUS.numeric, CENSUS.label, _CENSUS_KEYS
    )
    write_coefficients(result.coefficients, f"{out}/coefficients")
    write_metrics(result.metrics, f"{out}/metrics")
    write_report(result.best, f"{out}/grid")
    features = result.coefficients.filter(F.col("feature") != "intercept")
    return top_k_abs(features, "coefficient", ["feature"], 15)


def run_income_trees(spark: SparkSession, train: str, test: str, out: str) -> DataFrame:
    result = income.compare_trees(
        _census(spark, train, test), CENSUS.categorical, CENSUS.numeric, CENSUS.label, _CENSUS_KEYS
    )
    write_metrics(result.metrics, f"{out}/metrics")
    return result.metrics.orderBy("model", "metric")


def run_compare(spark: SparkSession, first: str, second: str, out: str) -> DataFrame:
    """The metrics of two saved runs side by side, with the best model of each metric.

    Files may have any layout of :func:`read_metrics`.  ``NAME=path`` names the model of a file that does not.
    """
    found = []
    for place, given in (("first", first), ("second", second)):
        name, equals, path = given.rpartition("=")
        found.append(read_metrics(spark, path, name if equals else place))
    metrics = materialize(union_all(*found), "metrics")
    models = sorted(r["model"] for r in metrics.select("model").distinct().collect())
    best = best_model_per_metric(metrics).select("metric", F.col("model").alias("best"))
    table = compare_models(metrics, models).join(best, "metric", "left").orderBy("metric")
    write_report(table, f"{out}/comparison")
    return table


def _write_profile(tables: dict[str, DataFrame], out: str) -> None:
    for name, df in tables.items():
        write_report(df, f"{out}/{name}")


def run_profile_comments(spark: SparkSession, train: str, out: str) -> DataFrame:
    """Shape, label counts and combinations, and text lengths of the labelled comments."""
    rows, labels = comments.clean_train(scan_csv_text(spark, train), COMMENTS.key, COMMENTS.text)
    rows = materialize(profile.text_length(rows, COMMENTS.text).drop(COMMENTS.text), "profile")
    tables = {
        "shape": profile.table_shape(rows),
        "label_counts": profile.label_counts(rows, labels),
        "labels_per_row": profile.labels_per_row(rows, labels),
        "any_label": profile.any_label_share(rows, labels),
        "label_correlations": profile.correlation_matrix(rows, labels),
        "text_length": profile.describe_numeric(rows, ["text_length"]),
        "text_length_by_class": profile.histogram(rows, "text_length", 50, by=labels[0], own_range=True),
        "text_length_by_any_label": profile.histogram(
            rows.withColumn("any_label", profile.has_label(labels)), "text_length", 100, by="any_label", own_range=True
        ),
    }
    _write_profile(tables, out)
    return tables["label_counts"]


def run_profile_risk(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Shape, balance, moments, correlations and class histograms of the measurements."""
    rows = materialize(risk.clean_heart(scan_csv_header(spark, path, HEART.schema)), "profile")
    features = list(HEART.features)
    tables = {
        "shape": profile.table_shape(rows),
        "balance": profile.class_balance(rows, HEART.target),
        "numbers": profile.describe_numeric(rows, features),
        "correlations": profile.correlation_matrix(rows, [*features, HEART.target]),
        "with_target": profile.correlation_with_target(rows, features, HEART.target),
        "boxes": profile.five_number_by_class(rows, list(HEART.fractional), HEART.target),
    }
    for c in HEART.fractional:
        tables[f"histogram_{c}"] = profile.histogram(rows, c, 20, by=HEART.target, own_range=True)
    _write_profile(tables, out)
    return tables["with_target"]


def run_profile_income(spark: SparkSession, train: str, test: str, out: str) -> DataFrame:
    """Shape, balance, moments, boxes and rates per category of the census rows."""
    rows = materialize(_census(spark, train, test), "profile")
    numeric = list(CENSUS.numeric)
    tables = {
        "shape": profile.table_shape(rows),
        "balance": profile.class_balance(rows, CENSUS.label),
        "numbers": profile.describe_numeric(rows, numeric),
        "correlations": profile.correlation_matrix(rows, [*numeric, CENSUS.label]),
        "boxes": profile.five_number_by_class(rows, numeric, CENSUS.label),
    }
    for c in CENSUS.categorical:
        tables[f"rate_{c}"] = profile.rate_by_group(rows, c, F.col(CENSUS.label) == 1)
    for c in numeric:
        tables[f"histogram_{c}"] = profile.histogram(rows, c, 20, by=CENSUS.label, own_range=True)
    _write_profile(tables, out)
    return tables["balance"]


JOBS = {
    "comments": (run_comments, ["train", "test"]),
    "risk": (run_risk, ["data"]),
    "income-logreg": (run_income_logreg, ["train", "test"]),
    "income-trees": (run_income_trees, ["train", "test"]),
    "compare": (run_compare, ["first", "second"]),
    "profile-comments": (run_profile_comments, ["train"]),
    "profile-risk": (run_profile_risk, ["data"]),
    "profile-income": (run_profile_income, ["train", "test"]),
}


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (_, inputs) in JOBS.items():
        command = commands.add_parser(name)
        for argument in inputs:
            command.add_argument(argument)
        command.add_argument("--out", default="results")
    args = parser.parse_args(argv)
    run, inputs = JOBS[args.job]
    spark = get_session(f"tablewright {args.job}")
    run(spark, *[getattr(args, i) for i in inputs], args.out).show(50, truncate=False)


if __name__ == "__main__":
    main()
