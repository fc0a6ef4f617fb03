"""Column layouts of the three input tables and of the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def string_fields(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@dataclass(frozen=True)
class CommentsLayout:
    """Free text with one 0/1 column per label; the scored table has no labels."""

    # Column names of the comments table.
    key: str = "id"
    text: str = "comment_text"
    # Fixed value: a text that is only this stray quote is not a comment.
    junk_text: str = '"'


@dataclass(frozen=True)
class HeartLayout:
    """Numeric measurements and a 0/1 target."""

    # File order of the columns, and which of them hold fractions.
    columns: tuple[str, ...] = (
        "age", "sex", "cp", "trestbps", "chol", "fbs", "restecg",
        "thalach", "exang", "oldpeak", "slope", "ca", "thal", "target",
    )
    fractional: tuple[str, ...] = ("age", "trestbps", "chol", "thalach", "oldpeak")
    target: str = "target"
    # Fixed value: the columns that the report of scored rows shows.
    report: tuple[str, ...] = ("age", "sex", "cp", "trestbps", "chol", "thalach", "oldpeak")

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c != self.target)

    @property
    def schema(self) -> T.StructType:
        # Whole-number columns may be written as 1.0, so every column is read as double.
        return T.StructType([T.StructField(c, T.DoubleType()) for c in self.columns])


@dataclass(frozen=True)
class CensusLayout:
    """Mixed columns without a header line, every one read as text."""

    # Column names by position, their roles, the missing token, the labels.
    columns: tuple[str, ...] = (
        "age", "workClass", "fnlwgt", "education", "educationNum",
        "maritalStatus", "occupation", "relationship", "race", "sex",
        "capitalGain", "capitalLoss", "hoursPerWeek", "nativeCountry", "Labels",
    )
    categorical: tuple[str, ...] = (
        "workClass", "maritalStatus", "occupation", "relationship", "race", "sex",
        "nativeCountry",
    )
    numeric: tuple[str, ...] = ("age", "educationNum", "hoursPerWeek")
    unused: tuple[str, ...] = ("fnlwgt", "education", "capitalGain", "capitalLoss")
    label: str = "Labels"
    missing: str = "?"
    negative: tuple[str, ...] = ("<=50K", "<=50K.")
    positive: tuple[str, ...] = (">50K", ">50K.")


COMMENTS = CommentsLayout()
HEART = HeartLayout()
CENSUS = CensusLayout()

# Result tables, by kind.
RESULTS: dict[str, T.StructType] = {
    "metrics": T.StructType(
        [
            T.StructField("model", T.StringType()),
            T.StructField("metric", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    ),
    "run_metrics": T.StructType(
        [T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())]
    ),
    "classifier_metrics": T.StructType(
        [
            T.StructField("classifier", T.StringType()),
            T.StructField("metric", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    ),
    "coefficients": T.StructType(
        [
            T.StructField("feature", T.StringType()),
            T.StructField("coefficient", T.DoubleType()),
        ]
    ),
    "confusion": T.StructType(
        [
            T.StructField("target", T.IntegerType()),
            T.StructField("prediction", T.DoubleType()),
            T.StructField("count", T.LongType()),
        ]
    ),
}


# Names of metrics in saved files, in lower case without blanks and marks, and what they are here.
METRIC_NAMES = {
    "accuracy": "accuracy",
    "precision": "weightedPrecision",
    "weightedprecision": "weightedPrecision",
    "recall": "weightedRecall",
    "weightedrecall": "weightedRecall",
    "f1": "f1",
    "f1score": "f1",
    "rocauc": "areaUnderROC",
    "areaunderroc": "areaUnderROC",
    "testareaunderroc": "areaUnderROC",
}


def _label_prediction_type(name: str) -> T.DataType:
    # The key and the prefixes of the columns, and their types.
    if name == "UID":
        return T.LongType()
    if name.startswith("proba_"):
        return T.FloatType()
    return T.DoubleType() if name.startswith("pred_") else T.StringType()


def _sample_prediction_type(name: str) -> T.DataType:
    # The columns besides the features, and their types.
    fixed = {"target": T.IntegerType(), "prediction": T.DoubleType(), "risk": T.FloatType()}
    return fixed.get(name, T.DoubleType())


# Result tables whose columns depend on the task: types by column name.
NAMED_TYPES = {
    "label_predictions": _label_prediction_type,
    "sample_predictions": _sample_prediction_type,
}
