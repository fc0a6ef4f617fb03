"""Projections, casts, filters and the one-pass table cleaner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import parse_number, stable_id, strip_dots

# --- projections and casts -------------------------------------------------


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Attach column names by position."""
    return df.toDF(*names)


def cast_columns(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """Cast lists of columns, ``{"float": [...], "int": [...]}``, in one projection.

    Text that does not parse becomes null instead of failing the job.
    """
    wanted = {c: t for t, cols in types.items() for c in cols}
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.select(
        *[F.col(c).try_cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def columns_except(df: DataFrame, *excluded: str) -> list[str]:
    """Names of all columns but the excluded ones, in table order."""
    return [c for c in df.columns if c not in set(excluded)]


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns, in the given order."""
    return df.select(*columns)


def derive_per_label(
    df: DataFrame, scores: Mapping[str, Column], threshold: float = 0.5
) -> DataFrame:
    """Add ``proba_<label>`` and ``pred_<label>`` for every label's score column."""
    added: dict[str, Column] = {}
    for label, score in scores.items():
        added[f"proba_{label}"] = score
        added[f"pred_{label}"] = F.when(score > threshold, 1.0).otherwise(0.0)
    return df.withColumns(added)


def surrogate_id(df: DataFrame, keys: Sequence[str], name: str = "uid") -> DataFrame:
    """Add a row id computed from the key columns, the same in every run and branch."""
    return df.select(stable_id(*keys).alias(name), *df.columns)


# --- filters and cleaning --------------------------------------------------


def _strings(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every text column; other columns keep their type."""
    text = _strings(df)
    return df.select(*[F.trim(c).alias(c) if c in text else F.col(c) for c in df.columns])


def null_tokens(df: DataFrame, token: str = "?") -> DataFrame:
    """Turn the missing-value token into null in every text column."""
    text = _strings(df)
    return df.select(
        *[F.nullif(F.col(c), F.lit(token)).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_null_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def filter_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column differs from ``value``; rows with null go too."""
    return df.filter(F.col(column) != F.lit(value))


def filter_non_numeric_rows(df: DataFrame, column: str) -> DataFrame:
    """Keep the rows whose column parses as a number."""
    return df.filter(parse_number(column).isNotNull())


def normalize_label(df: DataFrame, column: str) -> DataFrame:
    """Trim a text label and strip its trailing dots."""
    return df.withColumn(column, strip_dots(column))


def _binary_label(c: Column, negative: Sequence[str], positive: Sequence[str]) -> Column:
    # Whole numbers in the text pass through; any other text becomes null.
    return (
        F.when(c.isin(*negative), F.lit(0))
        .when(c.isin(*positive), F.lit(1))
        .otherwise(c.try_cast("int"))
    )


def encode_binary_label(
    df: DataFrame, column: str, negative: Sequence[str], positive: Sequence[str]
) -> DataFrame:
    """Replace a text label by 0 or 1; text that is neither nor a number becomes null."""
    return df.withColumn(column, _binary_label(F.col(column), negative, positive))


@dataclass(frozen=True)
class CleanSpec:
    """What :func:`clean_table` does to a table of text columns."""

    label: str
    negative: Sequence[str]
    positive: Sequence[str]
    drop: Sequence[str] = ()
    missing: str = "?"
    numeric: Sequence[str] = ()
    numeric_type: str = "float"
    extra: Mapping[str, str] = field(default_factory=dict)


def clean_table(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Trim, drop unused columns, drop rows with a missing value, cast and encode.

    One filter and one projection.  Rows are dropped for values missing in the input;
    a value that is there but does not parse stays as null.
    """
    text = _strings(df)
    kept = [c for c in df.columns if c not in set(spec.drop)]

    def value(c: str) -> Column:
        return F.nullif(F.trim(c), F.lit(spec.missing)) if c in text else F.col(c)

    def cleaned(c: str) -> Column:
        if c == spec.label:
            return _binary_label(value(c).cast("string"), spec.negative, spec.positive)
        if c in spec.numeric:
            return value(c).try_cast(spec.numeric_type)
        if c in spec.extra:
            return value(c).try_cast(spec.extra[c])
        return value(c)

    present = F.lit(True)
    for c in kept:
        present = present & value(c).isNotNull()
    return df.filter(present).select(*[cleaned(c).alias(c) for c in kept])
