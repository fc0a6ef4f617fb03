"""Splits, folds and samples that depend only on the row key, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tablewright.functions import hash_bucket


def in_train(keys: Sequence, train_percent: int = 80, seed: int = 47) -> Column:
    """Whether a row belongs to the training part.  Equal keys always share a side.

    ``keys`` are column names or expressions; give whole-number forms of fractions.
    """
    return hash_bucket(*keys, salt=seed, buckets=100) < train_percent


def split_train_test(
    df: DataFrame, keys: Sequence, train_percent: int = 80, seed: int = 47
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that cover the table."""
    train = in_train(keys, train_percent, seed)
    return df.filter(train), df.filter(~train)


def sample_fraction(df: DataFrame, keys: Sequence, percent: int = 40, seed: int = 47) -> DataFrame:
    """A repeatable sample without replacement."""
    return df.filter(hash_bucket(*keys, salt=f"sample{seed}", buckets=100) < percent)


def kfold_assign(
    df: DataFrame, keys: Sequence, folds: int = 3, seed: int = 47, name: str = "fold"
) -> DataFrame:
    """Add the fold number of each row."""
    bucket = hash_bucket(*keys, salt=f"fold{seed}", buckets=folds)
    return df.withColumn(name, bucket.cast("int"))
