"""Sinks for result tables.

A table is written whole into a hidden folder beside its path, then swapped with the old one by renames, which
file systems do at once or not at all.  So a job that fails midway leaves the table as it was, and readers never see
a part of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources.layouts import RESULTS

#: Folders that Spark's readers pass over: a table that is being written, and the one that it replaces.
VERSION = "_version-"
OLD = "_old-"


def _write(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str] = ()) -> None:
    """Writes ``df`` aside and swaps it with the table at ``path``.

    Between the two renames there is no table at ``path``; a driver lost there leaves the old one aside, and
    :func:`recover`, which readers of results and writers call first, brings it back.
    """
    recover(df.sparkSession, path)
    aside, old = _beside(path, VERSION, f"-{uuid.uuid4().hex}"), _beside(path, OLD)
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    files, at = _files(df.sparkSession, path)
    try:
        writer.save(aside)
    except BaseException:
        files.delete(at(aside), True)
        raise
    if files.exists(at(path)):
        _rename(files, at(path), at(old))
    _rename(files, at(aside), at(path))
    files.delete(at(old), True)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    """Saves a scored table as the catalog's external table ``name``, in ``buckets`` files by a hash of ``key``.

    The one shuffle is paid here.  Tables with the same key and number of buckets then join without another, however
    often (:func:`tablewright.operators.joins.fan_in_saved`).  Rows with a null key are kept.  A table of
    this name must not exist: a new version gets a new name, so readers of the old one are not disturbed.
    """
    placed = df.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)


def recover(spark: SparkSession, path: str) -> None:
    """Undoes a swap that a lost driver left half done: without a table at ``path``, the old one returns there."""
    files, at = _files(spark, path)
    old = at(_beside(path, OLD))
    if files.exists(old):
        if files.exists(at(path)):
            files.delete(old, True)
        else:
            _rename(files, old, at(path))


def _beside(path: str, prefix: str, suffix: str = "") -> str:
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}{prefix}{name}{suffix}"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def _as_kind(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RESULTS[kind]])


def write_predictions(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Scored rows.  Written in parallel, one file per task."""
    _write(df, path, fmt, partition_by)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Any other small table of a job."""
    _write(df, path, fmt)


def write_metrics(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Long ``(model, metric, value)`` table."""
    _write(_as_kind(df, "metrics"), path, fmt)


def write_coefficients(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """``(feature, coefficient)`` table with its ``intercept`` row."""
    _write(_as_kind(df, "coefficients"), path, fmt)


def write_confusion(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """``(target, prediction, count)`` table."""
    _write(_as_kind(df, "confusion"), path, fmt)
