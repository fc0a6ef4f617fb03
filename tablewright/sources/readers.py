"""Scans with explicit schemas: no inference pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import materialize
from tablewright.sources.layouts import METRIC_NAMES, NAMED_TYPES, RESULTS, string_fields
from tablewright.sources.writers import recover


#: Column that holds a line that does not fit its schema, and those of quarantined lines.
BAD_LINE = "_bad_line"


def _read_with_header(
    spark: SparkSession, path: str, schema: T.StructType | None, options: dict, bad_lines: bool = False
) -> DataFrame:
    """Take the column names from the header line, and their types from ``schema`` by name.

    All files must have the same header: one that names or orders its columns differently is an error.
    """
    options = {"header": True, "mode": "PERMISSIVE", "enforceSchema": False, **options}
    names = spark.read.options(**options).csv(path).columns
    fields = {f.name: f for f in schema or []}
    missing = sorted(set(fields) - set(names))
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    typed = [fields.get(n, T.StructField(n, T.StringType())) for n in names]
    return _with_bad_lines(spark, path, typed, options, bad_lines)


def _with_bad_lines(spark: SparkSession, path: str, fields: list, options: dict, bad_lines: bool) -> DataFrame:
    if bad_lines:
        fields = [*fields, T.StructField(BAD_LINE, T.StringType())]
        options = {**options, "columnNameOfCorruptRecord": BAD_LINE}
    return spark.read.schema(T.StructType(fields)).options(**options).csv(path)


def scan_csv_header(
    spark: SparkSession, path: str, schema: T.StructType | None = None, bad_lines: bool = False
) -> DataFrame:
    """CSV with a header line, in any column order that all files share.

    Columns not in ``schema`` are text; fields that do not parse are null.  ``bad_lines`` adds the text of
    lines with such fields, or of another length; see :func:`quarantine`.
    """
    return _read_with_header(spark, path, schema, {}, bad_lines)


def scan_csv_headerless(
    spark: SparkSession, path: str, names: Sequence[str], schema: T.StructType | None = None, bad_lines: bool = False
) -> DataFrame:
    """CSV without a header, columns named by position.

    Blanks after the commas are skipped while reading.  Columns are text unless a
    ``schema`` types them; short lines fill up with nulls.  ``bad_lines`` adds the text of lines of
    another length, or with fields that do not parse; see :func:`quarantine`.
    """
    schema = schema or string_fields(names)
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, schema, strict=True)]
    return _with_bad_lines(spark, path, fields, {"header": False, "ignoreLeadingWhiteSpace": True}, bad_lines)


def quarantine(scanned: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Splits a scan with ``bad_lines``: the good rows, and ``(file, lines, bad_lines)`` counted by file.

    The bad lines themselves, ``(file, line)``, are written to ``path`` as Parquet, so none is lost without trace.
    The scan is written once on the way, as Spark cannot tell good lines from bad ones without parsing all columns.
    """
    columns = [c for c in scanned.columns if c != BAD_LINE]
    rows = materialize(scanned.withColumn("_file", F.input_file_name()), "scanned")
    bad = rows.filter(F.col(BAD_LINE).isNotNull())
    bad.select(F.col("_file").alias("file"), F.col(BAD_LINE).alias("line")).write.mode("overwrite").parquet(path)
    counts = rows.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.count(BAD_LINE).alias("bad_lines")
    )
    return rows.filter(F.col(BAD_LINE).isNull()).select(*columns), counts


def scan_csv_text(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header whose quoted fields hold newlines, commas and doubled quotes.

    Such a file cannot be split, so keep the input in many files: one task reads one.
    """
    return _read_with_header(
        spark, path, schema, {"multiLine": True, "quote": '"', "escape": '"'}
    )


def scan_by_uri(
    spark: SparkSession, uri: str, columns: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Any path or URI Spark's file systems know (local, ``hdfs://``, ...)."""
    df = spark.read.format(fmt).load(uri)
    return df if columns is None else df.select(*columns)


def read_results(spark: SparkSession, path: str, kind: str, fmt: str = "csv") -> DataFrame:
    """Read a result table of a known kind back with its types.

    Kinds are those of ``RESULTS``, and ``label_predictions`` and ``sample_predictions``, whose
    columns depend on the labels and features: the types follow from the names.  A CSV whose
    header does not name the expected columns is an error.
    """
    recover(spark, path)
    if kind in NAMED_TYPES:
        names = spark.read.format(fmt).option("header", True).load(path).columns
        types = [NAMED_TYPES[kind](n) for n in names]
        schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types, strict=True)])
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True).option("enforceSchema", False)
        return reader.format(fmt).load(path)
    reader = spark.read.schema(RESULTS[kind])
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path).select(*RESULTS[kind].names)


def read_metrics(spark: SparkSession, path: str, model: str = "model") -> DataFrame:
    """``(model, metric, value)`` from a CSV of metrics of any known layout, under this library's metric names.

    The header tells the layout: ``model,metric,value``, ``classifier,metric,value``, or ``metric,value`` of one
    model, which ``model`` names.  A name of a metric that is not known is an error, as it could not be compared.
    """
    recover(spark, path)
    names = tuple(spark.read.option("header", True).csv(path).columns)
    kinds = {tuple(RESULTS[k].names): k for k in ("metrics", "classifier_metrics", "run_metrics")}
    if names not in kinds:
        raise ValueError(f"{path} has columns {names}, not those of a table of metrics")
    rows = read_results(spark, path, kinds[names])
    named = {"metrics": F.col("model"), "classifier_metrics": F.col("classifier")} if len(names) == 3 else {}
    plain = F.lower(F.regexp_replace("metric", "[^A-Za-z0-9]", ""))
    known = F.create_map(*[F.lit(x) for pair in METRIC_NAMES.items() for x in pair])
    unknown = F.raise_error(F.concat(F.lit("unknown metric "), F.col("metric"))).cast("string")
    return rows.select(
        named.get(kinds[names], F.lit(model)).alias("model"),
        F.coalesce(F.try_element_at(known, plain), unknown).alias("metric"),
        "value",
    )
