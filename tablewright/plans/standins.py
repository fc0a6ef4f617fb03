"""The three kinds of input, assembled from the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import spread
from tablewright.sources import scan_by_uri


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return scan_by_uri(spark, f"{folder}/{name}.parquet", columns or None)


def cents(column: str) -> Column:
    """A whole number for a two-digit fraction: the same text form in every engine."""
    return F.round(F.col(column) * 100).cast("bigint")


# Rows of ``lineitem`` have no shorter natural key.
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_FRACTIONS = ["l_quantity", "l_extendedprice"]


def line_keys() -> list:
    return [*LINE_KEYS, *[cents(c) for c in LINE_FRACTIONS]]


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, hash-partitioned if their file is a single split."""
    return spread(table(spark, folder, "documents", "doc_id", "text"), "doc_id")


TEXT_LABELS = ["toxic", "quality"]


def labeled_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, text, toxic, quality)``; documents without labels have null labels."""
    labels = table(spark, folder, "labels", "doc_id", *TEXT_LABELS)
    return texts(spark, folder).join(labels, "doc_id", "left")


RISK_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def risk_rows(spark: SparkSession, folder: str, for_training: bool = False) -> DataFrame:
    """Numeric columns of ``lineitem`` with a 0/1 ``target`` on the discounted price.

    A fit reads its rows many times, so for training a file of few splits is spread out.
    """
    lines = table(spark, folder, "lineitem", *LINE_KEYS, *RISK_FEATURES)
    if for_training:
        lines = spread(lines, *LINE_KEYS)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.withColumn("target", F.when(net > 50000, 1).otherwise(0))


INCOME_CATEGORICAL = ["l_returnflag", "l_linestatus", "p_type", "p_brand"]
INCOME_NUMERIC = ["l_quantity", "p_size", "p_retailprice"]


def income_rows(spark: SparkSession, folder: str, for_training: bool = False) -> DataFrame:
    """``lineitem`` with its parts: mixed columns and a 0/1 ``label``."""
    lines = table(
        spark, folder, "lineitem",
        *LINE_KEYS, *LINE_FRACTIONS, "l_returnflag", "l_linestatus",
    )
    if for_training:
        lines = spread(lines, *LINE_KEYS)
    parts = table(spark, folder, "part", "p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
    factor = F.when(F.col("l_returnflag") == "R", 1.5).otherwise(1.0)
    worth = F.col("l_quantity") * F.col("p_retailprice") * factor
    joined = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
    return joined.drop("p_partkey").withColumn("label", F.when(worth > 30000, 1).otherwise(0))


DIRTY_COLUMNS = ["order_id", "cents", "status", "priority", "unused", "label"]


def dirty_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` as untidy text: blanks around values, ``?`` for missing, odd labels."""
    orders = table(
        spark, folder, "orders",
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
    )
    order = F.col("o_orderkey")
    amount = F.when(order % 13 == 0, F.lit("|1x3")).otherwise(cents("o_totalprice").cast("string"))
    priority = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("?")).otherwise(
        F.col("o_orderpriority")
    )
    dot = F.when(order % 2 == 0, F.lit(".")).otherwise(F.lit(""))
    label = F.when(order % 97 == 0, F.lit("unknown")).otherwise(
        F.concat(F.when(F.col("o_totalprice") > 250000, ">50K").otherwise("<=50K"), dot)
    )
    return orders.select(
        order.cast("string").alias("order_id"),
        F.concat(F.lit(" "), amount).alias("cents"),
        F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" ")).alias("status"),
        F.concat(F.lit(" "), priority).alias("priority"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("unused"),
        F.concat(F.lit(" "), label).alias("label"),
    )
