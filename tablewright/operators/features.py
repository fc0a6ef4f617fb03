"""Text and categorical features.

Two forms of each: the ``pyspark.ml`` stages that models are trained on, and the same
numbers as plain tables ``(row key, term or slot, value)`` that SQL can check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    OneHotEncoder,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions import hash_bucket, tokens
from tablewright.operators.joins import MOST_BROADCAST_ROWS, lookup_hot_keys
from tablewright.session import materialize

# Fixed value: size of the hashed text features.
TEXT_FEATURES = 10_000

# Characters of text whose word counts one task holds, at some 30 bytes of memory each.
TASK_CHARACTERS = 4_000_000

# --- text, as tables -------------------------------------------------------


def tokenize(df: DataFrame, text: str, name: str = "words") -> DataFrame:
    """Add the array of lower-cased words.  Rows without text have null words."""
    return df.withColumn(name, tokens(text))


def term_frequency(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term, tf)``: how often each word occurs in each text.

    The texts are shuffled by key before they are split into words, as they are much
    smaller than their word counts; the counting then needs no shuffle of its own.
    So ``key`` must identify the text: all texts of one key go to one task.
    """
    words = _by_key(df, key, text).select(key, F.explode(tokens(text)).alias("term"))
    return words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def _by_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)`` shuffled by key, into parts that grow in number and not in size.

    Counting holds all word counts of a part in memory, and these are many times the size of the shuffled
    text, which is all that Spark could go by.  So a pass over the texts measures them first.
    """
    texts = df.select(key, text)
    characters = texts.agg(F.sum(F.length(text))).first()[0] or 0
    least = df.sparkSession.sparkContext.defaultParallelism
    return texts.repartition(max(least, ceil(characters / TASK_CHARACTERS)), key)


def hashed_term_frequency(
    df: DataFrame, key: str, text: str, size: int = TEXT_FEATURES
) -> DataFrame:
    """``(key, slot, tf)``: like :func:`term_frequency` with words hashed to ``size`` slots.

    Words that share a slot add up.
    """
    words = _by_key(df, key, text).select(key, F.explode(tokens(text)).alias("term"))
    slot = hash_bucket("term", salt="slot", buckets=size).cast("int")
    return words.groupBy(key, slot.alias("slot")).agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(df: DataFrame, text: str) -> DataFrame:
    """``(term, df)``: in how many texts (rows) each term occurs.

    Words are made distinct within the row and counted per task before the shuffle,
    so only one partial count per task and term travels.
    """
    words = df.select(F.explode(F.array_distinct(tokens(text))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def hashed_document_frequency(tf: DataFrame) -> DataFrame:
    """``(slot, df)`` from a :func:`hashed_term_frequency` table."""
    return tf.groupBy("slot").agg(F.count(F.lit(1)).alias("df"))


def idf(frequencies: DataFrame, texts: DataFrame, min_df: int = 0) -> DataFrame:
    """Add ``idf = ln((N + 1) / (df + 1))``; 0 for terms in fewer than ``min_df`` texts."""
    n = texts.agg(F.count(F.lit(1))).scalar()
    weight = F.log((n + 1) / (F.col("df") + 1))
    return frequencies.withColumn("idf", F.when(F.col("df") >= min_df, weight).otherwise(0.0))


def tf_idf(tf: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """``(key, term, tf, idf, tfidf)`` from :func:`term_frequency` and :func:`idf` tables.

    Common words make up most of the rows; the join does not shuffle them.
    Terms without a weight, unseen in training, drop out.
    """
    joined = lookup_hot_keys(tf, weights, "term")
    return joined.select(key, "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def hashed_tf_idf(tf: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """``(key, slot, tf, idf, tfidf)`` on hashed slots.

    The weight table has at most one row per slot; it is broadcast if it is counted to be small.
    """
    joined = tf.join(_small(weights.select("slot", "idf"), weights.count()), "slot")
    return joined.select(key, "slot", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


# --- categories, as tables -------------------------------------------------

def category_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, category, n)``: how often each category occurs, in one pass; nulls are no category."""
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    long = df.select(*by, *texts).unpivot(list(by), list(columns), "column", "category")
    return long.filter(F.col("category").isNotNull()).groupBy(*by, "column", "category").agg(F.count(F.lit(1)).alias("n"))


def string_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, category, n, idx)``: categories numbered from most to least frequent.

    Ties are numbered alphabetically; nulls are no category.  One pass counts all columns.
    """
    return number_categories(category_counts(df, columns))


def number_categories(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, category, n, idx)`` from a table of counts, numbered apart for each ``by``.

    Few categories are sorted by column.  Many are range-partitioned in their order; each part numbers its
    own rows, and the few sizes of the parts give where its numbers start.  So any number of them works.
    """
    counts = materialize(counts, "categories")
    group = [*by, "column"]
    if counts.count() <= MOST_BROADCAST_ROWS:
        nth = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("n").desc(), "category"))
        return counts.select(*group, "category", "n", (nth - 1).alias("idx"))
    order = [*group, F.col("n").desc(), "category"]
    parts = max(1, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = materialize(
        counts.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()),
        "ordered-categories",
    )
    sizes = placed.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_range").orderBy(F.col("n").desc(), "category")
    numbered = placed.withColumn("_nth", F.row_number().over(inside)).join(starts, [*group, "_range"])
    return numbered.select(
        *group, "category", "n", (F.col("_start") + F.col("_nth") - 1).cast("int").alias("idx")
    )


def _small(table: DataFrame, rows: int) -> DataFrame:
    """The table, hinted for a broadcast if it has no more than ``MOST_BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if rows <= MOST_BROADCAST_ROWS else table


def apply_index(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_idx`` for every column; unseen and null values get the next free index.

    Dictionaries counted to be small are broadcast, so rows are not shuffled for them.
    """
    sizes = dictionary.filter(F.col("column").isin(list(columns))).groupBy("column")
    sizes = {r["column"]: r["n"] for r in sizes.agg(F.count(F.lit(1)).alias("n")).collect()}
    out = df
    for c in columns:
        mine = dictionary.filter(F.col("column") == c)
        lookup = mine.select(F.col("category").alias(c), F.col("idx").alias(f"{c}_idx"))
        known = sizes.get(c, 0)
        out = (
            out.join(_small(lookup, known), out[c].cast("string") == lookup[c], "left")
            .drop(lookup[c])
            .withColumn(f"{c}_idx", F.coalesce(f"{c}_idx", F.lit(known)))
        )
    return out


def one_hot(
    df: DataFrame, dictionary: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``(*key, column, slot, value)``: the set slots of every row, one per known category.

    Unseen and null values set no slot.
    """
    long = df.select(*key, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        list(key), list(columns), "column", "category"
    )
    known = dictionary.select("column", "category", F.col("idx").alias("slot"))
    return long.join(_small(known, dictionary.count()), ["column", "category"]).select(
        *key, "column", "slot", F.lit(1.0).alias("value")
    )


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Add one array of doubles from numeric columns, in the given order.

    A null in any of them is an error, as a model cannot use the row.
    """

    def present(c: str) -> Column:
        missing = F.raise_error(F.lit(f"null in feature column {c}")).cast("double")
        return F.coalesce(F.col(c).cast("double"), missing)

    return df.withColumn(name, F.array(*[present(c) for c in columns]))


# --- stages for models -----------------------------------------------------


def text_stages(
    text: str, size: int = TEXT_FEATURES, features: str = "features"
) -> list:
    """Words, hashed counts, inverse document frequency."""
    return [
        Tokenizer(inputCol=text, outputCol=f"{features}_words"),
        HashingTF(
            inputCol=f"{features}_words", outputCol=f"{features}_tf", numFeatures=size
        ),
        IDF(inputCol=f"{features}_tf", outputCol=features),
    ]


def table_stages(
    categorical: Sequence[str], numeric: Sequence[str], features: str = "features"
) -> list:
    """Index and one-hot encode the categories, then append them to the numbers.

    Values unseen in training set no slot.
    """
    if not categorical:
        return [VectorAssembler(inputCols=list(numeric), outputCol=features)]
    index = [f"{c}_idx" for c in categorical]
    slots = [f"{c}_vec" for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=slots),
        VectorAssembler(inputCols=[*numeric, *slots], outputCol=features),
    ]


def fit_stages(stages: Sequence, train: DataFrame) -> PipelineModel:
    """Fit feature stages on training rows only."""
    return Pipeline(stages=list(stages)).fit(train)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the slots of a feature vector, read from the column's metadata.

    Hashed slots have no names, only numbers.
    """
    attributes: Mapping = df.schema[features].metadata.get("ml_attr", {})
    named = [a for group in attributes.get("attrs", {}).values() for a in group]
    if named:
        return [a["name"] for a in sorted(named, key=lambda a: a["idx"])]
    if "num_attrs" in attributes:
        return [f"{features}_{i}" for i in range(attributes["num_attrs"])]
    raise ValueError(f"{features} does not describe its slots")


def sum_columns(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
