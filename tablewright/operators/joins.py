"""Equi-joins: predictions on their key, and lookups on keys that may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import materialize


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, duplicates kept, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def join_predictions(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner equi-join of two scored tables on their row key."""
    keys = [key] if isinstance(key, str) else list(key)
    return left.join(right, keys, "inner")


def multi_label_fan_in(ids: DataFrame, scored: Sequence[DataFrame], key: str) -> DataFrame:
    """Collect one scored table per label into a wide table, joined on the key.

    Scoring all labels in one frame (``score.score_multilabel``) needs no join at all;
    this is for label scores that already exist as separate tables.  Both sides of
    every join are partitioned by the key, so only the inputs are shuffled, once each.
    """
    return reduce(lambda wide, one: join_predictions(wide, one, key), scored, ids)


def fan_in_saved(spark: SparkSession, tables: Sequence[str], key: str) -> DataFrame:
    """The wide table of ``tables``, saved by ``sources.write_bucketed`` with one key and number of buckets.

    Their files are merged bucket by bucket: no join shuffles or broadcasts a row.  Tables with other buckets
    give the same rows, but Spark then shuffles them.  The join is inner, so null keys match nothing.
    """
    return reduce(lambda wide, name: join_predictions(wide, spark.table(name).hint("merge"), key), tables[1:], spark.table(tables[0]))


# Largest table that is broadcast, in rows of about 100 bytes.
MOST_BROADCAST_ROWS = 500_000

# Rows of about 100 bytes that one task of a shuffled join sorts.
TASK_ROWS = 1_000_000


def frequent_keys(facts: DataFrame, key: str, share: float = 0.001) -> DataFrame:
    """``(key)``: every key with more than ``share`` of the rows, and perhaps some others; null is no key.

    One pass keeps at most ``1 / share`` counters per task (Misra and Gries) and merges them, so keys are
    not shuffled, however many there are.
    """
    found = facts.select(key).filter(F.col(key).isNotNull()).freqItems([key], share)
    return found.select(F.explode(found.columns[0]).alias(key))


def lookup_hot_keys(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    hot_share: float = 0.001,
    how: str = "inner",
    most_broadcast_rows: int = MOST_BROADCAST_ROWS,
) -> DataFrame:
    """Join ``facts`` to a table with one row per key, though few keys hold most rows.

    A table counted to be small is broadcast: the facts pass once and are not shuffled.  Beyond that the
    facts are written, so they are computed once, and their frequent keys found on the written table, known
    to ``table`` or not.  These are fewer than ``1 / hot_share``: their rows of ``table`` are broadcast, and the
    facts that hold them, which are most of the rows, stay where they are.  Only the others are shuffled, to
    parts whose number grows with the rows, as each task sorts its part.
    Null keys are not shuffled either; ``how`` is ``inner`` or ``left``.
    """
    size = table.count()
    if size <= most_broadcast_rows:
        return facts.join(F.broadcast(table), key, how)
    facts = materialize(facts, "facts")
    parts = max(facts.sparkSession.sparkContext.defaultParallelism, ceil((facts.count() + size) / TASK_ROWS))
    hot = materialize(frequent_keys(facts, key, hot_share), "frequent-keys")
    known = F.broadcast(materialize(table.join(F.broadcast(hot), key, "left_semi"), "frequent-rows"))
    often = facts.join(F.broadcast(hot), key, "left_semi").join(known, key, how)
    rest = facts.filter(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti")
    rest = rest.repartition(parts, key).join(table.repartition(parts, key), key, how)
    out = often.unionByName(rest)
    if how == "left":
        out = out.unionByName(facts.filter(F.col(key).isNull()).join(known, key, how))
    return out
