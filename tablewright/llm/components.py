"""Connected components of a graph given by its edges, in logarithmically many rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import materialize


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (a, b), both long.

    Alternates two steps: every node hands its larger neighbours, then its smaller ones, to the smallest
    among them. Each round is written to the shared folder. Smallest neighbours are found by a
    pre-aggregated minimum and met again by a join that adaptive execution can split, so a node with
    very many neighbours does not fall into one task.
    """
    now = _unique(edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")))
    now = materialize(now, "edges")
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        now = materialize(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _unique(edges: DataFrame) -> DataFrame:
    """Edges with the larger node as ``u``, once each."""
    return edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _unique(both.join(least, "u").filter("v > u").select("v", F.col("m").alias("u")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _unique(rest.unionByName(least.select("u", F.col("m").alias("v"))))
