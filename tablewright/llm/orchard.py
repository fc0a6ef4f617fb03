"""Centroid clustering in exact integers, with Orchard's search for the nearest centroid.

Every centroid has a list of all centroids by rising distance. The search for a vector walks the list of the best
centroid so far, computes the distance to each one it has not visited, jumps to the list of a closer one as soon as
it finds it, and stops at the first centroid strictly beyond twice the current distance: by the triangle inequality
nothing behind it can be nearer, nor as near. All distances are integers, so ties are exact: the smaller number wins.

Each round is one pass: a task adds up its vectors by centroid, and only one row of sums per task, centroid and
component is shuffled. The centroids, the model, are all that comes to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_arrow, with_more
from tablewright.session import materialize

CENTROIDS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64

#: Largest size of a scaled component for which squared distances of up to 64 components fit into a long.
LARGEST = 1 << 26

#: Vectors that a task searches together.
ROWS_TOGETHER = 8192


def neighbour_lists(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every centroid's list of all centroids by (distance, number), and all squared distances."""
    between = ((centres[:, None] - centres[None]) ** 2).sum(axis=2)
    return np.argsort(between, axis=1, kind="stable"), between


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the centroid nearest to each integer row; ties go to the smaller number."""
    lists, between = neighbour_lists(centres)
    n, k = len(rows), len(centres)
    best = np.zeros(n, np.int64)
    distance = ((rows - centres[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    place = np.zeros(n, np.int64)
    going = np.arange(n)
    while len(going):
        other = lists[best[going], place[going]]
        near = between[best[going], other] <= 4 * distance[going]
        going, other = going[near], other[near]
        new = ~visited[going, other]
        row, centre = going[new], other[new]
        visited[row, centre] = True
        found = ((rows[row] - centres[centre]) ** 2).sum(axis=1)
        closer = (found < distance[row]) | ((found == distance[row]) & (centre < best[row]))
        place[going] += 1
        jump = row[closer]
        best[jump], distance[jump], place[jump] = centre[closer], found[closer], 0
        going = going[place[going] < k]
    return best, distance


def _block(batch: pa.RecordBatch, column: int, dims: int) -> np.ndarray:
    rows = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    if len(rows) and (rows.max() > LARGEST or rows.min() < -LARGEST):
        raise ValueError(f"scaled components must not exceed {LARGEST} in size")
    return rows


def scaled(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(key, v): the vectors of ``dims`` finite components, as floor(scale * component)."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))

    whole = (F.size(vector) == dims) & F.forall(vector, finite)
    integers = F.transform(vector, lambda x: F.floor(scale * x.cast("double")))
    return vectors.select(key, vector).filter(whole).select(key, integers.alias("v"))


def first_centres(rows: DataFrame, key: str, k: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of ``1:<key>``; rows without a key come last."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col(key).cast("string")).cast("binary"), 256)
    first = rows.select("v", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k)
    return np.array([r.v for r in first.collect()], np.int64)


def next_centres(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of every centroid's vectors; a centroid without vectors stays."""
    k, dims = centres.shape
    sums = rows.select("v")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            block = _block(batch, 0, dims)
            best, _ = nearest(block, centres)
            count += np.bincount(best, minlength=k)
            np.add.at(total, best, block)
        own = np.flatnonzero(count)
        yield pa.record_batch(
            {
                "cluster": np.repeat(own, dims),
                "place": np.tile(np.arange(dims), len(own)),
                "total": total[own].ravel(),
                "n": np.repeat(count[own], dims),
            }
        )

    parts = map_arrow(sums, add, "cluster long, place long, total long, n long", ROWS_TOGETHER)
    out = centres.copy()
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r.cluster, r.place] = r.total // r.n
    return out


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the vectors of ``dims`` finite components.

    Vectors that are null, of another length, or hold null or non-finite components are left out. Fewer than ``k``
    vectors make as many centroids. Rows that repeat a key count each; rows without a key are assigned but start no
    centroid while others can. Components beyond ``LARGEST`` after scaling raise an error, as their distances would
    not fit into a long. Other columns are ignored; without vectors the result is empty.
    """
    spark = vectors.sparkSession
    rows = materialize(scaled(vectors, key, vector, dims, scale), "integer-vectors")
    centres = first_centres(rows, key, k)
    if not len(centres):
        centres = np.zeros((1, dims), np.int64)
    for _ in range(rounds):
        centres = next_centres(rows, centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, distance = nearest(_block(batch, 1, dims), centres)
            yield pa.record_batch([batch.column(0), best.astype(np.int32), distance], names=[key, "cluster", "distance"])

    assigned = map_arrow(rows, assign, with_more(rows, [key], "cluster int, distance long"), ROWS_TOGETHER)
    assigned = materialize(assigned, "assigned")
    inertia = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    facts = [(c, inertia[c], sum(inertia.values()), digests[c]) for c in inertia]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return assigned.join(F.broadcast(spark.createDataFrame(facts, schema)), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
