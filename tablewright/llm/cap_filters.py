"""Near duplicates among vectors by spherical-cap filters.

Filters are directions; a vector belongs to every filter whose cap it lies in, that is, whose inner product with it
is ``cut`` or more. The directions are random product codes: the coordinates, rotated once, are dealt into blocks,
each block has a few random codewords, and every combination of codewords is a direction. So a vector's list of caps
is decoded block by block without trying all directions. Two near vectors share a cap with a probability that depends
on their cosine alone; several independent codes make it close to 1. The number of directions grows with the table,
so that a cap holds ``PER_CAP`` vectors on average at any size.

Vectors meet by a join on filters. Pairs whose 128 sign bits differ too much are dropped in the join, the others are
verified by their cosine in double precision.

Groups of near copies would make a pair of any two members. Where caps are crowded, the mean of near members is a
centre: all vectors within half the linking angle of it are linked by the triangle inequality, whatever their number.
Such a core is counted as a whole, and its members meet only vectors outside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, cos, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from tablewright.llm.common import map_arrow, with_more
from tablewright.llm.components import components
from tablewright.session import materialize

#: Linked from this cosine on.
COSINE = 0.95

#: Independent codes, caps per vector and vectors per cap on average.
CODES = 64
CAPS_PER_VECTOR = 20
PER_CAP = 16

#: Codewords of a block, above which codes get a block more.
MOST_WORDS = 512

#: Of the 128 signs of random projections, pairs at the linking cosine differ in more than these once in a million.
MOST_SIGNS = 34

#: A cap of more vectors is crowded; it changes which rows meet, not the result.
CROWDED = 128

#: Cells of equal first signs in a crowded cap, and how many of the fullest get a centre.
CELLS = 64
CENTRES_PER_CAP = 4

MOST_BROADCAST_ROWS = 20_000
ROWS_TOGETHER = 4096

_SEED = 11
_SIGNS = 128


@lru_cache(maxsize=8)
def product_codes(dims: int, vectors: int) -> tuple:
    """(rotation, coordinates of each block per code, codewords, cut, sign directions) for ``vectors`` vectors."""
    draw = np.random.default_rng([_SEED, dims])
    wanted = max(vectors, 1) * CAPS_PER_VECTOR / PER_CAP / CODES
    blocks = 2
    while (words := max(8, ceil(wanted ** (1 / blocks)))) > MOST_WORDS:
        blocks += 1
    cut = -NormalDist().inv_cdf(min(0.5, CAPS_PER_VECTOR / CODES / words**blocks))
    rotation = np.linalg.qr(draw.standard_normal((dims, dims)))[0].astype(np.float32)
    places = [np.array_split(draw.permutation(dims), blocks) for _ in range(CODES)]
    codes = [[draw.standard_normal((len(p), words)).astype(np.float32) for p in code] for code in places]
    return rotation, places, codes, np.float32(cut), draw.standard_normal((dims, _SIGNS)).astype(np.float32)


def caps_of(units: np.ndarray, vectors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, filter) of every cap that holds a unit vector, sorted by row, and the vectors' sign bits."""
    rotation, places, codes, cut, signs = product_codes(units.shape[1], vectors)
    turned = units @ rotation
    rows, filters = [], []
    words = codes[0][0].shape[1]
    for number, (code, place) in enumerate(zip(codes, places, strict=True)):
        scores = [turned[:, p] @ c for p, c in zip(place, code, strict=True)]
        best = [s.max(axis=1) for s in scores]
        row = np.flatnonzero(sum(best) >= cut)
        partial, name = np.zeros(len(row), np.float32), np.zeros(len(row), np.int64)
        for block, score in enumerate(scores):
            rest = sum(best[block + 1 :], np.zeros(len(units), np.float32))[row]
            total = partial[:, None] + score[row]
            at, word = np.nonzero(total >= (cut - rest)[:, None])
            partial, name, row = total[at, word], name[at] * words + word, row[at]
        rows.append(row)
        filters.append(name * CODES + number)
    row, name = np.concatenate(rows), np.concatenate(filters)
    order = np.argsort(row, kind="stable")
    bits = np.packbits(turned @ signs > 0, axis=1).view(np.int64)
    return row[order], name[order], bits


def _units(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by a power of two, so that no square overflows, and which of them have a direction."""
    with np.errstate(invalid="ignore"):
        largest = np.abs(values).max(axis=1)
    good = np.isfinite(largest) & (largest > 0)
    scale = np.frexp(np.where(good, largest, 1))[1]
    return np.ldexp(np.where(good[:, None], values, 0), -scale[:, None]), good


def filtered(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(node, key, vec, norm, s1, s2, caps) per row: a number, the scaled vector, its signs and its filters.

    Rows without a key or a direction have no vector and no filter. Filters of different lengths differ.
    """
    total = vectors.count()
    rows = vectors.select(F.monotonically_increasing_id().alias("node"), key, vector)
    element = vectors.schema[vector].dataType.elementType
    kind = ArrayType(FloatType() if isinstance(element, FloatType) else DoubleType())
    rows = rows.withColumn(vector, F.col(vector).cast(kind))
    arrow = pa.float32() if isinstance(element, FloatType) else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            sizes = np.where(batch.column(1).is_valid().to_numpy(zero_copy_only=False), sizes, 0)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                part = lists.take(pa.array(own)) if size else None
                for a in range(0, len(own), ROWS_TOGETHER):
                    at = own[a : a + ROWS_TOGETHER]
                    n = len(at)
                    vec, norm, filters = pa.nulls(n, pa.list_(arrow)), np.zeros(n), np.zeros(0, np.int64)
                    offsets, bits = np.zeros(n + 1, np.int32), np.zeros((n, 2), np.int64)
                    if size:
                        values = part[a : a + n].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, size)
                        values, good = _units(values)
                        norm = np.sqrt((values**2).sum(axis=1))
                        units = (values[good] / norm[good, None]).astype(np.float32)
                        row, filters, found = caps_of(units, total)
                        filters = filters + (size << 44)
                        bits[good] = found
                        counts = np.zeros(n, np.int64)
                        counts[good] = np.bincount(row, minlength=len(units))
                        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                        places = np.concatenate([[0], np.cumsum(np.where(good, size, 0))]).astype(np.int32)
                        flat = pa.array(values[good].ravel(), arrow)
                        vec = pa.ListArray.from_arrays(pa.array(places, mask=np.append(~good, False)), flat)
                    caps = pa.ListArray.from_arrays(pa.array(offsets), pa.array(filters))
                    columns = [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), vec, pa.array(norm)]
                    columns += [pa.array(np.ascontiguousarray(bits[:, i])) for i in range(2)]
                    yield pa.record_batch([*columns, caps], names=["node", key, "vec", "norm", "s1", "s2", "caps"])

    name = "float" if isinstance(element, FloatType) else "double"
    more = f"vec array<{name}>, norm double, s1 long, s2 long, caps array<bigint>"
    return map_arrow(rows, run, with_more(rows, ["node", key], more), ROWS_TOGETHER)


def _cosine(a: str, b: str) -> Column:
    """Of two vectors with their norms, in double precision."""
    products = F.zip_with(f"{a}.vec", f"{b}.vec", lambda x, y: x.cast("double") * y.cast("double"))
    dot = F.aggregate(products, F.lit(0.0), lambda s, x: s + x)
    return dot / (F.col(f"{a}.norm") * F.col(f"{b}.norm"))


def _small(df: DataFrame) -> DataFrame:
    """A written frame, broadcast only if its counted rows are few."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST_ROWS else df


def _round_of_cores(nodes: DataFrame, cosine: float, crowded: int) -> DataFrame | None:
    """(node, core) of the vectors that get a core now; None if no cap is crowded."""
    listed = nodes.select("node", F.explode("caps").alias("cap"))
    hot = materialize(listed.groupBy("cap").agg(F.count("*").alias("n")).filter(F.col("n") > crowded), "crowded")
    if not hot.count():
        return None
    members = materialize(listed.join(_small(hot), "cap"), "crowded-members")
    most = F.max(F.struct("n", "cap")).alias("most")
    best = members.groupBy("node").agg(most)
    lead = members.select("node", "cap").join(best, "node").groupBy("cap").agg(F.max("most").alias("most"))
    lead = _small(materialize(lead, "leading-caps"))
    tried = members.select("node", "cap").join(lead, "cap").select("node", "most").distinct()
    cell = F.col("s1").bitwiseAND(CELLS - 1).alias("cell")
    tried = materialize(tried.join(nodes.select("node", "vec", "norm", cell), "node"), "centre-members")
    # A cap can hold several groups: its fullest cells of equal signs each draw a member by its hash, and the centre
    # is the mean of all that are near it.
    drawn = F.min_by(F.struct("vec", "norm"), F.struct(F.xxhash64("node"), "node")).alias("seed")
    cells = tried.groupBy("most", "cell").agg(F.count("*").alias("n"), drawn)
    fullest = Window.partitionBy("most").orderBy(F.desc("n"), "cell")
    cells = cells.withColumn("place", F.row_number().over(fullest)).filter(F.col("place") <= CENTRES_PER_CAP)
    place = F.struct("n", "most", F.col("cell").alias("by")).alias("place")
    seed = _small(materialize(cells.select("most", place, "seed.vec", "seed.norm"), "seeds"))
    around = tried.alias("t").join(seed.alias("c"), "most").filter(_cosine("t", "c") >= cosine).select("place", "t.vec", "t.norm")
    parts = around.select(F.col("place").alias("of"), "norm", F.posexplode("vec").alias("i", "x"))
    sums = parts.groupBy("of", "i").agg(F.sum(F.col("x").cast("double") / F.col("norm")).alias("x"))
    centre = sums.groupBy("of").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("sums"))
    centre = centre.select(F.col("of.most").alias("most"), "of", F.transform("sums", lambda s: s["x"]).alias("vec"))
    centre = centre.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)))
    centre = _small(materialize(centre, "centres"))
    # The margin is far above the rounding of doubles, so members are linked without any doubt.
    inside = cos(acos(cosine) / 2 - 1e-6)
    near = tried.alias("t").join(centre.alias("c"), "most").filter(_cosine("t", "c") >= inside)
    near = materialize(near.groupBy("node").agg(F.max("of").alias("of")), "near-centres")
    named = near.groupBy("of").agg(F.min("node").alias("core"), F.count("*").alias("n")).filter(F.col("n") > crowded // 4)
    return materialize(near.join(named, "of").select("node", "core"), "cores")


def find_cores(nodes: DataFrame, cosine: float, crowded: int = CROWDED, most_rounds: int = 8) -> DataFrame | None:
    """(node, core) of the vectors within half the linking angle of the centre of a crowd; None without any.

    ``core`` is the core's smallest node. A vector's candidates are the most crowded caps of the vectors that it
    shares crowded caps with, so that a group gets one core and not one for each of its caps. What is left is looked
    at again without the cores found, until no cap is crowded or a round finds none; vectors that stay without a core
    are compared in pairs, so the rounds change no result.
    """
    found, rest = None, nodes
    for _ in range(most_rounds):
        cores = _round_of_cores(rest, cosine, crowded)
        if cores is None or not cores.count():
            break
        found = cores if found is None else found.unionByName(cores)
        rest = nodes.join(found.select("node"), "node", "left_anti")
    return found


def _links(nodes: DataFrame, cores: DataFrame | None, cosine: float) -> DataFrame:
    """(a, b) once per pair of linked vectors that are not of one core."""

    def close(x: str, y: str) -> Column:
        differ = [F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in ("s1", "s2")]
        return differ[0] + differ[1] <= MOST_SIGNS

    def pairs(x: DataFrame, y: DataFrame, on: Column) -> DataFrame:
        return x.alias("x").join(y.alias("y"), on & close("x", "y")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    cap = F.col("x.cap") == F.col("y.cap")
    once = F.col("x.node") < F.col("y.node")
    if cores is None:
        listed = nodes.select("node", "s1", "s2", F.explode("caps").alias("cap"))
        found = pairs(listed, listed, cap & once)
    else:
        named = materialize(nodes.select("node", "s1", "s2", "caps").join(cores, "node", "left"), "nodes-with-cores")
        listed = named.select("node", "s1", "s2", "core", F.explode("caps").alias("cap"))
        free, held = listed.filter("core is null"), listed.filter("core is not null")
        found = pairs(free, free, cap & once).unionByName(pairs(free, held, cap))
        # Cores that meet in a cap: few, as a cap has few centres.
        met = held.select("cap", "core").distinct()
        met = met.alias("x").join(met.alias("y"), cap & (F.col("x.core") < F.col("y.core")))
        met = materialize(met.select("x.cap", "x.core", F.col("y.core").alias("other")), "meeting-cores")
        if met.count():
            left = held.join(met, ["cap", "core"])
            found = found.unionByName(pairs(left, held, cap & (F.col("x.other") == F.col("y.core"))))
    found = materialize(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    facts = nodes.select("node", "vec", "norm")
    x, y = facts.alias("x"), facts.alias("y")
    checked = found.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
    return materialize(checked.filter(_cosine("x", "y") >= cosine).select("a", "b"), "links")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) per row of ``vectors``, linked from ``cosine`` on.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest key that links reach, ``kept``
    whether it is the row's own. No pair below ``cosine`` is linked; a pair at it is missed with a probability of
    about 0.001, closer ones more rarely.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Rows that repeat a key are vectors of their own. Rows without a key take no part: their
    component is null, and they are kept. Other columns are ignored; an empty table gives an empty table.
    """
    vectors = vectors.select(key, vector)
    nodes = materialize(filtered(vectors, key, vector), "capped-vectors")
    cores = find_cores(nodes, cosine)
    links = _links(nodes, cores, cosine)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("n"))
    rows = nodes.select("node", key)
    if cores is None:
        group, edges = F.col("node"), links
        rows = rows.withColumn("others", F.lit(0).cast("long")).withColumn("group", group)
    else:
        sizes = cores.groupBy("core").agg((F.count("*") - 1).alias("others"))
        named = materialize(cores.join(sizes, "core").select("node", F.col("core").alias("group"), "others"), "core-nodes")
        rows = rows.join(named, "node", "left")
        rows = rows.select("node", key, F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("group", "node").alias("group"))
        of = named.select(F.col("node").alias("end"), "group")
        edges = links
        for c in ("a", "b"):
            edges = edges.join(of, F.col(c) == F.col("end"), "left").withColumn(c, F.coalesce("group", c)).drop("end", "group")
    roots = components(edges).select(F.col("node").alias("group"), "root")
    rows = rows.join(degree, "node", "left").join(roots, "group", "left")
    own = [(F.col("others") + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "group").alias("root")]
    rows = materialize(rows.select(key, *own), "rooted")
    least = rows.filter("n_links > 0").groupBy("root").agg(F.min(key).alias("least"))
    component = F.coalesce("least", key)
    return rows.join(least, "root", "left").select(
        key,
        "n_links",
        component.alias("component_id"),
        F.coalesce(F.col(key) == component, F.lit(True)).alias("kept"),
    )
