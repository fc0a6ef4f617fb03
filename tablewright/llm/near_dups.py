"""Near duplicates: MinHash bands, sequential Bayesian pruning of candidates, exact verification.

Documents with equal shingle sets are one class; only classes are compared. Classes that share a band of
their signatures are candidates. A candidate's signatures are compared in batches of 64 bits; after each
batch the pair is dropped if the posterior probability that its similarity reaches the threshold is below
the miss probability. Survivors are verified on the full sets.

A bucket of a band never gives all of its pairs. First every member meets the smallest member only;
links join classes into components. Members of a bucket that are still in different components then meet
further chosen members, and at last, when few such pairs are left, each other. Pairs inside one
component need no comparison, so a large group of near copies costs about as many pairs as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import give_back, map_arrow, mix64, slices, sub_batches, text_or_empty, utf8, word_hashes
from tablewright.llm.components import components
from tablewright.session import materialize, share_package

SHINGLE = 5
PERCENT = 75

#: Rows in a band, and the probability that a pair just at the threshold shares no band.
BAND_ROWS = 6
MISS = 1e-6

#: Posterior probability below which a candidate is dropped.
PRUNE = 1e-7

BATCH_BITS = 64
BATCHES = 6

#: Bytes of text hashed at a time; hashing takes some 60 times as much memory.
HASHED_BYTES = 500_000

#: Largest list of ids that is broadcast, in rows of 8 bytes.
MOST_BROADCAST_ROWS = 4_000_000

#: The pairs that are left meet each other once they are at most so many per class, or once a further round
#: with chosen members has left more than this share of them. Neither changes the result, only the work.
PAIRS_PER_CLASS = 5000
WORTH = 0.5

#: Members of a larger bucket are compared inside tasks, block by block.
SMALL_BUCKET = 48

_SEEDS = mix64(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TIMES = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def band_count(rows: int = BAND_ROWS, percent: int = PERCENT, miss: float = MISS) -> int:
    return ceil(log(miss) / log1p(-((percent / 100) ** rows)))


def least_matches(percent: int = PERCENT, prune: float = PRUNE) -> list[int]:
    """Matching bits a pair needs after each batch to stay a candidate.

    A bit of two signatures matches with probability (1 + s) / 2 at similarity s. With every s equally
    likely beforehand, the pair stays if P(s >= threshold | matches) >= ``prune``.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    yes, no = np.log((1 + s) / 2), np.log((1 - s) / 2)
    above = s >= percent / 100
    out = []
    for batch in range(1, BATCHES + 1):
        n = batch * BATCH_BITS
        for m in range(n + 1):
            density = m * yes + (n - m) * no
            weight = np.exp(density - density.max())
            if weight[above].sum() >= prune * weight.sum():
                out.append(m)
                break
    return out


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a shorter text is one shingle, a wordless none."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    joined = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        joined += words[k : len(words) - size + 1 + k] * _TIMES[k]
    joined = mix64(joined)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        start = end - n
        if n >= size:
            out.append(np.unique(joined[start : end - size + 1]))
        elif n:
            # The number of words goes into the hash, so it equals no shingle of full size.
            out.append(mix64((words[start:end] * _TIMES[8 : 8 + n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sets_in_parts(texts: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """``shingle_sets`` of many texts, a few at a time, as hashing takes many times a text's size."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    lengths = np.diff(utf8(texts)[1]).tolist()
    return [s for a, b in slices(lengths, HASHED_BYTES) for s in shingle_sets(texts.slice(a, b - a))]


def set_key(hashes: np.ndarray) -> int:
    """Signed 64-bit key of a shingle set."""
    twisted = mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    key = mix64(np.array([twisted.sum() + np.uint64(len(hashes))]))
    return int(key.astype(np.int64)[0])


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minima of the set under different permutations of 32-bit values."""
    seeds = (_SEEDS[:n] >> np.uint64(32)).astype(np.uint32)[:, None]
    times = (_SEEDS[:n].astype(np.uint32) | np.uint32(1))[:, None]
    values = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(values), 1024):
        block = np.bitwise_xor(values[None, a : a + 1024], seeds)
        block *= times
        np.minimum(out, block.min(axis=1), out=out)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key of each band, for signatures (documents, minima)."""
    parts = signatures[:, : signatures.shape[1] // rows * rows].reshape(len(signatures), -1, rows).astype(np.uint64)
    keys = (parts * _TIMES[:rows]).sum(axis=2, dtype=np.uint64)
    return mix64(keys + _SEEDS[: keys.shape[1]]).view(np.int64)


def signature_bits(signatures: np.ndarray) -> np.ndarray:
    """One bit of each minimum, packed into BATCHES signed 64-bit numbers."""
    some = signatures[:, : BATCHES * BATCH_BITS].astype(np.uint64)
    bits = (mix64(some + np.uint64(1)) >> np.uint64(40) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(">i8").astype(np.int64)


def sign(docs: DataFrame, rows: int = BAND_ROWS, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """(doc_id, n, cls, bands, bits) of every row: size and key of its shingle set, and its signature."""
    n_bands = band_count(rows, percent, miss)
    minima = max(n_bands * rows, BATCHES * BATCH_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in sub_batches(batch, 1, HASHED_BYTES):
                sets = shingle_sets(some.column(1))
                signatures = np.stack([signature(s, minima) for s in sets])
                keys = band_keys(signatures, rows)[:, :n_bands]
                bits = signature_bits(signatures)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) for s in sets], pa.int64()),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), n_bands).cast(pa.list_(pa.int64())),
                        pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel()), BATCHES).cast(pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "cls", "bands", "bits"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_arrow(texts, run, "doc_id long, n long, cls long, bands array<long>, bits array<long>")


def _close_enough(a: str, b: str, percent: int, prune: float) -> Column:
    """Sizes allow the similarity, and no batch of bits rules it out; later batches only if earlier pass."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    ok = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    matches = F.lit(0)
    for i, least in enumerate(least_matches(percent, prune)):
        differing = F.bit_count(F.get(F.col(f"{a}.bits"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{b}.bits"), F.lit(i))))
        matches = matches + (F.lit(BATCH_BITS) - differing)
        ok = ok & (matches >= least)
    return ok


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs`` (a, b, rep_a, rep_b): those whose full sets are similar enough.

    Only texts of documents in ``pairs`` move.
    """
    pairs = materialize(pairs, "survivors")
    wanted = pairs.select(F.col("rep_a").alias("id")).union(pairs.select("rep_b")).distinct()
    wanted = materialize(wanted, "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    few = wanted.count() <= MOST_BROADCAST_ROWS
    texts = texts.join(F.broadcast(wanted) if few else wanted, "id", "left_semi")
    left = texts.select(F.col("id").alias("rep_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("rep_b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "rep_b").join(left, "rep_a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in sub_batches(batch, 3, HASHED_BYTES):
                left = some.column(2).dictionary_encode()
                sets_a, sets_b = sets_in_parts(left.dictionary), sets_in_parts(some.column(3))
                keys_a = [set_key(s) for s in sets_a]
                keep = []
                for i, (a, b, which) in enumerate(
                    zip(some.column(0).to_pylist(), some.column(1).to_pylist(), left.indices.to_pylist(), strict=True)
                ):
                    x, y = sets_a[which], sets_b[i]
                    # A repeated doc_id brings all of its texts; only those of the two classes count.
                    if keys_a[which] == a and set_key(y) == b:
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        if 100 * both >= percent * (len(x) + len(y) - both):
                            keep.append(i)
                yield some.select([0, 1]).take(pa.array(keep, pa.int32()))

    return map_arrow(rows, run, "a long, b long").distinct()


def link_classes(signed: DataFrame, docs: DataFrame, percent: int = PERCENT, prune: float = PRUNE) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect exactly the classes that all links connect, and classes (cls, rep, n)."""
    solid = signed.filter("n > 0 and doc_id is not null")
    classes = materialize(solid.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "classes")
    one = solid.join(classes.select(F.col("cls").alias("c"), "rep"), (F.col("cls") == F.col("c")) & (F.col("doc_id") == F.col("rep")))
    one = materialize(one.select("cls", "rep", "n", "bits", "bands").dropDuplicates(["cls"]), "class-signatures")
    traits = one.select("cls", F.struct("rep", "n", "bits").alias("it"))
    buckets = one.select("cls", F.explode("bands").alias("band"))
    first = buckets.groupBy("band").agg(F.min("cls").alias("lead"), F.max("cls").alias("last")).filter("lead < last")
    members = materialize(buckets.join(first.select("band", "lead"), "band").select("band", "cls", "lead"), "members")

    # One doc_id with several texts links their classes.
    again = solid.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).filter("a < z")
    links = materialize(solid.join(again, "doc_id").filter("cls > a").select("a", F.col("cls").alias("b")).distinct(), "links")

    def survivors(pairs: DataFrame) -> DataFrame:
        left = traits.select(F.col("cls").alias("a"), F.col("it").alias("x"))
        right = traits.select(F.col("cls").alias("b"), F.col("it").alias("y"))
        met = pairs.join(left, "a").join(right, "b").filter(_close_enough("x", "y", percent, prune))
        return met.select("a", "b", F.col("x.rep").alias("rep_a"), F.col("y.rep").alias("rep_b"))

    # Round 0: every member of a bucket meets its smallest.
    alive = materialize(survivors(members.filter("cls > lead").select(F.col("lead").alias("a"), F.col("cls").alias("b")).distinct()), "candidates")
    tested = alive.select("a", "b")
    links = links.unionByName(_verified(alive, docs, percent))
    n_classes, before = classes.count(), float("inf")
    while True:
        links = materialize(links, "links")
        roots = materialize(components(links), "roots")
        placed = members.select("band", "cls").join(roots, F.col("cls") == F.col("node"), "left")
        placed = placed.select("band", "cls", F.coalesce("root", "cls").alias("root"))
        mixed = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("band")
        members = materialize(placed.join(mixed, "band"), "members")
        by_root = members.groupBy("band", "root").agg(F.count("*").cast("double").alias("k"))
        left_over = by_root.groupBy("band").agg(((F.sum("k") ** 2 - F.sum(F.col("k") ** 2)) / 2).alias("pairs"))
        count = left_over.agg(F.sum("pairs")).first()[0] or 0
        if not count:
            return links, classes
        if count <= PAIRS_PER_CLASS * n_classes or count > WORTH * before:
            break
        before = count
        # Another member of each bucket meets those outside its component.
        lead = members.groupBy("band").agg(F.min(F.struct(F.xxhash64("cls", "band", F.lit(count)).alias("h"), "cls", "root")).alias("lead"))
        pairs = members.join(lead, "band").filter("root != lead.root")
        pairs = pairs.select(F.least("cls", "lead.cls").alias("a"), F.greatest("cls", "lead.cls").alias("b")).distinct()
        alive = materialize(survivors(pairs.join(tested, ["a", "b"], "left_anti")), "candidates")
        tested = tested.unionByName(alive.select("a", "b"))
        links = links.unionByName(_verified(alive, docs, percent))

    # The rest meet each other: in small buckets by a join, each pair in the first band that it shares.
    sizes = members.groupBy("band").agg(F.count("*").alias("k")).filter(F.col("k") > SMALL_BUCKET)
    sizes = materialize(sizes.select(F.col("band").alias("big_band"), "k"), "big-buckets")
    placed = members.join(sizes, F.col("band") == F.col("big_band"), "left")
    rich = placed.filter("k is null").join(one.select("cls", F.struct("rep", "n", "bits", "bands").alias("it")), "cls")
    left = rich.select("band", F.col("cls").alias("a"), F.col("root").alias("r"), F.col("it").alias("x"))
    right = rich.select("band", F.col("cls").alias("b"), F.col("root").alias("q"), F.col("it").alias("y"))
    shared = F.array_position(F.zip_with("x.bands", "y.bands", lambda u, v: u == v), F.lit(True))
    here = F.array_position(F.col("x.bands"), F.col("band"))
    apart = (F.col("a") < F.col("b")) & (F.col("r") != F.col("q"))
    met = left.join(right, "band").filter(apart & _close_enough("x", "y", percent, prune)).filter(shared == here)
    alive = met.select("a", "b", F.col("x.rep").alias("rep_a"), F.col("y.rep").alias("rep_b"))
    found = materialize(_verified(alive.join(tested, ["a", "b"], "left_anti"), docs, percent), "links")
    links = links.unionByName(found)
    if sizes.isEmpty():
        return links, classes
    large = placed.filter("k is not null").select("band", "k", "cls", "root").join(one.select("cls", "rep", "n", "bits"), "cls")
    return links.unionByName(materialize(_links_of_large(large, docs, percent, prune), "links")), classes


def _tiles(rows: DataFrame, size: str, most: int) -> DataFrame:
    """Rows of groups cut into blocks of about ``most``, once for each pair of blocks: columns i, j, block."""
    blocks = F.ceil(F.col(size) / most).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "other")


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _survivors_in_tile(table: pa.Table, percent: int, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs of a tile that stay candidates: of different components, and from its two blocks.

    All pairs are compared by their first batch of bits; later batches look only at those that are left.
    """
    root, n, block = (_numbers(table, x) for x in ("root", "n", "block"))
    bits = table.column("bits").combine_chunks().values.to_numpy().view(np.uint64).reshape(len(n), -1)
    two = _numbers(table, "i")[0] != _numbers(table, "j")[0]
    out_a, out_b = [], []
    for start in range(0, len(n), 128):
        rows = np.arange(start, min(start + 128, len(n)))
        matches = BATCH_BITS - np.bitwise_count(bits[rows, None, 0] ^ bits[None, :, 0]).astype(np.int64)
        ok = (matches >= least[0]) & (root[rows, None] != root[None])
        ok &= (block[rows, None] < block[None]) if two else (rows[:, None] < np.arange(len(n))[None])
        ok &= np.minimum(n[rows, None], n[None]) * 100 >= np.maximum(n[rows, None], n[None]) * percent
        a, b = np.nonzero(ok)
        seen = matches[a, b]
        a = rows[a]
        for k in range(1, BATCHES):
            seen = seen + BATCH_BITS - np.bitwise_count(bits[a, k] ^ bits[b, k])
            keep = seen >= least[k]
            a, b, seen = a[keep], b[keep], seen[keep]
        out_a.append(a)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def _links_of_large(large: DataFrame, docs: DataFrame, percent: int, prune: float) -> DataFrame:
    """Links (a, b) inside large buckets, for rows (band, k, cls, root, rep, n, bits).

    Pairs never become rows. Blocks of a bucket are compared by their bits inside a task, which gives a
    spanning forest of the pairs that stay candidates. Its trees over all buckets are families of alike
    texts; blocks of a family, now with their texts, are compared inside a task once more, and the
    survivors verified there.
    """
    least = least_matches(percent, prune)

    def forest(table):
        a, b = _survivors_in_tile(table, percent, least)
        label = np.arange(table.num_rows)
        while len(a):
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if np.array_equal(before, label):
                break
        cls = _numbers(table, "cls")
        out = label != np.arange(len(label))
        return pa.table({"a": pa.array(cls[out]), "b": pa.array(cls[label[out]])})

    share_package(docs.sparkSession)
    tiles = _tiles(large, "k", 1500).select("band", "i", "j", "block", "cls", "root", "n", "bits")
    trees = materialize(tiles.groupBy("band", "i", "j").applyInArrow(forest, "a long, b long").distinct(), "trees")
    family = materialize(components(trees).withColumnRenamed("root", "family"), "families")
    sizes = family.groupBy("family").agg(F.count("*").alias("size"))
    traits = large.select("cls", "root", "rep", "n", "bits").dropDuplicates(["cls"])
    rows = traits.join(family.join(sizes, "family"), F.col("cls") == F.col("node")).drop("node")
    rows = materialize(rows, "family-members")
    wanted = rows.select(F.col("rep").alias("id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    few = rows.count() <= MOST_BROADCAST_ROWS
    texts = texts.join(F.broadcast(wanted) if few else wanted, "id", "left_semi")
    rows = rows.join(texts.dropDuplicates(["id", "text"]), F.col("rep") == F.col("id"))

    def verify(table):
        sets = sets_in_parts(table.column("text"))
        # A repeated doc_id brings all of its texts; only that of the class counts.
        own = [set_key(s) == c for s, c in zip(sets, table.column("cls").to_pylist(), strict=True)]
        table, sets = table.filter(pa.array(own)), [s for s, o in zip(sets, own, strict=True) if o]
        cls = _numbers(table, "cls")
        found = []
        if table.num_rows:
            a, b = _survivors_in_tile(table, percent, least)
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            cuts = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                mine, others = sets[a[start]], [sets[k] for k in b[start:end]]
                lengths = np.array([len(x) for x in others])
                joined = np.concatenate(others)
                at = np.minimum(np.searchsorted(mine, joined), len(mine) - 1)
                both = np.add.reduceat((mine[at] == joined).astype(np.int64), np.cumsum(lengths) - lengths)
                good = 100 * both >= percent * (len(mine) + lengths - both)
                found += [(cls[a[start]], cls[k]) for k in b[start:end][good]]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        give_back()
        return pa.table({"a": pa.array(pairs.min(axis=1)), "b": pa.array(pairs.max(axis=1))})

    tiles = _tiles(rows, "size", 250).select("family", "i", "j", "block", "cls", "root", "n", "bits", "text")
    return tiles.groupBy("family", "i", "j").applyInArrow(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, miss: float = MISS, prune: float = PRUNE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of (doc_id, text).

    Documents are linked if their sets of 5-word shingles have a Jaccard similarity of ``percent`` / 100
    or more; ``component_id`` is the smallest doc_id that links reach, ``kept`` whether it is the row's own.
    A link at the threshold is missed with a probability of about ``miss`` + ``prune`` at most.

    Null and wordless texts have no shingles and no links. Texts of fewer than five words are one shingle.
    Rows of one doc_id are linked to each other. Rows without a doc_id take no part: their component is
    null, and they are kept. Other columns are ignored; an empty table gives an empty table.
    """
    signed = materialize(sign(docs, percent=percent, miss=miss), "signatures")
    links, classes = link_classes(signed, docs, percent, prune)
    roots = components(links)
    named = classes.join(roots, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(least, "root").select(F.col("cls").alias("c"), "component")
    own = F.col("n") > 0
    rows = signed.select("doc_id", "n", "cls").join(named, own & F.col("doc_id").isNotNull() & (F.col("cls") == F.col("c")), "left")
    component = F.coalesce("component", "doc_id")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) without near duplicates: of each component, one row.

    It is a row of the smallest doc_id; of rows that repeat it, any. Rows without a doc_id stay. Only ids are
    shuffled, except for rows that repeat a doc_id.
    """
    found = materialize(near_duplicates(docs), "near-duplicates")
    away = found.filter("not kept").select(F.col("doc_id").alias("_away")).distinct()
    again = found.filter("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    again = again.filter("n > 1").select(F.col("doc_id").alias("_away"))
    away, again = materialize(away, "away"), materialize(again, "again")
    n_away, n_again = away.count(), again.count()

    def without(ids: DataFrame, n: int) -> DataFrame:
        return F.broadcast(ids) if n <= MOST_BROADCAST_ROWS else ids

    out = docs.join(without(away, n_away), F.col("doc_id") == F.col("_away"), "left_anti")
    if not n_again:
        return out
    single = out.join(without(again, n_again), F.col("doc_id") == F.col("_away"), "left_anti")
    repeated = out.join(without(again, n_again), F.col("doc_id") == F.col("_away"), "left_semi")
    return single.unionByName(repeated.dropDuplicates(["doc_id"]))
