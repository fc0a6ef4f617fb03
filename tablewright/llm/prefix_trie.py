"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. Peeling descends from the deepest turn: conversations that end at a
depth are merged with the nodes that survive from below, each node takes its sums, then the last turn is stripped and
the stripped nodes are grouped again. So nodes are discovered and summed up in one pass, a depth at a time.

A task peels many subtrees at once, none of more than ``MOST_ROWS`` turns. Prefixes that stand above more turns are
heavy; they are few. Their light children are summed per parent by a grouping with partial sums, and the heavy
prefixes, cut off where they end, are the conversations of the next round. Every round shrinks the table by about
``MOST_ROWS``, so a turn or a conversation that a third of all rows share costs a row per task.

Turns become two 64-bit hashes at the scan, and prefixes running sums of these times powers of an odd base, so texts
do not travel. Sums run over sorted ranges of turns; a conversation that spans ranges gets the sums of those before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_arrow, mix64, text_or_empty
from tablewright.session import materialize

#: Turns below a prefix that one task may peel together.
MOST_ROWS = 50_000

#: Conversation ids that are joined to one string before the strings are hashed in order.
IDS_TOGETHER_BITS = 13

MOST_BROADCAST_ROWS = 50_000

ROWS_TOGETHER = 10_000

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))  # odd
_DEPTH = np.uint64(0xA24BAED4963EE407)
_EMPTY = hashlib.sha256(b"").hexdigest()


def digest_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, t1, t2, chars): two hashes of (role, text), null as empty, and the text's code points.

    Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    return turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.length(text).cast("long").alias("chars"),
    )


def _power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2 ** 64, by squaring."""
    out, square, rest = np.ones(len(exponents), np.uint64), np.array([base], np.uint64), exponents.copy()
    while rest.any():
        odd = (rest & 1).astype(bool)
        out[odd] *= square
        square = square * square
        rest >>= 1
    return out


def _prefix_key(sums: np.ndarray, depth: np.ndarray) -> np.ndarray:
    return mix64(sums + depth.astype(np.uint64) * _DEPTH).view(np.int64)


ROOT_KEYS = tuple(int(_prefix_key(np.zeros(1, np.uint64), np.zeros(1, np.int64))[0]) for _ in _BASES)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of each row in its conversation, from 0, and the sums up to it, over one sorted range of rows."""
    context = TaskContext.get()
    here = context.partitionId() if context is not None else 0
    conv, count, sums = None, 0, np.zeros((2, 1), np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy()
        n = len(ids)
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
        place = np.arange(n) - first[group]
        carried = conv is not None and ids[0] == conv
        if carried:
            place[group == 0] += count
        lanes = []
        for lane, base in enumerate(_BASES):
            terms = batch.column(f"t{lane + 1}").to_numpy().view(np.uint64) * _power(base, place)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
            start = np.uint64(0) - total[first]
            if carried:
                start[:1] += sums[lane]
            lanes.append(total[1:] + start[group])
            sums[lane] = lanes[lane][-1:]
        conv, count = ids[-1], int(place[-1]) + 1
        yield pa.record_batch(
            {
                **{c: batch.column(c) for c in ("conv_id", "t1", "t2", "chars")},
                "part": np.full(n, here, np.int64),
                "place": place,
                "h1": lanes[0].view(np.int64),
                "h2": lanes[1].view(np.int64),
            }
        )


def _carried(parts: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """For each range that starts inside a conversation: that conversation, its rows before, and their sums.

    Looks at one conversation per range at most, so what comes to the driver is bounded by the ranges.
    """
    edges = parts.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high")).collect()
    edges.sort(key=lambda r: r.part)
    spanning = sorted({b.low for a, b in zip(edges[:-1], edges[1:], strict=True) if a.high == b.low})
    if not spanning:
        return {}
    last = F.max(F.struct("place", "h1", "h2")).alias("last")
    rows = parts.filter(F.col("conv_id").isin(spanning)).groupBy("conv_id", "part").agg(last).collect()
    out, mask = {}, (1 << 64) - 1
    running: dict[int, tuple[int, int, int]] = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.part)):
        n, s1, s2 = running.get(r.conv_id, (0, 0, 0))
        if n:
            out[r.part] = (r.conv_id, n, s1, s2)
        p1, p2 = (pow(int(base), n, 1 << 64) for base in _BASES)
        own = r.last
        running[r.conv_id] = (n + own.place + 1, (s1 + p1 * (own.h1 & mask)) & mask, (s2 + p2 * (own.h2 & mask)) & mask)
    return out


def number_turns(digests: DataFrame) -> DataFrame:
    """(conv_id, depth, t1, t2, chars, k1, k2, p1, p2): turns in order, the keys of the prefixes that end there, and
    those of the prefixes one turn shorter.

    Turns are ordered by turn, null first; rows of one turn by their hashes, so repeated rows stay, in any order.
    """
    order = ["conv_id", "turn", "t1", "t2"]
    ranges = digests.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "conv_id long, t1 long, t2 long, chars long, part long, place long, h1 long, h2 long"
    parts = materialize(map_arrow(ranges, _running, schema, ROWS_TOGETHER), "ranges")
    carried = _carried(parts)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            depth = got["place"] + 1
            sums = [got["h1"].view(np.uint64).copy(), got["h2"].view(np.uint64).copy()]
            for part in np.unique(got["part"]).tolist():
                if part in carried:
                    conv, n, *before = carried[part]
                    own = (got["part"] == part) & (got["conv_id"] == conv)
                    depth[own] += n
                    for lane, base in enumerate(_BASES):
                        scale = np.uint64(pow(int(base), n, 1 << 64))
                        sums[lane][own] = sums[lane][own] * scale + np.uint64(before[lane])
            keys = [_prefix_key(s, depth) for s in sums]
            last = [got[f"t{i + 1}"].view(np.uint64) * _power(base, depth - 1) for i, base in enumerate(_BASES)]
            keys += [_prefix_key(s - x, depth - 1) for s, x in zip(sums, last, strict=True)]
            kept = {c: got[c] for c in ("conv_id", "t1", "t2", "chars")}
            yield pa.record_batch({**kept, "depth": depth, **dict(zip(("k1", "k2", "p1", "p2"), keys, strict=True))})

    schema = "conv_id long, t1 long, t2 long, chars long, depth long, k1 long, k2 long, p1 long, p2 long"
    return map_arrow(parts, finish, schema, ROWS_TOGETHER)


def splice_families(digests: DataFrame, family: int = 100, most_shared: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of their family's head: (digests, conv_ids).

    With h = crc32(decimal conv_id) % (most_shared + 1), a conversation c becomes the first h turns of conversation
    c - c % family (all if fewer, none if absent) and then its own turns after its first h. Every conv_id is in the
    second frame, also those left without a turn.
    """
    turns = materialize(number_turns(digests).select("conv_id", "depth", "t1", "t2", "chars"), "numbered")
    lengths = turns.groupBy("conv_id").agg(F.max("depth").alias("length"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most_shared + 1)
    convs = lengths.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("head"), shared.alias("h"))
    heads = lengths.select(F.col("conv_id").alias("head"), "length")
    taken = F.least("h", F.coalesce("length", F.lit(0))).alias("taken")
    convs = materialize(convs.join(heads, "head", "left").select("conv_id", "head", "h", taken), "families")
    own = turns.join(convs, "conv_id").filter("depth > h")
    own = own.select("conv_id", (F.col("taken") + F.col("depth") - F.col("h")).alias("turn"), "t1", "t2", "chars")
    first = turns.filter(F.col("depth") <= most_shared).withColumnRenamed("conv_id", "head")
    first = first.join(convs, "head").filter("depth <= h")
    first = first.select("conv_id", F.col("depth").alias("turn"), "t1", "t2", "chars")
    return own.unionByName(first), convs.select("conv_id")


_SUMS = ("n", "children", "leaves", "saved")


def _peel(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Nodes of whole subtrees from the turns of their sequences; see the head of the module.

    ``top`` is the depth of the subtree's first node. Sums that a row brings belong to the node it stands for.
    """
    order = np.argsort(-rows["depth"], kind="stable")
    rows = {c: v[order] for c, v in rows.items()}
    depths, starts = np.unique(-rows["depth"], return_index=True)
    bounds = dict(zip((-depths).tolist(), zip(starts, [*starts[1:], len(order)], strict=True), strict=True))
    levels, alive = [], None
    deepest = int(-depths[0]) if len(depths) else -1
    for depth in range(deepest, int(-depths[-1]) - 1 if len(depths) else 0, -1):
        a, b = bounds.get(depth, (0, 0))
        here = {c: v[a:b] for c, v in rows.items()}
        if alive is not None and len(alive["k1"]):
            here = {c: np.concatenate([here[c], alive[c]]) for c in here}
        if not len(here["k1"]):
            continue  # between the subtrees of this batch
        by = np.lexsort((here["k2"], here["k1"]))
        k1, k2 = here["k1"][by], here["k2"][by]
        starts_here = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
        node = {c: here[c][by][starts_here] for c in ("k1", "k2")}
        # A row that stands for a survivor has no parent key; the sequence's own row at this depth does.
        for c in ("p1", "p2", "chars", "top"):
            node[c] = np.maximum.reduceat(np.where(here["known"], here[c], np.iinfo(np.int64).min)[by], starts_here)
        for c in _SUMS:
            node[c] = np.add.reduceat(here[c][by], starts_here)
        node["first"] = np.minimum.reduceat(here["first"][by], starts_here)
        node["leaves"] = node["leaves"] + (node["children"] == 0)
        node["saved"] = node["saved"] + (node["n"] - 1) * node["chars"]
        node["depth"] = np.full(len(starts_here), depth)
        node["above"] = np.zeros(len(starts_here), np.int64)
        if alive is not None and len(alive["k1"]):
            group = np.empty(len(by), np.int64)
            group[by] = np.repeat(np.arange(len(starts_here)), np.diff(np.append(starts_here, len(by))))
            levels[-1]["above"][alive["at"]] = node["first"][group[b - a :]]
        levels.append(node)
        up = np.flatnonzero(node["depth"] > node["top"])
        alive = {c: node[c][up] for c in (*_SUMS, "first")}
        alive |= {"k1": node["p1"][up], "k2": node["p2"][up], "children": np.ones(len(up), np.int64), "at": up}
        alive |= {c: np.zeros(len(up), np.int64) for c in ("p1", "p2", "chars", "top", "depth")}
        alive["known"] = np.zeros(len(up), bool)
    columns = ("k1", "k2", "p1", "p2", "depth", "first", *_SUMS, "above")
    whole = {c: np.concatenate([x[c] for x in levels]) for c in (*columns, "top")}
    return pa.record_batch({**{c: whole[c] for c in columns}, "cut": whole["depth"] == whole["top"]})


_ROW = "seq long, length long, depth long, k1 long, k2 long, p1 long, p2 long, chars long, first long, n long, children long, leaves long, saved long"
_NODE = "k1 long, k2 long, p1 long, p2 long, depth long, first long, n long, children long, leaves long, saved long, above long, cut boolean"
_NO_CONV = np.iinfo(np.int64).max


def _peel_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Peels rows that come sorted by subtree (g1, g2), whole subtrees at a time."""
    held: list[dict[str, np.ndarray]] = []

    def peel(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        own = {c: v for c, v in rows.items() if c not in ("g1", "g2")}
        return _peel({**own, "known": np.ones(len(own["k1"]), bool)})

    for batch in batches:
        if batch.num_rows:
            held.append({c: batch.column(c).to_numpy() for c in batch.schema.names})
        if sum(len(x["g1"]) for x in held) < MOST_ROWS:
            continue
        rows = {c: np.concatenate([x[c] for x in held]) for c in held[0]}
        last = (rows["g1"] == rows["g1"][-1]) & (rows["g2"] == rows["g2"][-1])
        cut = int(np.argmax(last))
        if cut:
            yield peel({c: v[:cut] for c, v in rows.items()})
        held = [{c: v[cut:] for c, v in rows.items()}]
    if held:
        yield peel({c: np.concatenate([x[c] for x in held]) for c in held[0]})


def _hash_ends(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): the ids that end at a key, ascending and comma-joined.

    Ids are sorted and joined by ranges of ids, each a bounded row; only these strings are hashed in order.
    """
    block = F.shiftright("conv_id", IDS_TOGETHER_BITS)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    strings = ends.groupBy("k1", "k2", block.alias("block")).agg(ids.alias("ids"))
    ordered = strings.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k1, k2, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids")), strict=True):
                if (k1, k2) == key:
                    state.update(b"," + text.encode())
                    continue
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(text.encode())
            yield _hashes(out)
        if key is not None:
            yield _hashes([(*key, state.hexdigest())])

    return map_arrow(ordered, run, "k1 long, k2 long, ends_sha256 string")


def _hashes(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    k1, k2, text = zip(*rows, strict=True) if rows else ((), (), ())
    kinds = pa.int64(), pa.int64(), pa.string()
    arrays = [pa.array(c, kind) for c, kind in zip((k1, k2, text), kinds, strict=True)]
    return pa.record_batch(arrays, names=["k1", "k2", "ends_sha256"])


def _sequences(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """The turns of one conversation for each distinct one, from the root on; the last brings the members."""
    found = ends.groupBy("length", "k1", "k2").agg(F.min("conv_id").alias("seq"), F.count("*").alias("n"))
    found = materialize(found.select("seq", "length", "n"), "sequences")
    turns = paths.select(F.col("conv_id").alias("seq"), "depth", "k1", "k2", "p1", "p2", "chars").join(found, "seq")
    root = found.select(
        "seq", F.lit(0).cast("long").alias("depth"), *(F.lit(v).alias(c) for c, v in zip(("k1", "k2"), ROOT_KEYS, strict=True)),
        *(F.lit(0).cast("long").alias(c) for c in ("p1", "p2", "chars")), "length", "n",
    )
    last = F.col("depth") == F.col("length")
    none = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    return turns.unionByName(root).select(
        "seq", "length", "depth", "k1", "k2", "p1", "p2", "chars",
        F.when(last, F.col("seq")).otherwise(_NO_CONV).alias("first"),
        F.when(last, F.col("n")).otherwise(0).alias("n"), *none,
    )


def _round(rows: DataFrame, most_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The nodes of all subtrees of up to ``most_rows`` turns, and the rows of the heavy prefixes above them."""
    below = F.sum(F.col("length") - F.col("depth") + 1).alias("below")
    heavy = rows.groupBy("k1", "k2").agg(below).filter(F.col("below") > most_rows).select("k1", "k2")
    heavy = materialize(heavy, "heavy")
    if not (n_heavy := heavy.count()):
        whole = rows.select("*", F.lit(0).cast("long").alias("top"), *(F.lit(0).cast("long").alias(c) for c in ("g1", "g2")))
        nodes = map_arrow(whole.drop("seq", "length").coalesce(1), _peel_groups, _NODE, ROWS_TOGETHER)
        return materialize(nodes, "nodes"), None
    heavy = F.broadcast(heavy) if n_heavy <= MOST_BROADCAST_ROWS else heavy
    deepest = rows.join(heavy, ["k1", "k2"], "left_semi").groupBy("seq").agg(F.max("depth").alias("heavy"))
    rows = materialize(rows.join(deepest, "seq"), "turns-by-weight")
    light = rows.filter("depth > heavy")
    group = light.filter("depth = heavy + 1").select("seq", F.col("k1").alias("g1"), F.col("k2").alias("g2"))
    light = light.withColumn("top", F.col("heavy") + 1).join(group, "seq").drop("seq", "length", "heavy")
    light = light.repartition("g1", "g2").sortWithinPartitions("g1", "g2")
    nodes = materialize(map_arrow(light, _peel_groups, _NODE, ROWS_TOGETHER), "nodes")

    up = nodes.filter("cut").select(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), "first", "n", F.lit(1).cast("long").alias("children"), "leaves", "saved"
    )
    own = rows.filter("depth = heavy")
    ended = own.filter("n > 0 and depth = length").select("k1", "k2", "first", *_SUMS)
    sums = up.unionByName(ended).groupBy("k1", "k2").agg(F.min("first").alias("first"), *(F.sum(c).alias(c) for c in _SUMS))
    shape = own.groupBy("k1", "k2").agg(F.min("seq").alias("seq"))
    brought = materialize(shape.join(sums, ["k1", "k2"]).drop("k1", "k2"), "heavy-ends")
    path = rows.filter("depth <= heavy").select("seq", F.col("heavy").alias("length"), "depth", "k1", "k2", "p1", "p2", "chars")
    last = F.col("depth") == F.col("length")
    path = path.join(brought, "seq").select(
        *path.columns,
        F.when(last, F.col("first")).otherwise(_NO_CONV).alias("first"),
        *(F.when(last, F.col(c)).otherwise(0).alias(c) for c in _SUMS),
    )
    return nodes, materialize(path, "heavy-turns")


def trie_of(digests: DataFrame, conv_ids: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """The trie of turns as :func:`digest_turns` gives them; ``conv_ids`` also holds conversations without turns.

    A heavy prefix loses its deepest turns in every round, so the rounds end.
    """
    paths = materialize(number_turns(digests), "paths")
    last = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("last"))
    ends = conv_ids.select("conv_id").distinct().join(last, "conv_id", "left")
    keys = [F.coalesce(f"last.{c}", F.lit(v)).alias(c) for c, v in zip(("k1", "k2"), ROOT_KEYS, strict=True)]
    ends = materialize(ends.select("conv_id", F.coalesce("last.depth", F.lit(0)).alias("length"), *keys), "ends")
    rows, rounds = materialize(_sequences(paths, ends), "turns-of-sequences"), []
    while rows is not None:
        nodes, rows = _round(rows, most_rows)
        rounds.append(nodes)
    found = rounds[0]
    for nodes in rounds[1:]:
        found = found.unionByName(nodes)
    inside = found.filter("not cut or depth = 0").withColumn("parent_conv_id", F.expr("if(depth = 0, null, above)"))
    whole = inside
    if len(rounds) > 1:
        above = rounds[1]
        for nodes in rounds[2:]:
            above = above.unionByName(nodes)
        above = above.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("first").alias("parent_conv_id"))
        above = F.broadcast(above) if above.count() <= MOST_BROADCAST_ROWS else above
        whole = whole.unionByName(found.filter("cut and depth > 0").join(above, ["p1", "p2"]).select(whole.columns))
    return whole.join(_hash_ends(ends), ["k1", "k2"], "left").select(
        F.col("first").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per distinct prefix
    of the conversations of ``turns`` (conv_id, turn, role, text).

    ``conv_id`` is the node's smallest member, ``parent_conv_id`` its parent's (root: null). Null roles and texts are
    empty. Turns are ordered by number, null first; several rows of one number all count, in the order of their
    hashes. Rows without a conv_id are left out, other columns ignored; an empty table has no node, not even a root.
    """
    digests = materialize(digest_turns(turns), "turn-digests")
    return trie_of(digests, digests.select("conv_id"), most_rows)
