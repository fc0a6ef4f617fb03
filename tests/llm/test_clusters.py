"""Vectors linked by cap filters, integer k-means and the prefix trie, each against a plain version."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import cap_filters, orchard, prefix_trie

# --- cap filters ---


def plain_links(rows, cosine=0.95):
    """(n_links, component) per row index, by comparing all pairs."""
    vecs = [None if k is None or not v or None in v or not np.isfinite(v).all() or not any(v) else np.array(v, float) for k, v in rows]
    linked = [set() for _ in rows]
    for i, a in enumerate(vecs):
        for j in range(i):
            b = vecs[j]
            if a is not None and b is not None and len(a) == len(b):
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    linked[i].add(j)
                    linked[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((rows[i][0], len(linked[i]), min((rows[j][0] for j in seen), default=None) if rows[i][0] is not None else None))
    return sorted(out, key=str)


def found_links(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], "vec_id long, embedding array<double>, node string, caps int, norm double")
    found = cap_filters.near_vectors(df.repartition(3), **more).collect()
    assert all(r.kept == (r.component_id is None or r.component_id == r.vec_id) for r in found)
    return sorted([(r.vec_id, r.n_links, r.component_id) for r in found], key=str)


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_odd_vectors(spark):
    base = [float(i % 5 - 2) for i in range(16)]
    rows = [
        (1, base),
        (2, base),
        (3, [x * 1e200 for x in base]),
        (4, [x * 1e-200 for x in base]),
        (5, [-x for x in base]),
        (6, base[:8]),
        (7, base[:8]),
        (8, None),
        (9, []),
        (10, [0.0] * 16),
        (11, [None, *base[1:]]),
        (12, [float("nan"), *base[1:]]),
        (13, [float("inf"), *base[1:]]),
        (None, base),
        (14, [3.0]),
        (15, [0.5]),
        (15, [0.5]),
        (15, base),
        (16, [-1.0]),
    ]
    want = plain_links([(k, None if v is None else [None if x is None else x / 1e200 if abs(x) > 1e150 else x * 1e200 if 0 < abs(x) < 1e-150 else x for x in v]) for k, v in rows])
    got = found_links(spark, rows)
    # Rows of one key are vectors of their own, so 15 comes three times.
    assert got == want


def test_crowds_are_whole(spark):
    """A crowd of exact and near copies, one too wide for a core, and lone pairs: no link is lost or added."""
    draw = np.random.default_rng(5)
    crowd = unit(unit(draw.standard_normal((1, 24))) + 0.018 * draw.standard_normal((330, 24)))
    wide = unit(unit(draw.standard_normal((1, 24))) + 0.05 * draw.standard_normal((260, 24)))
    lone = unit(draw.standard_normal((300, 24)))
    near = unit(lone[:60] + 0.02 * draw.standard_normal((60, 24)))
    same = np.repeat(lone[-1:], 160, axis=0)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([lone, crowd, near, wide, same]))]
    got, want = found_links(spark, rows), plain_links(rows)
    lost = sum(w[1] for w in want) - sum(g[1] for g in got)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert lost <= 0.002 * sum(w[1] for w in want)
    nodes = cap_filters.filtered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    cores = cap_filters.find_cores(nodes.cache(), 0.95)
    largest = cores.groupBy("core").count().agg(F.max("count")).first()[0]
    assert largest >= 320


@pytest.mark.parametrize("dims", [2, 8, 64, 300])
def test_pairs_at_the_limit_are_found(spark, dims):
    draw = np.random.default_rng(dims)
    a = unit(draw.standard_normal((700, dims)))
    side = unit(draw.standard_normal((700, dims)))
    side = unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    inside = 0.95001 * a + np.sqrt(1 - 0.95001**2) * side
    if dims > 2:
        rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, inside]))]
        got = found_links(spark, rows)
        want = plain_links(rows)
        lost = sum(w[1] for w in want) - sum(g[1] for g in got)
        assert lost <= 0.005 * sum(w[1] for w in want)
    else:
        rows = [(i, v.tolist()) for i, v in enumerate(a[:120])]
        assert [r[1:] for r in found_links(spark, rows)] == [r[1:] for r in plain_links(rows)]
    outside = 0.94999 * a + np.sqrt(1 - 0.94999**2) * side
    if dims > 8:
        rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, outside]))]
        assert {r[1] for r in found_links(spark, rows)} == {0}


def test_no_vectors(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cap_filters.near_vectors(nothing).collect() == []


def test_caps_are_those_of_all_directions():
    """Decoding finds exactly the directions with an inner product of ``cut`` or more."""
    units = unit(np.random.default_rng(0).standard_normal((40, 12))).astype(np.float32)
    rotation, places, codes, cut, _ = cap_filters.product_codes(12, 3000)
    row, name, _ = cap_filters.caps_of(units, 3000)
    turned, want = units @ rotation, set()
    words = codes[0][0].shape[1]
    for number, (code, place) in enumerate(zip(codes, places, strict=True)):
        for first in range(words):
            for second in range(words):
                score = turned[:, place[0]] @ code[0][:, first] + turned[:, place[1]] @ code[1][:, second]
                want |= {(int(r), (first * words + second) * cap_filters.CODES + number) for r in np.flatnonzero(score >= cut + 1e-5)}
                close = np.flatnonzero(np.abs(score - cut) < 1e-5)
                want |= {(int(r), None) for r in close}
    got = set(zip(row.tolist(), name.tolist(), strict=True))
    assert {w for w in want if w[1] is not None} <= got and len(got) <= len(want)


# --- Orchard ---


def plain_clusters(rows, k=16, rounds=3, dims=64, scale=64):
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((key, [int(np.floor(scale * x)) for x in v]))
    digest = {key: hashlib.sha256(f"1:{key}".encode()).hexdigest() for key, _ in kept}
    order = sorted(kept, key=lambda r: (r[0] is None, digest[r[0]], r[1]))
    centres = [v for _, v in order[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        for i, vs in groups.items():
            centres[i] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    last = [(key, *assign(v)[::-1]) for key, v in kept]
    inertia = {}
    for _, c, d in last:
        inertia[c] = inertia.get(c, 0) + d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(key, c, d, inertia[c], sum(inertia.values()), name[c]) for key, c, d in last], key=str)


@pytest.mark.parametrize("kind", ["grid", "spread", "few", "messy"])
def test_clusters(spark, kind):
    draw = np.random.default_rng(3)
    dims = 4
    if kind == "grid":  # equal vectors, equal centroids and equal distances
        rows = [(i, (draw.integers(-2, 3, dims) / 8).tolist()) for i in range(300)]
    elif kind == "spread":
        rows = [(i, (draw.standard_normal(dims) * 10.0 ** draw.integers(-1, 3)).tolist()) for i in range(200)]
    elif kind == "few":
        rows = [(i, draw.standard_normal(dims).tolist()) for i in range(5)]
    else:
        rows = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, None, 0.0, 0.0]), (5, [float("nan")] * 4), (6, [float("-inf"), 0.0, 0.0, 0.0])]
        rows += [(None, [0.5, -0.5, 0.25, 0.0]), (7, [0.0] * 4), (7, [0.0] * 4), (7, [9.0] * 4), (8, [-0.01, 0.01, 0.0, 1.0])]
    df = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], "vec_id long, embedding array<double>, cluster string, v int, distance int")
    got = orchard.cluster(df.repartition(3), dims=dims, k=16 if kind != "messy" else 3)
    assert sorted([tuple(r) for r in got.collect()], key=str) == plain_clusters(rows, dims=dims, k=16 if kind != "messy" else 3)


def test_search_equals_trying_all():
    draw = np.random.default_rng(1)
    for spread in (2, 6, 1000):
        rows, centres = draw.integers(-spread, spread, (500, 3)), draw.integers(-spread, spread, (40, 3))
        every = ((rows[:, None] - centres) ** 2).sum(axis=2)
        best, distance = orchard.nearest(rows, centres)
        assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_no_vectors_and_too_large_ones(spark):
    assert orchard.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    large = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="must not exceed"):
        orchard.cluster(large).collect()


# --- prefix trie ---


def plain_trie(convs):
    """{conv_id: [(role, text), ...]} to the rows of the trie."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        own = (len(members) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        parent = min(nodes[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(p), parent, len(members), children[p], leaves[p], saved[p], digest))
    return sorted(out, key=str)


def plain_convs(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in convs.items()}


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "conv_id long, turn int, role string, text string, k1 string, depth int, seq int")


def found_trie(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def shared_turns(n=60, seed=4):
    draw = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        start = [] if draw.random() < 0.4 else [("system", "be kind ✓")] * int(draw.integers(1, 6))
        turns = start + [("user", "ab"[draw.integers(2)] * int(draw.integers(1, 3))) for _ in range(draw.integers(0, 7))]
        rows += [(c * 3, i, *t) for i, t in enumerate(turns)]
    rows += [(900 + c, i, "user", f"same {i}") for c in range(25) for i in range(9)]
    rows += [(5000, i, "user", f"long {i}") for i in range(400)] + [(5001, i, "user", f"long {i}") for i in range(333)]
    return rows


@pytest.mark.parametrize("most_rows", [30, 400, 50_000])
def test_trie(spark, most_rows):
    rows = shared_turns()
    found = prefix_trie.prefix_trie(turns_frame(spark, rows).repartition(7), most_rows)
    assert found_trie(found) == plain_trie(plain_convs(rows))


def test_trie_of_odd_turns(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "", ""),
        (2, 0, "", ""),
        (2, 1, "", None),
        (3, 5, "ab", "c"),
        (4, 1, "a", "bc"),
        (4, -1, "a", "x" * 30_000),
        (None, 0, "a", "b"),
        (6, 1, "user", "hi"),
        (6, 1, "user", "hi"),
        (-7, 0, "user", "ünï \U0001f600"),
        (8, 0, "user", "ünï \U0001f600"),
    ]
    want = plain_trie(plain_convs(rows))
    assert found_trie(prefix_trie.prefix_trie(turns_frame(spark, rows))) == want
    assert prefix_trie.prefix_trie(turns_frame(spark, rows).limit(0)).collect() == []


def test_families(spark):
    rows = [(c, i, "user", f"{c % 7} {i}") for c in [0, 1, 2, 5, 60, 199, 200, 201, 260, 305, 399] for i in range(c % 9)]
    convs = plain_convs(rows)
    want = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    got = prefix_trie.trie_of(*prefix_trie.splice_families(prefix_trie.digest_turns(turns_frame(spark, rows))))
    assert any(not turns for turns in want.values())
    assert found_trie(got) == plain_trie(want)


def test_a_conversation_over_many_ranges(spark):
    """Prefixes of a conversation that spans sorted ranges have the same keys as in one range."""
    rows = [(c, i, "user", f"{i}") for c in (1, 2) for i in range(3000)]
    digests = prefix_trie.digest_turns(turns_frame(spark, rows))
    keys = prefix_trie.number_turns(digests.repartition(5)).groupBy("depth").agg(F.countDistinct("k1", "k2").alias("n"), F.count("*").alias("c"))
    assert keys.filter("n = 1 and c = 2").count() == 3000
