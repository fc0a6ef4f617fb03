"""Near duplicates, components, benchmark decontamination, and the pipeline."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import decontam, near_dups
from tablewright.llm.components import components
from tests.llm.words import prose

# --- components ---


def plain_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_components(spark, shape):
    draw = random.Random(2)
    edges = {
        "random": [(draw.randint(-99, 99), draw.randint(-99, 99)) for _ in range(110)],
        "path": [(i, i + 1) for i in draw.sample(range(200), 190)],
        "star": [(draw.randint(1, 400), 0) for _ in range(300)],
        "none": [],
    }[shape]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = plain_components([e for e in edges if e[0] != e[1]])
    assert {r.node: r.root for r in found} == want and len(found) == len(want)


# --- near duplicates ---


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_groups(rows):
    sets = [(i, plain_set(t)) for i, t in rows if i is not None]
    edges = []
    for k, (i, s) in enumerate(sets):
        for j, other in sets[:k]:
            both = len(s & other)
            if i == j and s and other or both and 100 * both >= 75 * (len(s) + len(other) - both):
                edges.append((i, j))
    return plain_components([e for e in edges if e[0] != e[1]])


def check_groups(spark, rows):
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n long, cls string").repartition(4)
    got = near_dups.near_duplicates(docs).collect()
    want = plain_groups(rows)
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sorted((str(i), len(plain_set(t))) for i, t in rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id, r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return got


def edited(text, share, draw):
    words = text.split(" ")
    for k in draw.sample(range(len(words)), int(share * len(words))):
        words[k] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, n=120):
    draw = random.Random(seed)
    texts = [prose("a", seed * 10_000 + i, draw.choice([1, 3, 5, 12, 60, 200])) for i in range(n)]
    for i in range(0, n, 3):
        base = texts[i]
        texts += [base.upper(), base + " end"] + [edited(base, share, draw) for share in (0.01, 0.02, 0.03, 0.05, 0.1)]
    ids = draw.sample(range(10**6), len(texts))
    return list(zip(ids, texts, strict=True))


def test_groups_equal_those_of_all_pairs(spark):
    check_groups(spark, corpus(1))


@pytest.mark.parametrize("limits", [{"SMALL_BUCKET": 2}, {"SMALL_BUCKET": 2, "PAIRS_PER_CLASS": 0, "WORTH": 0.9}, {"MOST_BROADCAST_ROWS": 0}])
def test_every_way_of_comparing_gives_the_same(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(near_dups, name, value)
    draw = random.Random(5)
    base = prose("b", 77, 150)
    family = [edited(base, 0.035, draw) for _ in range(70)]
    check_groups(spark, [*corpus(2, 30), *enumerate(family, 2_000_000)])


def test_messy_documents(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    check_groups(spark, [*rows, (2, "another text under the same id as one above"), (50, "another text under the same id as one above")])
    assert near_dups.near_duplicates(nothing).count() == 0
    kept = near_dups.one_of_each(messy)
    assert kept.columns == messy.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["0", "1", "2", "4", "5", "6", "7", "8", "9", "10", "None"])


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(4)
    for same in (0.5, 0.75, 0.95):
        a = draw.integers(0, 2**63, 1000).astype(np.uint64)
        keep = int(1000 * 2 * same / (1 + same))
        b = np.concatenate([a[:keep], draw.integers(0, 2**63, 1000 - keep).astype(np.uint64)])
        x, y = near_dups.signature(a, 4000), near_dups.signature(b, 4000)
        assert abs((x == y).mean() - same) < 0.04
        bits = near_dups.signature_bits(np.stack([x, y])).view(np.uint64)
        assert abs(1 - np.bitwise_count(bits[0] ^ bits[1]).sum() / 384 - (1 + same) / 2) < 0.09


def test_pruning_keeps_pairs_at_the_threshold():
    draw, least = np.random.default_rng(1), near_dups.least_matches()
    bits = draw.random((200_000, near_dups.BATCHES, near_dups.BATCH_BITS)) < 0.875
    assert (bits.sum(axis=2).cumsum(axis=1) >= np.array(least)).all(axis=1).mean() > 0.9999
    low = draw.random((20_000, near_dups.BATCHES, near_dups.BATCH_BITS)) < 0.65
    assert (low.sum(axis=2).cumsum(axis=1) >= np.array(least)).all(axis=1).mean() < 0.01
    s = 0.75**near_dups.BAND_ROWS
    assert (1 - s) ** near_dups.band_count() <= near_dups.MISS < (1 - s) ** (near_dups.band_count() - 1)


def test_shingle_sets_are_those_of_the_words():
    texts = [t for _, t in corpus(3, 40)] + ["", " ", "a", "A b\tc", "a b c d e", None, "x  y\nz w v u", "é É é É é É é"]
    found = near_dups.shingle_sets(pa.array(texts))
    plain = [plain_set(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in plain]
    keys = [near_dups.set_key(s) for s in found]
    for i in range(len(texts)):
        for j in range(i):
            assert (keys[i] == keys[j]) == (plain[i] == plain[j])
            assert len(np.intersect1d(found[i], found[j])) == len(plain[i] & plain[j])


# --- decontamination ---


def plain_hits(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))

    w, hit, seen = words(text), set(), set()
    for item, t in items:
        x = words(t)
        for win in {tuple(x[i : i + 10]) for i in range(max(len(x) - 9, 1))} if x else ():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    seen |= {str(item)} - {"None"}
    return len(w), sorted(hit), sorted(seen)


ITEMS = [
    (1, prose("a", 500, 25)), (20, prose("a", 501, 10)), (3, "Short Item, here!"), (4, "two words"), (5, "ONE"), (6, None), (7, " .,- "),
    (8, "É é É"), (9, prose("a", 500, 25)), (None, "no item id at all"), (11, "the the the the the the the the the the the the"), (3, "Short Item, here!"),
]


def dirty_documents():
    draw = random.Random(8)
    texts = []
    for i in range(60):
        words = prose("a", 900 + i, draw.randint(0, 60)).split(" ")
        for _ in range(draw.randint(0, 3)):
            item = draw.choice(ITEMS)[1] or ""
            part = item.split(" ")
            start = draw.randint(0, max(0, len(part) - 9))
            at = draw.randint(0, len(words))
            words[at:at] = part[start : start + draw.randint(8, 25)]
        texts.append(draw.choice([" ", ", ", "\n"]).join(words))
    texts += [(ITEMS[0][1] or "").upper(), "one", "É é É", "é é é", "the " * 30, "short\nitem...HERE", "İone", None, "", "x" * 5000]
    return [(draw.choice([i, i, i, None]) if i % 9 == 0 else i, t) for i, t in enumerate(texts)]


def check_hits(spark, rows, items, most_rows):
    docs = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, text string, at long, n long, window string")
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    got = decontam.contamination(docs, bench, most_rows).collect()
    want = [(str(i), *plain_hits(t, items)) for i, t in rows]
    flat = [(str(r.doc_id), r.n_words, [x for s in r.spans for x in range(s.begin, s.end)], r["items"]) for r in got]
    assert all(len(f[2]) == r.n_hit for f, r in zip(flat, got, strict=True))
    assert sorted(flat) == sorted(want)


@pytest.mark.parametrize("most_rows", [decontam.MOST_BROADCAST_ROWS, 0])
def test_hit_words_equal_a_plain_search(spark, most_rows):
    rows = dirty_documents()
    check_hits(spark, [*rows, rows[3], rows[5]], ITEMS, most_rows)


@pytest.mark.parametrize("most_rows", [decontam.MOST_BROADCAST_ROWS, 0])
def test_words_whose_lower_case_depends_on_the_text_around_them(spark, most_rows):
    items = [(1, "ΟΔΟΣ.ΑΒ"), (2, "one ΤΙΣ'Α two ΟΔΟΣ: three"), (3, "İK ŒΣ.x")]
    rows = [(i, f"Some words {t} and more") for i, t in items] + [(4, "οδος αβ"), (5, "SOME ΟΔΟΣ ΑΒ")]
    check_hits(spark, rows, items, most_rows)


def test_messy_documents_and_empty_benchmarks(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    check_hits(spark, rows, [(1, "three four five six"), (2, "x" * 30_000)], decontam.MOST_BROADCAST_ROWS)
    check_hits(spark, rows, [(1, None)], decontam.MOST_BROADCAST_ROWS)
    bench = spark.createDataFrame([(1, "three four five six")], "item_id long, text string")
    assert decontam.contamination(nothing, bench).count() == 0
    assert decontam.contamination(messy, bench.limit(0)).filter("n_hit > 0").count() == 0
    clean = decontam.clean_documents(messy, bench)
    assert clean.columns == messy.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, _ in rows if i not in (2, 3))


def test_decontamination_runs_no_python(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    windows, _ = decontam.item_windows(bench)
    prefixes, sizes = decontam.rarest_shingles(windows, docs)
    plan = decontam.find_windows(docs, prefixes, sizes)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


# --- pipeline ---


def test_stages_do_what_they_say(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), "test")
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count() <= len(rows) and set(after) <= set(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "language ID":
            assert all(re.search(r"[^\W\d_]", r.text or "") for r in after.values())
        if name == "near-dedup":
            groups = plain_groups([(i, r.text) for i, r in rows.items()])
            assert set(after) == {i for i in rows if groups.get(i, i) == i}
        if name == "decontamination":
            assert set(after) == {i for i, r in rows.items() if not plain_hits(r.text, items)[1]}
        if name == "PII":
            from tablewright.llm.pii import base_spans

            assert set(after) == set(rows) and not any(base_spans(r.text) for r in after.values())
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "SentencePiece":
            assert set(after) == set(rows) and all(r.round_trip for r in after.values())
    assert 0 < docs.count() < before


def test_stages_take_messy_and_empty_tables(spark, messy, nothing):
    folder = "/root/testdata/sf0.001"
    for docs in (messy, nothing):
        docs = docs.withColumns({"source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, folder), "test")
        assert docs.filter("not round_trip").count() == 0


def test_registered_queries_give_their_contract(spark):
    import __spark_entry__ as entry

    folder, queries = "/root/testdata/sf0.001", entry.queries()
    ids = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    wanted = {
        "op2_pii": "n_email n_ip n_card n_phone base_sha256 spans",
        "op4_byte_cnn": "held_out lang_pred score",
        "op6_merkle": "n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op8_near_duplicates": "n_shingles component_id kept",
        "op9_decontaminate": "n_words n_hit n_items items_sha256 contaminated",
        "op10_direct_codes": "start n_tokens ids_crc32",
    }
    for name, columns in wanted.items():
        rows = queries[name](spark, folder).collect()
        assert len(rows) == len(ids) and {r.doc_id for r in rows} == ids
        assert set(columns.split()) <= set(rows[0].asDict())
    assert "pipeline" in queries
