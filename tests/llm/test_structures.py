"""URL filter, WARC, Merkle trees, token codes, piece codes."""

import gzip
import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import dac, merkle, sp_codec, url_filter, warc
from tablewright.session import scratch_path

# --- urls ---

RULES = [
    url_filter.Rule("net/", "block"),
    url_filter.Rule("example.net/en/", "allow"),
    url_filter.Rule("example.com/de/", "block"),
    url_filter.Rule("org/fr/", "allow"),
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path):
    fits = []
    for rule in RULES:
        name, slash, prefix = rule.pattern.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + prefix):
            fits.append(rule)
    return max(fits, key=lambda r: len(r.pattern)) if fits else None


@pytest.fixture(scope="module")
def pages(spark):
    urls = [
        None, "", "no scheme", "http://", "http://A.EXAMPLE.com/De/x", "http://a.example.com/de/x?y#z", "https://x.net", "https://x.net/",
        "https://m.example.net/en/1", "https://example.net/en", "http://a.org/fr/1", "http://a.org/FR/1", "x://h?/a://b", "x://h#f/a",
        "http://cheappills.example.com/en/1", "http://thering.example.com/en/2", "http://thering.example.com/en/2", "http://adult-x.example.org/",
        "http://" + "a" * 5000 + ".com/" + "b/" * 5000, "http://exämple.com/ü", "http://a\nb/c\nd", "net://net/", "http://xnet/",
    ]
    urls += [f"http://www.thering.example.{'com' if i % 2 else 'org'}/en/{i}" for i in range(60)]
    rows = [(i, u, "<p>", 1.0, "r", "v", 5) for i, u in enumerate(urls)] + [(None, "http://thering.example.com/", None, 2.0, None, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, score double, rule string, verdict string, n long")


def test_urls_are_judged(spark, pages, messy):
    docs = spark.createDataFrame([("the ring cheap the ring",), (None,), ("cheap cheap",)], "text string")
    rows = url_filter.judge_urls(pages, docs, RULES).collect()
    urls = {r.page_id: r.url for r in pages.collect()}
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == plain_parts(urls[r.page_id])
        rule = plain_rule(r.host, r.path)
        assert r.rule == (rule.pattern if rule else None)
        if rule:
            assert r.verdict == rule.verdict
    verdict = {r.page_id: r.verdict for r in rows}
    assert verdict[14] == verdict[17] == "block"
    assert verdict[15] == verdict[16] == verdict[0] == verdict[3] == verdict[None] == "allow"


def test_no_pages_and_no_documents(spark, pages, nothing):
    assert url_filter.judge_urls(pages.limit(0), nothing, RULES).count() == 0
    assert url_filter.judge_urls(pages, nothing, RULES).count() == pages.count()


def test_names_are_split_into_their_words(spark):
    counts = {"the": 50, "ring": 20, "her": 10, "in": 30, "therin": 1}
    names = spark.createDataFrame([("thering",), ("ringher",), ("zzz",), ("a" * 64,)], "name string")
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.name: r.words for r in url_filter.split_names(names, words, []).collect()}
    assert found["thering"] == ["the", "ring"] and found["ringher"] == ["ring", "her"] and found["a" * 64] == ["a" * 64]

    def cost(words):
        total = sum(counts.values())
        return sum(np.log(counts[w] / total) if w in counts else np.log(10 / total) - len(w) * np.log(10) for w in words)

    def splits(name):
        return [[name]] + [[name[:i], *rest] for i in range(1, len(name)) for rest in splits(name[i:])]

    for name in ("therinring", "inherin", "xthey"):
        assert cost(url_filter.split_name(name, counts, sum(counts.values()))) == pytest.approx(max(map(cost, splits(name))))


def test_names_and_words_of_any_length(spark):
    long = "abcdefghijklmnopqrstuvwxyz"
    words = spark.createDataFrame([(long, 500), ("the", 50), ("ring", 20)], "word string, n long")
    name = ("the" + long + "ring") * 20
    found = url_filter.split_names(spark.createDataFrame([(name,)], "name string"), words, []).first().words
    assert found == ["the", long, "ring"] * 20


def test_tokens_of_hosts_and_paths(spark):
    words = spark.createDataFrame([("cheap", 50), ("pills", 20), ("the", 30)], "word string, n long")
    names = ["www.cheappills.example.com", "/cheappills/the/the/#.html", "/ü/#", "", "..."]
    rows = url_filter.name_tokens(spark.createDataFrame([(n,) for n in names], "name string"), words).collect()
    found = {r.name: r.tokens for r in rows}
    assert found[names[0]] == ["www", "cheap", "pills", "example", "com"]
    assert found[names[1]] == ["cheap", "pills", "the", "the", "#", "html"]  # repeated words stay
    assert found[names[2]] == ["ü", "#"] and found[""] == found["..."] == []


def test_urls_of_hidden_seed_words_are_still_blocked(spark):
    """A third of the seed words label nothing; the words around them give their urls away."""
    draw = random.Random(8)
    lures, plain = ["cheap", "free", "win", "bonus", "hot", "best", "online", "now"], ["news", "garden", "river", "school", "music", "city", "daily", "book"]
    seeds = ["casino", "poker", "pills", "viagra", "loans", "jackpot", "escort", "warez", "lottery"]
    hidden, shown = seeds[::3], [s for i, s in enumerate(seeds) if i % 3]
    urls, kind = [], []
    for i in range(1800):
        k = (0, 0, 1)[i % 12] if i % 12 < 3 else 2  # shown seed words, hidden ones, none
        own, word = (plain, draw.choice(plain)) if k == 2 else (lures, draw.choice(hidden if k else shown))
        name = "".join(draw.sample([word, *draw.sample(own, 2)], 3))
        urls.append((i, f"http://{name}{i}.example.com/{draw.choice(own)}{draw.choice(own)}/{i}"))
        kind.append(k)
    docs = spark.createDataFrame([(" ".join(lures + plain + seeds),)] * 5, "text string")
    pages = spark.createDataFrame(urls, "page_id long, url string")
    verdict = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, docs, [], shown).collect()}
    share = [np.mean([verdict[i] == "block" for i in range(1800) if kind[i] == k]) for k in range(3)]
    assert share[0] == 1 and share[1] > 0.95 and share[2] < 0.02


def test_naive_bayes_equals_a_plain_version(spark):
    rows = [(["a", "b"], 3, True), (["a", "a", "c"], 2, False), ([], 1, False), (None, 4, True)]
    odds, prior = url_filter.fit_naive_bayes(spark.createDataFrame(rows, "tokens array<string>, weight long, blocked boolean"))
    bad, good, found = {"a": 3, "b": 3, "c": 0}, {"a": 4, "b": 0, "c": 2}, {r.token: r.odds for r in odds.collect()}
    for t in "abc":
        assert found[t] == pytest.approx(np.log((bad[t] + 1) / 9) - np.log((good[t] + 1) / 9))
    assert prior == pytest.approx(np.log(8 / 4))


# --- WARC ---


def record(i, payload=b"x" * 200, **more):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    lines = {"WARC-Type": "response", "WARC-Record-ID": f"<{warc.ID_PREFIX}{i}>", "Content-Type": "application/http;msgtype=response"}
    lines |= {"WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(), "Content-Length": str(len(block))} | more
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines.items()) + b"\r\n" + block + b"\r\n\r\n"


def spans(found):
    """(start, length) once per member, and a check that all bytes are accounted for."""
    return list(dict.fromkeys((a, n) for a, n, _, _ in found))


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_recovers_what_follows_damage(zipped):
    draw = random.Random(4)
    for _ in range(60):
        parts = [record(i, bytes(draw.choices(b"ab\r\n <WARC/1.1", k=draw.randint(0, 400)))) for i in range(6)]
        parts = [gzip.compress(p) for p in parts] if zipped else parts
        bad = draw.sample(range(6), 2)
        for b in bad:
            cut = bytearray(parts[b])
            kind = draw.randrange(3)
            if kind == 0:
                cut = cut[: draw.randrange(1, len(cut))]
            elif kind == 1:
                cut[len(cut) // 2] ^= 0xFF
            else:
                cut = bytearray(draw.randbytes(50)) + cut
            parts[b] = bytes(cut)
        data = b"".join(parts)
        found = list(warc.salvage(data))
        ids = [warc._page(r.headers["warc-record-id"]) for *_, r in found if r]
        assert {i for i in range(6) if i not in bad} <= set(ids)
        assert len(ids) == len(set(ids))
        at = 0
        for a, n in spans(found):
            assert a == at
            at += n
        assert at == len(data)
        for (_, _, status, r), before in zip(found[1:], found, strict=False):
            assert (status == "recovered") == (before[2] == "quarantined" and r is not None)


def test_salvage_of_whole_and_hopeless_files():
    good = [record(i) for i in range(3)]
    assert [s for _, _, s, _ in warc.salvage(b"".join(good))] == ["ok"] * 3
    assert [s for _, _, s, _ in warc.salvage(gzip.compress(b"".join(good)))] == ["ok"] * 3
    assert list(warc.salvage(b"")) == []
    for junk in (b"junk", b"WARC/1.1\r\n", b"\x1f\x8b\x08", b"WARC/1.1\r\n" * 500):
        assert [(a, n, s) for a, n, s, _ in warc.salvage(junk)] == [(0, len(junk), "quarantined")]
    assert warc.parse_record(record(1, **{"Content-Length": "5"}), 0) is None
    assert warc.parse_record(record(1, **{"WARC-Payload-Digest": "sha256:00"}), 0) is None
    assert warc.parse_record(record(1).replace(b"xxx", b"xyx", 1), 0) is None


def found_in(data):
    rows = list(warc.salvage_inside(data))
    assert [r[:4] for r in rows] == list(warc.salvage(data))
    return [(s, warc._page(r.headers["warc-record-id"]) if r else inner) for _, _, s, r, inner in rows]


def test_salvage_searches_inside_members(spark, tmp_path):
    n = len(record(1))
    wrong = record(2).replace(b"xxx", b"xyx", 1)
    lost = [("ok", 1), ("quarantined", (n, n)), ("recovered", 3)]
    one = gzip.compress(record(1) + wrong + record(3))
    assert found_in(one) == lost
    assert found_in(one + gzip.compress(record(4))) == [*lost, ("ok", 4)]
    # A broken checksum: records that have a digest stay; the member is logged.
    for level in (0, 9):
        whole = gzip.compress(record(1) + record(2), level)
        broken = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
        want = [("ok", 1), ("ok", 2), ("quarantined", (2 * n, 0))]
        assert found_in(broken) == want
        assert found_in(broken + gzip.compress(record(3))) == [*want, ("recovered", 3)]
    bare = gzip.compress(record(5).replace(b"WARC-Payload-Digest", b"X"))
    assert found_in(bare) == [("ok", 5)] and [s for s, _ in found_in(bare[:-8] + bytes(8))] == ["quarantined"]
    # What inflates before the error or the end.
    draw = random.Random(7)
    pages = [record(i, draw.randbytes(30_000)) for i in range(6)]
    stream = gzip.compress(b"".join(pages))
    hurt = bytearray(stream)
    hurt[len(stream) * 2 // 3 : len(stream) * 2 // 3 + 200] = b"\xff" * 200
    for data in (stream[: len(stream) // 2], bytes(hurt)):
        got = found_in(data + gzip.compress(record(9)))
        assert got[:2] == [("ok", 0), ("ok", 1)] and got[-2][0] == "quarantined" and got[-1] == ("recovered", 9)
    (tmp_path / "a.warc.gz").write_bytes(one)
    rows = [(r.start, r.length, r.status, r.page_id, r.inner_start, r.inner_length) for r in warc.read_warc(spark, str(tmp_path)).collect()]
    m = len(one)
    assert rows == [(0, m, "ok", 1, 0, n), (0, m, "quarantined", None, n, n), (0, m, "recovered", 3, 2 * n, n)]


@pytest.mark.parametrize("compress", [False, True])
def test_pages_come_back_as_they_went(spark, compress):
    same, small = "copy " * 40, "tiny"
    rows = [(1, "http://a/\r\nb", "x" * 300), (2, None, None), (3, "u", ""), (4, "u", same), (9, "u", same), (5, "u", same), (6, "u", small)]
    rows += [(7, "u", small), (8, "u", "é\r\n\r\nWARC/1.1\r\n" * 9), (10, "u", "y" * 17_000_000), (None, "u", same), (4, "u", same)]
    rows += [(i, "u", f"page {i} " * 30) for i in range(11, 60)]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, kind string, refers_to long").repartition(3)
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path, records_per_file=7, compress=compress)
    found = warc.read_warc(spark, path).collect()
    assert len(found) == len(rows) and all(r.status == "ok" for r in found)
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in found:
        data = html[r.page_id]
        assert r.payload_bytes == len(data) and r.payload_digest == hashlib.sha256(data).hexdigest()
        assert (r.kind, r.refers_to) == (("revisit", 4) if r.page_id in (5, 9) else ("response", None))
        assert bytes(r.payload) == (b"" if r.kind == "revisit" else data)
    assert {r.uri for r in found if r.page_id == 1} == {"http://a/%0D%0Ab"} and {r.uri for r in found if r.page_id == 2} == {None}
    names = [f"{path}/{n}" for n in os.listdir(path) if n.startswith("part")]
    whole = b"".join(open(n, "rb").read() if not compress else gzip.decompress(open(n, "rb").read()) for n in names)
    assert whole.count(b"WARC-Record-ID") == len(rows) - 1


def test_no_pages_give_no_records(spark):
    path = scratch_path(spark, "warc")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).count() == 0


def test_quarantined_gaps_are_logged(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(1) + b"broken" + record(2) + record(3)[:90])
    rows = sorted((r.start, r.length, r.status, r.page_id) for r in warc.read_warc(spark, str(tmp_path)).collect())
    n = len(record(1))
    assert rows == [(0, n, "ok", 1), (n, 6, "quarantined", None), (n + 6, n, "recovered", 2), (2 * n + 6, 90, "quarantined", None)]


# --- Merkle ---


def test_equal_texts_and_only_they_have_equal_roots():
    draw = random.Random(1)
    texts = {"".join(draw.choices("ab \n#é", k=draw.randint(0, 60))) for _ in range(2000)}
    assert len({merkle.tree(t).digest for t in texts}) == len(texts)
    assert merkle.tree(None) == merkle.tree("")


def test_leaves_add_up_to_the_text():
    draw = random.Random(2)
    for _ in range(300):
        text = "".join(draw.choices(["the ", "ünd ", "\n", "\r\n", "x", "  ", "# h", "\U0001f600 "], k=80))
        root = merkle.tree(text)
        assert root.size == len(text)
        assert "".join(p for line in merkle._lines(text) for p in merkle.leaves(line)) == text


def test_differing_branches_locate_the_edit():
    lines = [" ".join(f"w{i * 31 + j * 7 % 13}q{j}" for j in range(40)) for i in range(50)]
    text = "\n".join(lines)
    at = text.index(lines[20]) + 50
    other = text[:at] + "CHANGED" + text[at + 3 :]
    spots = list(merkle.changed(merkle.tree(text), merkle.tree(other)))
    assert spots and all(a <= at + 3 and at <= a + n for a, n in spots) and sum(n for _, n in spots) < 400
    assert 0.9 < merkle.likeness(merkle.tree(text), merkle.tree(other)) < 1
    moved = "\n".join([lines[30], *lines[:30], *lines[31:]])
    assert merkle.likeness(merkle.tree(text), merkle.tree(moved)) > 0.95
    assert merkle.likeness(merkle.tree(text), merkle.tree("nothing alike")) == 0


def check_edits(rows, docs):
    order = sorted(((i is not None, i or 0, i, t or "") for i, t in docs), key=lambda x: (x[0], x[1], x[3]))
    want = []
    for k, (_, _, i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][3]
        n = len(t) // 4
        new = t[: len(t) - n] + nxt[:n]
        a, b, c = merkle.tree(t), merkle.tree(new), merkle.tree(nxt)
        want.append((str(i), len(t), hashlib.sha256(new.encode()).hexdigest(), a.digest.hex(), b.digest.hex(), round(merkle.likeness(a, b), 9), round(merkle.likeness(a, c), 9)))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows]
    assert sorted(got) == sorted(want)


def test_edits_of_messy_rows(messy, nothing, spark):
    check_edits(merkle.fingerprint_edits(messy).collect(), [(r.doc_id, r.text) for r in messy.collect()])
    assert merkle.fingerprint_edits(nothing).count() == 0
    one = spark.createDataFrame([(5, "just one text of some words")], "doc_id long, text string")
    check_edits(merkle.fingerprint_edits(one).collect(), [(5, "just one text of some words")])
    none = spark.createDataFrame([(None, "b"), (None, "a")], "doc_id long, text string")
    check_edits(merkle.fingerprint_edits(none).collect(), [(None, "b"), (None, "a")])


def test_next_document_across_partitions(spark):
    draw = random.Random(8)
    rows = [(draw.randint(-(10**12), 10**12), f"text {i} " * draw.randint(1, 9)) for i in range(700)] + [(7, "tie b"), (7, "tie a"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check_edits(merkle.fingerprint_edits(docs).collect(), rows)


# --- token codes ---


@pytest.mark.parametrize("bits", [8, 16])
def test_any_id_is_read_in_place(bits):
    draw = np.random.default_rng(1)
    for n, top in ((0, 9), (1, 3), (513, 256), (5000, 70_000), (3000, 2**32 - 1), (2000, 200)):
        ids = np.sort(draw.integers(0, top, n)) if n == 5000 else draw.integers(0, top, n)
        segment = dac.Segment(dac.encode_segment(ids.astype(np.uint32), [None, 4], [n // 2, n], bits))
        assert segment.doc_ids == [None, 4] and segment.ends.tolist() == [n // 2, n]
        assert segment.ids().tolist() == ids.tolist()
        assert [segment[i] for i in range(0, n, 7)] == ids[::7].tolist()
        for a, b in draw.integers(0, n + 1, (20, 2)):
            a, b = sorted((int(a), int(b)))
            assert segment.ids(a, b).tolist() == ids[a:b].tolist()
        with pytest.raises(IndexError):
            segment[n]
    with pytest.raises(ValueError):
        dac.Segment(b"JUNK" + bytes(40))


ODD = ["", " ", "a", " a b", "a  b", "a \n b", "a, b,c. d!", "x\ny z\n w", "\u3000a b\u3000", "it's 's a", "a b c  d", "é, ñ. 5. 5, a1.", None]
ODD += ["<|endoftext|> a <|endoftext|>", "a ", "a  ", "\n", "a\t b", "日本, 語.", "x 'd. y", "a\nb", "a\n\nb", "a\n", "a\n\n c", "\na b", "\n a"]
ODD += ["a \u3000b", "q q q " + "z" * 70 + " z", "\x00 a\x00 \x1c b", "a\x85 b", "\r\n a", "w " * 3000]


def direct_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_are_encoded_as_whole_texts_are(spark):
    encoder = dac.ByteBpeEncoder(public_tokenizers.path("byte_bpe_50k.json"), remembered=50)
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = direct_ids(texts)
    for some in (range(len(texts)), range(len(ODD)), range(0)):
        ids, cuts = encoder(pa.array([texts[i] for i in some], pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == [want[i] for i in some]


def test_written_codes_are_read_back(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()] + [(100 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, part int, seq int").repartition(5)
    path = scratch_path(spark, "codes")
    dac.write_codes(docs, path, public_tokenizers.path("byte_bpe_50k.json"), 2, segment_ids=500)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, stream = [], []
    for (i, _), ids in zip(order, direct_ids([t for _, t in order]), strict=True):
        own = [*ids, 2]
        want.append((str(i), len(stream), len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        stream += own
    got = [(str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in dac.read_documents(spark, path).collect()]
    assert sorted(got) == sorted(want)
    places = [0, 5, 5, len(stream) - 1, len(stream), -1, None, *range(0, len(stream), 997)]
    found = dac.read_ids(spark, path, spark.createDataFrame([(p,) for p in places], "place long")).collect()
    assert sorted((r.place, r.id) for r in found) == sorted((p, stream[p]) for p in places if p is not None and 0 <= p < len(stream))
    empty = scratch_path(spark, "codes")
    dac.write_codes(nothing, empty, public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert dac.read_documents(spark, empty).count() == 0


def test_special_tokens_as_in_the_plain_call(spark, tmp_path):
    from tokenizers import Tokenizer

    import __spark_entry__ as entry

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ODD + ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>  y\n<|endoftext|>\nz", "<|endoftext|><|endoftext|>", "<|endof text|>"]
    texts += ["z" * 70 + "<|endoftext|>", "a <|endoftext|>\u3000b", "<|endoftext |>"]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [64, 220, 50256, 275] in want
    encoder = dac.ByteBpeEncoder(path, remembered=50, special_tokens=True)
    for _ in range(2):
        ids, cuts = encoder(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == want
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in entry.queries()["op10_direct_codes"](spark, str(tmp_path)).collect()}
    start = 0
    for i, ids in enumerate(want):
        assert got[i] == (start, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes()))
        start += len(ids) + 1


# --- pieces ---


@pytest.fixture(scope="module")
def vocabulary():
    return sp_codec.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def whole_viterbi(vocabulary, text):
    """Table over the whole text."""
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        top, length = None, 1
        for n in range(min(vocabulary.longest, end), 0, -1):
            if found := vocabulary.pieces.get(text[end - n : end]):
                score = best[end - n] + found[1]
                if top is None or score > top:
                    top, length = score, n
        best.append(best[-1] + vocabulary.worst if top is None else top)
        back.append(length)
    lengths, at = [], len(text)
    while at:
        lengths.append(back[at])
        at -= back[at]
    return vocabulary.ids(text, lengths[::-1])


def random_texts():
    draw = random.Random(6)
    out = ["".join(draw.choices(["a", "b", " ", "\n", "▁", "é", "the", "日", "ing", "\x00", "ﬁ"], k=draw.randint(0, 120))) for _ in range(300)]
    return [*out, "a" * 700, "theinger" * 200, " " * 300, "\n" * 50]


def stream(vocabulary, text, portion):
    search, out = sp_codec.StreamingViterbi(vocabulary), []
    for i in range(0, len(text), portion):
        out += search.feed(text[i : i + portion])
    return out + search.finish(), search.held


def test_streaming_equals_the_whole_table(vocabulary):
    codec = sp_codec.Codec(vocabulary)
    texts = random_texts()
    for text, coded in zip(texts, codec.encode(texts), strict=True):
        want = whole_viterbi(vocabulary, " " + text) if text else []
        assert np.frombuffer(coded, np.uint32).tolist() == want
        assert codec.decode(want) == text
        if text:
            assert stream(vocabulary, " " + text, 7)[0] == want


def test_streaming_over_small_vocabularies():
    draw = random.Random(9)
    for _ in range(300):
        pieces = {"".join(draw.choices("abc ", k=draw.randint(1, 5))): 0 for _ in range(draw.randint(1, 15))}
        pieces = {p: (i, -float(draw.randint(0, 12))) for i, p in enumerate(pieces)}
        vocabulary = sp_codec.Vocabulary.of(pieces, None, 99)
        codec = sp_codec.Codec(vocabulary)
        for text in ("".join(draw.choices("abcd ", k=draw.randint(1, 90))) for _ in range(5)):
            want = whole_viterbi(vocabulary, text)
            assert stream(vocabulary, text, draw.randint(1, 30))[0] == want
            assert np.frombuffer(codec.encode([text])[0], np.uint32).tolist() == want


def test_the_window_stays_small(vocabulary):
    text = " ".join(r for r in random_texts()[:300] if r) * 30
    assert stream(vocabulary, text, 4096)[1] <= 6 * vocabulary.longest
    # Paths of different phase never meet in such a text; it still takes time in proportion.
    assert len(stream(vocabulary, "a" * 200_000, 4096)[0]) > 1000


def test_the_batched_search_keeps_a_window(vocabulary, monkeypatch):
    draw = random.Random(3)
    texts = ["".join(draw.choices(["the", "ing", "a", "日", "é", "on"], k=draw.randint(1, 400))) for _ in range(120)]
    texts += ["a" * n for n in (15, 16, 17, 33, 5000)] + ["theinger" * 300]
    texts.sort(key=len, reverse=True)
    table = sp_codec.PieceTable(vocabulary)
    want = [np.array(whole_viterbi(vocabulary, t), np.uint32).tobytes() for t in texts]
    for few in (0, 1, 64):
        monkeypatch.setattr(sp_codec._Batch, "FEW", few)
        batch = sp_codec._Batch(vocabulary, table, texts)
        assert batch.run() == want
    monkeypatch.setattr(sp_codec._Batch, "FEW", 0)
    meeting = [t for t in texts if len(set(t)) > 3 and "theingertheinger" not in t]
    batch = sp_codec._Batch(vocabulary, table, meeting)
    batch.run()
    assert len(meeting[0]) > 500 and batch.held <= batch.ROOM * vocabulary.longest and not batch.alone


def test_library_decodes_the_ids(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["plain words, here.", "two  spaces", "é ñ 日本\nnew line", "tail "]
    for text, coded in zip(texts, sp_codec.Codec(vocabulary).encode(texts), strict=True):
        assert model.decode(np.frombuffer(coded, np.uint32).tolist()) == text


def test_pieces_of_messy_rows(messy, nothing, vocabulary):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = sp_codec.encode_documents(messy, path, "doc_id", "row").collect()
    assert len(rows) == 13 and all(r.round_trip and r.n_ids == len(r.ids) for r in rows)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert {r.doc_id for r in rows if not r.n_ids} == {0, 1}
    assert sp_codec.encode_documents(nothing, path, "doc_id").count() == 0
    assert sp_codec.encode_documents(messy, path, "doc_id", ids=False).filter(F.col("round_trip")).count() == 13
