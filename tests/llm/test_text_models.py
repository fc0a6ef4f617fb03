"""Language network, personal data network, importance resampling."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import importance, lang_cnn, pii
from tablewright.llm.common import utf8
from tests.llm.words import prose

# --- language ---


@pytest.fixture(scope="module")
def language_model():
    texts = [prose(kind, i, 120) for i in range(150) for kind in "ab"]
    return lang_cnn.train(texts, ["aa" if i % 2 == 0 else "bb" for i in range(len(texts))], epochs=3)


def test_network_tells_unseen_texts_apart(language_model):
    texts = [prose(kind, 1000 + i, 60) for i in range(50) for kind in "ab"]
    some, rows, _ = lang_cnn.windows(*lang_cnn.plain_bytes(*utf8(pa.array(texts, pa.large_string()))))
    found = lang_cnn.probabilities(language_model.weights, some).argmax(axis=1)
    assert np.mean(found == np.array([0, 1] * 50)[rows]) > 0.97


def test_training_is_repeatable(language_model):
    again = lang_cnn.train([prose("a", i, 50) for i in range(20)] + [prose("b", i, 50) for i in range(20)], ["x"] * 20 + ["y"] * 20)
    once = lang_cnn.train([prose("a", i, 50) for i in range(20)] + [prose("b", i, 50) for i in range(20)], ["x"] * 20 + ["y"] * 20)
    assert all(np.array_equal(again.weights[k], once.weights[k]) for k in once.weights)


def test_gradients_of_the_network():
    weights = {k: v.astype(np.float64) for k, v in lang_cnn.start_weights(3, 5).items()}
    draw = np.random.default_rng(1)
    some = draw.integers(1, 256, (4, lang_cnn.WINDOW)).astype(np.uint8)
    labels, weigh = np.array([0, 1, 2, 1]), np.ones(4, np.float32)

    def loss(w):
        found = lang_cnn.probabilities({k: v.astype(np.float32) for k, v in w.items()}, some)
        return -np.log(found[np.arange(4), labels]).mean()

    gradients = lang_cnn._gradients({k: v.astype(np.float32) for k, v in weights.items()}, some, labels, weigh)
    for name in ("out", "bias", "filter3", "embed"):
        at = np.unravel_index(np.abs(gradients[name]).argmax(), gradients[name].shape)
        step = 1e-2
        up, down = {**weights, name: weights[name].copy()}, {**weights, name: weights[name].copy()}
        up[name][at] += step
        down[name][at] -= step
        assert math.isclose((loss(up) - loss(down)) / (2 * step), gradients[name][at], rel_tol=0.05, abs_tol=2e-3)


def test_windows_cover_every_byte():
    texts = ["", "a", "ab" * 200, "xyz" * 1000]
    data, offsets = lang_cnn.plain_bytes(*utf8(pa.array(texts, pa.large_string())))
    some, rows, filled = lang_cnn.windows(data, offsets)
    for i, text in enumerate(texts):
        mine = [bytes(w[:n]) for w, n in zip(some[rows == i], filled[rows == i], strict=True)]
        joined = mine[0] if mine else b""
        for w in mine[1:]:
            joined += w[lang_cnn.OVERLAP :]
        assert joined == text.encode()


def test_language_of_messy_rows(messy, nothing, language_model):
    rows = lang_cnn.identify(messy, language_model, "doc_id", "lang").collect()
    assert len(rows) == 13
    by_id = {r.doc_id: r for r in rows}
    for i in (0, 1, 4, 9):  # null, empty, white space, digits only
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert all(0 <= r.score <= 1 for r in rows)
    assert by_id[5].lang_pred in ("aa", "bb")
    assert lang_cnn.identify(nothing, language_model, "doc_id").count() == 0
    kept = lang_cnn.in_known_language(messy, language_model)
    assert kept.columns == messy.columns and {0, 1, 4, 9}.isdisjoint(r.doc_id for r in kept.collect())


def test_numerals_are_no_letters(spark, language_model):
    texts = ["\u00bd", "\u00b2\u00b2", "\u2167 \u2168", "\u2460", "12 34", "\u0663", "_", "\u2167 x", "\u6c49", "\u00aa"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in lang_cnn.identify(rows, language_model, "doc_id").collect()}
    assert [found[i].lang_pred == "und" for i in range(len(texts))] == [True] * 7 + [False] * 3
    assert {found[i].score for i in range(7)} == {0.0}
    kept = {r.doc_id for r in lang_cnn.in_known_language(rows, language_model, 0.0).collect()}
    assert kept == {7, 8, 9}


def test_predictions_equal_a_plain_network(spark, language_model):
    """Convolution, pooling, softmax and the mean over windows, byte by byte and without any shared code."""
    names, w = language_model

    def response(window, place, width, f):
        cells = [w["embed"][window[place + k]] if place + k < len(window) else np.zeros(lang_cnn.EMBEDDING) for k in range(width)]
        return float(np.concatenate(cells) @ w[f"filter{width}"][:, f])

    def plain(text):
        seen = re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+", b" ", text.encode())
        seen = bytes(b + 32 if 65 <= b <= 90 else b for b in seen)
        step, total, weight, at = lang_cnn.WINDOW - lang_cnn.OVERLAP, 0.0, 0, 0
        while True:
            part = seen[at : at + lang_cnn.WINDOW]
            window = list(part) + [0] * (lang_cnn.WINDOW - len(part))
            pooled = [
                max(0.0, max(response(window, p, width, f) for p in range(lang_cnn.WINDOW)) + w["bias"][i * lang_cnn.FILTERS + f])
                for i, width in enumerate(lang_cnn.WIDTHS)
                for f in range(lang_cnn.FILTERS)
            ]
            raw = np.exp(np.array(pooled) @ w["out"] + w["out_bias"])
            total, weight = total + raw / raw.sum() * len(part), weight + len(part)
            if at + lang_cnn.WINDOW >= len(seen):
                break
            at += step
        return total / weight

    texts = [prose("a", 77, 60), prose("b", 78, 9) + " 12 -- \u00fcn", "Q"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in lang_cnn.identify(rows, language_model, "doc_id").collect():
        mean = plain(texts[r.doc_id])
        assert r.lang_pred == names[int(mean.argmax())] and r.score == pytest.approx(float(mean.max()), abs=1e-4)


def test_a_table_of_very_many_languages_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(lang_cnn, "MOST_TEXTS", 60)
    monkeypatch.setattr(lang_cnn, "MOST_LANGUAGES", 20)
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 2 = 0, 'en', concat('x', id % 500)) as lang")
    texts, languages = lang_cnn.training_sample(docs)
    assert len(texts) <= 60 and len(set(languages)) <= 20 and "en" in languages


def test_no_language_to_learn(nothing, messy):
    model = lang_cnn.learn_languages(nothing)
    assert {r.lang_pred for r in lang_cnn.identify(messy, model, "doc_id").collect()} == {"und"}
    assert lang_cnn.in_known_language(messy, model).filter("doc_id = 2").count() == 2


def test_held_out_documents_are_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts, _ = lang_cnn.training_sample(docs, most_bytes=10**9)
    held = {r.text for r in docs.filter(lang_cnn.held_out(docs)).collect()}
    free = {r.text for r in docs.filter(~lang_cnn.held_out(docs)).collect()}
    assert texts and all(t in free for t in texts) and held - free and not (held - free) & set(texts)


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lang_cnn.identify(docs.filter(lang_cnn.held_out(docs)), lang_cnn.learn_languages(docs), "lang").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


UNSEEN = [
    "Η γρήγορη καφέ αλεπού πηδά πάνω από το τεμπέλικο σκυλί και φεύγει μακριά",
    "これは日本語の文章です。今日は天気がとても良いので散歩に行きました。",
    "Съешь же ещё этих мягких французских булок, да выпей чаю",
    "qwrt zxcv bnmp lkjh gfds qwrt zxcv bnmp",
    "xkcd jqzv wvbn plmk zzxq rtyp ghjk mnbv",
]


def test_texts_in_no_known_language_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    model = lang_cnn.learn_known_languages(docs)
    strange = [(-1 - i, None, t) for i, t in enumerate([*UNSEEN, "Der schnelle braune Fuchs", "2026", None])]
    mixed = docs.unionByName(spark.createDataFrame(strange, docs.schema))
    kept = {r.doc_id for r in lang_cnn.in_known_language(mixed, model).select("doc_id").collect()}
    lettered = {r.doc_id for r in docs.filter(F.col("text").rlike(r"\p{L}")).collect()}
    assert kept == lettered | {-1 - len(UNSEEN)}


def test_foreign_texts_use_no_script_of_the_corpus():
    texts = [prose("a", i, 20) + " привет" for i in range(400)]
    foreign = lang_cnn.foreign_texts(texts)
    assert len(foreign) == 200 and foreign == lang_cnn.foreign_texts(texts)
    other_script = [t for i, t in enumerate(foreign) if i % 4 > 1]
    assert not any(re.search("[а-я]", t) for t in other_script) and not set(texts) & set(foreign)
    assert lang_cnn.foreign_texts([]) == []


# --- personal data ---


def slow_spans(text):
    """The patterns as the contract words them."""
    import re

    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits[::-1])]
        if 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    draw = random.Random(3)
    parts = ["@", ".", "a.b", "x@y.z", "+1 (555) 010-9999", "4111 1111 1111 1111", "4111111111111111", "10.0.0.256"]
    parts += ["10.0.0.1", ".7", "1.2.3.4.5", "é", " ", "-", "a@b", "@c.d", "+", "12", "(", "٣", "\n", "0.0.0.000"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        assert sorted(pii.base_spans(text)) == sorted(slow_spans(text)), text


def test_long_runs_cost_little():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000):
        pii.base_spans(text)


def labelled(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        digits = [draw.randrange(10) for _ in range(15)]
        card = "".join(map(str, digits))
        card += next(str(d) for d in range(10) if pii.luhn(card + str(d)))
        spans = [f"jo{i}@mail.example.org", f"10.{i % 250}.3.{i % 99}", card, f"+1 (555) 01{i % 10}-{1000 + i}"]
        words = prose("a", seed * 1000 + i, 40).split(" ")
        for s in draw.sample(spans, 2):
            words.insert(draw.randrange(len(words)), s)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def pii_model():
    return pii.train(labelled(250, 1), epochs=10)


def test_network_finds_spans_of_unseen_texts(pii_model):
    hit = total = 0
    for text in labelled(120, 2):
        found = pii.decode(pii_model.weights, pii.stitched(pii_model.weights, [pii.codes(text)]))
        for _, a, b in pii.base_spans(text):
            total += 1
            hit += any(x < b and a < y for _, x, y in found)
    assert hit / total > 0.9


def test_network_finds_respelled_spans_of_unseen_texts(pii_model):
    """Spans in spellings that no pattern matches, in texts that did not train: what the method adds."""
    draw, hit, total = np.random.default_rng(4), {}, {}
    for text in labelled(150, 6):
        other, here = pii.respelled(text, pii.base_spans(text), draw)
        base = pii.base_spans(other)
        found = pii.decode(pii_model.weights, pii.stitched(pii_model.weights, [pii.codes(other)]))
        added = pii.added_spans(other, found, base)
        for kind, a, b in here:
            if not any(x < b and a < y for _, x, y in base):
                total[kind] = total.get(kind, 0) + 1
                hit[kind] = hit.get(kind, 0) + any(k == kind and x < b and a < y for k, x, y in added)
    assert set(total) == {0, 2, 3} and min(total.values()) >= 8
    assert sum(hit.values()) / sum(total.values()) >= 0.9


def test_gradients_of_the_crf():
    weights = pii.start_weights(1)
    some, tags = (x[:5] for x in pii.training_windows(labelled(10, 5)))
    gradients, _ = pii._gradients(weights, some, tags)
    draw = np.random.default_rng(0)
    for name in weights:
        at = tuple(draw.integers(0, d) for d in weights[name].shape)
        if name.startswith("in_"):
            at = (int(some[0, 5]), at[1])
        up, down = ({k: v.astype(np.float64) for k, v in weights.items()} for _ in range(2))
        up[name][at] += 1e-4
        down[name][at] -= 1e-4
        slope = (pii._gradients(up, some, tags)[1] - pii._gradients(down, some, tags)[1]) / 2e-4
        assert math.isclose(slope, gradients[name][at], rel_tol=1e-2, abs_tol=1e-3)


def full_viterbi(weights, scores):
    step, n = weights["step"], len(scores)
    full = np.zeros((n, pii.TAGS))
    full[:, 1:] = scores
    best, back = weights["first"] + full[0], []
    for t in range(1, n):
        ways = best[:, None] + step
        back.append(ways.argmax(0))
        best = ways.max(0) + full[t]
    tags = [int((best + weights["last"]).argmax())]
    for b in back[::-1]:
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def test_decoding_in_stretches_equals_decoding_all(pii_model):
    draw = np.random.default_rng(2)
    for n in (1, 2, 30, 300):
        for shift in (-3, 0, 1):
            scores = draw.normal(shift, 3, (pii.TAGS - 1, n)).astype(np.float32)
            tags = full_viterbi(pii_model.weights, scores.T)
            spans = [(t, i) for i, t in enumerate(tags) if t and (i == 0 or tags[i - 1] != t)]
            found = pii.decode(pii_model.weights, scores)
            assert [(k + 1, a) for k, a, _ in found] == spans
            assert all(tags[i] == k + 1 for k, a, b in found for i in range(a, b))


def test_spans_do_not_depend_on_windows(pii_model):
    text = " ".join(labelled(40, 7))
    whole = pii.stitched(pii_model.weights, [pii.codes(text)])
    found = dict.fromkeys(pii.decode(pii_model.weights, whole))
    short = 0
    for _, a, b in pii.base_spans(text):
        part = text[max(0, a - 150) : b + 150]
        at = a - max(0, a - 150)
        near = pii.decode(pii_model.weights, pii.stitched(pii_model.weights, [pii.codes(part)]))
        short += any(x <= at < y for _, x, y in near) == any(x <= a < y for _, x, y in found)
    assert short >= 0.95 * len(pii.base_spans(text))


def test_added_spans_touch_no_base_span(pii_model):
    for text in labelled(60, 9) + ["call 1 (555) 010-9999 now", "card 4111.1111.1111.1111", "jo at mail dot example.org"]:
        base, more = next(pii.find_all([text], pii_model))
        assert base == pii.base_spans(text)
        assert not any(a < y and x < b for _, a, b in more for _, x, y in base)


def test_personal_data_of_messy_rows(messy, nothing, pii_model):
    rows = pii.detect(messy, pii_model, "doc_id").collect()
    assert len(rows) == 13 and all(r.base == "" for r in rows)
    assert pii.detect(nothing, pii_model, "doc_id").count() == 0
    assert pii.learn(nothing) is None
    assert pii.detect(messy, None, "doc_id").count() == 13
    out = pii.mask(messy, pii_model)
    assert out.columns == messy.columns
    assert {(r.doc_id, r.text) for r in out.collect()} >= {(0, None), (1, ""), (7, "no")}


def test_rare_spans_of_all_documents_train_the_network(spark):
    ids = spark.range(10_000).withColumnRenamed("id", "doc_id")
    last = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id").desc()).limit(300).collect()]
    card, mail = "pay 4111 1111 1111 1111 now", F.concat(F.lit("to jo"), F.col("doc_id"), F.lit("@mail.example.org"))
    plain = ids.withColumn("text", F.lit("plain words"))
    rare = plain.withColumn("text", F.when(F.col("doc_id").isin(last[:3]), card).otherwise(F.col("text")))
    assert pii.training_texts(rare).count(card) == 3
    assert pii.learn(rare) is not None
    # Of each kind as many as the bound says, however common another kind is.
    both = rare.withColumn("text", F.when(F.col("text") == "plain words", mail).otherwise(F.col("text")))
    some = pii.training_texts(both.union(both), with_spans=40)
    assert len(some) == len(set(some)) + 2 == 43 and some.count(card) == 3
    assert set(some[:40]) == {f"to jo{r.doc_id}@mail.example.org" for r in ids.orderBy(F.xxhash64("doc_id")).limit(40).collect()}


def test_masking():
    text = "a@b.c and +1 (555) 010-9999 x"
    assert pii.masked(text, pii.base_spans(text)) == "<email> and <phone> x"
    assert pii.masked("abcdef", [(0, 1, 4), (1, 2, 5)]) == "a<email>f"


# --- importance ---


def test_counts_and_weights_equal_a_plain_version(spark):
    texts = {1: "a b a", 2: "B c", 3: "", 4: None, 5: "a b"}
    docs = spark.createDataFrame([(i, t, i) for i, t in texts.items()], "doc_id long, text string, log_weight long")
    target = spark.createDataFrame([(1,), (5,), (5,), (99,), (None,)], "doc_id long")
    raw, aim = importance.gram_counts(docs, target, 64)
    assert raw.sum() == (3 + 2) + (2 + 1) + (2 + 1) and aim.sum() == 5 + 3
    ratio = importance.log_ratio(raw, aim)
    out = {r.doc_id: r.log_weight for r in importance.weigh(docs.select("doc_id", "text"), ratio, "doc_id").collect()}
    for i, t in texts.items():
        found, _ = importance.grams(pa.array([(t or "")]), 64)
        assert out[i] == pytest.approx(sum(ratio[g] for g in found))
    assert out[1] > out[2] and out[3] == out[4] == 0


def test_kth_largest(spark):
    draw = random.Random(5)
    for span in (3, 10**6, 2**62):
        values = [draw.randint(-span, span) for _ in range(500)]
        df = spark.createDataFrame([(v,) for v in values], "v long").coalesce(2)
        for k in (1, 77, 500):
            at, left = importance.kth_largest(df, "v", k)
            want = sorted(values, reverse=True)[k - 1]
            assert at == want and left == k - sum(v > want for v in values)


def test_exactly_the_share_is_selected(spark, messy, nothing):
    good = spark.createDataFrame([(2,), (5,)], "doc_id long")
    for share, k in ((0.0, 0), (0.3, 3), (0.5, 6), (1.0, 13)):
        rows = importance.resample(messy, good, share).collect()
        assert len(rows) == 13 and sum(r.selected for r in rows) == k
        if 0 < k < 13:
            assert min(r.key for r in rows if r.selected) >= max(r.key for r in rows if not r.selected)
    assert importance.resample(nothing, good, 0.5).count() == 0
    same = spark.createDataFrame([(1, "x y")] * 10, "doc_id long, text string")
    assert importance.resample(same, good, 0.3).filter("selected").count() == 3


def test_sampling_follows_the_weights(spark):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "bad stuff there") for i in range(400)], "doc_id long, text string")
    rows = importance.resample(docs, docs.filter("doc_id % 2 = 1"), 0.25).collect()
    assert sum(r.selected and r.doc_id % 2 == 1 for r in rows) >= 90


def test_weights_are_written_to_few_files(spark):
    docs = spark.range(960).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text"))
    rows = importance.resample(docs.repartition(24, "doc_id"), docs.filter("doc_id % 2 = 1"), 0.25)
    assert len(rows.inputFiles()) == 1
    assert rows.count() == 960 and rows.filter("selected").count() == 240
