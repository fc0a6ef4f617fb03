"""Language identification by a byte convolutional network, trained and applied in numpy.

Bytes are embedded, filters of several widths slide over a window of fixed length, their largest responses
in the window go through a softmax. A text is the sequence of its windows; its language is the one of the
highest mean probability, windows weighted by their bytes.

A-Z are lower-cased, runs of other ASCII characters become one space, all other bytes stay.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.adam import Adam
from tablewright.llm.common import map_arrow, packed, sub_batches, text_or_empty, utf8, with_more
from tablewright.session import materialize

WINDOW = 256
OVERLAP = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8

#: Training sample: texts per language and bytes of each, chosen by a hash of doc_id; and bounds for tables that
#: label their texts with very many names: the most common languages, and texts in all.
TEXTS_PER_LANGUAGE = 800
BYTES_PER_TEXT = 2048
MOST_LANGUAGES = 1000
MOST_TEXTS = 20_000

UNKNOWN = "und"

#: The class of texts in no known language, how likely it must be to reject a text, and of what length.
OTHER = "(other)"
MOST_OTHER = 0.9
LEAST_CHARS = 24

ALPHABET = "abcdefghijklmnopqrstuvwxyz"

#: First letter of scripts and how many letters follow one another there: small Greek, Cyrillic, Armenian, Hebrew,
#: Arabic, Devanagari, Bengali, Thai, Georgian, Hiragana, Katakana, Hangul, Chinese signs.
SCRIPTS = [
    (0x3B1, 25), (0x430, 32), (0x561, 38), (0x5D0, 27), (0x627, 20), (0x905, 53), (0x995, 36), (0xE01, 46), (0x10D0, 33),
    (0x3041, 86), (0x30A1, 90), (0xAC00, 11172), (0x4E00, 20000),
]

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = 32
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)

#: A letter is a character of Unicode category L; numerals such as \u00bd or \u2167 are none.
_LETTER = regex.compile(r"\p{L}")


class Model(NamedTuple):
    languages: list[str]
    weights: dict[str, np.ndarray]


def plain_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as the network sees them, and the offsets of the texts among them."""
    data = _PLAIN[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, WINDOW) bytes, padded with zeros; the text of each; and its number of bytes.

    Neighbours share OVERLAP bytes, so every filter sees every place. An empty text has no window.
    """
    step = WINDOW - OVERLAP
    sizes = np.diff(offsets)
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // step)), 0)
    rows = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[rows] + nth * step
    filled = np.minimum(offsets[rows + 1] - starts, WINDOW)
    padded = np.zeros(len(data) + WINDOW, np.uint8)
    padded[: len(data)] = data
    out = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts].copy()
    out[np.arange(WINDOW) >= filled[:, None]] = 0
    return out, rows, filled


def start_weights(classes: int, seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    weights = {"embed": draw.normal(0, 0.5, (256, EMBEDDING)), "bias": np.zeros(total)}
    for width in WIDTHS:
        weights[f"filter{width}"] = draw.normal(0, (width * EMBEDDING) ** -0.5, (width * EMBEDDING, FILTERS))
    weights |= {"out": draw.normal(0, total**-0.5, (total, classes)), "out_bias": np.zeros(classes)}
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    weights["embed"][0] = 0
    return weights


def _all_filters(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All widths in one matrix; a narrow filter has zeros behind it."""
    out = np.zeros((max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)), np.float32)
    for i, width in enumerate(WIDTHS):
        out[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = weights[f"filter{width}"]
    return out


def _responses(weights: dict[str, np.ndarray], some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedded stretches (windows, places, widest * EMBEDDING) and filter responses at each place."""
    n, widest = len(some), max(WIDTHS)
    embedded = np.zeros((n, WINDOW + widest - 1, EMBEDDING), np.float32)
    embedded[:, :WINDOW] = weights["embed"][some]
    flat = embedded.reshape(n, -1)
    stretches = np.lib.stride_tricks.as_strided(
        flat, (n, WINDOW, widest * EMBEDDING), (flat.strides[0], EMBEDDING * 4, 4), writeable=False
    )
    stretches = np.ascontiguousarray(stretches)
    return stretches, (stretches.reshape(n * WINDOW, -1) @ _all_filters(weights)).reshape(n, WINDOW, -1)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def probabilities(weights: dict[str, np.ndarray], some: np.ndarray) -> np.ndarray:
    """(windows, classes) for bytes (windows, WINDOW)."""
    out = []
    for a in range(0, len(some), 128):
        _, found = _responses(weights, some[a : a + 128])
        pooled = np.maximum(found.max(axis=1) + weights["bias"], 0)
        out.append(_softmax(pooled @ weights["out"] + weights["out_bias"]))
    return np.concatenate(out) if out else np.empty((0, len(weights["out_bias"])), np.float32)


def train(texts: list[str], languages: list[str], epochs: int = 3, seed: int = 7, rate: float = 4e-3) -> Model:
    """Fit the network to labelled texts; the same input gives the same model."""
    names = sorted(set(languages))
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    some, rows, filled = windows(*plain_bytes(data, offsets))
    labels = np.array([names.index(x) for x in languages], np.int64)[rows] if texts else np.empty(0, np.int64)
    full = filled >= 16
    some, labels = some[full], labels[full]
    weights = start_weights(max(len(names), 1), seed)
    if len(names) < 2 or not len(some):
        return Model(names, weights)
    # Languages weigh the same however many windows they have.
    share = np.bincount(labels, minlength=len(names))
    weigh = (len(labels) / (len(names) * np.maximum(share, 1)))[labels].astype(np.float32)
    adam, draw = Adam(weights, rate), np.random.default_rng(seed)
    for _ in range(epochs):
        order = draw.permutation(len(some))
        for a in range(0, len(order), 64):
            pick = order[a : a + 64]
            adam.step(_gradients(weights, some[pick], labels[pick], weigh[pick]))
            weights["embed"][0] = 0
    return Model(names, weights)


def _gradients(weights, some, labels, weigh) -> dict[str, np.ndarray]:
    n, total = len(some), FILTERS * len(WIDTHS)
    stretches, found = _responses(weights, some)
    best = found.argmax(axis=1)
    top = np.take_along_axis(found, best[:, None], axis=1)[:, 0] + weights["bias"]
    pooled = np.maximum(top, 0)
    error = _softmax(pooled @ weights["out"] + weights["out_bias"])
    error[np.arange(n), labels] -= 1
    error *= (weigh / n)[:, None]
    back = (error @ weights["out"].T) * (top > 0)
    gradients = {"out": pooled.T @ error, "out_bias": error.sum(0), "bias": back.sum(0)}
    # Only the place of the largest response passes a gradient.
    seen = stretches[np.arange(n)[:, None], best]
    gradients["embed"] = np.zeros_like(weights["embed"])
    padded = np.zeros((n, WINDOW + max(WIDTHS)), np.int64)
    padded[:, :WINDOW] = some
    for i, width in enumerate(WIDTHS):
        part = slice(i * FILTERS, (i + 1) * FILTERS)
        own = seen[:, part, : width * EMBEDDING]
        gradients[f"filter{width}"] = np.einsum("nfe,nf->ef", own, back[:, part])
        spread = back[:, part, None] * weights[f"filter{width}"].T[None]
        spread = spread.reshape(n, FILTERS, width, EMBEDDING)
        where = padded[np.arange(n)[:, None, None], best[:, part, None] + np.arange(width)]
        np.add.at(gradients["embed"], where, spread)
    return gradients


def held_out(docs: DataFrame):
    """True for the quarter of documents that no model learns from: crc32(doc_id) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(
    docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, most_bytes: int = BYTES_PER_TEXT
) -> tuple[list[str], list[str]]:
    """Texts and languages of at most ``per_language`` labelled documents of each language.

    They are those with the smallest hashes of doc_id among the documents that are not held out; a random
    stretch of ``most_bytes`` characters of each is taken. No more than ``MOST_TEXTS`` texts of the
    ``MOST_LANGUAGES`` most common languages reach the driver.
    """
    known = docs.filter(~held_out(docs) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    common = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    common = materialize(common.withColumnRenamed("lang", "of"), "languages")
    per_language = min(per_language, max(1, MOST_TEXTS // max(common.count(), 1)))
    # Of a language with many documents only those below a hash that twice as many pass leave their tasks.
    bound = F.least(F.lit(2.0 * per_language) / F.col("n"), F.lit(1.0)) * F.lit(float(2**63)) * 2 - F.lit(float(2**63))
    ranked = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    ranked = ranked.join(F.broadcast(common), F.col("lang") == F.col("of")).filter(F.col("h").cast("double") <= bound)
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    ranked = ranked.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)
    ids = [r.doc_id for r in ranked.select("doc_id").distinct().collect()]
    room = F.greatest(F.length("text") - most_bytes, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("doc_id", "lang"), room) + 1).cast("int")
    part = F.substring(F.col("text"), start, F.lit(most_bytes))
    rows = known.filter(F.col("doc_id").isin(ids)).select("doc_id", "lang", part.alias("text")).orderBy("doc_id", "lang", "text").collect()
    return [r.text for r in rows], [r.lang for r in rows]


def identify(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with ``lang_pred`` and ``score``.

    ``score`` is the mean probability of the language over all windows of the whole text. A text that is
    null or has no letter is ``und`` with score 0, as is every text if the model knows no language.
    """
    schema = with_more(docs, keep, "lang_pred string, score double")
    names, weights = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in sub_batches(batch, len(keep), 1_000_000):
                texts = some.column(len(keep))
                data, offsets = utf8(texts)
                lettered = np.array([bool(_LETTER.search(t)) for t in texts.to_pylist()], bool)
                cut, rows, filled = windows(*plain_bytes(data, offsets))
                total = np.zeros((some.num_rows, max(len(names), 1)))
                found = probabilities(weights, cut) * filled[:, None]
                np.add.at(total, rows, found)
                size = np.bincount(rows, filled, some.num_rows)
                mean = total / np.maximum(size, 1)[:, None]
                known = lettered & (size > 0) & bool(names)
                best = mean.argmax(axis=1)
                languages = [names[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), known.tolist(), strict=True)]
                score = np.where(known, np.clip(mean.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(i) for i in range(len(keep))), pa.array(languages, pa.string()), pa.array(score, pa.float64())],
                    names=[*keep, "lang_pred", "score"],
                )

    return map_arrow(docs.select(*keep, text_or_empty().alias("_text")), run, schema)


def foreign_texts(texts: list[str], seed: int = 13) -> list[str]:
    """Texts in no language of ``texts``, as long as theirs, one for every two of them.

    In turns: every word of random letters; the letters of the alphabet exchanged for one another; letters of a
    script that no text uses, letter by letter or, for scripts of syllables and signs, without spaces.
    """
    draw = random.Random(seed)
    used = {ord(c) for t in texts for c in set(t)}
    scripts = [(first, n) for first, n in SCRIPTS if not used & set(range(first, first + n))]
    out = []
    for i, text in enumerate(texts[::2]):
        way = i % 4
        if way == 0:
            out.append(re.sub("[^\\W\\d_]", lambda _: draw.choice(ALPHABET), text))
            continue
        if way == 1:
            shuffled = draw.sample(ALPHABET, len(ALPHABET))
            out.append(text.lower().translate({ord(a): b for a, b in zip(ALPHABET, shuffled, strict=True)}))
            continue
        if not scripts:
            continue
        first, n = draw.choice(scripts)
        if n <= 64:
            to = {c: chr(first + draw.randrange(n)) for c in set(text) if c.isalpha()}
            out.append("".join(to.get(c, c) for c in text))
        else:
            out.append("".join(chr(first + draw.randrange(n)) for c in text[::3] if c.isalpha()))
    return out


def learn_known_languages(docs: DataFrame) -> Model:
    """A model of the languages in ``lang`` and of ``OTHER``, what ``foreign_texts`` makes of the same sample."""
    texts, languages = training_sample(docs)
    if not texts:
        return train(texts, languages)
    foreign = foreign_texts(texts)
    return train([*texts, *foreign], [*languages, *[OTHER] * len(foreign)])


def in_known_language(docs: DataFrame, model: Model, most_other: float = MOST_OTHER) -> DataFrame:
    """The rows of ``docs`` whose text has a letter and is in a language of ``model``, unchanged.

    A text is in none if the mean probability of ``OTHER`` over its windows is above ``most_other``; texts of
    fewer than ``LEAST_CHARS`` characters tell too little for that and stay. Without any language to know,
    every text with a letter stays.
    """
    if OTHER not in model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = identify(packed(docs), model, "row")
    foreign = (F.col("lang_pred") == OTHER) & (F.col("score") > most_other) & (F.char_length("row.text") >= LEAST_CHARS)
    return found.filter((F.col("lang_pred") != UNKNOWN) & ~foreign).select("row.*")


def learn_languages(docs: DataFrame) -> Model:
    """A model of the languages in ``lang``, from the bounded sample of ``training_sample``."""
    return train(*training_sample(docs))
