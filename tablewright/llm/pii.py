"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds what they miss.

The patterns find e-mail addresses, IP addresses, card and phone numbers in their usual form. Their matches,
as they stand and in other spellings, are the labelled spans from which the network learns in numpy. It is then
applied to overlapping windows of the whole text. In the stretch that two windows share, every character takes
its scores from the window in which it lies deeper, and the best sequence of tags under the CRF is decoded
over the stitched scores of the text, so a span never depends on where windows end.

Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.adam import Adam
from tablewright.llm.common import map_arrow, packed, slices, text_or_empty, with_more
from tablewright.session import materialize

# The kinds in the order of the report, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAIL_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _valid(kind: int, text: str) -> bool:
    digits = "".join(_DIGIT.findall(text))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 8 <= len(digits) <= 15
    return True


def _mails(text: str) -> Iterator[Span]:
    """Leftmost matches of the pattern, found from their ``@`` so that long words cost no more than short ones."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _MAIL_HEAD:
            start -= 1
        found = _MAIL.match(text, start) if start < at else None
        if found:
            yield 0, start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, by kind and start; matches that fail their kind's check are dropped."""
    out = list(_mails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if _valid(kind, m.group())]
    return out


def span_text(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# --- the network ---

WINDOW = 512
OVERLAP = 64
HIDDEN = 8
TAGS = 1 + len(KINDS)  # 0 is outside

#: Training sample: texts with labelled spans of each kind, texts without any, and the characters of a training window.
TEXTS_WITH = 500
TEXTS_WITHOUT = 300
TRAIN_WINDOW = 96

#: Characters as the network sees them: ASCII with one digit and one letter case, then other letters, others, padding.
_OTHER_LETTER, _OTHER, _PAD, CODES = 128, 129, 130, 131
_CODE = np.arange(128, dtype=np.uint8)
_CODE[48:58] = 48
_CODE[65:91] += 32

Weights = dict[str, np.ndarray]


class Model(NamedTuple):
    weights: Weights


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(points >= 0xAA, _OTHER_LETTER, _OTHER).astype(np.uint8)
    # Above Latin letters: general punctuation and symbols.
    out[(points >= 0x2000) & (points < 0x2C00)] = _OTHER
    plain = points < 128
    out[plain] = _CODE[points[plain]]
    return out


def start_weights(seed: int) -> Weights:
    draw = np.random.default_rng(seed)
    weights: Weights = {"out_bias": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS), "last": np.zeros(TAGS)}
    for side in ("f", "b"):
        weights[f"in_{side}"] = draw.normal(0, 0.5, (CODES, 4 * HIDDEN))
        weights[f"in_{side}"][:, HIDDEN : 2 * HIDDEN] += 1  # forget gates start open
        weights[f"rec_{side}"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        weights[f"out_{side}"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, TAGS))
    return {k: v.astype(np.float32) for k, v in weights.items()}


# Gate order: input, forget, output, candidate. Cells are squashed by x / (1 + |x|), which takes a quarter of the time
# of a tanh; a gate is the same, shifted to lie between 0 and 1. Slopes follow from the squashed values.


def _slope(squashed: np.ndarray) -> np.ndarray:
    return (1 - np.abs(squashed)) ** 2


def _gate_slope(gate: np.ndarray) -> np.ndarray:
    return 0.5 * _slope(2 * gate - 1)


def _run_side(weights: Weights, side: str, some: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Tag scores (time, tags, windows) of one direction for codes (windows, time).

    Windows are the last axis, so every gate is one contiguous block.
    """
    into = np.ascontiguousarray(weights[f"in_{side}"].T)
    recurrent = np.ascontiguousarray(weights[f"rec_{side}"].T)
    out = np.ascontiguousarray(weights[f"out_{side}"].T)
    n, time = some.shape
    kind = into.dtype
    h, c = np.zeros((HIDDEN, n), kind), np.zeros((HIDDEN, n), kind)
    scores = np.empty((time, TAGS, n), kind)
    columns = np.ascontiguousarray(some.T).astype(np.intp)
    gates, given, cell, fresh = (np.empty((k * HIDDEN, n), kind) for k in (4, 4, 1, 1))
    for t in range(time) if side == "f" else range(time - 1, -1, -1):
        np.dot(recurrent, h, out=gates)
        np.take(into, columns[t], axis=1, out=given, mode="clip")
        gates += given
        np.abs(gates, out=given)
        given += 1
        gates /= given
        gates[: 3 * HIDDEN] *= 0.5
        gates[: 3 * HIDDEN] += 0.5
        before, last = (c.copy(), h.copy()) if keep is not None else (c, h)
        c *= gates[HIDDEN : 2 * HIDDEN]
        np.multiply(gates[:HIDDEN], gates[3 * HIDDEN :], out=fresh)
        c += fresh
        np.abs(c, out=fresh)
        fresh += 1
        np.divide(c, fresh, out=cell)
        np.multiply(gates[2 * HIDDEN : 3 * HIDDEN], cell, out=h)
        np.dot(out, h, out=scores[t])
        if keep is not None:
            keep.append((t, gates.copy(), before, cell.copy(), last, h.copy()))
    return scores


def emissions(weights: Weights, some: np.ndarray) -> np.ndarray:
    """Tag scores (time, tags, windows) of both directions."""
    scores = _run_side(weights, "f", some)
    scores += _run_side(weights, "b", some)
    scores += weights["out_bias"][:, None]
    return scores


def _back_side(weights: Weights, side: str, some: np.ndarray, keep: list, error: np.ndarray, out: Weights) -> None:
    """Gradients of one direction from those of the tag scores (time, windows, tags)."""
    into, recurrent = np.zeros_like(weights[f"in_{side}"]), np.zeros_like(weights[f"rec_{side}"])
    head = np.zeros_like(weights[f"out_{side}"])
    n = len(some)
    dh, dc = np.zeros((HIDDEN, n), np.float32), np.zeros((HIDDEN, n), np.float32)
    for t, gates, before, cell, last, h in reversed(keep):
        i, f, o, g = gates.reshape(4, HIDDEN, n)
        head += h @ error[t]
        dh = dh + weights[f"out_{side}"] @ error[t].T
        dc = dc + dh * o * _slope(cell)
        d = np.concatenate([dc * g * _gate_slope(i), dc * before * _gate_slope(f), dh * cell * _gate_slope(o), dc * i * _slope(g)])
        np.add.at(into, some[:, t], d.T)
        recurrent += last @ d.T
        dh, dc = weights[f"rec_{side}"] @ d, dc * f
    out |= {f"in_{side}": into, f"rec_{side}": recurrent, f"out_{side}": head}


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradients(weights: Weights, some: np.ndarray, tags: np.ndarray) -> tuple[Weights, float]:
    """Gradients and value of the mean negative log likelihood of ``tags`` (windows, time) under the CRF."""
    n, time = some.shape
    keep_f: list = []
    keep_b: list = []
    scores = _run_side(weights, "f", some, keep_f) + _run_side(weights, "b", some, keep_b)
    scores = scores.transpose(0, 2, 1) + weights["out_bias"]
    step, first, last = weights["step"], weights["first"], weights["last"]
    ahead, behind = np.empty_like(scores), np.empty_like(scores)
    ahead[0], behind[-1] = scores[0] + first, last
    for t in range(1, time):
        ahead[t] = _logsum(ahead[t - 1][:, :, None] + step, 1) + scores[t]
        back = time - 1 - t
        behind[back] = _logsum(step[None] + (scores[back + 1] + behind[back + 1])[:, None, :], 2)
    total = _logsum(ahead[-1] + last, 1)
    error = np.exp(ahead + behind - total[:, None])
    pairs = np.exp(ahead[:-1][:, :, :, None] + step + (scores[1:] + behind[1:])[:, :, None, :] - total[:, None, None]).sum(axis=(0, 1))
    rows, path = np.arange(n), tags.T
    value = scores[np.arange(time)[:, None], rows, path].sum() + first[path[0]].sum() + last[path[-1]].sum() + step[path[:-1], path[1:]].sum()
    loss = float((total.sum() - value) / n)
    out: Weights = {"first": error[0].sum(0), "last": error[-1].sum(0)}
    error[np.arange(time)[:, None], rows, path] -= 1
    np.subtract.at(pairs, (path[:-1], path[1:]), 1)
    np.subtract.at(out["first"], path[0], 1)
    np.subtract.at(out["last"], path[-1], 1)
    error = (error / n).astype(np.float32)
    out = {k: v / n for k, v in out.items()} | {"step": pairs / n, "out_bias": error.sum(axis=(0, 1))}
    _back_side(weights, "f", some, keep_f, error, out)
    _back_side(weights, "b", some, keep_b, error, out)
    return out, loss


def respelled(text: str, spans: list[Span], draw: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with some labelled spans in another spelling, and the spans where they are then."""
    out, parts, done = [], [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < done:
            continue
        old = text[a:b]
        new = old
        choice = draw.integers(0, 4)
        if kind == 0 and choice == 0:
            new = old.replace("@", [" at ", " (at) ", " [at] "][draw.integers(0, 3)])
            new = new if draw.integers(0, 2) else new.replace(".", " dot ")
        elif kind == 2 and choice < 2:
            digits = "".join(_DIGIT.findall(old))
            new = [".", " ", "-", "/"][draw.integers(0, 4)].join(digits[i : i + 4] for i in range(0, len(digits), 4))
        elif kind == 3 and choice < 2:
            new = old.replace("(", "").replace(")", "") if choice else old.lstrip("+")
            new = new.replace(" ", [".", "-", " "][draw.integers(0, 3)])
        parts += [text[done:a], new]
        start = sum(map(len, parts)) - len(new)
        out.append((kind, start, start + len(new)))
        done = b
    parts.append(text[done:])
    return "".join(parts), out


def training_windows(texts: Sequence[str], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags (windows, TRAIN_WINDOW): around labelled spans, around other digits, and anywhere."""
    draw = np.random.default_rng(seed)
    some, tags = [], []
    for original in texts:
        spans = base_spans(original)
        for turn in range(2 if spans else 1):
            text, here = respelled(original, spans, draw) if turn else (original, sorted(spans, key=lambda s: s[1]))
            marks = np.zeros(len(text), np.int64)
            for kind, a, b in here:
                marks[a:b] = kind + 1
            seen = np.full(len(text) + 2 * TRAIN_WINDOW, _PAD, np.uint8)
            seen[TRAIN_WINDOW : TRAIN_WINDOW + len(text)] = codes(text)
            padded = np.zeros(len(seen), np.int64)
            padded[TRAIN_WINDOW : TRAIN_WINDOW + len(text)] = marks
            centres = [(a + b) // 2 for _, a, b in here[:6]]
            others = [m.start() for m in re.finditer("[0-9@+]", text) if not marks[m.start()]]
            if others:
                centres += draw.choice(others, min(3, len(others)), replace=False).tolist()
            if text:
                centres += draw.integers(0, len(text), 2).tolist()
            for centre in centres:
                start = TRAIN_WINDOW + centre - int(draw.integers(10, TRAIN_WINDOW - 10))
                some.append(seen[start : start + TRAIN_WINDOW])
                tags.append(padded[start : start + TRAIN_WINDOW])
    if not some:
        return np.empty((0, TRAIN_WINDOW), np.uint8), np.empty((0, TRAIN_WINDOW), np.int64)
    return np.stack(some), np.stack(tags)


def train(texts: Sequence[str], epochs: int = 12, seed: int = 11, rate: float = 2e-2) -> Model | None:
    """Fit the network to the labelled spans of ``texts``; None if they have none."""
    some, tags = training_windows(texts, seed)
    if not tags.any():
        return None
    weights = start_weights(seed)
    adam, draw = Adam(weights, rate), np.random.default_rng(seed)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        order = draw.permutation(len(some))
        for a in range(0, len(order), 64):
            adam.step(_gradients(weights, some[order[a : a + 64]], tags[order[a : a + 64]])[0])
    return Model(weights)


# --- decoding ---


def stitched(weights: Weights, texts: Sequence[np.ndarray], at_once: int = 1024) -> np.ndarray:
    """Scores of every tag over those of tag 0, (TAGS - 1, characters of all texts)."""
    step, half = WINDOW - OVERLAP, OVERLAP // 2
    places: list[tuple[int, int, int, int]] = []  # first and end of the characters it decides, of its codes
    base = 0
    for x in texts:
        n = len(x)
        starts = range(0, max(n - OVERLAP, 1), step) if n else ()
        for s in starts:
            end = min(s + WINDOW, n)
            places.append((base + (s + half if s else 0), base + (end if end == n else end - half), base + s, base + end))
        base += n
    whole = np.concatenate([*texts, np.full(WINDOW, _PAD, np.uint8)])
    out = np.empty((TAGS - 1, base), np.float32)
    # Windows of like length go together, so short texts are not padded much.
    order = sorted(range(len(places)), key=lambda i: places[i][3] - places[i][2])
    for a in range(0, len(order), at_once):
        mine = [places[i] for i in order[a : a + at_once]]
        longest = mine[-1][3] - mine[-1][2]
        some = np.lib.stride_tricks.sliding_window_view(whole, longest)[[p[2] for p in mine]].copy()
        sizes = np.array([p[3] - p[2] for p in mine])
        some[np.arange(longest) >= sizes[:, None]] = _PAD
        scores = emissions(weights, some)
        scores = np.ascontiguousarray((scores[:, 1:] - scores[:, :1]).transpose(1, 2, 0))
        for k, (first, end, start, _) in enumerate(mine):
            out[:, first:end] = scores[:, k, first - start : end - start]
    return out


def decode(weights: Weights, scores: np.ndarray) -> list[Span]:
    """Spans of the best tag sequence of one text, given its scores over tag 0, (TAGS - 1, characters).

    A run of other tags is worth its scores, a transition inside for each character but one, and one in and
    one out. Characters in no interval that could be worth more than nothing, at the largest transitions,
    have tag 0 on the best path. So the text falls into stretches that are decoded one by one.
    """
    step = weights["step"] - weights["step"][0, 0]
    first, last = weights["first"] - weights["first"][0], weights["last"] - weights["last"][0]
    inside = float(step[1:, 1:].max())
    in_and_out = max(float(step[0, 1:].max()), float(first[1:].max())) + max(float(step[1:, 0].max()), float(last[1:].max()))
    n = scores.shape[1]
    if not n:
        return []
    sums = np.zeros(n + 1)
    np.cumsum(scores.max(axis=0) + np.float32(inside), dtype=np.float64, out=sums[1:])
    best = np.maximum.accumulate(sums[:0:-1])[::-1] - np.minimum.accumulate(sums[:-1])
    open_ = np.flatnonzero(best + in_and_out - inside > -0.01)
    out: list[Span] = []
    if not len(open_):
        return out
    breaks = np.flatnonzero(np.diff(open_) > 1)
    for a, b in zip(open_[np.concatenate(([0], breaks + 1))].tolist(), open_[np.concatenate((breaks, [len(open_) - 1]))].tolist(), strict=True):
        out += _decode_stretch(weights, step, scores[:, a : b + 1].T, a, a == 0, b == n - 1)
    return out


def _decode_stretch(weights: Weights, step: np.ndarray, scores: np.ndarray, at: int, starts: bool, ends: bool) -> list[Span]:
    """Viterbi between two characters of tag 0, or the ends of the text."""
    n = len(scores)
    full = np.zeros((n, TAGS), np.float32)
    full[:, 1:] = scores
    best = full[0] + ((weights["first"] - weights["first"][0]) if starts else step[0])
    back = np.zeros((n, TAGS), np.int64)
    for t in range(1, n):
        ways = best[:, None] + step
        back[t] = ways.argmax(axis=0)
        best = ways.max(axis=0) + full[t]
    tag = int((best + ((weights["last"] - weights["last"][0]) if ends else step[:, 0])).argmax())
    out: list[Span] = []
    end = n
    for t in range(n - 1, -1, -1):
        before = int(back[t][tag]) if t else 0
        if before != tag:
            if tag:
                out.append((tag - 1, at + t, at + end))
            end = t
        tag = before
    return out[::-1]


_EDGE = " \t\r\n.,;:!?()[]{}<>\"'|-"


def added_spans(text: str, found: Sequence[Span], base: Sequence[Span]) -> list[Span]:
    """Spans of the network that touch no base span and hold what their kind must: see ``_valid``.

    Edges are trimmed of white space and punctuation (a phone's plus and opening bracket stay). An e-mail
    address needs letters on both sides of an at sign, written as such or as a word.
    """
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for kind, a, b in found:
        while a < b and text[a] in _EDGE and not (kind == 3 and text[a] == "("):
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        part = text[a:b]
        if kind == 0 and not re.search(r"[^\W_](@|\W*\bat\b\W*)[^\W_]+(\.|\W*\bdot\b\W*)[^\W\d_]", part):
            continue
        if kind and (len(_DIGIT.findall(part)) < 4 or not _valid(kind, part)):
            continue
        if a < b and not any(x < b and a < y for x, y in taken):
            out.append((kind, a, b))
            taken.append((a, b))
    return sorted(out)


SCHEMA = "base string, spans string"


def training_texts(docs: DataFrame, with_spans: int = TEXTS_WITH, without: int = TEXTS_WITHOUT, most_chars: int = 4000) -> list[str]:
    """A bounded sample of all documents: of each kind at most ``with_spans`` texts that hold a labelled span
    of it, and at most ``without`` texts that hold none, in each case those with the smallest hashes of doc_id.

    Of each text ``most_chars`` around its first span of the kind are taken. A task keeps no more than these bounds.
    """
    bounds = [with_spans] * len(KINDS) + [without]  # by kind, and last of the texts without spans
    known = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int, str]]] = [[] for _ in bounds]
        last: list[tuple] = [(float("inf"),)] * len(bounds)
        for batch in batches:
            for h, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (h, doc_id) > max(last):
                    continue
                spans = base_spans(text)
                for kind in {s[0] for s in spans} or {len(KINDS)}:
                    if (h, doc_id) > last[kind]:
                        continue
                    start = max(0, min((s[1] for s in spans if s[0] == kind), default=0) - most_chars // 2)
                    best[kind].append((h, doc_id, text[start : start + most_chars]))
                    if len(best[kind]) >= 2 * max(bounds[kind], 1):
                        best[kind] = sorted(set(best[kind]))[: bounds[kind]]
                        if len(best[kind]) == bounds[kind] > 0:
                            last[kind] = best[kind][-1][:2]
        for kind, some in enumerate(best):
            some = sorted(set(some))[: bounds[kind]]
            columns = [pa.array([kind] * len(some), pa.int32()), *(pa.array([r[i] for r in some], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "h", "doc_id", "part"])

    rows = known.select(F.xxhash64("doc_id").alias("h"), F.col("doc_id").cast("long"), "text")
    rows = materialize(map_arrow(rows, pick, "kind int, h long, doc_id long, part string"), "pii-sample")
    # A text that was taken for several kinds trains once.
    taken: dict[tuple[int, str], None] = {}
    for kind, most in enumerate(bounds):
        some = rows.filter(F.col("kind") == kind).select("h", "doc_id", "part").distinct().orderBy("h", "doc_id", "part").limit(most)
        taken |= dict.fromkeys((r.doc_id, r.part) for r in some.collect())
    return [part for _, part in taken]


def learn(docs: DataFrame) -> Model | None:
    """A network from the labelled spans of the bounded sample of ``training_texts``; None if no document has one."""
    return train(training_texts(docs))


def find_all(texts: list[str], model: Model | None) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    for a, b in slices([len(t) for t in texts], 1_000_000):
        some = texts[a:b]
        base = [base_spans(t) for t in some]
        if model is None:
            yield from ((x, []) for x in base)
            continue
        cut = [codes(t) for t in some]
        scores = stitched(model.weights, cut)
        at = 0
        for text, mine in zip(some, base, strict=True):
            found = decode(model.weights, scores[:, at : at + len(text)])
            at += len(text)
            yield mine, added_spans(text, found, mine) if found else []


def detect(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The columns ``keep`` of every row, ``base`` and ``spans``: matches of the patterns, and all spans.

    Both are strings of kind:start:end, ordered by kind and start. A null text is empty and has none;
    repeated rows get the same spans; other columns are ignored. Without a model, spans are the base ones.
    """
    schema = with_more(docs, keep, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            found = list(find_all(texts, model))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(keep))),
                    pa.array([span_text(b) for b, _ in found], pa.string()),
                    pa.array([span_text([*b, *more]) for b, more in found], pa.string()),
                ],
                names=[*keep, "base", "spans"],
            )

    return map_arrow(docs.select(*keep, text_or_empty().alias("_text")), run, schema)


def mask(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows of ``docs`` with every span in ``text`` as its kind in angle brackets.

    ``n_chars``, if there, becomes the length of a text that changed. Null texts and other columns stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = find_all([t or "" for t in texts], model)
            new = [masked(t, [*b, *more]) if b or more else t for t, (b, more) in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], names=["row", "_text"])

    rows = packed(docs).select("row", "text")
    out = map_arrow(rows, run, with_more(rows, ["row"], "_text string"))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    columns.append(F.col("_text").alias("text"))
    if "n_chars" in docs.columns:
        changed = ~F.col("_text").eqNullSafe(F.col("row.text"))
        count = F.char_length("_text").cast(docs.schema["n_chars"].dataType)
        columns.append(F.when(changed, count).otherwise(F.col("row.n_chars")).alias("n_chars"))
    return out.select(*columns).select(*[F.col(f"`{c}`") for c in docs.columns])


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with every span as its kind in angle brackets; of overlapping spans the outer part is one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{KINDS[kind]}>"]
            done = b
        elif b > done:
            done = b
    return "".join([*out, text[done:]])
