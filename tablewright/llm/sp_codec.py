"""SentencePiece encoding by a streaming Viterbi, and decoding.

The best segmentation is the one with the largest sum of piece scores; of equal ones, the one whose last
differing piece is longer. Characters in no piece become their UTF-8 bytes' pieces.

The search reads a text from left to right. Only the scores of the last ``longest`` boundaries can still be
extended, so only those are kept, with the back pointers since the last commitment. As soon as the paths of
all of them run through one boundary, nothing that follows can change what lies before it: its ids are
committed and their pointers dropped. A text of any length therefore needs a window, not a table.

Some boundaries are known to be such points: no piece holds a space after another character, so every path
runs through the boundary before a run of spaces. Stretches between them are independent: many are searched
at a time, each in its own window, and those that were met before are looked up.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import SpanHashes, map_arrow, slices, span_hashes, sub_batches, text_or_empty, with_more

SPACE = "▁"  # how pieces write a space

#: Below the worst score, for a character that becomes bytes.
UNKNOWN_PENALTY = 10.0

#: Stretches up to this length are remembered from batch to batch, and how many.
MEMO_CHARS = 40
MEMO_STRETCHES = 250_000


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(model.get_piece_size())
        text = [i for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i).replace(SPACE, " "): (i, model.get_score(i)) for i in text}
        named = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
        self._set(pieces, [named[f"<0x{b:02X}>"] for b in range(256)] if len(named) == 256 else None, model.unk_id())
        self.prefix = " " if model.encode("a", out_type=str)[0].startswith(SPACE) else ""

    @classmethod
    def of(cls, pieces: dict[str, tuple[int, float]], byte_ids: Sequence[int] | None, unknown: int, prefix: str = "") -> Vocabulary:
        """A vocabulary given directly: pieces (with plain spaces) to (id, score)."""
        out = cls.__new__(cls)
        out._set(pieces, byte_ids, unknown)
        out.prefix = prefix
        return out

    def _set(self, pieces, byte_ids, unknown) -> None:
        self.pieces, self.byte_ids, self.unknown = pieces, byte_ids, unknown
        self.longest = max(map(len, pieces), default=1)
        self.worst = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        # Every beginning of a piece, so a search can stop where no piece goes on.
        self.begins: dict[str, float | None] = {}
        for piece, (_, score) in pieces.items():
            for n in range(1, len(piece)):
                self.begins.setdefault(piece[:n], None)
            self.begins[piece] = score
        self.text_of = {i: p for p, (i, _) in pieces.items()}
        self.byte_of = {i: b for b, i in enumerate(byte_ids or ())}
        inner = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        spaced = not any(x[1] == " " and x[0] != " " for x in inner)
        lines = not any("\n" in p for p in pieces)
        # Stretches end where no piece can reach across.
        self.stretches = re.compile(" +[^ \n]*|\n|[^ \n]+" if spaced and lines else " +[^ ]*|[^ ]+" if spaced else r"(?s).+")

    def ids(self, text: str, lengths: Iterable[int]) -> list[int]:
        """Ids of the pieces of these lengths that make up ``text``."""
        out: list[int] = []
        at = 0
        for n in lengths:
            piece = text[at : at + n]
            at += n
            if found := self.pieces.get(piece):
                out.append(found[0])
            elif self.byte_ids is None:
                out.append(self.unknown)
            else:
                out += [self.byte_ids[b] for b in piece.encode("utf-8", "replace")]
        return out


class StreamingViterbi:
    """Feeds of text in any portions; ids come out as soon as they are certain.

    Scores are kept for ``longest`` boundaries. Pointers are kept from the last commitment on, one byte or two
    each; only a text that repeats itself for long, so that paths never meet, makes them grow. Convergence
    is looked for whenever the window has grown by ``longest`` and by half, so that costs stay linear.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.held = 0  # most characters ever kept
        self._restart()

    def _restart(self) -> None:
        self.text = ""  # since the last commitment
        self.scores: list[float] = [0.0]  # of the boundaries that a piece can still start from
        self.back = array("H", [0])  # length of the best last piece at each boundary since the commitment
        self.look = self.vocabulary.longest

    def feed(self, portion: str) -> list[int]:
        out: list[int] = []
        longest, begins, worst = self.vocabulary.longest, self.vocabulary.begins, self.vocabulary.worst
        text, scores, back, base = self.text + portion, self.scores, self.back, 0
        for end in range(len(self.text) + 1, len(text) + 1):
            best, length = scores[-1] + worst, 0
            # From the longest piece to the shortest, so that of equal scores the longest stays.
            for n in range(min(longest, len(scores)), 0, -1):
                score = begins.get(text[end - n : end])
                if score is not None:
                    score += scores[-n]
                    if not length or score > best:
                        best, length = score, n
            scores.append(best)
            if len(scores) > longest:
                del scores[0]
            back.append(length or 1)
            if end - base >= self.look:
                self.held = max(self.held, end - base)
                shared = self._shared()
                if shared:
                    out += self._ids(text[base : base + shared], shared)
                    del back[1 : shared + 1]
                    base += shared
                self.look = max((end - base) * 3 // 2, end - base + longest)
        self.text = text[base:]
        self.held = max(self.held, len(self.text))
        return out

    def _shared(self) -> int:
        """The last boundary that the paths of all live boundaries run through."""
        end = len(self.back) - 1
        live = {b for b in range(end - len(self.scores) + 1, end + 1) if b >= 0}
        while len(live) > 1:
            b = max(live)
            live.discard(b)
            live.add(b - self.back[b])
        return live.pop()

    def _ids(self, text: str, boundary: int) -> list[int]:
        lengths = []
        while boundary > 0:
            lengths.append(self.back[boundary])
            boundary -= lengths[-1]
        return self.vocabulary.ids(text, reversed(lengths))

    def finish(self) -> list[int]:
        """The ids that were still open; the search then starts afresh."""
        out = self._ids(self.text, len(self.text))
        self._restart()
        return out

    def resume(self, text: str, scores: list[float], lengths: list[int]) -> None:
        """Go on from the state of another search: the text since its commitment, live scores, pointers."""
        self.text, self.scores, self.back = text, scores, array("H", [0, *lengths])
        self.look = max(len(text) * 3 // 2, len(text) + self.vocabulary.longest)

    def rest(self, text: str) -> bytes:
        """The ids of all that is still open and of ``text``, as native uint32 bytes."""
        out = array("I")
        for a in range(0, len(text), 4096):
            out.extend(self.feed(text[a : a + 4096]))
        out.extend(self.finish())
        return out.tobytes()


class PieceTable:
    """Vectorised look-up of pieces, and of their beginnings, by a hash of their code points.

    Every entry stands in one of the two slots that its hash names.
    """

    BITS = 18

    def __init__(self, vocabulary: Vocabulary):
        entries = list(vocabulary.begins)
        hashes = span_hashes(*_points(entries))
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have the same hash")
        found = [vocabulary.pieces.get(p) for p in entries]
        self.ids = np.array([f[0] if f else -1 for f in found], np.int32)
        self.scores = np.array([f[1] if f else -np.inf for f in found], np.float64)
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.which = np.full(1 << self.BITS, -1, np.int32)
        slots, values = [self._slots(hashes)[k].tolist() for k in (0, 1)], hashes.tolist()
        holder: dict[int, int] = {}
        for i in range(len(values)):
            moved, slot = i, slots[0][i]
            for _ in range(500):
                moved, holder[slot] = holder.get(slot, -1), moved
                if moved < 0:
                    break
                slot = slots[1][moved] if slot == slots[0][moved] else slots[0][moved]
            else:
                raise ValueError("the vocabulary is too large for the table")
        for slot, i in holder.items():
            self.keys[slot], self.which[slot] = values[i], i

    def _slots(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = hashes & np.uint64((1 << self.BITS) - 1)
        return (hashes >> np.uint64(64 - self.BITS)).astype(np.int64), low.astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of the entry with each hash, -1 for none."""
        one, two = self._slots(hashes)
        out = np.where(self.keys[one] == hashes, self.which[one], -1)
        rest = np.flatnonzero(out < 0)
        two = two[rest]
        out[rest] = np.where(self.keys[two] == hashes[rest], self.which[two], -1)
        return out


def _points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-32 bytes of all texts, and where each starts and ends among them."""
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint8)
    ends = 4 * np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return data, np.concatenate(([0], ends[:-1])).astype(np.int64), ends


class _Batch:
    """The streaming search on many texts at a time, portion by portion of ``longest`` characters.

    Scores are kept for the last ``longest`` boundaries of each text; pointers and the pieces they stand for
    since its last commitment, at most ``ROOM`` portions of them. A text whose paths have not met by then, and
    the last few texts of a batch, go on one by one in ``StreamingViterbi``, from where they stand.
    """

    ROOM = 4
    FEW = 64

    def __init__(self, vocabulary: Vocabulary, table: PieceTable, texts: Sequence[str]):
        """``texts`` come from the longest to the shortest, so those still open are always the first ones."""
        self.vocabulary, self.table, self.texts = vocabulary, table, texts
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.out: list[bytes] = [b""] * len(texts)
        self.alone: set[int] = set()
        self.held = 0  # most characters ever kept of a text

    def run(self) -> list[bytes]:
        longest, at, open_ = self.vocabulary.longest, 0, len(self.texts)
        scores = np.zeros((open_, 1))  # the last one is that of the boundary ``at``
        base = np.zeros(open_, np.int64)  # the last commitment
        lengths, pieces = np.zeros((open_, 1), np.int64), np.full((open_, 1), -1, np.int32)  # from there on
        while open_:
            scores, step_lengths, step_pieces = self._advance(at, scores)
            after = at + longest
            room = step_lengths.shape[1] if not at else (self.ROOM + 1) * longest + 1
            if at:
                rows, columns = np.arange(open_)[:, None], (at - base)[:, None] + np.arange(1, step_lengths.shape[1])
                lengths[rows, columns], pieces[rows, columns] = step_lengths[:, 1:], step_pieces[:, 1:]
            else:
                lengths, pieces = step_lengths, step_pieces
            self.held = max(self.held, int((np.minimum(self.sizes[:open_], after) - base).max(initial=0)))
            going = int(np.searchsorted(-self.sizes[:open_], -after, side="left"))
            ended = np.arange(going, open_)
            self._commit(ended, base[ended], self.sizes[ended] - base[ended], lengths, pieces)
            if not going:
                return self.out
            base = base[:going]
            shared = self._shared(after - base, lengths)
            self._commit(np.flatnonzero(shared), base[shared > 0], shared[shared > 0], lengths, pieces)
            # Pointers move up by what is committed.
            from_ = np.minimum(shared[:, None] + np.arange((self.ROOM + 1) * longest + 1), room - 1)
            lengths, pieces = (np.take_along_axis(x[:going], from_, axis=1) for x in (lengths, pieces))
            base, scores, at, open_ = base + shared, scores[:going, -longest - 1 :], after, going
            stuck = np.arange(going) if going < self.FEW else np.flatnonzero(at - base > (self.ROOM - 1) * longest)
            for row in stuck.tolist():
                if row not in self.alone:
                    self._go_on(row, at, int(base[row]), scores[row], lengths[row])
            if going < self.FEW:
                return self.out
            # One that goes on alone is done here; its row is passed over.
            base[stuck] = at
        return self.out

    def _advance(self, at: int, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next portion: scores with those before it, lengths and pieces of the best last piece of each boundary."""
        vocabulary, table, count = self.vocabulary, self.table, len(scores)
        longest, carry = vocabulary.longest, min(at, vocabulary.longest - 1)
        sizes = self.sizes[:count] - at
        width, before = min(longest, int(sizes[0])), scores.shape[1] - 1
        some = [t[at - carry : at + longest] for t in self.texts[:count]]
        data, starts, ends = _points(some)
        starts, ends = starts // 4, ends // 4
        total = len(data) // 4
        room = np.repeat(ends, ends - starts) - np.arange(total)
        pieces = np.full((longest, total), -1, np.int32)
        hashes = SpanHashes(data)
        alive = np.arange(total)
        for n in range(1, min(longest, width + carry) + 1):
            alive = alive[room[alive] >= n]
            which = table.find(hashes(4 * alive, 4 * (alive + n)))
            pieces[n - 1, alive] = np.where(which >= 0, np.where(table.ids[which] >= 0, which, -1), -1)
            alive = alive[which >= 0]  # only beginnings of pieces go on
        scores = np.concatenate((scores, np.full((count, width), -np.inf)), axis=1)
        lengths, found = np.zeros((count, width + 1), np.int64), np.full((count, width + 1), -1, np.int32)
        for j in range(1, width + 1):
            live = int(np.searchsorted(-sizes, -j, side="right"))
            top = scores[:live, before + j]
            # From the longest piece to the shortest, so that of equal scores the longest stays.
            for n in range(min(longest, at + j), 0, -1):
                which = pieces[n - 1, starts[:live] + carry + j - n]
                score = np.where(which >= 0, scores[:live, before + j - n] + table.scores[which], -np.inf)
                better = score > top
                top[better] = score[better]
                lengths[:live, j][better] = n
                found[:live, j][better] = which[better]
            none = lengths[:live, j] == 0
            top[none] = scores[:live, before + j - 1][none] + vocabulary.worst
            lengths[:live, j][none] = 1
        return scores, lengths, found

    def _shared(self, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each text the last boundary that the paths of all live boundaries run through."""
        live = np.maximum(ends[:, None] - np.arange(self.vocabulary.longest), 0)
        while True:
            last = live.max(axis=1, keepdims=True)
            rows, columns = np.nonzero((live == last) & (last > live.min(axis=1, keepdims=True)))
            if not len(rows):
                return live[:, 0]
            here = live[rows, columns]
            live[rows, columns] = np.maximum(here - lengths[rows, here], 0)

    def _commit(self, rows: np.ndarray, base: np.ndarray, ends: np.ndarray, lengths: np.ndarray, pieces: np.ndarray) -> None:
        """Add the ids from the commitment of each text to the boundary ``ends`` after it."""
        if self.alone:
            mine = ~np.isin(rows, list(self.alone))
            rows, base, ends = rows[mine], base[mine], ends[mine]
        most = int(ends.max(initial=0))
        if not most:
            return
        found = np.full((len(rows), most), -1, np.int32)
        odd = np.zeros(len(rows), bool)
        which_of, at, column = np.arange(len(rows)), ends.copy(), most
        which_of, at = which_of[at > 0], at[at > 0]
        while len(which_of):
            column -= 1
            piece = pieces[rows[which_of], at]
            odd[which_of[piece < 0]] = True
            found[which_of, column] = np.where(piece >= 0, self.table.ids[piece], 0)
            at = at - lengths[rows[which_of], at]
            which_of, at = which_of[at > 0], at[at > 0]
        flat = found[found >= 0].astype(np.uint32).tobytes()
        cuts = (4 * np.concatenate(([0], np.cumsum((found >= 0).sum(axis=1))))).tolist()
        out = self.out
        for k, (row, a, b) in enumerate(zip(rows.tolist(), cuts[:-1], cuts[1:], strict=True)):
            if odd[k]:
                steps, j = [], int(ends[k])
                while j:
                    steps.append(int(lengths[row, j]))
                    j -= steps[-1]
                text = self.texts[row][int(base[k]) : int(base[k] + ends[k])]
                out[row] += array("I", self.vocabulary.ids(text, reversed(steps))).tobytes()
            else:
                out[row] += flat[a:b]

    def _go_on(self, row: int, at: int, base: int, scores: np.ndarray, lengths: np.ndarray) -> None:
        self.alone.add(row)
        search, text = StreamingViterbi(self.vocabulary), self.texts[row]
        search.resume(text[base:at], scores[1:].tolist(), lengths[1 : at - base + 1].tolist())
        self.out[row] += search.rest(text[at:])
        self.held = max(self.held, search.held)


def encode_stretches(vocabulary: Vocabulary, table: PieceTable, stretches: Sequence[str]) -> list[bytes]:
    """Ids of texts of any length as native uint32 bytes: the streaming search, on all of them at a time."""
    order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
    out: list[bytes] = [b""] * len(stretches)
    for i, ids in zip(order, _Batch(vocabulary, table, [stretches[i] for i in order]).run(), strict=True):
        out[i] = ids
    return out


class Codec:
    """Encodes and decodes texts; remembers short stretches it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.table = PieceTable(vocabulary)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as native uint32 bytes; an empty text has none."""
        if len(self.known) > MEMO_STRETCHES:
            self.known.clear()
        known, prefix, cut = self.known, self.vocabulary.prefix, self.vocabulary.stretches.findall
        parts = [cut(prefix + t) if t else [] for t in texts]
        new = list({s for stretches in parts for s in stretches if s not in known})
        long: list[str] = []
        for a, b in slices([len(s) for s in new], 200_000):
            known.update(zip(new[a:b], encode_stretches(self.vocabulary, self.table, new[a:b]), strict=True))
            long += [s for s in new[a:b] if len(s) > MEMO_CHARS]
        out = [b"".join([known[s] for s in stretches]) for stretches in parts]
        for s in long:
            del known[s]
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character, unknown ids nothing."""
        vocabulary = self.vocabulary
        parts: list[bytes] = []
        for i in ids:
            if (b := vocabulary.byte_of.get(i)) is not None:
                parts.append(bytes((b,)))
            else:
                parts.append(vocabulary.text_of.get(i, "").encode())
        text = b"".join(parts).decode("utf-8", "replace")
        return text.removeprefix(vocabulary.prefix) if vocabulary.prefix else text


@lru_cache(maxsize=1)
def codec_of(model_path: str) -> Codec:
    """The codec of a worker, kept with what it remembers from task to task."""
    return Codec(Vocabulary(model_path))


def encode_documents(docs: DataFrame, model_path: str, *keep: str, ids: bool = True) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, its piece ids, and what decoding them gives.

    ``ids`` (array, if asked for), ``n_ids``, ``ids_crc32`` (of the ids as little-endian uint32),
    ``round_trip``: whether the decoded ids equal the text. A null text is empty and has no ids; a text that
    is one long run without spaces is searched in portions; repeated rows come back repeated.
    """
    schema = with_more(docs, keep, ("ids array<int>, " if ids else "") + "n_ids long, ids_crc32 long, round_trip boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_path)
        for batch in batches:
            for some in sub_batches(batch, len(keep)):
                texts = some.column(len(keep)).to_pylist()
                coded = codec.encode(texts)
                same = [codec.decode(memoryview(c).cast("I")) == t for c, t in zip(coded, texts, strict=True)]
                columns = [some.column(i) for i in range(len(keep))]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                if ids:
                    flat = np.frombuffer(b"".join(coded), np.int32)
                    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                columns += [pa.array(sizes), pa.array([zlib.crc32(c) for c in coded], pa.int64()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(["ids"] if ids else []), "n_ids", "ids_crc32", "round_trip"])

    return map_arrow(docs.select(*keep, text_or_empty().alias("_text")), run, schema)
