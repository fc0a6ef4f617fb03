"""Token ids as directly addressable codes.

Ids are cut into chunks of ``bits`` bits. Level 0 holds the lowest chunk of every id; a bitmap per level
says which ids go on, and level k + 1 holds the next chunks of just those. The place of an id in the next
level is the number of set bits before it, so any id is read with one lookup per level and a rank: no
block is decoded. A rank directory counts the set bits before every ``RANK_BITS`` bits.

A segment is one byte string (little-endian):

    4 bytes magic, uint32 version, uint32 bits per chunk, uint32 levels, uint64 ids, uint64 documents,
    documents: int64 doc_id, then uint8 (1: has an id, 0: null), then uint64 end of the ids of each,
    per level: uint64 entries, chunks (uint8 or uint16), bitmap bytes, uint32 rank directory
    (bitmap and directory are missing on the last level), each part padded to 8 bytes.

Segments are the rows of a Parquet table (part, seq, n_ids, segment), ordered by part and seq.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import map_arrow, slices, span_hashes, sub_batches, text_or_empty, utf8

# Fixed values of the format.
MAGIC = b"TDAC"
FORMAT_VERSION = 1
RANK_BITS = 512

SEGMENT_IDS = 1 << 20

#: Longest piece that is remembered.
MEMO_BYTES = 48

AFTER_SPACE, AFTER_LINE, AT_START = 0, 1, 2
_KINDS = np.array([0, 0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)
SEGMENT_SCHEMA = "part int, seq long, n_ids long, segment binary"

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _padded(part: bytes) -> bytes:
    return part + bytes(-len(part) % 8)


def encode_segment(ids: np.ndarray, doc_ids: Sequence[int | None], ends: Sequence[int], bits: int = 8) -> bytes:
    """One segment with the ids of several documents one after the other."""
    if bits not in (8, 16):
        raise ValueError("bits must be 8 or 16")
    kind = np.uint8 if bits == 8 else np.dtype("<u2")
    rest = np.asarray(ids, np.uint64)
    levels = []
    while True:
        above = rest >> np.uint64(bits)
        part = _padded((rest & np.uint64((1 << bits) - 1)).astype(kind).tobytes())
        more = above > 0
        if not more.any():
            levels.append(len(rest).to_bytes(8, "little") + part)
            break
        bitmap = np.packbits(more, bitorder="little")
        counts = np.zeros(-(-len(rest) // RANK_BITS) * RANK_BITS // 8, np.int64)
        counts[: len(bitmap)] = _ONES[bitmap]
        ranks = np.concatenate(([0], np.cumsum(counts.reshape(-1, RANK_BITS // 8).sum(1)))).astype("<u4")
        levels.append(len(rest).to_bytes(8, "little") + part + _padded(bitmap.tobytes()) + _padded(ranks.tobytes()))
        rest = above[more]
    head = MAGIC + np.array([FORMAT_VERSION, bits, len(levels)], "<u4").tobytes()
    head += np.array([len(ids), len(doc_ids)], "<u8").tobytes()
    known = [d is not None for d in doc_ids]
    docs = np.array([d if d is not None else 0 for d in doc_ids], "<i8").tobytes()
    return b"".join(
        [head, docs, _padded(np.array(known, np.uint8).tobytes()), np.array(ends, "<u8").tobytes(), *levels]
    )


class Segment:
    """Reads a segment in place."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        version, self.bits, count = np.frombuffer(data, "<u4", 3, 4).tolist()
        if version != FORMAT_VERSION:
            raise ValueError(f"format version {version} is unknown")
        self.size, n_docs = np.frombuffer(data, "<u8", 2, 16).tolist()
        at = 32

        def take(kind, n):
            nonlocal at
            part = np.frombuffer(data, kind, n, at)
            at += part.nbytes + -part.nbytes % 8
            return part

        ids = take("<i8", n_docs).tolist()
        self.doc_ids = [d if known else None for d, known in zip(ids, take(np.uint8, n_docs).tolist(), strict=True)]
        self.ends = take("<u8", n_docs).astype(np.int64)
        kind = np.uint8 if self.bits == 8 else "<u2"
        self.chunks, self.bitmaps, self.ranks = [], [], []
        for level in range(count):
            n = int(take("<u8", 1)[0])
            self.chunks.append(take(kind, n))
            if level < count - 1:
                self.bitmaps.append(take(np.uint8, -(-n // 8)))
                self.ranks.append(take("<u4", -(-n // RANK_BITS) + 1))

    def __getitem__(self, i: int) -> int:
        """The id at place ``i``: a lookup and a rank per level, nothing else is read."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for level, chunks in enumerate(self.chunks):
            value |= int(chunks[i]) << (self.bits * level)
            if level == len(self.bitmaps) or not self.bitmaps[level][i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            bitmap = self.bitmaps[level]
            before = _ONES[bitmap[block * RANK_BITS // 8 : i >> 3]].sum(dtype=np.int64)
            before += _ONES[bitmap[i >> 3] & ((1 << (i & 7)) - 1)]
            i = int(self.ranks[level][block]) + int(before)
        return value

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """The ids of a range, all levels at a time."""
        end = self.size if end is None else end
        out = self.chunks[0][start:end].astype(np.uint32)
        places = np.arange(len(out))
        first = start
        for level, bitmap in enumerate(self.bitmaps):
            n = len(places) if level == 0 else taken
            byte = first >> 3
            window = np.unpackbits(bitmap[byte : (first + n + 7) >> 3], bitorder="little")[first & 7 :][:n].astype(bool)
            block = first // RANK_BITS
            head = bitmap[block * RANK_BITS // 8 : byte]
            before = int(self.ranks[level][block]) + int(_ONES[head].sum(dtype=np.int64))
            if first & 7:
                before += int(_ONES[bitmap[byte] & ((1 << (first & 7)) - 1)])
            places = places[window]
            taken, first = len(places), before
            if not taken:
                break
            more = self.chunks[level + 1][first : first + taken].astype(np.uint32)
            out[places] |= more << np.uint32(self.bits * (level + 1))
        return out


class ByteBpeEncoder:
    """Ids of texts, as the tokenizer gives them, with every distinct piece of a text encoded once.

    The split before the merges never joins text across a single space or a single line end between two
    other characters, so texts are cut there. The distinct pieces of a batch are looked up among the known
    ones; the unknown are encoded in long runs, parted by line ends, which are one token of their own.
    Texts with other runs of white space are encoded whole. A known piece of up to MEMO_BYTES bytes is
    found by its hash, length and first eight bytes together. All are forgotten when there are
    ``remembered`` of them.

    The name of a special token in a text is plain text, or, with ``special_tokens``, its id as the library's
    plain call gives it; texts that hold one are then encoded whole.
    """

    def __init__(self, tokenizer_path: str, remembered: int = 1_000_000, special_tokens: bool = False):
        # A task has one core; threads of its own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = not special_tokens
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added if t.special and special_tokens]
        if any(len(t.split()) != 1 for t in self.special):
            raise ValueError("a special token must have no white space, as texts are cut there")
        self.remembered = remembered
        ids = self._plain(["\n"])[0]
        if len(ids) != 1:
            raise ValueError("a line end must be one token")
        self.line_end = ids[0]
        self._forget()

    def _forget(self) -> None:
        self.keys, self.marks = np.empty(0, np.uint64), np.empty(0, np.uint64)  # sorted by key
        self.begins, self.sizes = np.empty(0, np.int64), np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for a, b in slices([len(t) for t in texts], 200_000):
            found = self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False)
            out += [np.array(x.ids, np.uint32) for x in found]
        return out

    def _encode(self, kinds: list[int], pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces in one array, with begin and size of each; a line end in front is part of its ids."""
        n = len(pieces)
        begins, sizes = np.zeros(n, np.int64), np.zeros(n, np.int32)
        lead = np.array([k == AFTER_LINE for k in kinds], np.int64)
        clean = np.array([len(p.split()) == 1 for p in pieces], bool)
        forms = [" " + p if k == AFTER_SPACE else p for k, p in zip(kinds, pieces, strict=True)]
        flat, total, at = [], 0, np.flatnonzero(clean)
        texts = [forms[i] for i in at.tolist()]
        for (a, b), run in zip(spans := [*slices([len(t) for t in texts], 100_000)], self._plain(["\n" + "\n".join(texts[a:b]) for a, b in spans]), strict=True):
            cuts = np.append(np.flatnonzero(run == self.line_end), len(run))
            if len(cuts) != b - a + 1:
                raise RuntimeError("a run of pieces was not cut as expected")
            mine = at[a:b]
            begins[mine] = cuts[:-1] + 1 - lead[mine] + total
            sizes[mine] = np.diff(cuts) - 1 + lead[mine]
            flat.append(run)
            total += len(run)
        odd = np.flatnonzero(~clean).tolist()
        for i, run in zip(odd, self._plain(["\n" * int(lead[i]) + forms[i] for i in odd]), strict=True):
            begins[i], sizes[i] = total, len(run)
            flat.append(run)
            total += len(run)
        return np.concatenate([np.empty(0, np.uint32), *flat]), begins, sizes

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offsets that cut them by text."""
        if len(self.keys) > self.remembered:
            self._forget()
        data, offsets = utf8(texts)
        size, n_texts = len(data), len(offsets) - 1
        raw = data.tobytes()
        # A piece starts at each text and after each space and line end.
        cuts = np.flatnonzero((data == 0x20) | (data == 0x0A))
        starts = np.concatenate([offsets[:-1], cuts + 1])
        kinds = np.concatenate([np.full(n_texts, AT_START, np.uint8), np.where(data[cuts] == 0x20, AFTER_SPACE, AFTER_LINE).astype(np.uint8)])
        order = np.argsort(starts, kind="stable")
        # An empty text's start precedes that of the next text; a piece may start where its text ends.
        rows = np.concatenate([np.arange(n_texts), np.searchsorted(offsets, cuts, side="right") - 1])
        order = order[np.argsort(rows[order], kind="stable")]
        starts, kinds, rows = starts[order], kinds[order], rows[order]
        first = np.searchsorted(rows, np.arange(n_texts))
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        ends[first[1:] - 1] = offsets[1:-1]
        ends[-1:] = size
        lengths = ends - starts
        key = span_hashes(data, starts, ends) ^ _KINDS[kinds]
        unique, at, which = np.unique(key, return_index=True, return_inverse=True)
        head = np.zeros(size + 8, np.uint8)
        head[:size] = data
        n = lengths[at]
        window = np.lib.stride_tricks.sliding_window_view(head, 8)[starts[at]].copy()
        window[np.arange(8) >= n[:, None]] = 0
        mark = window.view(np.uint64)[:, 0] ^ n.astype(np.uint64) << np.uint64(56)
        slot = np.searchsorted(self.keys, unique)
        slot[slot == len(self.keys)] = 0
        known = (self.keys[slot] == unique) & (self.marks[slot] == mark) if len(self.keys) else np.zeros(len(unique), bool)
        short = n <= MEMO_BYTES
        begins, sizes = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int32)
        begins[known], sizes[known] = self.begins[slot[known]], self.sizes[slot[known]]
        known &= short
        # White space at a piece's edge belongs to a run of white space. A special token splits its text first.
        bad = n == 0
        new = np.flatnonzero(~known & ~bad)
        pieces = [raw[a:b].decode() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]
        edge = np.array([p[0].isspace() or p[-1].isspace() or any(t in p for t in self.special) for p in pieces], bool)
        bad[new[edge]] = True
        whole = np.zeros(n_texts, bool)
        whole[rows[bad[which]]] = True
        new, pieces = new[~edge], [p for p, e in zip(pieces, edge.tolist(), strict=True) if not e]
        fresh, begins_new, sizes_new = self._encode(kinds[at[new]].tolist(), pieces)
        begins[new], sizes[new] = begins_new + len(self.ids), sizes_new
        keep = new[short[new]]
        plain = self._plain([raw[offsets[i] : offsets[i + 1]].decode() for i in np.flatnonzero(whole).tolist()])
        table = np.concatenate([self.ids, fresh, *plain])
        if len(keep):
            self.ids = table[: len(self.ids) + len(fresh)]
            merged = np.concatenate([self.keys, unique[keep]])
            into = np.argsort(merged, kind="stable")
            self.keys = merged[into]
            self.marks = np.concatenate([self.marks, mark[keep]])[into]
            self.begins = np.concatenate([self.begins, begins[keep]])[into]
            self.sizes = np.concatenate([self.sizes, sizes[keep]])[into]
        n_plain = np.array([len(x) for x in plain], np.int64)
        begin = begins[which]
        count = np.where(whole[rows], 0, sizes[which]).astype(np.int64)
        begin[first[whole]] = len(table) - n_plain.sum() + np.cumsum(n_plain) - n_plain
        count[first[whole]] = n_plain
        stops = np.cumsum(count)
        total = int(stops[-1]) if len(stops) else 0
        places = np.arange(total) + np.repeat(begin - (stops - count), count)
        return table[places], np.concatenate([np.concatenate(([0], stops))[first], [total]])


@lru_cache(maxsize=1)
def encoder_of(tokenizer_path: str, special_tokens: bool) -> ByteBpeEncoder:
    """The encoder of a worker, kept with what it remembers from task to task."""
    return ByteBpeEncoder(tokenizer_path, special_tokens=special_tokens)


def write_codes(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    bits: int = 8,
    segment_ids: int = SEGMENT_IDS,
    special_tokens: bool = False,
) -> None:
    """Encode (doc_id, text) and write segments in ascending order of doc_id.

    Null texts are empty and get the end id only; rows with a null doc_id come first; repeated doc_ids are
    ordered by text. A segment closes at the first document end after ``segment_ids`` ids, so a document
    is never cut. Other columns are ignored. One shuffle brings the texts into order. For ``special_tokens``
    see ``ByteBpeEncoder``.
    """
    spark = docs.sparkSession
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.repartitionByRange(wanted, "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        encoder = encoder_of(tokenizer_path, special_tokens)
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        ends: list[int] = []
        total = 0

        def close():
            data = encode_segment(np.concatenate(parts), doc_ids, ends, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in ((part, pa.int32()), (seq, pa.int64()), (total, pa.int64()), (data, pa.binary()))],
                names=["part", "seq", "n_ids", "segment"],
            )

        for batch in batches:
            for some in sub_batches(batch, 1):
                ids, cuts = encoder(some.column(1))
                ids = np.insert(ids, cuts[1:], end_id)
                cuts = (cuts + np.arange(len(cuts))).tolist()
                for doc, a, b in zip(some.column(0).to_pylist(), cuts[:-1], cuts[1:], strict=True):
                    total += b - a
                    doc_ids.append(doc)
                    parts.append(ids[a:b])
                    ends.append(total)
                    if total >= segment_ids:
                        yield close()
                        seq += 1
                        doc_ids, parts, ends, total = [], [], [], 0
        if doc_ids:
            yield close()

    # Pieces are encoded once a batch, so larger batches encode fewer.
    map_arrow(rows, encode, SEGMENT_SCHEMA, rows=10_000).write.parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, first): number of ids in all earlier segments. Only the counts are read.

    The order of parts is settled on one row per part, that of segments inside each part.
    """
    sizes = spark.read.schema(SEGMENT_SCHEMA).parquet(path).select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    local = sizes.withColumn("local", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return local.join(parts, F.col("part") == F.col("p")).select("part", "seq", (F.col("base") + F.col("local")).alias("first"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the written segments."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                segment = Segment(data)
                ids = segment.ids().astype("<u4").tobytes()
                starts = np.concatenate(([0], segment.ends[:-1])).astype(np.int64)
                crc = [zlib.crc32(memoryview(ids)[4 * a : 4 * b]) for a, b in zip(starts.tolist(), segment.ends.tolist(), strict=True)]
                n = len(segment.doc_ids)
                columns = [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int64())]
                columns += [pa.array(segment.doc_ids, pa.int64()), pa.array(starts), pa.array(segment.ends - starts), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "doc_id", "place", "n_tokens", "ids_crc32"])

    table = spark.read.schema(SEGMENT_SCHEMA).parquet(path).select("part", "seq", "segment")
    found = map_arrow(table, read, "part int, seq long, doc_id long, place long, n_tokens long, ids_crc32 long")
    starts = segment_starts(spark, path)
    return found.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """The id at each place of ``places`` (column ``place``, counted over all segments), by direct access.

    (place, id) in any order; repeated places come back repeated, places that are null or outside the
    table are not returned. Places meet their segments by a band join on blocks of places.
    """
    block = 1 << 20
    spans = segment_starts(spark, path).join(
        spark.read.schema(SEGMENT_SCHEMA).parquet(path).select("part", "seq", "n_ids"), ["part", "seq"]
    )
    spans = spans.withColumn("block", F.explode(F.expr(f"sequence(first div {block}, (first + n_ids - 1) div {block})")))
    asked = places.select(F.col("place").cast("long").alias("place")).groupBy("place").agg(F.count("*").alias("times"))
    met = asked.withColumn("block", F.expr(f"place div {block}")).join(spans, "block")
    met = met.filter("place >= first and place < first + n_ids").groupBy("part", "seq", "first")
    # Distinct places of a segment are at most as many as its ids.
    wanted = met.agg(F.collect_list(F.struct("place", "times")).alias("wanted"))
    table = spark.read.schema(SEGMENT_SCHEMA).parquet(path).select("part", "seq", "segment")
    rows = wanted.join(table, ["part", "seq"]).select("first", "wanted", "segment")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, wanted, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                segment = Segment(data)
                at, times = [w["place"] for w in wanted], [w["times"] for w in wanted]
                columns = [np.array(at, np.int64), np.array(times, np.int64), np.array([segment[p - first] for p in at], np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["place", "times", "id"])

    found = map_arrow(rows, read, "place long, times long, id long")
    return found.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("place", "id")
