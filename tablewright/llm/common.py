"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.session import share_package

#: Texts handled together inside a task, in characters (UTF-8 bytes for Arrow buffers).
BATCH_CHARS = 2_000_000

#: Rows that come to a Python worker, and go back from it, at a time.
ROWS_PER_BATCH = 1000

_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_arrow(df: DataFrame, run: Callable, schema: StructType | str, rows: int = ROWS_PER_BATCH) -> DataFrame:
    """``mapInArrow`` by a function of this library, which workers can import wherever they run.

    A worker lives on after its task, so what the task has freed goes back to the system at its end.
    Arrow batches of this session get ``rows`` rows at most from now on, as texts may be long.
    """
    spark = df.sparkSession
    share_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def with_more(docs: DataFrame, keep: Sequence[str], more: str) -> StructType:
    """The fields of ``keep`` as they are in ``docs``, then those of the DDL string ``more``."""
    return StructType([*(docs.schema[c] for c in keep), *StructType.fromDDL(more).fields])


def packed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): all columns in one, so that no name can clash with what an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def slices(lengths: Sequence[int], limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths add up to about ``limit``; a longer row stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def sub_batches(batch: pa.RecordBatch, column: int, limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch, bounded by the bytes of one text column."""
    lengths = np.diff(utf8(batch.column(column))[1])
    for a, b in slices(lengths.tolist(), limit):
        yield batch.slice(a, b - a)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and the offsets that cut it; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _SHIFT)
    x *= _MIX_A
    x ^= x >> _SHIFT
    x *= _MIX_B
    x ^= x >> _SHIFT
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.empty(max(n, 1), np.uint64)
    out[0], done = 1, 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_pow_cache = {"up": _powers(_BASE, 1), "down": _powers(_INVERSE, 1)}


class SpanHashes:
    """64-bit hashes of spans of one byte array; equal spans have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_pow_cache["up"]) < n:
            _pow_cache["up"], _pow_cache["down"] = _powers(_BASE, n), _powers(_INVERSE, n)
        self.sums = np.zeros(n, np.uint64)
        coded = _BYTE_CODE[data]
        coded *= _pow_cache["up"][: n - 1]
        np.cumsum(coded, out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = self.sums[ends]
        value -= self.sums[starts]
        value *= _pow_cache["down"][starts]
        value += (ends - starts).astype(np.uint64)
        return mix64(value)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHashes(data)(starts, ends)


#: ASCII white space that ends a word: 0x20 and 0x09 to 0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = WHITE) -> tuple[np.ndarray, ...]:
    """Starts, ends and row numbers of the runs of bytes outside ``gap``; rows cut runs."""
    inside = ~gap[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[:-1][np.diff(offsets) > 0]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tail = offsets[1:][np.diff(offsets) > 0] - 1
    last[tail] = inside[tail]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts in order, and each text's number of words."""
    data, offsets = utf8(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    return span_hashes(data, starts, ends), np.bincount(rows, minlength=len(texts))
