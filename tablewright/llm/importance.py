"""Quality selection by importance resampling.

Two generative models of hashed words and word pairs are counted, one over the target texts and one over all
raw texts. A document's importance weight is the ratio of its probabilities under the two. Adding Gumbel
noise to the log weights and keeping the k largest sums draws k documents without replacement in proportion to
their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import map_arrow, mix64, sub_batches, text_or_empty, with_more, word_hashes
from tablewright.session import materialize

BUCKETS = 10_000

#: Added to every bucket's count.
SMOOTHING = 1.0

#: Largest list of target ids that is broadcast, in rows of 8 bytes.
MOST_BROADCAST_ROWS = 4_000_000

_PAIR = np.uint64(0x9FB21C651E98DF25)


def grams(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and of all pairs of neighbouring words, and the text of each."""
    words, counts = word_hashes(texts)
    rows = np.repeat(np.arange(len(counts)), counts)
    inside = rows[1:] == rows[:-1]
    pairs = mix64(words[:-1][inside] * _PAIR + words[1:][inside])
    found = np.concatenate([words, pairs]) % np.uint64(buckets)
    return found.astype(np.int64), np.concatenate([rows, rows[1:][inside]])


def gram_counts(docs: DataFrame, target_ids: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every bucket in the raw and in the target texts, over all documents.

    Each task adds up its rows first and sends one row per bucket at most; ``buckets`` rows reach the driver.
    """
    ids = materialize(target_ids.select(F.col("doc_id").alias("target")).filter("target is not null").distinct(), "target-ids")
    few = ids.count() <= MOST_BROADCAST_ROWS
    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    rows = rows.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("target"), "left")
    rows = rows.select("_text", F.col("target").isNotNull().alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for some in sub_batches(batch, 0):
                found, of = grams(some.column(0), buckets)
                wanted = some.column(1).to_numpy(zero_copy_only=False).astype(bool)
                raw += np.bincount(found, minlength=buckets)
                target += np.bincount(found[wanted[of]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])

    sums = map_arrow(rows, run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in sums.collect():
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of the target's over the raw probability of each bucket; zeros if there is no target text."""
    if not target.sum():
        return np.zeros(len(raw))
    p, q = target + smoothing, raw + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def weigh(docs: DataFrame, ratio: np.ndarray, *keep: str) -> DataFrame:
    """The columns ``keep`` of every row, and ``log_weight`` of its whole text; 0 for null or wordless texts."""
    schema = with_more(docs, keep, "log_weight double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in sub_batches(batch, len(keep)):
                found, of = grams(some.column(len(keep)), len(ratio))
                weight = np.bincount(of, ratio[found], some.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(i) for i in range(len(keep))), pa.array(weight, pa.float64())], names=[*keep, "log_weight"]
                )

    return map_arrow(docs.select(*keep, text_or_empty().alias("_text")), run, schema)


def gumbel(*key: str, seed: int) -> Column:
    """Standard Gumbel noise that depends on the key and the seed only."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def sortable(value: Column) -> Column:
    """Order-preserving whole numbers for doubles, by steps of 2 ** -32; NaN does not occur."""
    return F.round(value * F.lit(float(1 << 32))).cast("long")


def kth_largest(values: DataFrame, column: str, k: int) -> tuple[int, int]:
    """(the k-th largest value of a long column, how many of its ties belong to the k largest).

    Narrows a range of values by counts of 4096 equal parts: 6 passes over the column at most, with one row per
    part and task shuffled, whatever k is. k must be between 1 and the number of rows.
    """
    low, high = (int(x) for x in values.agg(F.min(column), F.max(column)).first())
    while low < high:
        width = (high - low) // 4096 + 1
        part = F.expr(f"cast((cast({column} as decimal(38,0)) - {low}) div {width} as long)")
        counts = values.filter(F.col(column).between(low, high)).groupBy(part.alias("part")).agg(F.count("*").alias("n"))
        for r in sorted(counts.collect(), key=lambda r: -r.part):
            if r.n >= k:
                low, high = low + r.part * width, min(high, low + r.part * width + width - 1)
                break
            k -= r.n
    return low, k


def resample(docs: DataFrame, target_ids: DataFrame, share: float, seed: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, log_weight, key, selected) for every row of (doc_id, text).

    Exactly floor(share * rows) rows are selected: those of the largest keys, the log weight plus Gumbel
    noise; among equal keys those with the largest tie number, a hash of id and text, and of rows that repeat
    id and text any. Target texts are those of ``target_ids``; without any, all weights are equal. Null and
    wordless texts have weight 0. Other columns are ignored; an empty table gives an empty table.
    """
    raw, target = gram_counts(docs, target_ids, buckets)
    rows = docs.select("doc_id", "text", F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("tie"))
    weighed = weigh(rows, log_ratio(raw, target), "doc_id", "tie")
    weighed = weighed.withColumn("key", F.col("log_weight") + gumbel("tie", seed=seed))
    # Few numbers a row, read many times: files as large as the session advises, not a small one for each split of the texts.
    weighed = materialize(weighed.withColumn("place", sortable(F.col("key"))).hint("rebalance"), "weighed")
    n = weighed.count()
    k = int(share * n)
    if k <= 0:
        selected = F.lit(False)
    elif k >= n:
        selected = F.lit(True)
    else:
        place, left = kth_largest(weighed, "place", k)
        tie, left = kth_largest(weighed.filter(F.col("place") == place), "tie", left)
        selected = (F.col("place") > place) | ((F.col("place") == place) & (F.col("tie") > tie))
        edge = (F.col("place") == place) & (F.col("tie") == tie)
        if weighed.filter(edge).count() == left:
            selected |= edge
        else:
            # Rows that repeat one id and text: any of them, so a number of them is marked.
            nth = F.row_number().over(Window.partitionBy("place", "tie").orderBy("log_weight"))
            some = weighed.filter(edge).withColumn("nth", nth).withColumn("selected", F.col("nth") <= left).drop("nth")
            rest = weighed.filter(~edge).withColumn("selected", selected)
            return rest.unionByName(some).select("doc_id", "log_weight", "key", "selected")
    return weighed.select("doc_id", "log_weight", "key", selected.alias("selected"))
