"""Benchmark decontamination: which words of a document lie in a passage of a benchmark item.

A prefix-filtered set join. The sets are the windows of the items: 10 consecutive words, or all words of a
shorter item. A window is a set of shingles of 3 words (fewer if the window is shorter). Shingles are ordered
by rarity, counted over all documents. A document holds a window only if it holds all of its shingles, so a
prefix of one shingle, the rarest, is enough for the join to find every candidate. The shingle's place gives
the place of the window; it must begin and end inside the document (positional and length bound), and the
words there are compared exactly.

DataFrame functions only. Documents are not shuffled: their shingles meet the windows in a broadcast table
whose size is checked. Beyond that size, only (document, place, shingle key) are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import text_or_empty
from tablewright.session import materialize

WINDOW = 10
SHINGLE = 3

#: A word is a run of characters outside these; letters A-Z are lower-cased first.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Largest table of windows to broadcast, in rows (a row holds a window's words, about 200 bytes).
MOST_BROADCAST_ROWS = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def raw_words(text: Column) -> Column:
    """Words as they stand. ``words`` are these with A-Z lower-cased."""
    return F.array_remove(F.split(text, GAP), "")


def plain_case(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _key(words: Column, at: Column, size: int) -> Column:
    """Key of the shingle at a place: equal shingles have equal keys, others rarely."""
    return F.xxhash64(F.lit(size), *[F.get(words, at + i) for i in range(size)])


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, words, n), and (window, item_id) of the items that have them."""
    items = benchmark.select("item_id", raw_words(plain_case(text_or_empty())).alias("words")).filter("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW + 1, F.lit(1)))
    rows = items.withColumn("start", F.explode(starts)).select(
        "item_id", F.expr(f"slice(words, start, {WINDOW})").alias("words")
    )
    rows = materialize(rows.withColumn("window", F.array_join("words", " ")), "windows")
    return rows.select("window", "words", F.size("words").alias("n")).distinct(), rows.select("window", "item_id").distinct()


def _positions(docs: DataFrame, sizes: list[int], raw: bool) -> DataFrame:
    """A row per document and place: -1, which has no key, and the place of every word.

    Keys are made from words with A-Z lower-cased before the text is split, as those of windows are. What ``lower``
    makes of a word can depend on the text around it (final sigma).
    """
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id"),
        F.xxhash64(text).alias("text_key"),
        raw_words(plain_case(text)).alias("low"),
        (raw_words(text) if raw else F.lit(None)).alias("raw"),
    )
    rows = rows.select("*", F.explode(F.sequence(F.lit(-1), F.size("low") - 1)).alias("at"))
    keys = F.array(*[_key(F.col("low"), F.col("at"), n) for n in sizes])
    none = F.array(F.lit(None).cast("long"))
    if len(sizes) == 1:
        return rows.withColumn("key", F.when(F.col("at") >= 0, _key(F.col("low"), F.col("at"), sizes[0])))
    return rows.withColumn("key", F.explode(F.when(F.col("at") >= 0, keys).otherwise(none)))


def rarest_shingles(windows: DataFrame, docs: DataFrame, most_rows: int = MOST_BROADCAST_ROWS) -> tuple[DataFrame, list[int]]:
    """(window, n, key, place) of each window's rarest shingle over all documents, and the shingle sizes."""
    sized = windows.withColumn("size", F.least(F.lit(SHINGLE), "n"))
    sizes = sorted(r.size_ for r in sized.select(F.col("size").alias("size_")).distinct().collect())  # at most 3
    shingles = None
    for size in sizes:
        some = sized.filter(F.col("size") == size).withColumn("place", F.explode(F.expr(f"sequence(0, n - {size})")))
        some = some.select("window", "n", "place", _key(F.col("words"), F.col("place"), size).alias("key"))
        shingles = some if shingles is None else shingles.unionByName(some)
    if shingles is None:
        return windows.selectExpr("window", "n", "0L as key", "0 as place").limit(0), [SHINGLE]
    shingles = materialize(shingles, "window-shingles")
    keys = materialize(shingles.select(F.col("key").alias("k")).distinct(), "shingle-keys")
    keys = F.broadcast(keys) if keys.count() <= most_rows else keys
    seen = _positions(docs, sizes, raw=False).select("key").join(keys, F.col("key") == F.col("k"))
    counts = seen.groupBy("k").agg(F.count("*").alias("times"))
    counted = shingles.join(counts, F.col("key") == F.col("k"), "left").withColumn("times", F.coalesce("times", F.lit(0)))
    best = counted.groupBy("window", "n").agg(F.min(F.struct("times", "place", "key")).alias("best"))
    return best.select("window", "n", F.col("best.key").alias("key"), F.col("best.place").alias("place")), sizes


def find_windows(docs: DataFrame, prefixes: DataFrame, sizes: list[int], most_rows: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_key, at, n_words, begin, n, window): per row at -1, and per occurrence of a window."""
    prefixes = materialize(prefixes, "prefixes").select(F.col("key").alias("k"), "place", "n", "window")
    columns = ["doc_id", "text_key", "at", "n_words", "begin", "n", "window"]
    begin = (F.col("at") - F.col("place")).alias("begin")
    bounds = (F.col("at") >= F.col("place")) & (F.col("at") - F.col("place") + F.col("n") <= F.size("low"))
    if prefixes.count() <= most_rows:
        same = plain_case(F.array_join(F.expr("slice(raw, at - place + 1, n)"), " ")) == F.col("window")
        rows = _positions(docs, sizes, raw=True)
        rows = rows.join(F.broadcast(prefixes), (F.col("key") == F.col("k")) & bounds & same, "left")
        rows = rows.filter("at < 0 or window is not null")
        return rows.withColumn("n_words", F.size("low")).withColumn("begin", begin).select(columns)
    # The places of candidates travel, and meet their document's words once more for the exact comparison.
    rows = _positions(docs, sizes, raw=False).select("doc_id", "text_key", "at", "key", F.size("low").alias("n_words"))
    met = rows.filter("at >= 0").join(prefixes, F.col("key") == F.col("k"))
    met = met.filter("at >= place and at - place + n <= n_words").select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "at", begin, "n", "window"
    )
    met = met.distinct()
    words = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), raw_words(text_or_empty()).alias("raw"))
    one = words.groupBy("doc_id", "text_key").agg(F.first("raw").alias("raw"))
    same = plain_case(F.array_join(F.expr("slice(raw, begin + 1, n)"), " ")) == F.col("window")
    hits = met.join(one, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_key"))).filter(same)
    hits = hits.withColumn("n_words", F.lit(0)).select(columns)
    return rows.filter("at < 0").selectExpr("doc_id", "text_key", "at", "n_words", "null as begin", "null as n", "null as window").unionByName(hits)


def contamination(docs: DataFrame, benchmark: DataFrame, most_rows: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) per document row of (doc_id, text), for items (item_id, text).

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` are the sorted item_ids (as
    strings) of windows that occur, ``spans`` the sorted merged (begin, end) places of hit words. Null and
    wordless texts have no words and no hits; items without words have no windows; windows of items without
    an id count as hits but name no item. Repeated rows come back repeated; rows of one doc_id with different
    texts are judged apart. Other columns are ignored. No documents give no rows.
    """
    windows, owners = item_windows(benchmark)
    windows = materialize(windows, "distinct-windows")
    prefixes, sizes = rarest_shingles(windows, docs, most_rows)
    found = materialize(find_windows(docs, prefixes, sizes, most_rows), "hits")
    key = ["doc_id", "text_key"]
    # What a document holds is bounded by its length.
    begins = F.collect_set(F.when(F.col("at") >= 0, F.struct("begin", "n")))
    places = found.groupBy(key).agg(
        F.count_if(F.col("at") < 0).alias("copies"), F.max("n_words").alias("n_words"), F.array_sort(begins).alias("hits")
    )
    pairs = found.filter("at >= 0").select(*key, "window").distinct().join(owners.withColumnRenamed("window", "w"), F.col("window") == F.col("w"))
    items = pairs.groupBy(key).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    items = items.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "items")
    rows = places.join(items, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    hit = F.expr("size(array_distinct(flatten(transform(hits, x -> sequence(x.begin, x.begin + x.n - 1)))))")
    merged = F.expr(
        "aggregate(hits, cast(array() as array<struct<begin: int, end: int>>), (spans, x) -> "
        "if(size(spans) > 0 and x.begin <= element_at(spans, -1).end, "
        "concat(slice(spans, 1, size(spans) - 1), array(named_struct('begin', element_at(spans, -1).begin, "
        "'end', greatest(element_at(spans, -1).end, x.begin + x.n)))), "
        "concat(spans, array(named_struct('begin', x.begin, 'end', x.begin + x.n)))))"
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        merged.alias("spans"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) in which no window of the benchmark occurs, unchanged."""
    windows, _ = item_windows(benchmark)
    windows = materialize(windows, "distinct-windows")
    prefixes, sizes = rarest_shingles(windows, docs)
    hits = find_windows(docs, prefixes, sizes).filter("at >= 0").selectExpr("doc_id as _hit_doc", "text_key as _hit_text").distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_hit_doc")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_hit_text"))
    return docs.join(hits, same, "left_anti")
