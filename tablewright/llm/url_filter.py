"""URL filter: path rules first, then naive Bayes over the words of hosts and paths.

Names such as ``cheappillsonline`` are split into words by a unigram Viterbi: the split of highest
probability under word counts of a corpus. A multinomial naive Bayes over these words of host and path
then says whether a url is to be blocked.

Everything is computed on distinct names, hosts and path shapes; pages only look up their two scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_arrow

from tablewright.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed seed words: urls whose host or path has one are the labelled examples of the class to block.
SEED_WORDS = (
    "adult porn sex xxx casino poker bet bets betting gambling jackpot slots lottery viagra cialis pills "
    "pharmacy spam ads adserver track tracker tracking malware phishing warez torrent escort dating loan loans payday"
).split()

#: Seed words count as seen so often in the corpus, which may not hold them.
SEED_COUNT = 1000


#: Added to every token's count when those of an example add up to one.
EVEN_ALPHA = 0.02


class Rule(NamedTuple):
    """``pattern`` is a host, then a path prefix that starts with ``/``; it holds for subdomains too."""

    pattern: str
    verdict: str


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], value: str) -> Column:
    """``pattern`` or ``verdict`` of the longest rule that fits, else null; of equal rules the first."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.pattern)):
        name, slash, prefix = rule.pattern.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def corpus_words(docs: DataFrame, column: str = "text") -> DataFrame:
    """(word, n) of the lower-case a-z words; null texts have none."""
    words = F.split(F.translate(F.coalesce(F.col(column).cast("string"), F.lit("")), UPPER, LOWER), "[^a-z]+")
    rows = docs.select(F.explode(words).alias("word")).filter("word <> ''")
    return rows.groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """Most probable words that add up to ``name``; of equal splits the one whose last words are longest.

    An unseen word of k letters has probability 10 / (total * 10 ** k), so it costs more than seen words.
    Of all unseen last words, the best begins where the split before it lost least for each letter, so only
    that one is tried, and words of any length are allowed.
    """
    each, unseen = math.log(10), math.log(10 / total)
    sizes = sorted({len(w) for w in counts}, reverse=True)
    best, back = [0.0], [0]
    lead, lead_at = 0.0, 0
    for end in range(1, len(name) + 1):
        top, start = best[lead_at] + unseen - (end - lead_at) * each, lead_at
        for size in sizes:
            begin = end - size
            n = counts.get(name[begin:end], 0) if begin >= 0 else 0
            if n:
                p = best[begin] + math.log(n / total)
                if p > top or (p == top and begin < start):
                    top, start = p, begin
        best.append(top)
        back.append(start)
        if top + end * each > lead:
            lead, lead_at = top + end * each, end
    words, end = [], len(name)
    while end:
        words.append(name[back[end] : end])
        end = back[end]
    return words[::-1]


def split_names(names: DataFrame, words: DataFrame, known: Sequence[str] = SEED_WORDS) -> DataFrame:
    """(name, words) for distinct a-z ``names``, each split by the counts of ``words`` (word, n).

    The model never leaves the cluster whole: every name meets the counts of its own substrings of those
    lengths that words have; the driver sees these lengths, no more than the longest name has letters.
    ``known`` words count SEED_COUNT more.
    """
    total = (words.agg(F.sum("n")).first()[0] or 0) + SEED_COUNT * len(known)
    extra = names.sparkSession.createDataFrame([(w, SEED_COUNT) for w in known], "word string, n long")
    model = words.unionByName(extra).groupBy("word").agg(F.sum("n").alias("n"))
    longest = names.agg(F.max(F.length("name"))).first()[0] or 0
    lengths = model.select(F.length("word").alias("size")).distinct().filter(F.col("size") <= longest)
    sizes = F.array(*(F.lit(r.size) for r in lengths.orderBy("size").collect())).cast("array<int>")
    parts = names.select("name", F.explode(sizes).alias("size")).filter("size <= length(name)")
    parts = parts.withColumn("begin", F.explode(F.sequence(F.lit(1), F.length("name") - F.col("size") + 1)))
    parts = parts.select("name", F.expr("substring(name, begin, size)").alias("word"))
    seen = parts.distinct().join(model, "word").groupBy("name")
    seen = seen.agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("counts"))
    rows = names.join(seen, "name", "left").select("name", "counts")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                split_name(name, dict(counts or ()), max(total, 1))
                for name, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["name", "words"])

    return map_arrow(rows, split, "name string, words array<string>")


def name_tokens(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, tokens) of distinct hosts and path shapes: the words of their a-z runs, in order, as often as they occur.

    A run of digits, or the ``#`` of a shape, is the token ``#``; a run beyond ASCII is a token as it is.
    """
    found = F.regexp_extract_all(F.col("name"), F.lit(r"([a-z]+|[0-9#]+|[^\x00-\x7F]+)"), F.lit(1))
    runs = names.select("name", F.posexplode(found).alias("at", "run"))
    split = split_names(runs.filter("run rlike '^[a-z]'").select(F.col("run").alias("name")).distinct(), words)
    placed = runs.join(split.withColumnRenamed("name", "run"), "run", "left")
    other = F.when(F.col("run").rlike("^[0-9#]"), F.lit("#")).otherwise(F.col("run"))
    placed = placed.withColumn("words", F.coalesce("words", F.array(other)))
    placed = placed.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
    found = placed.select("name", F.flatten(F.col("parts.words")).alias("tokens"))
    return names.select("name").join(found, "name", "left").select(
        "name", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")
    )


def path_shape(path: Column) -> Column:
    """The lower-cased path with every run of digits as ``#``."""
    return F.regexp_replace(F.translate(path, UPPER, LOWER), "[0-9]+", "#")


def fit_naive_bayes(examples: DataFrame, alpha: float = 1.0, even: bool = False) -> tuple[DataFrame, float]:
    """Log odds of each token, and the prior log odds, from (tokens, weight, blocked) rows.

    Multinomial with ``alpha`` added to every count. Without examples of one of the classes the prior is
    their counts plus ``alpha``, too. Null tokens count nothing. If ``even``, the counts of an example are divided
    by their sum, so that one of thousands of tokens does not outweigh all others.
    """
    sums = examples.groupBy("blocked").agg(F.sum("weight").alias("n"))
    prior = {r.blocked: r.n for r in sums.collect()}  # two rows
    weight = F.col("weight") / F.size("tokens") if even else F.col("weight")
    counts = examples.select(weight.alias("weight"), "blocked", F.explode("tokens").alias("token")).filter("token is not null")
    counts = counts.groupBy("token").agg(
        F.sum(F.when(F.col("blocked"), F.col("weight")).otherwise(0)).alias("bad"),
        F.sum(F.when(~F.col("blocked"), F.col("weight")).otherwise(0)).alias("good"),
    )
    size, bad, good = counts.agg(F.count("*"), F.sum("bad"), F.sum("good")).first()
    bad, good = (bad or 0) + alpha * max(size, 1), (good or 0) + alpha * max(size, 1)
    odds = F.log((F.col("bad") + alpha) / F.lit(float(bad))) - F.log((F.col("good") + alpha) / F.lit(float(good)))
    return counts.select("token", odds.alias("odds")), math.log((prior.get(True, 0) + alpha) / (prior.get(False, 0) + alpha))


def token_odds(keys: DataFrame, key: str, odds: DataFrame) -> DataFrame:
    """(key, odds): sum of the log odds of the tokens of each distinct key; unknown tokens add nothing."""
    rows = keys.select(key, F.explode("tokens").alias("token")).groupBy(key, "token").agg(F.count("*").alias("n"))
    rows = rows.join(odds, "token").groupBy(key).agg(F.sum(F.col("n") * F.col("odds")).alias("odds"))
    return keys.select(key).join(rows, key, "left").select(key, F.coalesce("odds", F.lit(0.0)).alias("odds"))


def judge_urls(
    pages: DataFrame, docs: DataFrame, rules: Sequence[Rule], seeds: Sequence[str] = SEED_WORDS
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of (page_id, url).

    The verdict is that of the longest fitting rule, else ``block`` if naive Bayes finds the url's words
    more likely among urls with a seed word than among the others, else ``allow``. ``score`` is its log
    odds for block. Null urls and urls without ``://`` have an empty host and path and are allowed.
    Repeated rows are judged alike; other columns are ignored; no pages give no rows. Without ``docs``
    words, names are split by the seed words alone.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("shape", path_shape(F.col("path")))
    pairs = materialize(urls.groupBy("host", "shape").agg(F.count("*").alias("weight")), "url-shapes")
    words = materialize(corpus_words(docs), "corpus-words")
    names = materialize(pairs.select(F.explode(F.array("host", "shape")).alias("name")).distinct(), "names")
    tokens = materialize(name_tokens(names, words), "name-words")
    hosts = tokens.withColumnsRenamed({"name": "host", "tokens": "host_tokens"})
    shapes = tokens.withColumnsRenamed({"name": "shape", "tokens": "shape_tokens"})
    examples = pairs.join(hosts, "host").join(shapes, "shape").select("weight", F.concat("host_tokens", "shape_tokens").alias("tokens"))
    seeded = F.arrays_overlap("tokens", F.array(*map(F.lit, seeds)))
    odds, prior = fit_naive_bayes(examples.withColumn("blocked", F.coalesce(seeded, F.lit(False))), EVEN_ALPHA, even=True)
    odds = materialize(odds, "token-odds")
    by_name = materialize(token_odds(tokens, "name", odds), "name-odds")
    by_host = by_name.withColumnsRenamed({"name": "host", "odds": "host_odds"})
    by_shape = by_name.withColumnsRenamed({"name": "shape", "odds": "shape_odds"})
    scored = urls.join(by_host, "host").join(by_shape, "shape")
    host, path = F.col("host"), F.col("path")
    empty = (host == "") & (path == "")
    score = F.when(empty, F.lit(prior)).otherwise(F.col("host_odds") + F.col("shape_odds") + F.lit(prior))
    found = F.when((score > 0) & ~empty, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id",
        "host",
        "path",
        matching_rule(host, path, rules, "pattern").alias("rule"),
        F.coalesce(matching_rule(host, path, rules, "verdict"), found).alias("verdict"),
        score.alias("score"),
    )
