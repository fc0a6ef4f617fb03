"""Profiling: balance, co-occurrence, correlation, distribution and rates.

Result tables are small; the input is only ever aggregated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.gram import pair_correlations, wide_correlations
from tablewright.operators.joins import MOST_BROADCAST_ROWS
from tablewright.operators.order_bins import MOST_ACCURATE, bin_count
from tablewright.session import materialize


def _labels_set(labels: Sequence[str]) -> Column:
    """How many of the 0/1 label columns are set in a row, nulls counting as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in labels])


def has_label(labels: Sequence[str]) -> Column:
    """Whether any 0/1 label of a row is set."""
    return _labels_set(labels) > 0


def _long(df: DataFrame, columns: Sequence[str], names: tuple[str, str], keep=()) -> DataFrame:
    """One row per row and column: ``(*keep, name, value)``."""
    return df.unpivot(list(keep), list(columns), *names)


def _share_of_total(counts: DataFrame) -> Column:
    return F.col("n") / counts.agg(F.sum("n")).scalar()


# --- counts ----------------------------------------------------------------


def table_shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns, and the column names in order."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def class_balance(df: DataFrame, column: str) -> DataFrame:
    """Rows per class and their share of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", _share_of_total(counts))


def label_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Positives per label, fewest first."""
    sums = df.agg(*[F.sum(c).cast("bigint").alias(c) for c in labels])
    return _long(sums, labels, ("label", "positives")).orderBy("positives", "label")


def labels_per_row(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """How many rows carry 0, 1, 2, ... labels."""
    return (
        df.groupBy(_labels_set(labels).cast("int").alias("n_labels"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("n_labels")
    )


def any_label_share(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows without and with any label, and their percentages."""
    group = F.when(_labels_set(labels) > 0, F.lit("any label")).otherwise(F.lit("clean"))
    counts = df.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", 100 * _share_of_total(counts))


def rate_by_group(df: DataFrame, group: str, positive: Column) -> DataFrame:
    """Share of rows per group for which ``positive`` holds, lowest first."""
    return (
        df.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.when(positive, 1.0).otherwise(0.0)).alias("rate"),
        )
        .orderBy("rate", group)
    )


def text_length(df: DataFrame, text: str, name: str = "text_length") -> DataFrame:
    """Add the number of characters of a text column."""
    return df.withColumn(name, F.length(text))


# --- correlation -----------------------------------------------------------


# Up to so many pairs are one aggregation; more are matrix products.
FEW_PAIRS = 100


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, lower triangle, over the rows where both are present."""
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    if len(pairs) <= FEW_PAIRS:
        return _correlations(df, pairs)
    return pair_correlations(_numbers(df, columns), columns, columns, lower=True)


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, strongest first."""
    if len(columns) <= FEW_PAIRS:
        found = _correlations(df, [(c, target) for c in columns])
    else:
        found = pair_correlations(_numbers(df, [*columns, target]), columns, [target], lower=False)
    return found.select(F.col("row").alias("feature"), "corr").orderBy(
        F.abs("corr").desc(), "feature"
    )


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN as null."""
    plain = df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(columns)])
    return plain.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in plain.columns])


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    if not pairs:
        return df.sparkSession.createDataFrame([], "row string, col string, corr double")
    return wide_correlations(_numbers(df, [c for pair in pairs for c in pair]), pairs)


# --- exact quantiles -------------------------------------------------------
#
# Two passes over the rows.  The first takes the moments and a quantile sketch of every column and class.  A sketch
# bounds the value of a rank from both sides, so the second pass sends on only the values between such bounds;
# of the values in the gaps between them it counts and keeps the extremes.  Counts then show whether every wanted
# rank lies between its bounds.  A sketch that was less accurate than it should be costs another pass with wider
# bounds, never a wrong value.

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}

# Smallest size parameter of a sketch, and the share of ranks by which it may be wrong, three times over.
LEAST_ACCURATE = 4096
RANK_ERROR = 3 * 2.3

# Up to so many pieces are sorted by column and class alone.
MOST_SORTED_ROWS = 500_000


@dataclass(frozen=True)
class _Ranked:
    """What two passes find: moments, pieces ``(*by, _feature, _region, value, n, low, high)``, and quantiles."""

    moments: DataFrame
    pieces: DataFrame
    quantiles: DataFrame


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated quantiles: ``(*by, feature, <one column per name in probs>)``.

    Reads ``df`` twice.  Nulls and NaNs do not count; rows with a null in ``by`` are left out.
    """
    return _rank(df, columns, probs, by).quantiles


def _rank(
    df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = (), whiskers: bool = False
) -> _Ranked:
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    numbers = numbers.select(*by, *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in columns])
    for c in by:
        numbers = numbers.filter(F.col(c).isNotNull())
    size = max(LEAST_ACCURATE, min(MOST_ACCURATE, 16 * bin_count(df.sparkSession)))
    error = RANK_ERROR / size**0.9
    sketched = materialize(numbers.groupBy(*by).agg(*[_summary(c, size).alias(c) for c in columns]), "sketches")
    moments = sketched.select(*by, F.inline(F.array(*[_moments(c) for c in columns])))
    for margin in (error, 8 * error, 1.0):
        bounds = sketched.select(*by, *[_bounds(c, probs, margin, whiskers).alias(f"{c}_bounds") for c in columns])
        if not by or sketched.count() * len(columns) <= MOST_BROADCAST_ROWS:
            bounds = F.broadcast(bounds)
        pieces = materialize(_pieces(numbers, bounds, len(probs) + 2 * whiskers, columns, by), "pieces")
        found = materialize(_at_ranks(pieces, columns, by, probs), "quantiles")
        if found.filter(" or ".join(f"`{name}` is null" for name in probs)).isEmpty():
            break
    return _Ranked(moments, pieces, found)


def _summary(c: str, size: int) -> Column:
    return F.struct(
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.kll_sketch_agg_double(c, F.lit(size)).alias("sketch"),
    )


def _moments(c: str) -> Column:
    return F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}.{m}").alias(m) for m in ("n", "mean", "std", "min", "max")])


def _bounds(c: str, probs: Mapping[str, float], margin: float, whiskers: bool) -> Column:
    """``array(struct(low, high))``: between them lie the wanted ranks, and the ends of the whiskers."""

    def value(p: float, beyond: str) -> Column:
        if not 0 < p < 1:
            return F.col(f"{c}.{beyond}")
        return F.when(F.col(f"{c}.n") > 0, F.kll_sketch_get_quantile_double(f"{c}.sketch", F.lit(float(p))))

    found = {name: (value(p - margin, "min"), value(p + margin, "max")) for name, p in probs.items()}
    if whiskers:
        (a, b), (d, e) = found["q25"], found["q75"]

        def slack(x: Column, sign: int) -> Column:  # for the rounding of the ends themselves
            return x + sign * (F.abs(x) * 1e-9 + 1e-300)

        found["low end"] = (slack(2.5 * a - 1.5 * e, -1), slack(2.5 * b - 1.5 * d, 1))
        found["high end"] = (slack(2.5 * d - 1.5 * b, -1), slack(2.5 * e - 1.5 * a, 1))
    return F.array(*[F.struct(low.alias("low"), high.alias("high")) for low, high in found.values()])


def _pieces(numbers: DataFrame, bounds: DataFrame, n_bounds: int, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Counts of the values between bounds, each value for itself, and of the gaps, as wholes.

    A region is the number of bounds below the value, so regions rise with the values, and each lies between
    bounds or in a gap as a whole.
    """
    each = [F.struct(F.lit(i).alias("_feature"), F.col(f"{c}_bounds").alias("_bounds")) for i, c in enumerate(columns)]
    each = bounds.select(*by, F.inline(F.array(*each)))  # keeps the hint of a broadcast
    ends = [(f"_low{k}", f"_high{k}") for k in range(n_bounds)]
    each = each.select(*by, "_feature", *[F.col("_bounds")[k][x].alias(f"_{x}{k}") for k in range(n_bounds) for x in ("low", "high")])
    numbered = numbers.select(*by, *[F.col(c).alias(str(i)) for i, c in enumerate(columns)])
    long = numbered.unpivot(list(by), [str(i) for i in range(len(columns))], "_feature", "_v").filter(F.col("_v").isNotNull())
    long = long.withColumn("_feature", F.col("_feature").cast("int"))
    long = long.join(each, [*by, "_feature"])
    value = F.col("_v")
    below = sum(((value >= F.col(low)).cast("int") + (value > F.col(high)).cast("int") for low, high in ends), F.lit(0))
    kept = reduce(lambda x, y: x | y, [value.between(F.col(low), F.col(high)) for low, high in ends])
    long = long.select(*by, "_feature", below.alias("_region"), F.when(kept, value).alias("value"), "_v")
    return long.groupBy(*by, "_feature", "_region", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
    )


def _wanted(probs: Mapping[str, float]) -> Column:
    """The two neighbours of every quantile among ``total`` values: their ranks, and the weight of the upper one."""
    wanted = []
    for name, p in probs.items():
        position = (F.col("total") - 1).cast("double") * F.lit(float(p))
        weight = position - F.floor(position)
        for which, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            wanted.append(
                F.struct(
                    F.lit(name).alias("stat"), F.lit(which).alias("side"), rank.cast("bigint").alias("rank"), weight.alias("weight")
                )
            )
    return F.inline(F.array(*wanted))


def _holds(rank: str) -> Column:
    """Whether a row of ``n`` values, the last of them at ``upto``, holds a rank."""
    return (F.col(rank) >= F.col("upto") - F.col("n")) & (F.col(rank) < F.col("upto"))


def _at_ranks(pieces: DataFrame, columns: Sequence[str], by: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Quantiles from pieces; null where a wanted rank lies in a gap.

    Many pieces are first counted by region, and sorted inside regions only.
    """
    whole = Window.partitionBy(*by, "_feature")

    def ranked(rows: DataFrame, order: str) -> DataFrame:
        sums = [F.sum("n").over(whole.orderBy(order)).alias("upto"), F.sum("n").over(whole).alias("total")]
        return rows.select("*", *sums).select("*", _wanted(probs)).filter(_holds("rank"))

    if pieces.count() <= MOST_SORTED_ROWS:
        at_rank = ranked(pieces, "low")
    else:
        place = [*by, "_feature", "_region"]
        regions = ranked(pieces.groupBy(*place).agg(F.sum("n").alias("n")), "_region")
        offset = (F.col("rank") - F.col("upto") + F.col("n")).alias("offset")
        regions = regions.select(*place, "stat", "side", "weight", offset)
        upto = F.sum("n").over(Window.partitionBy(*place).orderBy("low"))
        at_rank = regions.join(pieces.withColumn("upto", upto), place).filter(_holds("offset"))

    def side(name: str, which: str) -> Column:
        hit = (F.col("stat") == name) & (F.col("side") == which)
        return F.max(F.when(hit, F.col("value")))

    def interpolated(name: str) -> Column:
        weight = F.max(F.when(F.col("stat") == name, F.col("weight")))
        low, high = side(name, "low"), side(name, "high")
        return (low + (high - low) * weight).alias(name)

    found = at_rank.groupBy(*by, "_feature").agg(*[interpolated(name) for name in probs])
    return found.select(*by, F.element_at(F.lit(list(columns)), F.col("_feature") + 1).alias("feature"), *probs)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles per column.

    Nulls and NaNs do not count.  Reads ``df`` twice.
    """
    found = _rank(df, columns, QUARTILES)
    # Both sides hold one row per profiled column.
    return found.moments.join(F.broadcast(found.quantiles), "feature", "left").select(
        "feature", "n", "mean", "std", "min", *QUARTILES, "max"
    )


def five_number_by_class(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Box-plot numbers of each column per class.

    Whiskers reach to the last value within 1.5 times the inter-quartile range of the
    box; values beyond them are counted as outliers.  Reads ``df`` twice: the ends of the
    whiskers lie between bounds of their own, so each gap is inside or outside as a whole.
    """
    found = _rank(df, columns, QUARTILES, [by], whiskers=True)
    feature = F.element_at(F.lit(list(columns)), F.col("_feature") + 1).alias("feature")
    pieces = found.pieces.select(by, feature, "n", "low", "high")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("low").between(F.col("q25") - reach, F.col("q75") + reach)
    return pieces.join(found.quantiles, [by, "feature"]).groupBy(by, "feature", *QUARTILES).agg(
        F.sum("n").alias("n"),
        F.min(F.when(inside, F.col("low"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("high"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
    )


# --- histograms ------------------------------------------------------------


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    low: float | None = None,
    high: float | None = None,
    by: str | None = None,
    own_range: bool = False,
) -> DataFrame:
    """Equal-width bins with their counts, empty bins included: ``([by], bin, low, high, n)``.

    Without bounds the range of the data is used.  Values outside the bounds do not
    count, nor do NaNs; the last bin includes its upper end.  With ``own_range`` every
    group of ``by`` has the bins of its own range.
    """
    keep = [by] if by else []
    numbers = df.select(*keep, F.col(column).cast("double").alias("value"))
    numbers = numbers.filter(~F.isnan("value"))
    if own_range:
        return _own_bins(numbers, keep, bins)
    if low is None or high is None:
        ends = numbers.agg(F.min("value"), F.max("value")).first()
        low = ends[0] if low is None else low
        high = ends[1] if high is None else high
        if low is None:
            low, high = 0.0, 1.0
    low, high = float(low), float(high)
    if high <= low:  # a single value sits in the middle of a range of width one
        low, high = low - 0.5, low + 0.5
    return _fixed_bins(numbers, keep, bins, low, high)


def _own_bins(numbers: DataFrame, keep, bins: int) -> DataFrame:
    """Bin counts per group, each group cut at its own range."""
    ends = numbers.filter("value is not null").groupBy(*keep).agg(
        F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    single = F.col("_low") == F.col("_high")
    ends = ends.select(
        *keep,
        F.when(single, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"),
        F.when(single, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("_high"),
    )
    ends = materialize(ends, "ranges")
    width = (F.col("_high") - F.col("_low")) / bins
    place = F.least(F.floor((F.col("value") - F.col("_low")) / width).cast("int"), F.lit(bins - 1))
    found = numbers.filter("value is not null").join(ends, keep).groupBy(*keep, place.alias("bin"))
    found = found.agg(F.count(F.lit(1)).alias("n"))
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(found, [*keep, "bin"], "left").select(
        *keep,
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("low"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _fixed_bins(numbers: DataFrame, keep, bins: int, low: float, high: float) -> DataFrame:
    """Bin counts of the column ``value`` per ``keep`` group, zeros filled in."""
    width = (high - low) / bins
    place = F.least(F.floor((F.col("value") - low) / F.lit(width)).cast("int"), F.lit(bins - 1))
    found = (
        numbers.filter(F.col("value").between(low, high))
        .groupBy(*keep, place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most one entry per bin, so a group's counts fit in one row.
    entries = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    filled = (
        found.groupBy(*keep)
        .agg(entries.alias("counts"))
        .select(*keep, "counts", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .withColumn("n", F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0)))
    )
    return filled.select(
        *keep,
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        "n",
    )


def probability_distribution(
    df: DataFrame, bins: int = 30, prefix: str = "proba_"
) -> DataFrame:
    """Histogram over 0..1 of every ``proba_<label>`` column: ``(label, bin, low, high, n)``."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    scores = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = _long(scores, columns, ("column", "value")).select(
        F.regexp_replace("column", f"^{prefix}", "").alias("label"), "value"
    )
    return _fixed_bins(long, ["label"], bins, 0.0, 1.0)
