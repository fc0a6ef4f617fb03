"""Order-preserving bins for exact rank statistics.

Exact quantiles and exact AUC need running counts over a sorted column.  A window
without a partition would pull that column into one task.  Instead the values are
cut at approximate quantiles into many bins; running counts are taken inside each
bin, and the few bin totals are summed up afterwards.  The cut points only balance
the work: the results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INF = float("inf")
MOST_BINS = 10_000
MOST_ACCURATE = 65_535  # the largest size parameter a sketch takes
MERGE_GROUPS = 256


def bin_count(spark: SparkSession) -> int:
    """As many bins as shuffle partitions, within bounds that keep bin totals small."""
    return max(64, min(MOST_BINS, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def add_order_bins(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = "_bin",
    bins: int | None = None,
    common: bool = False,
):
    """Add ``<column><suffix>``: bin numbers that rise with the (double) column.

    Runs one pass over ``df`` for the quantile sketches; only the cut points come back.  With
    ``common`` also returns the values of the first column that are a cut point more than once.
    """
    bins = bins or bin_count(df.sparkSession)
    cuts = _cut_points(df, columns, bins)
    splits = [[-INF, *_inner(c), INF] for c in cuts]
    names = [c + suffix for c in columns]
    binned = Bucketizer(
        inputCols=list(columns), outputCols=names, splitsArray=splits, handleInvalid="keep"
    ).transform(df)
    binned = binned.withColumns({n: F.col(n).cast("int") for n in names})
    if not common:
        return binned
    return binned, sorted({a for a, b in pairwise(sorted(cuts[0])) if a == b})


def _cut_points(df: DataFrame, columns: Sequence[str], bins: int) -> list[Sequence[float]]:
    """About equally spaced quantiles of every column.

    The sketches of the tasks are merged in groups first, so that no task has to take
    the sketches of all of them.
    """
    shares = F.lit([i / bins for i in range(1, bins)])
    accuracy = F.lit(min(MOST_ACCURATE, 16 * bins))
    tasks = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("_tasks")
    sketches = df.groupBy(tasks).agg(
        *[F.kll_sketch_agg_double(c, accuracy).alias(c) for c in columns]
    )
    merged = sketches.agg(*[F.kll_merge_agg_double(c, accuracy).alias(c) for c in columns])
    cuts = merged.select(
        *[
            F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, shares))
            for c in columns
        ]
    ).first()
    return [c or [] for c in cuts]


def _inner(cuts: Sequence[float]) -> list[float]:
    return sorted({c for c in cuts if -INF < c < INF}) or [0.0]
