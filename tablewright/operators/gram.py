"""Cross-product sums of many columns, a block of columns against a block of columns at a time.

Every task adds up, over its rows, one small matrix per sum; rows are never multiplied.  The matrices of the
tasks are merged by pair of columns.  This is the one place of the table part where numpy runs inside tasks: sums
over all pairs of a thousand columns are matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import union_all
from tablewright.session import share_package

#: Columns of a block: its sums take seven matrices of this size squared.
BLOCK = 1024

#: Rows that choose the origin of the sums; any origin is right, a near one keeps the sums small.
ROWS_FOR_ORIGIN = 1000

SUMS = ("n", "sa", "sb", "qa", "qb", "ab", "endless")


def pair_correlations(numbers: DataFrame, rows: Sequence[str], cols: Sequence[str], lower: bool) -> DataFrame:
    """``(row, col, corr)`` of columns of doubles, over the rows where both are present; null if it does not exist.

    ``lower`` takes each pair of ``rows`` once, the later column as ``row``; ``cols`` is then the same list.
    Beyond ``BLOCK`` columns there is a pass per pair of blocks.
    """
    used = list(dict.fromkeys([*rows, *cols]))
    near = numbers.limit(ROWS_FOR_ORIGIN).agg(*[F.avg(F.when(F.abs(c) < float("inf"), F.col(c))).alias(c) for c in used])
    origin = {c: v or 0.0 for c, v in near.first().asDict().items()}
    # More tasks than this only make more matrices to merge.
    tasks = numbers.coalesce(2 * numbers.sparkSession.sparkContext.defaultParallelism)
    blocks = [
        _block_sums(tasks, rows, cols, range(i, min(i + BLOCK, len(rows))), range(j, min(j + BLOCK, len(cols))), origin, lower)
        for i in range(0, len(rows), BLOCK)
        for j in range(0, len(cols), BLOCK)
        if not lower or j <= i
    ]
    sums = union_all(*blocks).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in SUMS])
    n = F.col("n")
    spread = [F.col(q) - F.col(s) * F.col(s) / n for q, s in (("qa", "sa"), ("qb", "sb"))]
    corr = (F.col("ab") - F.col("sa") * F.col("sb") / n) / F.sqrt(spread[0] * spread[1])
    # What rounding leaves of a constant column is no spread.
    real = [v > 1e-13 * F.col(q) for v, q in zip(spread, ("qa", "qb"), strict=True)]
    known = (F.col("endless") == 0) & (n > 0) & real[0] & real[1]
    names = [F.element_at(F.lit(list(c)), F.col(i) + 1).alias(name) for c, i, name in ((rows, "a", "row"), (cols, "b", "col"))]
    return sums.select(*names, F.when(known, corr).alias("corr"))


def _block_sums(
    numbers: DataFrame, rows: Sequence[str], cols: Sequence[str], a: range, b: range, origin: dict[str, float], lower: bool
) -> DataFrame:
    """``(a, b, *SUMS)``: the sums of each task for the pairs of two blocks of columns, from their origins."""
    left, right = [rows[i] for i in a], [cols[j] for j in b]
    used = list(dict.fromkeys([*left, *right]))
    at = {c: i for i, c in enumerate(used)}
    of_a, of_b = [at[c] for c in left], [at[c] for c in right]
    zero = np.array([origin[c] for c in used])
    wanted = [(i, j) for i in a for j in b if not lower or j < i]
    if not wanted:
        return numbers.sparkSession.createDataFrame([], _schema())
    pair_a, pair_b = (np.array(x, np.int32) for x in zip(*wanted, strict=True))
    places = pair_a - a.start, pair_b - b.start
    share_package(numbers.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), len(left), len(right)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            endless = np.isinf(x)
            has = ~np.isnan(x)
            x = np.where(has & ~endless, x - zero, 0.0)
            xa, xb = x[:, of_a], x[:, of_b]
            total[5] += xa.T @ xb
            if has.all():  # then all sums but the products are those of single columns
                total[0] += len(x)
                total[1] += xa.sum(axis=0)[:, None]
                total[2] += xb.sum(axis=0)
                total[3] += (xa * xa).sum(axis=0)[:, None]
                total[4] += (xb * xb).sum(axis=0)
            else:
                ha, hb = has[:, of_a].astype(float), has[:, of_b].astype(float)
                for i, (u, v) in enumerate(((ha, hb), (xa, hb), (ha, xb), (xa * xa, hb), (ha, xb * xb))):
                    total[i] += u.T @ v
            if endless.any():
                ea, eb = endless[:, of_a].astype(float), endless[:, of_b].astype(float)
                total[6] += ea.T @ has[:, of_b] + has[:, of_a].T @ eb
        sums = [t[places] for t in total]
        yield pa.record_batch([pa.array(pair_a), pa.array(pair_b), *map(pa.array, sums)], names=["a", "b", *SUMS])

    return numbers.select(*used).mapInArrow(run, _schema())


def _schema() -> str:
    return "a int, b int, " + ", ".join(f"{c} double" for c in SUMS)


def wide_correlations(numbers: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The same for few pairs, as one aggregation without Python."""

    def corr(a: str, b: str) -> Column:
        return F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b)))

    found = numbers.agg(*[corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.when(~F.isnan(f"_{i}"), F.col(f"_{i}")).alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return found.select(F.inline(F.array(*cells)))
