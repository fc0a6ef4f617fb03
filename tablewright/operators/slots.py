"""Feature vectors put together on the cluster: categories live in a written table, never on the driver.

The numbers come first, then the categories of each column from most to least frequent, as in
``features.table_stages``, whose stages hold every category in the driver's memory.  Here the driver knows how many
slots each column has and nothing else.  Categories of fewer than ``least_count`` training rows share one slot per
column, which bounds the model by the rows: a column of n rows has at most ``n / least_count + 1`` slots.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.features import category_counts, number_categories
from tablewright.operators.joins import MOST_BROADCAST_ROWS
from tablewright.session import file_by_file, materialize, scratch_path

#: Most frequent categories of a column with a large dictionary, which are broadcast.
COMMON = 1000

#: Bytes of memory for an entry of a sparse vector, and for the rest of a row, in a fit.
ENTRY_BYTES = 12
ROW_BYTES = 24

#: Bytes of memory for the rows that one task of a fit keeps.
FIT_TASK_BYTES = 64 * 1024 * 1024

#: Name of the slot that rare categories share. A fixed word, so that reports can show it.
RARE = "(rare)"


@dataclass(frozen=True)
class SlotStages:
    """Slots for categories and numbers, to be fitted on training rows."""

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    least_count: int = 1
    most_broadcast_rows: int = MOST_BROADCAST_ROWS

    def fit(self, train: DataFrame) -> Slots:
        counts = category_counts(train, self.categorical).withColumn("part", F.lit("0"))
        return self._number(counts, 1)[0]

    def fit_folds(self, df: DataFrame, fold: str, folds: int) -> list[Slots]:
        """The slots of the training rows of each fold, then those of all rows, from one count of the categories."""
        counts = category_counts(df, self.categorical, [fold])
        sums = [F.sum(F.when(F.col(fold) != k, F.col("n"))).alias(str(k)) for k in range(folds)]
        wide = counts.groupBy("column", "category").agg(*sums, F.sum("n").alias(str(folds)))
        parts = [str(k) for k in range(folds + 1)]
        return self._number(wide.unpivot(["column", "category"], parts, "part", "n").filter("n > 0"), folds + 1)

    def _number(self, counts: DataFrame, parts: int) -> list[Slots]:
        """From ``(part, column, category, n)``. A row per part and column comes to the driver."""
        dictionary = materialize(number_categories(counts, ["part"]), "dictionary")
        often = F.col("n") >= self.least_count
        sums = dictionary.groupBy("part", "column").agg(F.count_if(often).alias("often"), F.count_if(~often).alias("rare"))
        sizes = {(r["part"], r["column"]): (r["often"], r["rare"]) for r in sums.collect()}
        out = []
        for part in map(str, range(parts)):
            first, columns = len(self.numeric), []
            for c in self.categorical:
                often, rare = sizes.get((part, c), (0, 0))
                columns.append((c, first, often, often + rare))
                first += often + min(rare, 1)
            out.append(Slots(self, dictionary.filter(F.col("part") == part), tuple(columns), first))
        return out


@dataclass(frozen=True)
class Slots:
    """Fitted slots: a dictionary ``(column, category, n, idx)`` and, by column, first slot, own slots, categories."""

    stages: SlotStages
    dictionary: DataFrame
    columns: tuple[tuple[str, int, int, int], ...]
    size: int

    def _lookup(self, column: str) -> DataFrame:
        """``(category, slot)`` of a column; rare categories, which come last, share the slot after the others."""
        _, first, often, _ = next(c for c in self.columns if c[0] == column)
        mine = self.dictionary.filter(F.col("column") == column)
        slot = (F.least(F.col("idx"), F.lit(often)) + first).cast("int")
        return mine.select("category", slot.alias("slot"), "idx")

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        """``df`` with a vector column, written. Unseen and null categories set no slot; a null number is an error.

        The vectors of a task that reads the table take at most ``FIT_TASK_BYTES``, however few they take there.
        """
        columns = df.columns
        small = [c for c, _, _, n in self.columns if n <= self.stages.most_broadcast_rows]
        large = [c for c, _, _, n in self.columns if n > self.stages.most_broadcast_rows]
        rows = df
        for i, c in enumerate(small):
            known = F.broadcast(self._lookup(c).select(F.col("category").alias(f"_key{i}"), F.col("slot").alias(f"_slot_{c}")))
            rows = rows.join(known, F.col(c).cast("string") == F.col(f"_key{i}"), "left").drop(f"_key{i}")
        if large:
            rows = self._join_large(rows, large)

        def number(c: str) -> Column:
            missing = F.raise_error(F.lit(f"null in feature column {c}")).cast("double")
            return F.coalesce(F.col(c).cast("double"), missing)

        set_slots = F.array(*[F.col(f"_slot_{c}") for c, *_ in self.columns])
        if self.columns:  # few rows lack a slot, and taking nulls out is not compiled
            missing = reduce(lambda a, b: a | b, [F.col(f"_slot_{c}").isNull() for c, *_ in self.columns])
            set_slots = F.when(missing, F.array_compact(set_slots)).otherwise(set_slots)
        numbers = F.array(*[number(c) for c in self.stages.numeric]).cast("array<double>")
        ones = F.array_repeat(F.lit(1.0), F.size(set_slots))
        vector = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(self.size).alias("size"),
            F.concat(F.lit(list(range(len(self.stages.numeric)))).cast("array<int>"), set_slots.cast("array<int>")).alias("indices"),
            F.concat(numbers, ones).alias("values"),
        )
        most = (len(self.stages.numeric) + len(self.stages.categorical)) * ENTRY_BYTES + ROW_BYTES
        return _as_vectors(rows.select(*columns, vector.alias(name)), name, max(1, FIT_TASK_BYTES // most))

    def _join_large(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Adds ``_slot_<column>`` of columns whose dictionaries are too large to broadcast.

        Rows get a number and are written; only (number, column, category) of categories that are not common is
        shuffled to the dictionary, and the slots found go back to their rows by number.
        """
        rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
        cells = [F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("category")) for c in columns]
        long = rows.select("_row", F.inline(F.array(*cells))).filter("category is not null")
        known = [self._lookup(c).withColumn("_column", F.lit(c)) for c in columns]
        known = reduce(lambda a, b: a.unionByName(b), known)
        keys = ["_column", "category"]
        common = F.broadcast(known.filter(F.col("idx") < COMMON).drop("idx"))
        found = long.join(common, keys).unionByName(
            long.join(common.drop("slot"), keys, "left_anti").join(known.filter(F.col("idx") >= COMMON).drop("idx"), keys)
        )
        each = [F.max(F.when(F.col("_column") == c, F.col("slot"))).alias(f"_slot_{c}") for c in columns]
        return rows.join(found.groupBy("_row").agg(*each), "_row", "left").drop("_row")

    def names(self) -> DataFrame:
        """``(slot, name)`` of every slot, as a table."""
        spark = self.dictionary.sparkSession
        numeric = spark.createDataFrame(list(enumerate(self.stages.numeric)), "slot int, name string")
        parts = [numeric]
        for c, first, often, categories in self.columns:
            # Fixed part of a name, as the stages of pyspark.ml write it.
            own = F.concat(F.lit(f"{c}_vec_"), F.col("category"))
            parts.append(self._lookup(c).filter(F.col("idx") < often).select("slot", own.alias("name")))
            if categories > often:
                parts.append(spark.createDataFrame([(first + often, f"{c}_vec_{RARE}")], "slot int, name string"))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def coefficients(self, model: Model) -> DataFrame:
        """``(feature, coefficient)`` with an ``intercept`` row; names meet the model's weights on the cluster."""
        spark = self.dictionary.sparkSession
        values = model.coefficients.toArray()
        weights = pa.table({"slot": pa.array(range(len(values)), pa.int32()), "coefficient": values})
        named = spark.createDataFrame(weights).join(self.names(), "slot")
        last = spark.createDataFrame([("intercept", float(model.intercept))], "feature string, coefficient double")
        return named.select(F.col("name").alias("feature"), "coefficient").unionByName(last)


def _as_vectors(df: DataFrame, name: str, task_rows: int) -> DataFrame:
    """Writes the struct of a sparse vector, and reads it as the vector that files hold in this form."""
    spark = df.sparkSession
    path = scratch_path(spark, "vectors")
    df.write.option("maxRecordsPerFile", task_rows).parquet(path)
    fields = [T.StructField(name, VectorUDT()) if f.name == name else f for f in df.schema]
    return file_by_file(spark).read.schema(T.StructType(fields)).parquet(path)
