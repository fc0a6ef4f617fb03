import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import profile
from tablewright.operators.order_bins import add_order_bins


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(7)
    n = 3001
    frame = pd.DataFrame(
        {
            "g": rng.choice(["a", "b"], n, p=[0.9, 0.1]),
            "x": np.where(rng.random(n) < 0.35, 5.0, rng.normal(size=n)),
            "y": rng.integers(0, 7, n).astype(float),
        }
    )
    return frame


def test_quantiles_equal_pandas(spark, numbers):
    rows = spark.createDataFrame(numbers)
    probs = {"p0": 0.0, "p1": 0.01, "p33": 0.333, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = profile.quantiles(rows, ["x", "y"], probs, ["g"]).collect()
    assert len(got) == 4
    for row in got:
        column = numbers[numbers.g == row["g"]][row["feature"]]
        for name, p in probs.items():
            assert row[name] == pytest.approx(column.quantile(p), abs=1e-12)


def test_quantiles_do_not_depend_on_bins_or_partitions(spark, numbers, monkeypatch):
    rows = spark.createDataFrame(numbers)
    expected = sorted(profile.quantiles(rows, ["x"], profile.QUARTILES).collect())
    for bins in (2, 3, 1000):
        monkeypatch.setattr("tablewright.operators.order_bins.bin_count", lambda _, b=bins: b)
        again = profile.quantiles(rows.repartition(13), ["x"], profile.QUARTILES)
        assert sorted(again.collect()) == expected


def test_quantiles_skip_nulls_and_nans(spark):
    rows = spark.createDataFrame(
        [(1.0, None), (float("nan"), 2.0), (3.0, 4.0), (None, None)], "x double, y double"
    )
    got = {r["feature"]: r["m"] for r in profile.quantiles(rows, ["x", "y"], {"m": 0.5}).collect()}
    assert got == {"x": 2.0, "y": 3.0}


def test_quantiles_of_constant_and_empty(spark):
    rows = spark.createDataFrame([(2.0, None), (2.0, None)], "x double, y double")
    got = profile.quantiles(rows, ["x", "y"], {"m": 0.5}).collect()
    assert [(r["feature"], r["m"]) for r in got] == [("x", 2.0)]


def test_bounds_that_miss_their_rank_are_widened(spark, numbers, monkeypatch):
    """Sketches worse than they should be cost passes, not right values."""
    rows = spark.createDataFrame(numbers)
    want = sorted(profile.five_number_by_class(rows, ["x", "y"], "g").collect())
    monkeypatch.setattr(profile, "MOST_SORTED_ROWS", 0)
    assert sorted(profile.five_number_by_class(rows, ["x", "y"], "g").collect()) == want
    monkeypatch.setattr(profile, "LEAST_ACCURATE", 8)
    monkeypatch.setattr(profile, "MOST_ACCURATE", 8)
    monkeypatch.setattr(profile, "RANK_ERROR", 1e-6)
    assert sorted(profile.five_number_by_class(rows, ["x", "y"], "g").collect()) == want
    assert sorted(profile.quantiles(rows, ["x"], profile.QUARTILES).collect())[0]["q50"] == numbers["x"].median()


def test_profiles_do_not_copy_their_source(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(50_000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("x")).write.parquet(path)
    for profiled in (
        lambda df: profile.describe_numeric(df, ["x"]),
        lambda df: profile.five_number_by_class(df, ["x"], "k"),
    ):
        found = profiled(spark.read.parquet(path))
        # What the result still reads are the small tables of both passes, not the source.
        assert path not in found._jdf.queryExecution().executedPlan().toString()


def test_order_bins_rise(spark, numbers):
    binned = add_order_bins(spark.createDataFrame(numbers), ["x"]).toPandas().sort_values("x")
    assert binned["x_bin"].is_monotonic_increasing


def test_describe_equals_pandas(spark, numbers):
    got = profile.describe_numeric(spark.createDataFrame(numbers), ["x", "y"]).collect()
    want = numbers[["x", "y"]].describe()
    for row in got:
        column = want[row["feature"]]
        for name, key in zip(
            ["n", "mean", "std", "min", "q25", "q50", "q75", "max"],
            ["count", "mean", "std", "min", "25%", "50%", "75%", "max"],
        ):
            assert row[name] == pytest.approx(column[key], abs=1e-9)


def test_box_numbers(spark, numbers):
    rows = spark.createDataFrame(numbers).withColumn(
        "x", F.when(F.rand(3) > 0.1, F.col("x"))
    ).cache()
    frame = rows.toPandas()
    got = profile.five_number_by_class(rows, ["x", "y"], "g").collect()
    assert len(got) == 4
    for row in got:
        column = frame[frame.g == row["g"]][row["feature"]].dropna()
        q25, q75 = column.quantile(0.25), column.quantile(0.75)
        inside = column[column.between(q25 - 1.5 * (q75 - q25), q75 + 1.5 * (q75 - q25))]
        assert row["n"] == len(column)
        assert row["q50"] == pytest.approx(column.median())
        assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())
        assert row["outliers"] == len(column) - len(inside)


def test_histogram_equals_numpy(spark, numbers):
    rows = spark.createDataFrame(numbers)
    counts, edges = np.histogram(numbers["x"], bins=17)
    got = sorted(profile.histogram(rows, "x", 17).collect())
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["low"] for r in got] == pytest.approx(edges[:-1].tolist())
    clipped = np.histogram(numbers["y"], bins=4, range=(1, 5))[0]
    got = sorted(profile.histogram(rows, "y", 4, 1, 5).collect())
    assert [r["n"] for r in got] == clipped.tolist()


def test_histogram_of_one_value(spark):
    rows = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["n"] for r in profile.histogram(rows, "x", 4).collect()) == 2


def test_correlation_equals_pandas(spark, numbers):
    got = profile.correlation_matrix(spark.createDataFrame(numbers), ["x", "y"]).collect()
    assert len(got) == 1
    assert got[0]["corr"] == pytest.approx(numbers["x"].corr(numbers["y"]), abs=1e-12)


@pytest.mark.parametrize("gaps", [0, 1, 3])
def test_wide_correlation_equals_pandas(spark, gaps):
    rng = np.random.default_rng(gaps)
    base = rng.normal(size=(400, 7))
    frame = pd.DataFrame(base @ rng.normal(size=(7, 7)), columns=[f"x{i}" for i in range(7)])
    for i in range(gaps):
        frame.loc[rng.choice(400, 60, replace=False), f"x{i}"] = np.nan
    got = profile.correlation_matrix(spark.createDataFrame(frame), list(frame.columns)).collect()
    want = frame.corr()
    assert len(got) == 21
    for row in got:
        assert row["corr"] == pytest.approx(want.loc[row["row"], row["col"]], abs=1e-9)


def test_correlation_of_constant_is_null(spark):
    rows = spark.range(30).select(F.lit(1.0).alias("one"), *[(F.col("id") * i).alias(f"x{i}") for i in range(1, 6)])
    got = profile.correlation_matrix(rows, rows.columns).collect()
    assert len(got) == 15
    assert {r["corr"] for r in got if "one" in (r["row"], r["col"])} == {None}


def test_label_profiles(spark):
    rows = spark.createDataFrame(
        [(0, 0), (1, 0), (1, 1), (None, 1)], "toxic int, threat int"
    )
    labels = ["toxic", "threat"]
    assert [tuple(r) for r in profile.label_counts(rows, labels).collect()] == [
        ("threat", 2),
        ("toxic", 2),
    ]
    assert [tuple(r) for r in profile.labels_per_row(rows, labels).collect()] == [
        (0, 1),
        (1, 2),
        (2, 1),
    ]
    shares = {r["group"]: r["percent"] for r in profile.any_label_share(rows, labels).collect()}
    assert shares == {"clean": 25.0, "any label": 75.0}


def test_rate_by_group(spark):
    rows = spark.createDataFrame([("a", ">50K"), ("a", "<=50K"), ("b", "<=50K")], "o string, l string")
    got = profile.rate_by_group(rows, "o", F.col("l") == ">50K").collect()
    assert [(r["o"], r["n"], r["rate"]) for r in got] == [("b", 1, 0.0), ("a", 2, 0.5)]


def test_probability_distribution_names_labels(spark):
    rows = spark.createDataFrame([(0.0, 1.0), (0.5, 0.99)], "proba_a double, proba_b double")
    got = profile.probability_distribution(rows, 2).collect()
    assert sorted((r["label"], r["bin"], r["n"]) for r in got) == [
        ("a", 0, 1),
        ("a", 1, 1),
        ("b", 0, 0),
        ("b", 1, 2),
    ]
