import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.operators import forest, train
from tablewright.operators.features import fit_stages, table_stages

PLAIN = {"bootstrap": False, "featureSubsetStrategy": "all"}


def mixed_rows(spark, rows=3000, classes=2):
    """Two numbers, one of many values, and a category; a tenth of the labels is drawn at random."""
    noise = F.pmod(F.xxhash64("id"), F.lit(10))
    label = F.when(noise == 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(classes))).otherwise(
        F.pmod((F.col("x") > 4).cast("int") + (F.col("c") == "c3").cast("int") + (F.col("y") > 0.3).cast("int"), F.lit(classes))
    )
    table = spark.range(rows).selectExpr("id", "cast(id % 9 as double) x", "sin(id) y", "concat('c', id * id % 7) c")
    table = table.withColumn("label", label.cast("int"))
    return fit_stages(table_stages(["c"], ["x", "y"]), table).transform(table).select("id", "features", "label").cache()


def chances(model, df):
    rows = model.transform(df).select("id", vector_to_array("probability").alias("p")).orderBy("id").collect()
    return np.array([r["p"] for r in rows])


@pytest.mark.parametrize("classes", [2, 3])
def test_a_tree_of_all_rows_and_slots_is_that_of_spark(spark, monkeypatch, classes):
    """Nothing is drawn here, so the same rows must lead to the same leaves, whatever the blocks."""
    monkeypatch.setattr(forest, "BLOCK_ROWS", 700)
    rows = mixed_rows(spark, classes=classes)
    theirs = DecisionTreeClassifier(labelCol="label").fit(rows)
    ours = train.fit_random_forest(rows, "label", 2, **PLAIN)
    assert ours.getNumTrees == 2 and ours.numClasses == classes
    assert {t.numNodes for t in ours.trees} == {theirs.numNodes}
    assert np.abs(chances(ours, rows) - chances(theirs, rows)).max() < 1e-12
    assert np.abs(ours.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 1e-9


def test_limits_of_splits_are_those_of_spark(spark):
    rows = mixed_rows(spark)
    limits = {"maxDepth": 4, "maxBins": 8, "minInstancesPerNode": 200, "minInfoGain": 0.005}
    theirs = DecisionTreeClassifier(labelCol="label", **limits).fit(rows)
    ours = train.fit_random_forest(rows, "label", 1, **PLAIN, **limits)
    assert np.abs(chances(ours, rows) - chances(theirs, rows)).max() < 1e-12


def test_dense_sparse_and_odd_vectors(spark):
    """Rows of both kinds, negative and missing entries, a constant slot, and rows without any entry."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(800):
        values = np.array([rng.integers(-3, 4), rng.random() if i % 3 else 0.0, 7.0 if i % 11 else 0.0, 0.0])
        label = int(values[0] > 0 or values[1] > 0.8)
        if i % 11 == 0:
            values[:] = 0.0
        dense = Vectors.dense(values)
        rows.append((i, dense if i % 2 else Vectors.sparse(4, {j: v for j, v in enumerate(values.tolist()) if v}), label))
    df = spark.createDataFrame(rows, ["id", "features", "label"]).repartition(3).cache()
    theirs = DecisionTreeClassifier().fit(df)
    ours = train.fit_random_forest(df, "label", 1, **PLAIN)
    assert np.abs(chances(ours, df) - chances(theirs, df)).max() < 1e-12
    with pytest.raises(Exception, match="null in the features"):
        train.fit_random_forest(df.union(spark.createDataFrame([(1, Vectors.dense([0.0] * 4), None)], df.schema)), "label", 2)


def test_forest_is_fitted_in_blocks_and_ranks_as_that_of_spark(spark, monkeypatch):
    """Rows are not handed to the fit of pyspark.ml, which keeps them as objects with a number per tree."""
    rows = mixed_rows(spark)
    learn, held = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    area = BinaryClassificationEvaluator().evaluate
    theirs = area(RandomForestClassifier(labelCol="label", numTrees=30, seed=1).fit(learn).transform(held))
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *_: pytest.fail("rows went to pyspark.ml"))
    ours = [train.fit_random_forest(learn, "label", 30, seed) for seed in (1, 1, 2)]
    areas = [area(m.transform(held)) for m in ours]
    assert min(areas) > theirs - 0.02 and theirs > 0.85
    assert ours[0].toDebugString.split("\n", 1)[1] == ours[1].toDebugString.split("\n", 1)[1] != ours[2].toDebugString.split("\n", 1)[1]
    assert len({t.toDebugString.split("\n", 1)[1] for t in ours[0].trees}) > 20  # rows and slots differ by tree
    assert ours[0].getOrDefault("numTrees") == 30 and ours[0].getLabelCol() == "label"


def test_other_parameters_are_left_to_spark(spark):
    rows = mixed_rows(spark, 300)
    for params in ({"maxDepth": 7}, {"impurity": "entropy"}, {"featureSubsetStrategy": "2"}):
        assert not forest.takes(RandomForestClassifier(labelCol="label", **params), rows)
        assert train.fit_random_forest(rows, "label", 2, **params).getNumTrees == 2
    assert forest.takes(RandomForestClassifier(labelCol="label"), rows)


@pytest.mark.parametrize("rate", [0.4, 1.0])
def test_copies_are_poisson(rate):
    n = forest._Copies(rate).draw(np.random.Generator(np.random.SFC64([1])), 1_000_000)
    assert abs(n.mean() - rate) < 0.005 and abs(n.var() - rate) < 0.01
    shares = np.bincount(n, minlength=3)[:3] / len(n)
    assert np.abs(shares - np.exp(-rate) * np.array([1, rate, rate * rate / 2])).max() < 0.002


def test_many_values_are_cut_at_quantiles_of_all_rows(spark):
    """The greater half of the rows of a value far from the others must not hide behind a sample."""
    table = spark.range(40_000, numPartitions=7).selectExpr("id", "if(id >= 39990, id * 1000.0, sqrt(id)) x", "cast(id >= 20000 as int) label")
    rows = fit_stages(table_stages([], ["x"]), table).transform(table).select("id", "features", "label")
    model = train.fit_random_forest(rows, "label", 1, maxDepth=1, **PLAIN)
    wrong = model.transform(rows).filter("prediction <> label").count()
    assert wrong < 40_000 / 32


def test_an_entry_of_all_rows_is_counted_once(spark):
    """Every row is in one block, whatever its width, and blocks keep to their limits."""
    import pyarrow as pa
    import pickle

    vector = pa.array([{"type": 1, "size": None, "indices": None, "values": [float(i), float(i % 3)][: 1 + i % 2] + [0.0] * (1 - i % 2)} for i in range(1000)],
                      pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]))
    batch = pa.record_batch([vector, pa.array([float(i % 2) for i in range(1000)])], names=["vector", "label"])
    bins = forest.Bins.of(2, {0: np.array([10.0, 500.0]), 1: np.array([0.5, 1.5])})
    kept = forest.BLOCK_ROWS
    try:
        forest.BLOCK_ROWS = 300
        blocks = pa.concat_batches(list(forest._encode(bins, 2, iter([batch.slice(0, 450), batch.slice(450)])))).to_pylist()
    finally:
        forest.BLOCK_ROWS = kept
    sizes = [len(pickle.loads(b["data"])[0][1]) for b in blocks]
    assert sum(sizes) == 1000 and max(sizes) <= 300 and len({b["block"] for b in blocks}) == len(blocks)


def test_both_models_of_a_comparison_score_all_held_out_rows(spark, monkeypatch):
    """The forest of a comparison is counted in blocks too, and ranks as well as the single tree or better."""
    from tablewright.operators.split import in_train
    from tablewright.plans import income

    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *_: pytest.fail("rows went to pyspark.ml"))
    rows = spark.range(2000).selectExpr("id", "concat('c', id % 5) c", "cast(id % 17 as double) x", "cast(id % 17 < 9 as int) label")
    result = income.compare_trees(rows, ["c"], ["x"], "label", ["id"], trees=10)
    held = rows.filter(~in_train(["id"], 80, income.SPLIT_SEED)).count()
    assert {(r["model"], r["count"]) for r in result.scored.groupBy("model").count().collect()} == {("RF", held), ("DT", held)}
    areas = {r["model"]: r["value"] for r in result.metrics.filter("metric = 'areaUnderROC'").collect()}
    assert areas["DT"] == 1.0 and areas["RF"] > 0.99
