"""Vectors from written dictionaries equal those of the stages of ``pyspark.ml``."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.operators import train as ops
from tablewright.operators.features import feature_names, fit_stages, table_stages
from tablewright.operators.slots import RARE, Slots, SlotStages
from tablewright.plans import income
from tablewright.session import materialize


@pytest.fixture(scope="module")
def rows(spark):
    skewed = F.when(F.col("id") % 3 == 0, "often").otherwise(F.concat(F.lit("c"), (F.col("id") * 7) % 40))
    return materialize(
        spark.range(1200).select(
            "id",
            skewed.alias("a"),
            F.when(F.col("id") % 11 != 0, F.col("id") % 5).alias("b"),
            (F.col("id") % 13).cast("double").alias("x"),
            F.col("id").cast("int").alias("y"),
            ((F.col("id") % 3 == 0) | (F.col("id") % 13 > 9)).cast("int").alias("label"),
        ),
        "rows",
    )


def arrays(df):
    return {r["id"]: r["f"] for r in df.select("id", vector_to_array("features").alias("f")).collect()}


@pytest.mark.parametrize("most", [0, 10, 1000])
def test_vectors_equal_the_stages(spark, rows, most, monkeypatch):
    """By broadcast, by the shuffled dictionary, and by one each; unseen and null categories set no slot."""
    monkeypatch.setattr("tablewright.operators.slots.COMMON", 3)
    train, test = rows.filter("id < 900"), rows.filter("id >= 300").withColumn("a", F.when(F.col("id") % 50 == 0, "new").otherwise(F.col("a")))
    slots = SlotStages(("a", "b"), ("x", "y"), most_broadcast_rows=most).fit(train)
    theirs = fit_stages(table_stages(["a", "b"], ["x", "y"]), train)
    ours = slots.transform(test)
    assert ours.count() == test.count()
    assert arrays(ours) == arrays(theirs.transform(test))
    names = {r["slot"]: r["name"] for r in slots.names().collect()}
    assert [names[i] for i in range(slots.size)] == feature_names(theirs.transform(test))


def test_models_equal_those_of_the_stages(spark, rows):
    slots = SlotStages(("a", "b"), ("x", "y")).fit(rows)
    ours = slots.transform(rows)
    theirs = fit_stages(table_stages(["a", "b"], ["x", "y"]), rows).transform(rows)
    one, two = ops.fit_logreg(ours, "label", regParam=0.1), ops.fit_logreg(theirs, "label", regParam=0.1)
    assert one.coefficients.toArray() == pytest.approx(two.coefficients.toArray(), abs=1e-6)
    got = {r["feature"]: r["coefficient"] for r in slots.coefficients(one).collect()}
    want = {r["feature"]: r["coefficient"] for r in ops.coefficients_table(two, theirs).collect()}
    assert got == pytest.approx(want, abs=1e-6)
    scored = [
        ops.fit_decision_tree(df, "label").transform(df).select("id", vector_to_array("probability")[1].alias("p")) for df in (ours, theirs)
    ]
    both = scored[0].join(scored[1].withColumnRenamed("p", "q"), "id")
    assert both.filter(F.abs(F.col("p") - F.col("q")) > 1e-9).count() == 0


def test_rare_categories_share_a_slot(spark, rows):
    slots = SlotStages(("a", "b"), ("x",), least_count=30).fit(rows)
    counts = {r["a"]: r["count"] for r in rows.groupBy("a").count().collect()}
    often = [c for c, n in counts.items() if n >= 30]
    assert 0 < len(often) < len(counts) and slots.size == 1 + len(often) + 1 + 5
    shared = slots.columns[0][1] + len(often)
    for r in slots.transform(rows).select("a", vector_to_array("features")[shared].alias("shared")).distinct().collect():
        assert r["shared"] == float(counts[r["a"]] < 30)
    assert [r["name"] for r in slots.names().filter(F.col("slot") == shared).collect()] == [f"a_vec_{RARE}"]
    unseen = slots.transform(spark.createDataFrame([("never seen", 1, 2.0)], "a string, b int, x double"))
    assert sum(unseen.select(vector_to_array("features")).first()[0]) == 3.0


def test_folds_are_counted_once(spark, rows):
    folded = rows.withColumn("fold", (F.col("id") % 3).cast("int"))
    stages = SlotStages(("a", "b"), ("x",))
    *each, whole = stages.fit_folds(folded, "fold", 3)
    for k, slots in enumerate(each):
        train = folded.filter(F.col("fold") != k)
        assert arrays(slots.transform(folded)) == arrays(fit_stages(table_stages(["a", "b"], ["x"]), train).transform(folded))
    assert whole.size == stages.fit(rows).size


def test_a_null_number_is_an_error(spark):
    rows = spark.createDataFrame([("a", None)], "a string, x double")
    with pytest.raises(Exception, match="null in feature column x"):
        SlotStages(("a",), ("x",)).fit(rows).transform(rows)


def test_cross_validation_over_slots(spark, rows):
    folded = materialize(rows.withColumn("fold", (F.col("id") % 3).cast("int")), "folded")
    estimator = ops.logreg("label", maxIter=30)
    grids = [
        ops.cross_validate(folded, stages, estimator, ops.param_grid(estimator, (0.01, 0.1)))
        for stages in (SlotStages(("a", "b"), ("x",)), table_stages(["a", "b"], ["x"]))
    ]
    ours, theirs = ({(r.reg_param, r.fold): r.auc for r in g.collect()} for g in grids)
    assert len(ours) == 6 and ours == pytest.approx(theirs, abs=1e-6)


def test_folds_share_one_table_of_vectors(spark, rows, monkeypatch):
    # A category of one fold only, which sets a slot in the shared table and none in a table of the other folds.
    fold = F.when(F.col("b") == 1, 0).otherwise(F.col("id") % 3).cast("int")
    folded = materialize(rows.withColumn("fold", fold), "folded")
    estimator = ops.logreg("label", maxIter=30)
    grid = ops.param_grid(estimator, (0.01, 0.1))
    theirs = ops.cross_validate(folded, table_stages(["a", "b"], ["x"]), estimator, grid)
    written, transform = [], Slots.transform
    monkeypatch.setattr(Slots, "transform", lambda self, df, *more: written.append(self.size) or transform(self, df, *more))
    ours = ops.cross_validate(folded, SlotStages(("a", "b"), ("x",)), estimator, grid)
    assert len(written) == 1
    ours, theirs = ({(r.reg_param, r.fold): r.auc for r in g.collect()} for g in (ours, theirs))
    assert len(ours) == 6 and ours == pytest.approx(theirs, abs=1e-6)


@pytest.mark.parametrize("least, tables", [(1, 2), (30, 5)])
def test_the_tuned_fit_writes_vectors_once(spark, rows, monkeypatch, least, tables):
    written, transform = [], Slots.transform
    monkeypatch.setattr(Slots, "transform", lambda self, df, *more: written.append(self.size) or transform(self, df, *more))
    result = income.fit_tuned_logreg(rows, ["a", "b"], ["x"], "label", ["id"], reg_params=(0.1,), max_iter=10, least_count=least)
    assert len(written) == tables and result.grid.count() == 3
    assert result.coefficients.count() == written[-1] + 1
