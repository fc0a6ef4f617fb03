from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tablewright.operators import slots, train
from tablewright.operators.slots import SlotStages
from tablewright.session import materialize


def folded_rows(spark):
    table = spark.range(3000).selectExpr("concat('c', id % 11) c", "cast(id % 17 as double) x", "cast(id % 17 < 9 as int) label", "cast(id % 3 as int) fold")
    return materialize(table.coalesce(1), "rows")


def test_vectors_of_a_fit_are_dealt_by_the_memory_they_take(spark, monkeypatch):
    """A part of the written vectors has few rows, however few bytes they take; every fit still sees all rows of its folds."""
    seen = []
    fit = LogisticRegression.fit

    def noted(self, df, params=None):
        seen.append([len(p) for p in df.rdd.glom().collect()])
        return fit(self, df, params)

    monkeypatch.setattr(LogisticRegression, "fit", noted)
    monkeypatch.setattr(slots, "FIT_TASK_BYTES", 48 * 200, raising=False)  # two entries of 12 bytes and 24 more
    estimator = train.logreg("label", maxIter=2)
    found = train.cross_validate(folded_rows(spark), SlotStages(("c",), ("x",)), estimator, train.param_grid(estimator, (0.01, 0.2)))
    assert found.count() == 6 and len(seen) == 6
    for parts in seen:
        assert sum(parts) == 2000 and max(parts) <= 200


def test_fits_side_by_side_are_bounded_by_memory(spark, monkeypatch):
    """Each fit keeps all its rows, so as many run at once as find memory; all of them run."""
    at_once = []
    run = train._in_threads
    monkeypatch.setattr(train, "_in_threads", lambda tasks, most, spark: at_once.append(most) or run(tasks, most, spark))
    estimator = train.logreg("label", maxIter=2)
    rows, stages, grid = folded_rows(spark), SlotStages(("c",), ("x",)), train.param_grid(estimator)
    areas = []
    for memory in (10**9, 2000 * 48 * 2, 1000):  # the rows of a fit take 2000 * 48 bytes
        monkeypatch.setattr(train, "storage_bytes", lambda _, memory=memory: memory, raising=False)
        areas.append(sorted(train.cross_validate(rows, stages, estimator, grid).select("reg_param", "fold", F.round("auc", 9)).collect()))
    assert at_once == [3] * 3 + [2] * 3 + [1] * 3
    assert len(areas[0]) == 9 and areas[0] == areas[1] == areas[2]


def test_storage_of_a_local_session_is_that_of_its_driver(spark):
    assert 10**8 < train.storage_bytes(spark) < 8 * 2**30
