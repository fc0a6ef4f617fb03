"""Fitted models on the stand-in tables.

SQL cannot fit a model, but it can count the rows that a fit sees.  Each query returns these counts,
and flags that a second route sets: the slope of the loss, the coefficient table, counts of the scored rows.
"""

from pyspark.sql import functions as F

from tablewright.catalog.registry import INCOME, LINE_KEY_SQL, RISK, bucket_sql, query
from tablewright.functions import vector_element
from tablewright.operators import train as ops
from tablewright.operators.features import fit_stages, table_stages
from tablewright.operators.score import risk_score as add_risk
from tablewright.operators.score import score as score_rows
from tablewright.operators.score import score_linear, weights_of
from tablewright.operators.slots import SlotStages
from tablewright.operators.split import in_train, kfold_assign, split_train_test
from tablewright.plans import comments, income, risk
from tablewright.plans.standins import (
    INCOME_CATEGORICAL,
    INCOME_NUMERIC,
    LINE_KEYS,
    RISK_FEATURES,
    income_rows,
    labeled_texts,
    line_keys,
    risk_rows,
)
from tablewright.session import materialize

# The stand-in risk target is almost separable: some regularization keeps weights finite.
RISK_REG_PARAM = 0.01


def _risk_vectors(spark, folder):
    rows = risk_rows(spark, folder, for_training=True)
    train, test = split_train_test(rows, line_keys(), 80, risk.SPLIT_SEED)
    assembled = fit_stages(table_stages([], RISK_FEATURES), train)
    vectors = materialize(assembled.transform(train).select("features", "target"), "risk-train")
    return vectors, assembled.transform(test)


# The rows that the risk models learn from, counted, for every coefficient.
FITTED_SQL = f"""with {RISK},
    train as (select * from risk where {bucket_sql(str(risk.SPLIT_SEED), 100, *LINE_KEY_SQL)} < 80)
    select feature, (select count(*) from train) as n_train, true as at_optimum
    from (values {', '.join(f"('{c}')" for c in [*RISK_FEATURES, 'intercept'])}) as names(feature)"""


def _optimality(vectors, coefficients, reg_param):
    """``(feature, n_train, at_optimum)``: whether the loss is flat along each coefficient."""
    weights, intercept = weights_of(coefficients)
    values = vectors.select("target", *[vector_element("features", i).alias(c) for i, c in enumerate(RISK_FEATURES)])
    error = F.col("score") - F.col("target")
    slopes = {"intercept": F.avg(error)}
    for c in RISK_FEATURES:
        penalty = F.lit(reg_param * weights[c]) * F.stddev_samp(c)
        slopes[c] = F.avg(error * F.col(c)) / F.stddev_samp(c) + penalty
    sums = score_linear(values, weights, intercept).agg(
        F.count(F.lit(1)).alias("n_train"), *[(F.abs(v) < 1e-3).alias(c) for c, v in slopes.items()]
    )
    return sums.unpivot(["n_train"], list(slopes), "feature", "at_optimum").select("feature", "n_train", "at_optimum")


@query(FITTED_SQL)
def fit_logreg(spark, folder):
    vectors, _ = _risk_vectors(spark, folder)
    model = ops.fit_logreg(vectors, "target", regParam=RISK_REG_PARAM)
    return _optimality(vectors, ops.coefficients_table(model, vectors), RISK_REG_PARAM)


@query(FITTED_SQL)
def fit_logreg_l2(spark, folder):
    vectors, _ = _risk_vectors(spark, folder)
    model = ops.fit_logreg_l2(vectors, "target")
    return _optimality(vectors, ops.coefficients_table(model, vectors), ops.TEXT_REG_PARAM)


@query(
    f"""with {RISK} select {', '.join(LINE_KEYS)}, target, true as valid from risk
    where {bucket_sql(str(risk.SPLIT_SEED), 100, *LINE_KEY_SQL)} >= 80"""
)
def score_held_out(spark, folder):
    """Every held-out row gets a probability and the class that goes with it."""
    vectors, test = _risk_vectors(spark, folder)
    model = ops.fit_logreg(vectors, "target", regParam=RISK_REG_PARAM)
    scored = add_risk(score_rows(model, test))
    expected = F.when(F.col("risk") > 0.5, 1.0).otherwise(0.0)
    valid = F.col("risk").between(0.0, 1.0) & (F.col("prediction") == expected)
    return scored.select(*LINE_KEYS, "target", valid.alias("valid"))


def _risk(spark, folder):
    return risk.fit_risk(
        risk_rows(spark, folder, for_training=True),
        RISK_FEATURES,
        "target",
        keys=line_keys(),
        report=["l_orderkey", "l_linenumber", *RISK_FEATURES],
        regParam=RISK_REG_PARAM,
    )


HELD_OUT_RISK = f"""with {RISK},
    held_out as (select * from risk where {bucket_sql(str(risk.SPLIT_SEED), 100, *LINE_KEY_SQL)} >= 80)"""


@query(
    f"{HELD_OUT_RISK} select l_orderkey, l_linenumber, {', '.join(RISK_FEATURES)}, target, "
    "true as same from held_out"
)
def risk_score(spark, folder):
    """Every held-out row, and whether its risk is the score from the model's coefficient table."""
    result = _risk(spark, folder)
    rows = score_linear(result.predictions, *weights_of(result.coefficients))
    return rows.withColumn("same", F.abs(F.col("score") - F.col("risk")) < 1e-9).drop("score", "risk", "prediction")


@query(FITTED_SQL)
def coefficients_table(spark, folder):
    vectors, _ = _risk_vectors(spark, folder)
    return _optimality(vectors, _risk(spark, folder).coefficients, RISK_REG_PARAM)


@query(
    f"""{HELD_OUT_RISK} select metric, count(*) as n, true as same
    from held_out, (values ('precision'), ('recall'), ('f1'), ('areaUnderROC')) as names(metric) group by metric"""
)
def risk_metrics(spark, folder):
    """Metrics of class 1, and whether counts by another route give the same."""
    result = _risk(spark, folder)
    return _against_counts(
        result.metrics.withColumn("model", F.lit("LR")),
        result.predictions.select(F.lit("LR").alias("model"), F.col("target").alias("label"), "prediction", F.col("risk").alias("score")),
        {},
        one_class=True,
    ).drop("model")


#: Bins of the scores that bound an area from below and above.
AREA_BINS = 1000


def _against_counts(metrics, scored, names, one_class=False):
    """``(model, metric, n, same)``: each metric against counts taken by another route, over ``n`` scored rows.

    One aggregation counts labels, classes and score bins. The counts give the metrics of the confusion; the area
    must lie between that with all pairs inside a bin ranked wrong and that with all of them ranked right.
    """
    place = F.floor(F.col("score") * AREA_BINS).cast("int")
    cells = scored.groupBy("model", F.col("label").cast("double").alias("label"), "prediction", place.alias("bin")).count()
    by_model: dict[str, list] = {}
    for r in cells.collect():  # at most models x labels x classes x (AREA_BINS + 1) rows
        by_model.setdefault(r["model"], []).append((r["label"], r["prediction"], r["bin"], r["count"]))
    rows = []
    for r in metrics.collect():  # a row per model and metric
        found = by_model[r["model"]]
        low, high = _expected(names.get(r["metric"], r["metric"]), found, one_class)
        rows.append((r["model"], r["metric"], sum(c[3] for c in found), low - 1e-9 <= r["value"] <= high + 1e-9))
    return metrics.sparkSession.createDataFrame(rows, "model string, metric string, n bigint, same boolean")


def _expected(metric, cells, one_class):
    """The least and the greatest value of a metric that the cells (label, class, bin, count) allow."""
    if metric == "areaUnderROC":
        bins = sorted({c[2] for c in cells})
        totals = [[sum(n for label, _, b, n in cells if label == side and b == at) for at in bins] for side in (1.0, 0.0)]
        pairs = sum(totals[0]) * sum(totals[1])
        below = sum(p * sum(totals[1][:i]) for i, p in enumerate(totals[0]))
        return below / pairs, (below + sum(p * n for p, n in zip(*totals, strict=True))) / pairs
    total, value = sum(c[3] for c in cells), 0.0
    if metric == "accuracy":
        value = sum(n for label, guess, _, n in cells if label == guess) / total
        return value, value
    for side in [1.0] if one_class else sorted({c[0] for c in cells}):
        hits = sum(n for label, guess, _, n in cells if label == guess == side)
        actual = sum(n for label, _, _, n in cells if label == side)
        guessed = sum(n for _, guess, _, n in cells if guess == side)
        precision, recall = hits / guessed if guessed else 0.0, hits / actual if actual else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        value += {"precision": precision, "recall": recall, "f1": f1}[metric] * (1 if one_class else actual / total)
    return value, value


def label_probabilities(spark, folder):
    """Label probabilities of all texts that lack a label, from models of those that have all."""
    rows = labeled_texts(spark, folder)
    full = F.col("toxic").isNotNull() & F.col("quality").isNotNull()
    test = comments.clean_test(rows.filter(~full).select("doc_id", "text"), "text")
    train, labels = comments.clean_train(rows.filter(full), "doc_id", "text")
    return comments.predict_labels(train, test, labels, "doc_id", "text")


@query(
    """select doc_id, true as toxic_fits, true as quality_fits from documents left join labels using (doc_id)
    where (toxic is null or quality is null) and text <> '"'"""
)
def fit_multilabel(spark, folder):
    """Every text to score, and whether its classes go with its probabilities."""

    def fits(label):
        p = F.col(f"proba_{label}")
        class_of = F.when(p > 0.5, 1.0).otherwise(0.0)
        return (p.between(0.0, 1.0) & (F.col(f"pred_{label}") == class_of)).alias(f"{label}_fits")

    return label_probabilities(spark, folder).select("doc_id", fits("toxic"), fits("quality"))


def _income(spark, folder):
    return income_rows(spark, folder, for_training=True), INCOME_CATEGORICAL, INCOME_NUMERIC, "label", line_keys()


def _cross_validation(spark, folder):
    train, _ = split_train_test(income_rows(spark, folder, for_training=True), line_keys(), 80, income.SPLIT_SEED)
    folded = materialize(
        kfold_assign(train, line_keys(), 3, income.SPLIT_SEED).select(
            *INCOME_CATEGORICAL, *INCOME_NUMERIC, "label", "fold"
        ),
        "folds",
    )
    estimator = ops.logreg("label", maxIter=ops.CV_MAX_ITER)
    stages = SlotStages(tuple(INCOME_CATEGORICAL), tuple(INCOME_NUMERIC))
    return folded, ops.cross_validate(folded, stages, estimator, ops.param_grid(estimator))


INCOME_SPLIT = f"""with {INCOME},
    split as (select *, {bucket_sql(str(income.SPLIT_SEED), 100, *LINE_KEY_SQL)} as part,
              cast({bucket_sql(f'fold{income.SPLIT_SEED}', 3, *LINE_KEY_SQL)} as integer) as fold from income),
    train as (select * from split where part < 80), held_out as (select * from split where part >= 80)"""
GRID_SQL = f"(values {', '.join(f'({p}::double)' for p in ops.REG_PARAMS)}) as grid(reg_param)"


@query(
    f"""{INCOME_SPLIT} select reg_param, fold, (select count(*) from train) - count(*) as n_train,
    count(*) as n_valid, true as ranks_well from train, {GRID_SQL} group by reg_param, fold"""
)
def cross_validate(spark, folder):
    """Rows trained on and ranked in every fold, and whether the area is far above chance."""
    folded, grid = _cross_validation(spark, folder)
    sizes = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n_valid"))
    total = folded.count()
    return grid.join(sizes, "fold").select(
        "reg_param", "fold", (F.lit(total) - F.col("n_valid")).alias("n_train"), "n_valid", (F.col("auc") > 0.8).alias("ranks_well")
    )


@query(
    f"""{INCOME_SPLIT}, sizes as (select fold, count(*) as n from train group by fold)
    select reg_param, count(*) as folds, sum(n)::bigint as n_ranked, ((count(*) - 1) * sum(n))::bigint as n_trained, true as same
    from sizes, {GRID_SQL} group by reg_param"""
)
def best_params(spark, folder):
    """Every grid point, over how many folds and rows, and whether its mean and place in the order are right."""
    folded, grid = _cross_validation(spark, folder)
    sizes = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    grid = materialize(grid.join(sizes, "fold"), "grid")
    by_point: dict[float, list] = {}
    for r in grid.collect():  # a row per grid point and fold
        by_point.setdefault(r["reg_param"], []).append(r)
    means = {p: sum(r["auc"] for r in rs) / len(rs) for p, rs in by_point.items()}
    ordered = sorted(means, key=lambda p: (-means[p], p))
    rows = []
    for place, r in enumerate(ops.best_params(grid).collect()):
        mine = by_point[r["reg_param"]]
        total = sum(m["n"] for m in mine)
        right = abs(r["mean_auc"] - means[r["reg_param"]]) < 1e-12 and ordered[place] == r["reg_param"]
        rows.append((r["reg_param"], len(mine), total, (len(mine) - 1) * total, right))
    return spark.createDataFrame(rows, "reg_param double, folds bigint, n_ranked bigint, n_trained bigint, same boolean")


METRIC_NAMES = {"accuracy": "accuracy", "weightedPrecision": "precision", "weightedRecall": "recall", "f1": "f1"}


def _checked_metrics_sql(*models):
    names = ", ".join(f"('{m}', '{x}')" for m in models for x in [*METRIC_NAMES, "areaUnderROC"])
    return f"""{INCOME_SPLIT} select model, metric, count(*) as n, true as same
    from held_out, (values {names}) as names(model, metric) group by model, metric"""


def _checked(result):
    return _against_counts(result.metrics, result.scored, METRIC_NAMES)


@query(_checked_metrics_sql("LR"))
def tuned_logreg_metrics(spark, folder):
    """Metrics of the tuned model, and whether counts by another route give the same."""
    return _checked(income.fit_tuned_logreg(*_income(spark, folder)))


def _income_vectors(spark, folder):
    marked = income_rows(spark, folder, for_training=True).select(
        *INCOME_CATEGORICAL, *INCOME_NUMERIC, "label", in_train(line_keys(), 80, income.SPLIT_SEED).alias("learn")
    )
    rows = materialize(marked, "income-rows")  # the join and the keys' hashes run once
    train, test = rows.filter("learn"), rows.filter("not learn")
    prepared = fit_stages(table_stages(INCOME_CATEGORICAL, INCOME_NUMERIC), train)
    vectors = ops.tree_table(prepared.transform(train), "label")
    return vectors, prepared.transform(test).select("features", "label")


HELD_OUT_INCOME = f"{INCOME_SPLIT} select label, count(*) as n, true as learned from held_out group by label"


def _held_out_counts(model, test):
    """Held-out rows of each label, and whether most of all rows are classified right."""
    counts = score_rows(model, test).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == F.col("prediction")).cast("bigint")).alias("hits")
    )
    counts = materialize(counts, "held-out-counts")  # all rows are scored once
    totals = counts.agg(F.sum("hits") / F.sum("n")).first()[0]
    return counts.select("label", "n", F.lit(bool(totals > 0.8)).alias("learned"))


@query(HELD_OUT_INCOME)
def fit_random_forest(spark, folder):
    vectors, test = _income_vectors(spark, folder)
    return _held_out_counts(ops.fit_random_forest(vectors, "label"), test)


@query(HELD_OUT_INCOME)
def fit_decision_tree(spark, folder):
    vectors, test = _income_vectors(spark, folder)
    return _held_out_counts(ops.fit_decision_tree(vectors, "label"), test)


@query(_checked_metrics_sql("RF", "DT"))
def tree_model_metrics(spark, folder):
    """Metrics of both tree models, and whether counts by another route give the same."""
    return _checked(income.compare_trees(*_income(spark, folder)))
