"""Evaluation on scores with fixed weights, and scoring from weights."""

from pyspark.sql import functions as F

from tablewright.catalog.registry import RISK, query
from tablewright.operators import evaluate as ops
from tablewright.operators import score as scoring
from tablewright.operators.features import hashed_term_frequency
from tablewright.operators.joins import union_all
from tablewright.operators.ordering import best_model_per_metric as best_models
from tablewright.catalog.features import SLOT_SQL, WORDS
from tablewright.plans.standins import LINE_KEYS, RISK_FEATURES, risk_rows, table

# Two fixed models of the risk target: a weighted sum, and the bare quantity.
WEIGHTS = {"l_quantity": 0.01, "l_extendedprice": 0.0001, "l_discount": -6.0, "l_tax": 0.5}
INTERCEPT = -5.0
LINEAR_SQL = (
    f"1.0 / (1.0 + exp(-({INTERCEPT}::double"
    + "".join(f" + ({w}::double * {c})" for c, w in WEIGHTS.items())
    + ")))"
)

SCORED = f"""{RISK},
scored as (
  select 'linear' as model, target, s as score,
         case when s > 0.5 then 1.0 else 0.0 end::double as prediction
  from (select target, {LINEAR_SQL} as s from risk)
  union all
  select 'quantity', target, s, case when s > 0.5 then 1.0 else 0.0 end::double
  from (select target, l_quantity / 50.0::double as s from risk))
"""

CELLS_OF_SCORED = """
cells as (
  select model,
         count(*) filter (target = 1 and prediction = 1) as tp,
         count(*) filter (target = 0 and prediction = 1) as fp,
         count(*) filter (target = 0 and prediction = 0) as tn,
         count(*) filter (target = 1 and prediction = 0) as fn
  from scored group by model),
per_class as (
  select model, 1.0::double as class, tp + fn as support, tp + fp as predicted, tp as hits from cells
  union all select model, 0.0::double, tn + fp, tn + fn, tn from cells),
rates as (
  select *, case when predicted = 0 then 0 else hits / predicted::double end as precision,
         case when support = 0 then 0 else hits / support::double end as recall
  from per_class),
metrics as (
  select *, case when precision + recall = 0 then 0
                 else 2 * precision * recall / (precision + recall) end as f1 from rates)
"""

CELLS = f"{SCORED}, {CELLS_OF_SCORED}"

AUC = """
by_score as (
  select model, score, sum(target)::double as p, sum(1 - target)::double as n
  from scored group by model, score),
ranked as (
  select model, p, n,
         coalesce(sum(n) over (partition by model order by score
                  rows between unbounded preceding and 1 preceding), 0) as cn from by_score),
areas as (
  select model, sum(p * (cn + n / 2)) / (sum(p) * sum(n)) as auc from ranked group by model)
"""

METRICS_OF_SCORED = f"""{CELLS_OF_SCORED}, {AUC},
all_metrics as (
  select model, 'accuracy' as metric, sum(hits) / sum(support)::double as value from metrics group by model
  union all
  select model, 'weightedPrecision', sum(support * precision) / sum(support) from metrics group by model
  union all
  select model, 'weightedRecall', sum(support * recall) / sum(support) from metrics group by model
  union all
  select model, 'f1', sum(support * f1) / sum(support) from metrics group by model
  union all
  select model, 'areaUnderROC', auc from areas)
"""

ALL_METRICS = f"{SCORED}, {METRICS_OF_SCORED}"


def _scored(spark, folder):
    """``(model, target, prediction, score)`` of the two fixed models, in one pass."""
    rows = scoring.score_linear(risk_rows(spark, folder, for_training=True), WEIGHTS, INTERCEPT, "linear")
    rows = rows.withColumn("quantity", F.col("l_quantity") / 50.0)
    long = rows.unpivot(["target"], ["linear", "quantity"], "model", "score")
    return scoring.threshold_predict(long, "score")


def _confusion(spark, folder):
    return ops.confusion_matrix(_scored(spark, folder), "target", "prediction", ["model"])


def _round(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    f"""with {SCORED} select model, target, prediction, count(*) as count
    from scored group by all"""
)
def confusion_matrix(spark, folder):
    return _confusion(spark, folder)


@query(
    f"""with {SCORED} select model, target, count(*) filter (prediction = 0) as pred_0,
    count(*) filter (prediction = 1) as pred_1 from scored group by model, target"""
)
def confusion_dense(spark, folder):
    scored = _scored(spark, folder)
    one_each = [
        ops.confusion_dense(scored.filter(F.col("model") == m), "target", "prediction").withColumn("model", F.lit(m))
        for m in ("linear", "quantity")
    ]
    return union_all(*one_each)


THREE = f"""{RISK},
scored as (
  select 'thirds' as model, cast(floor(l_quantity / 17) as double) as target,
         case when l_discount < 0.01 then null else cast(floor(l_extendedprice / 40000) as double) end as prediction
  from risk)"""


@query(
    f"""with {THREE},
    counts as (select target, prediction, count(*) as n from scored group by all),
    classes as (select target as class, sum(n) as support,
                       coalesce(sum(n) filter (prediction = target), 0) as hits from counts group by target),
    guesses as (select prediction as class, sum(n) as predicted from counts where prediction is not null group by prediction),
    rates as (select support, hits / support as recall, coalesce(hits / predicted, 0) as precision
              from classes left join guesses using (class)),
    metrics as (select *, case when precision + recall = 0 then 0 else 2 * precision * recall / (precision + recall) end as f1 from rates)
    select 'accuracy' as metric, round((select sum(hits) / sum(support) from classes), 6) as value
    union all select 'weightedPrecision', round(sum(support * precision) / sum(support), 6) from metrics
    union all select 'weightedRecall', round(sum(support * recall) / sum(support), 6) from metrics
    union all select 'f1', round(sum(support * f1) / sum(support), 6) from metrics"""
)
def evaluate_three_classes(spark, folder):
    """Metrics over three classes, with rows that have no prediction."""
    rows = risk_rows(spark, folder).select(
        F.lit("thirds").alias("model"),
        F.floor(F.col("l_quantity") / 17).cast("double").alias("target"),
        F.when(F.col("l_discount") >= 0.01, F.floor(F.col("l_extendedprice") / 40000).cast("double")).alias("prediction"),
        F.lit(0.5).alias("score"),
    )
    found = ops.evaluate_model(rows, "target", "prediction", "score").filter("metric <> 'areaUnderROC'")
    return _round(found.select("metric", "value"), "value")


@query(f"with {CELLS} select model, tp, fp, tn, fn from cells")
def error_counts(spark, folder):
    return ops.error_counts(_scored(spark, folder), "target", "prediction", ["model"])


@query(
    f"""with {CELLS} select model, class, support, hits, round(precision, 6) as precision,
    round(recall, 6) as recall, round(f1, 6) as f1 from metrics"""
)
def class_metrics(spark, folder):
    per_class = ops.class_metrics(_confusion(spark, folder), ["model"])
    return _round(per_class, "precision", "recall", "f1")


@query(
    f"with {CELLS} select model, round(sum(hits) / sum(support)::double, 6) as accuracy "
    "from metrics group by model"
)
def accuracy(spark, folder):
    return _round(ops.accuracy(_confusion(spark, folder), ["model"]), "accuracy")


@query(
    f"with {CELLS} select model, round(sum(support * precision) / sum(support), 6) "
    "as weighted_precision from metrics group by model"
)
def weighted_precision(spark, folder):
    return _round(ops.weighted_precision(_confusion(spark, folder), ["model"]), "weighted_precision")


@query(
    f"with {CELLS} select model, round(sum(support * recall) / sum(support), 6) "
    "as weighted_recall from metrics group by model"
)
def weighted_recall(spark, folder):
    return _round(ops.weighted_recall(_confusion(spark, folder), ["model"]), "weighted_recall")


@query(
    f"with {CELLS} select model, round(sum(support * f1) / sum(support), 6) "
    "as weighted_f1 from metrics group by model"
)
def weighted_f1(spark, folder):
    return _round(ops.weighted_f1(_confusion(spark, folder), ["model"]), "weighted_f1")


@query(f"with {SCORED}, {AUC} select model, round(auc, 6) as auc from areas")
def auc_roc(spark, folder):
    return _round(ops.auc_roc(_scored(spark, folder), "target", "score", ["model"]), "auc")


def _metrics(spark, folder):
    return ops.evaluate_model(_scored(spark, folder), "target", "prediction", "score")


@query(f"with {ALL_METRICS} select model, metric, round(value, 6) as value from all_metrics")
def evaluate_model(spark, folder):
    return _round(_metrics(spark, folder), "value")


@query(
    f"""with {ALL_METRICS}
    select metric, round(max(value) filter (model = 'linear'), 6) as linear,
           round(max(value) filter (model = 'quantity'), 6) as quantity
    from all_metrics group by metric"""
)
def compare_models(spark, folder):
    wide = ops.compare_models(_metrics(spark, folder), ["linear", "quantity"])
    return _round(wide, "linear", "quantity")


@query(
    f"""with {ALL_METRICS}
    select metric, arg_max(model, value) as model, round(max(value), 6) as value
    from all_metrics group by metric"""
)
def best_model_per_metric(spark, folder):
    return _round(best_models(_metrics(spark, folder)), "value")


@query(
    f"""with {RISK}, s as (select target, {LINEAR_SQL} as score from risk),
    f as (select target, least(cast(floor((score - 0.0) / (1.0::double / 20)) as integer), 19) as bin,
                 count(*) as n from s group by all)
    select g.target, b.bin, round(b.bin * (1.0::double / 20), 6) as low,
           round((b.bin + 1) * (1.0::double / 20), 6) as high, coalesce(f.n, 0) as n
    from (select distinct target from s) g,
         (select cast(range as integer) as bin from range(20)) b
    left join f on f.target = g.target and f.bin = b.bin"""
)
def risk_distribution_by_class(spark, folder):
    rows = scoring.score_linear(risk_rows(spark, folder), WEIGHTS, INTERCEPT)
    bins = ops.risk_distribution_by_class(rows, "target", "score", 20)
    return _round(bins, "low", "high")


# --- scoring from weights --------------------------------------------------


@query(f"with {RISK} select {', '.join(LINE_KEYS)}, target, round({LINEAR_SQL}, 6) as score from risk")
def score_linear(spark, folder):
    rows = scoring.score_linear(risk_rows(spark, folder), WEIGHTS, INTERCEPT)
    return _round(rows, "score").drop(*RISK_FEATURES)


@query(
    f"""with {RISK} select {', '.join(LINE_KEYS)}, round({LINEAR_SQL}, 6) as score,
    case when {LINEAR_SQL} > 0.3 then 1.0 else 0.0 end::double as prediction from risk"""
)
def threshold_predict(spark, folder):
    rows = scoring.score_linear(risk_rows(spark, folder), WEIGHTS, INTERCEPT)
    predicted = scoring.threshold_predict(rows, "score", 0.3)
    return _round(predicted, "score").drop("target", *RISK_FEATURES)


@query(
    f"""with {WORDS},
    tf as (select doc_id, {SLOT_SQL} as slot, count(*) as tf from words group by all),
    z as (select doc_id, -1.0::double + sum(tf * ((slot % 7) - 3) * 0.001::double) as z from tf group by doc_id)
    select doc_id, round(z, 6) as z, round(1.0 / (1.0 + exp(-z)), 6) as score from z"""
)
def score_linear_long(spark, folder):
    """Every hashed slot has a weight derived from its number."""
    documents = table(spark, folder, "documents", "doc_id", "text")
    values = hashed_term_frequency(documents, "doc_id", "text")
    weights = spark.range(10_000).select(
        F.col("id").cast("int").alias("slot"), ((F.col("id") % 7 - 3) * 0.001).alias("weight")
    )
    scored = scoring.score_linear_long(values, weights, "doc_id", "slot", "tf", -1.0)
    return _round(scored, "z", "score")
