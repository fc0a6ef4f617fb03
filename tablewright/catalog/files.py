"""Sources and sinks.  Tables are written to the shared folder and read back."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.catalog.evaluation import METRICS_OF_SCORED
from tablewright.catalog.registry import DIRTY, LINE_KEY_SQL, RISK, query
from tablewright.functions import vector_element
from tablewright.operators.evaluate import confusion_matrix, evaluate_model
from tablewright.operators.joins import union_all
from tablewright.operators.ordering import preview
from tablewright.operators.score import score_linear, threshold_predict
from tablewright.plans.standins import DIRTY_COLUMNS, dirty_rows, line_keys, risk_rows, table
from tablewright.session import scratch_path
from tablewright.sources import (
    read_results,
    scan_by_uri as read_uri,
    scan_csv_header as read_csv_header,
    scan_csv_headerless as read_csv_headerless,
    scan_csv_text as read_csv_text,
    write_coefficients as save_coefficients,
    write_confusion as save_confusion,
    write_metrics as save_metrics,
    write_predictions as save_predictions,
)


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def scan_by_uri(spark, folder):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    return read_uri(spark, f"{folder}/orders.parquet", columns)


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_csv_header(spark, folder):
    source = table(
        spark, folder, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    path = scratch_path(spark, "csv-header")
    source.write.option("header", True).csv(path)
    return read_csv_header(spark, path, source.schema)


@query(
    f"with {DIRTY} select order_id, ltrim(cents) as cents, ltrim(status) as status, "
    "ltrim(priority) as priority, ltrim(unused) as unused, ltrim(label) as label from dirty"
)
def scan_csv_headerless(spark, folder):
    path = scratch_path(spark, "csv-headerless")
    (
        dirty_rows(spark, folder)
        .write.option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_csv_headerless(spark, path, DIRTY_COLUMNS)


@query("select cast(doc_id as varchar) as id, md5(text) as text_md5, length(text) as n from documents")
def scan_csv_text(spark, folder):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "comment_text")])
    path = scratch_path(spark, "csv-text")
    (
        table(spark, folder, "documents", "doc_id", "text")
        .toDF("id", "comment_text")
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    rows = read_csv_text(spark, path, schema)
    return rows.select("id", F.md5("comment_text").alias("text_md5"), F.length("comment_text").alias("n"))


PRICE_SCORE = "1.0 / (1.0 + exp(-(-5.0 + 0.0001 * l_extendedprice)))"


def _scored(spark, folder):
    rows = score_linear(risk_rows(spark, folder), {"l_extendedprice": 0.0001}, -5.0)
    return threshold_predict(rows, "score")


@query(
    f"""with {RISK}
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, target,
           case when {PRICE_SCORE} > 0.5 then 1.0 else 0.0 end::double as prediction,
           round({PRICE_SCORE}, 6) as score
    from risk"""
)
def write_predictions(spark, folder):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    scored = _scored(spark, folder).select(
        *keys, "target", "prediction", F.round("score", 6).alias("score")
    )
    path = scratch_path(spark, "predictions")
    save_predictions(scored, path, partition_by=["target"])
    return spark.read.schema(scored.schema).parquet(path).select(scored.columns)


@query(
    f"""with {RISK},
    scored as (select 'price' as model, target, {PRICE_SCORE} as score,
               case when {PRICE_SCORE} > 0.5 then 1.0 else 0.0 end::double as prediction from risk),
    {METRICS_OF_SCORED}
    select model, metric, round(value, 6) as value from all_metrics"""
)
def write_metrics(spark, folder):
    scored = _scored(spark, folder).withColumn("model", F.lit("price"))
    metrics = evaluate_model(scored, "target", "prediction", "score")
    path = scratch_path(spark, "metrics")
    save_metrics(metrics, path)
    return read_results(spark, path, "metrics").withColumn("value", F.round("value", 6))


@query(
    """select 'l_quantity' as feature, round(corr(l_quantity, l_extendedprice), 6) as coefficient
       from lineitem
       union all
       select 'l_discount', round(corr(l_discount, l_extendedprice), 6) from lineitem
       union all
       select 'intercept', round(avg(l_tax), 6) from lineitem"""
)
def write_coefficients(spark, folder):
    lines = table(spark, folder, "lineitem", "l_quantity", "l_discount", "l_extendedprice", "l_tax")
    wide = lines.agg(
        F.corr("l_quantity", "l_extendedprice").alias("l_quantity"),
        F.corr("l_discount", "l_extendedprice").alias("l_discount"),
        F.avg("l_tax").alias("intercept"),
    )
    path = scratch_path(spark, "coefficients")
    save_coefficients(wide.unpivot([], wide.columns, "feature", "coefficient"), path)
    return read_results(spark, path, "coefficients").withColumn(
        "coefficient", F.round("coefficient", 6)
    )


@query(
    f"""with {RISK}
    select target, case when {PRICE_SCORE} > 0.5 then 1.0 else 0.0 end::double as prediction,
           count(*) as count
    from risk group by all"""
)
def write_confusion(spark, folder):
    path = scratch_path(spark, "confusion")
    save_confusion(confusion_matrix(_scored(spark, folder), "target", "prediction"), path)
    return read_results(spark, path, "confusion")


@query(
    """select o_orderkey, o_orderstatus, o_totalprice from orders
       order by o_totalprice desc, o_orderkey limit 20"""
)
def preview_rows(spark, folder):
    orders = table(spark, folder, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return preview(orders, columns, [F.col("o_totalprice").desc(), "o_orderkey"], 20)


@query("select vec_id, round(embedding[2]::double, 6) as element from embeddings")
def vector_element_of(spark, folder):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    vectors = vectors.withColumn("vector", array_to_vector("embedding"))
    return vectors.select("vec_id", F.round(vector_element("vector", 1), 6).alias("element"))


#: A number for a line of ``lineitem``: 60 bits of the md5 of all that names it.
LINE_UID_SQL = f"""('0x' || substr(md5({" || '|' || ".join(f"coalesce(cast({k} as varchar), '')" for k in LINE_KEY_SQL)}), 1, 15))::bigint"""


def _line_uid():
    keys = [k if isinstance(k, Column) else F.col(k) for k in line_keys()]
    name = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


@query(
    f"""with {RISK},
    scored as (select target, {PRICE_SCORE} as score, case when {PRICE_SCORE} > 0.5 then 1.0 else 0.0 end::double as prediction from risk),
    counted as (select count(*) as n, sum(target) as positives, sum(prediction) as alarms from scored),
    long as (select unnest(['n', 'positives', 'alarms']) as metric, unnest([n::double, positives::double, alarms::double]) as value from counted)
    select 'run_metrics' as kind, metric as name, value from long
    union all select 'classifier_metrics', 'price ' || metric, value from long
    union all select 'label_predictions', 'UID ' || {LINE_UID_SQL}, round(l_discount, 2) from risk
    union all select 'sample_predictions', l_orderkey || ' ' || l_linenumber || ' ' || target, round(l_quantity, 2) from risk"""
)
def read_saved_results(spark, folder):
    """Tables of every layout that names its columns by task, written as CSV and read back, with all lines."""
    back = {kind: read for kind, (_, read) in saved_and_read_back(spark, folder).items()}
    place = F.concat_ws(" ", *[F.col(c).cast("bigint").cast("string") for c in ("order", "line", "target")])
    named = {
        "run_metrics": (F.col("metric"), F.col("value")),
        "classifier_metrics": (F.concat_ws(" ", "classifier", "metric"), F.col("value")),
        "label_predictions": (F.concat(F.lit("UID "), F.col("UID").cast("string")), F.round(F.col("proba_first").cast("double"), 2)),
        "sample_predictions": (place, F.round("l_quantity", 2)),
    }
    return union_all(*[back[k].select(F.lit(k).alias("kind"), n.alias("name"), v.alias("value")) for k, (n, v) in named.items()])


def saved_and_read_back(spark, folder):
    """By kind, the table as written to its layout, of all lines, and as read back."""
    scored = _scored(spark, folder)
    counted = scored.agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("target").cast("double").alias("positives"), F.sum("prediction").alias("alarms")
    )
    long = counted.unpivot([], counted.columns, "metric", "value")
    lines = risk_rows(spark, folder)
    tables = {
        "run_metrics": long,
        "classifier_metrics": long.select(F.lit("price").alias("classifier"), "metric", "value"),
        "label_predictions": lines.select(
            _line_uid().alias("UID"), F.col("l_discount").cast("float").alias("proba_first"), F.lit(1.0).alias("pred_first")
        ),
        "sample_predictions": lines.select(
            F.col("l_quantity").cast("double"), F.col("l_orderkey").cast("double").alias("order"),
            F.col("l_linenumber").cast("double").alias("line"), F.col("target").cast("int"),
            F.lit(1.0).alias("prediction"), F.lit(0.5).cast("float").alias("risk"),
        ),
    }
    back = {}
    for kind, df in tables.items():
        path = scratch_path(spark, kind)
        df.write.option("header", True).csv(path)
        back[kind] = (df, read_results(spark, path, kind))
    return back
