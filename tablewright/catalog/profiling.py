"""Profiles, sorted reports and top-k."""

from pyspark.sql import functions as F

from tablewright.catalog.registry import LABELED, RISK, query
from tablewright.operators import ordering, profile
from tablewright.plans.standins import RISK_FEATURES, risk_rows, table

LABELS = ["toxic", "quality"]


def _rounded(df, *keep, digits=6):
    return df.select(
        *keep, *[F.round(c, digits).alias(c) for c in df.columns if c not in set(keep)]
    )


@query(
    """select count(*) as n_rows, 11 as n_columns,
       'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,'
       || 'l_returnflag,l_linestatus,l_shipdate' as columns from lineitem"""
)
def table_shape(spark, folder):
    return profile.table_shape(table(spark, folder, "lineitem"))


@query(
    """select o_orderpriority, count(*) as n,
       round(count(*) / (select count(*) from orders)::double, 6) as share
       from orders group by o_orderpriority"""
)
def class_balance(spark, folder):
    balance = profile.class_balance(table(spark, folder, "orders"), "o_orderpriority")
    return _rounded(balance, "o_orderpriority", "n")


@query(
    """select 'toxic' as label, cast(sum(toxic) as bigint) as positives from labels
       union all select 'quality', cast(sum(quality) as bigint) from labels"""
)
def label_counts(spark, folder):
    return profile.label_counts(table(spark, folder, "labels"), LABELS)


@query("select toxic + quality as n_labels, count(*) as n from labels group by 1")
def labels_per_row(spark, folder):
    return profile.labels_per_row(table(spark, folder, "labels"), LABELS)


@query(
    f"""with {LABELED}, t as (
      select case when coalesce(toxic, 0) + coalesce(quality, 0) > 0 then 'any label'
                  else 'clean' end as "group" from labeled)
    select "group", count(*) as n,
           round(100 * (count(*) / (select count(*) from t)::double), 6) as percent
    from t group by 1"""
)
def any_label_share(spark, folder):
    labels = table(spark, folder, "labels")
    rows = table(spark, folder, "documents", "doc_id").join(labels, "doc_id", "left")
    return _rounded(profile.any_label_share(rows, LABELS), "group", "n")


@query(
    """select lang, count(*) as n, round(avg(case when toxic = 1 then 1.0 else 0.0 end), 6) as rate
       from documents d join labels l on d.doc_id = l.doc_id group by lang"""
)
def rate_by_group(spark, folder):
    documents = table(spark, folder, "documents", "doc_id", "lang")
    rows = documents.join(table(spark, folder, "labels", "doc_id", "toxic"), "doc_id")
    return _rounded(profile.rate_by_group(rows, "lang", F.col("toxic") == 1), "lang", "n")


@query("select doc_id, length(text) as text_length from documents")
def text_length(spark, folder):
    return profile.text_length(table(spark, folder, "documents", "doc_id", "text"), "text").drop("text")


def _corr_sql(pairs):
    return " union all ".join(
        f"select '{a}' as row, '{b}' as col, round(corr({a}, {b}), 6) as corr from risk"
        for a, b in pairs
    )


RISK_ALL = [*RISK_FEATURES, "target"]
RISK_PAIRS = [(RISK_ALL[j], RISK_ALL[i]) for i in range(5) for j in range(i + 1, 5)]


@query(f"with {RISK} {_corr_sql(RISK_PAIRS)}")
def correlation_matrix(spark, folder):
    return _rounded(profile.correlation_matrix(risk_rows(spark, folder), RISK_ALL), "row", "col")


@query(
    f"with {RISK} "
    + " union all ".join(
        f"select '{c}' as feature, round(corr({c}, target), 6) as corr from risk"
        for c in RISK_FEATURES
    )
)
def correlation_with_target(spark, folder):
    found = profile.correlation_with_target(risk_rows(spark, folder), RISK_FEATURES, "target")
    return _rounded(found, "feature")


def _describe_sql(column):
    return f"""select '{column}' as feature, count({column}) as n, round(avg({column}), 4) as mean,
      round(stddev_samp({column}), 4) as std, min({column})::double as min,
      round(quantile_cont({column}, 0.25), 4) as q25, round(quantile_cont({column}, 0.5), 4) as q50,
      round(quantile_cont({column}, 0.75), 4) as q75, max({column})::double as max from lineitem"""


@query(" union all ".join(_describe_sql(c) for c in RISK_FEATURES))
def describe_numeric(spark, folder):
    described = profile.describe_numeric(risk_rows(spark, folder, for_training=True), RISK_FEATURES)
    return _rounded(described, "feature", "n", "min", "max", digits=4)


def _box_sql(column):
    return f"""select target, '{column}' as feature, q25, q50, q75, count(*) as n,
      min(case when {column} between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) then {column} end) as whisker_low,
      max(case when {column} between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) then {column} end) as whisker_high,
      cast(sum(case when {column} between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) then 0 else 1 end) as bigint) as outliers
      from risk join (
        select target as t, quantile_cont({column}, 0.25) as q25, quantile_cont({column}, 0.5) as q50,
               quantile_cont({column}, 0.75) as q75 from risk group by target) on target = t
      group by all"""


@query(
    f"with {RISK} select target, feature, round(q25, 4) as q25, round(q50, 4) as q50, "
    "round(q75, 4) as q75, n, round(whisker_low, 4) as whisker_low, "
    "round(whisker_high, 4) as whisker_high, outliers from ("
    + " union all ".join(_box_sql(c) for c in RISK_FEATURES)
    + ")"
)
def five_number_by_class(spark, folder):
    boxes = profile.five_number_by_class(risk_rows(spark, folder, for_training=True), RISK_FEATURES, "target")
    return _rounded(boxes, "target", "feature", "n", "outliers", digits=4)


def _histogram_sql(source, value, low, high, bins, by=None):
    """Bins of ``value`` with the width of the range, zeros filled in."""
    keep = f"{by}, " if by else ""
    groups = f"(select distinct {by} from {source} where {value} between {low} and {high})" if by else "(select 1)"
    match = f"and g.{by} = f.{by}" if by else ""
    bin_of = f"least(cast(floor(({value} - {low}) / (({high} - {low}) / {bins}::double)) as integer), {bins - 1})"
    return f"""
    select {'g.' + keep if by else ''} b.bin, round({low} + b.bin * (({high} - {low}) / {bins}::double), 6) as low,
           round({low} + (b.bin + 1) * (({high} - {low}) / {bins}::double), 6) as high, coalesce(f.n, 0) as n
    from {groups} g, (select cast(range as integer) as bin from range({bins})) b
    left join (select {keep} {bin_of} as bin, count(*) as n from {source}
               where {value} between {low} and {high} group by all) f
    on b.bin = f.bin {match}"""


@query(
    "with ends as (select min(n_chars)::double as lo, max(n_chars)::double as hi from documents), "
    "t as (select n_chars::double as v, lo, hi from documents, ends), "
    "f as (select least(cast(floor((v - lo) / ((hi - lo) / 100::double)) as integer), 99) as bin, "
    "count(*) as n from t group by 1) "
    "select b.bin, round(lo + b.bin * ((hi - lo) / 100::double), 6) as low, "
    "round(lo + (b.bin + 1) * ((hi - lo) / 100::double), 6) as high, coalesce(f.n, 0) as n "
    "from ends, (select cast(range as integer) as bin from range(100)) b left join f on b.bin = f.bin"
)
def histogram(spark, folder):
    bins = profile.histogram(table(spark, folder, "documents", "n_chars"), "n_chars", 100)
    return _rounded(bins, "bin", "n")


@query(f"with {RISK} {_histogram_sql('risk', 'l_extendedprice', '0.0::double', '60000.0::double', 20, 'target')}")
def histogram_by_class(spark, folder):
    bins = profile.histogram(risk_rows(spark, folder), "l_extendedprice", 20, 0.0, 60000.0, "target")
    return _rounded(bins, "target", "bin", "n")


@query(
    "with scores as (select 'discount' as label, l_discount * 8 as v from lineitem "
    "union all select 'tax', l_tax * 8 from lineitem) "
    + _histogram_sql("scores", "v", "0.0::double", "1.0::double", 30, "label")
)
def probability_distribution(spark, folder):
    lines = table(spark, folder, "lineitem", "l_discount", "l_tax")
    scores = lines.select(
        (F.col("l_discount") * 8).alias("proba_discount"), (F.col("l_tax") * 8).alias("proba_tax")
    )
    return _rounded(profile.probability_distribution(scores, 30), "label", "bin", "n")


@query("select c_custkey, c_acctbal, c_mktsegment from customer")
def sort(spark, folder):
    rows = table(spark, folder, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    return ordering.sort(rows, "c_mktsegment", F.col("c_acctbal").desc(), "c_custkey")


@query("select doc_id, lang, source from documents order by doc_id limit 5")
def head_n(spark, folder):
    return ordering.head_n(table(spark, folder, "documents", "doc_id", "lang", "source"), 5, ["doc_id"])


def _supplier_weights(spark, folder):
    """Average balance per nation as a stand-in for a table of signed weights."""
    customers = table(spark, folder, "customer", "c_nationkey", "c_acctbal")
    name = F.when(F.col("c_nationkey") == 0, "intercept").otherwise(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))
    )
    return customers.groupBy(name.alias("feature")).agg(
        F.round(F.avg(F.col("c_acctbal") - 4500), 4).alias("coefficient")
    )


WEIGHTS = """weights as (
  select case when c_nationkey = 0 then 'intercept' else 'nation_' || c_nationkey end as feature,
         round(avg(c_acctbal - 4500), 4) as coefficient from customer group by 1)"""


@query(f"with {WEIGHTS} select * from weights where feature <> 'intercept'")
def rank_coefficients(spark, folder):
    return ordering.rank_coefficients(_supplier_weights(spark, folder))


@query(
    f"with {WEIGHTS} select * from weights where feature <> 'intercept' "
    "order by abs(coefficient) desc, feature limit 15"
)
def top_k_abs(spark, folder):
    weights = _supplier_weights(spark, folder).filter(F.col("feature") != "intercept")
    return ordering.top_k_abs(weights, "coefficient", ["feature"], 15)
