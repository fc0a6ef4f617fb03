"""Projections, casts, filters, cleaning and set operations."""

from pyspark.sql import functions as F

from tablewright.catalog.registry import DIRTY, query
from tablewright.functions import rounded
from tablewright.operators import clean as ops
from tablewright.operators.joins import union_all as union_tables
from tablewright.plans.standins import dirty_rows, table
from tablewright.operators.clean import CleanSpec

NEGATIVE = ["<=50K", "<=50K."]
POSITIVE = [">50K", ">50K."]

LABEL_SQL = """case when {c} in ('<=50K', '<=50K.') then 0 when {c} in ('>50K', '>50K.') then 1
               else try_cast({c} as integer) end"""


@query("select c_custkey as id, c_name as name, c_nationkey as nation from customer")
def rename_positional(spark, folder):
    rows = table(spark, folder, "customer", "c_custkey", "c_name", "c_nationkey")
    return ops.rename_positional(rows, ["id", "name", "nation"])


@query(
    f"""with {DIRTY}
    select cast(order_id as integer) as order_id, try_cast(trim(cents) as double) as cents,
           trim(status) as status, trim(priority) as priority, trim(unused) as unused,
           trim(label) as label
    from dirty"""
)
def cast_columns(spark, folder):
    rows = ops.trim_all(dirty_rows(spark, folder))
    return ops.cast_columns(rows, {"int": ["order_id"], "double": ["cents"]})


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def drop_columns(spark, folder):
    return ops.drop_columns(table(spark, folder, "orders"), ["o_orderdate", "o_orderpriority"])


@query("select doc_id, source, n_chars from documents")
def columns_except(spark, folder):
    rows = table(spark, folder, "documents")
    return rows.select(ops.columns_except(rows, "text", "lang"))


@query("select p_type, p_partkey, p_size from part")
def project(spark, folder):
    return ops.project(table(spark, folder, "part"), ["p_type", "p_partkey", "p_size"])


@query(
    """select event_id,
              value / 100.0 as proba_high, case when value / 100.0 > 0.3 then 1.0 else 0.0 end::double as pred_high,
              1.0 - value / 100.0 as proba_low,
              case when 1.0 - value / 100.0 > 0.3 then 1.0 else 0.0 end::double as pred_low
       from events"""
)
def derive_per_label(spark, folder):
    rows = table(spark, folder, "events", "event_id", "value")
    share = F.col("value") / 100.0
    return ops.derive_per_label(rows, {"high": share, "low": 1.0 - share}, 0.3).drop("value")


@query(
    """select md5('|' || length(cast(o_orderkey as varchar)) || ':' || cast(o_orderkey as varchar)) as uid,
    o_orderkey from orders"""
)
def surrogate_id(spark, folder):
    return ops.surrogate_id(table(spark, folder, "orders", "o_orderkey"), ["o_orderkey"])


@query("select p_partkey, round(p_retailprice / 7, 4) as price from part")
def round_for_report(spark, folder):
    rows = table(spark, folder, "part", "p_partkey", "p_retailprice")
    return rows.select("p_partkey", rounded(F.col("p_retailprice") / 7, 4).alias("price"))


@query(
    f"""with {DIRTY} select trim(order_id) as order_id, trim(cents) as cents,
    trim(status) as status, trim(priority) as priority, trim(unused) as unused,
    trim(label) as label from dirty"""
)
def trim_all(spark, folder):
    return ops.trim_all(dirty_rows(spark, folder))


@query("select o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') as o_orderpriority from orders")
def null_tokens(spark, folder):
    rows = table(spark, folder, "orders", "o_orderkey", "o_orderpriority")
    return ops.null_tokens(rows, "4-NOT SPECIFIED")


@query(
    """select o_orderkey, o_orderpriority from orders
       where o_orderpriority is not null and o_orderpriority <> '4-NOT SPECIFIED'"""
)
def drop_any_null(spark, folder):
    rows = table(spark, folder, "orders", "o_orderkey", "o_orderpriority")
    return ops.drop_any_null(ops.null_tokens(rows, "4-NOT SPECIFIED"))


@query(
    """select d.doc_id, l.toxic, l.quality from documents d left join labels l on d.doc_id = l.doc_id
       where l.toxic is not null and l.quality is not null"""
)
def drop_null_subset(spark, folder):
    labels = table(spark, folder, "labels")
    rows = table(spark, folder, "documents", "doc_id").join(labels, "doc_id", "left")
    return ops.drop_null_subset(rows, ["toxic", "quality"])


@query(
    """select o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') as o_orderpriority from orders
       where nullif(o_orderpriority, '4-NOT SPECIFIED') <> '5-LOW'"""
)
def filter_not_equal(spark, folder):
    rows = ops.null_tokens(
        table(spark, folder, "orders", "o_orderkey", "o_orderpriority"), "4-NOT SPECIFIED"
    )
    return ops.filter_not_equal(rows, "o_orderpriority", "5-LOW")


@query(
    f"with {DIRTY} select order_id, cents from dirty where try_cast(trim(cents) as double) is not null"
)
def filter_non_numeric_rows(spark, folder):
    rows = dirty_rows(spark, folder).select("order_id", "cents")
    return ops.filter_non_numeric_rows(rows, "cents")


@query(f"with {DIRTY} select order_id, rtrim(trim(label), '.') as label from dirty")
def normalize_label(spark, folder):
    return ops.normalize_label(dirty_rows(spark, folder).select("order_id", "label"), "label")


@query(
    f"with {DIRTY}, t as (select order_id, trim(label) as label from dirty) "
    f"select order_id, {LABEL_SQL.format(c='label')} as label from t"
)
def encode_binary_label(spark, folder):
    rows = ops.trim_all(dirty_rows(spark, folder).select("order_id", "label"))
    return ops.encode_binary_label(rows, "label", NEGATIVE, POSITIVE)


@query(
    f"""with {DIRTY},
    t as (select trim(order_id) as order_id, trim(cents) as cents, trim(status) as status,
                 nullif(trim(priority), '?') as priority, trim(label) as label from dirty)
    select order_id, try_cast(cents as double) as cents, status, priority,
           {LABEL_SQL.format(c='label')} as label
    from t where priority is not null"""
)
def clean_table(spark, folder):
    spec = CleanSpec(
        label="label",
        negative=NEGATIVE,
        positive=POSITIVE,
        drop=["unused"],
        numeric=["cents"],
        numeric_type="double",
    )
    return ops.clean_table(dirty_rows(spark, folder), spec)


@query(
    """select s_name as name, s_nationkey as nation, s_acctbal as balance from supplier
       union all
       select c_name, c_nationkey, c_acctbal from customer
       union all
       select s_name, s_nationkey, s_acctbal from supplier"""
)
def union_all(spark, folder):
    names = ["name", "nation", "balance"]
    suppliers = table(spark, folder, "supplier", "s_name", "s_nationkey", "s_acctbal").toDF(*names)
    customers = table(spark, folder, "customer", "c_name", "c_nationkey", "c_acctbal").toDF(*names)
    return union_tables(suppliers, customers, suppliers)
