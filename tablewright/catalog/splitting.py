"""Splits, samples, folds and joins of scored tables."""

import uuid

from pyspark.sql import functions as F

from tablewright.catalog.registry import LINE_KEY_SQL, bucket_sql, query
from tablewright.operators import joins, split
from tablewright.plans.standins import LINE_FRACTIONS, LINE_KEYS, line_keys, table
from tablewright.session import scratch_path
from tablewright.sources import write_bucketed

LINE_COLUMNS = [*LINE_KEYS, *LINE_FRACTIONS]


@query(
    f"select {', '.join(LINE_COLUMNS)}, "
    f"case when {bucket_sql('47', 100, *LINE_KEY_SQL)} < 80 then 'train' else 'test' end as part "
    "from lineitem"
)
def split_train_test(spark, folder):
    rows = table(spark, folder, "lineitem", *LINE_COLUMNS)
    train, test = split.split_train_test(rows, line_keys(), 80, 47)
    return joins.union_all(
        train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))
    )


@query(f"select o_orderkey, o_totalprice from orders where {bucket_sql('sample47', 100, 'o_orderkey')} < 40")
def sample_fraction(spark, folder):
    rows = table(spark, folder, "orders", "o_orderkey", "o_totalprice")
    return split.sample_fraction(rows, ["o_orderkey"], 40, 47)


@query(f"select o_orderkey, cast({bucket_sql('fold47', 3, 'o_orderkey')} as integer) as fold from orders")
def kfold_assign(spark, folder):
    return split.kfold_assign(table(spark, folder, "orders", "o_orderkey"), ["o_orderkey"], 3, 47)


@query(
    """select o_orderkey, o_totalprice / 500000 as proba_price,
              1.0 / (1.0 + o_custkey) as proba_customer from orders"""
)
def join_predictions(spark, folder):
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice", "o_custkey")
    by_price = orders.select("o_orderkey", (F.col("o_totalprice") / 500000).alias("proba_price"))
    by_customer = orders.select(
        "o_orderkey", (F.lit(1.0) / (1.0 + F.col("o_custkey"))).alias("proba_customer")
    )
    return joins.join_predictions(by_price, by_customer, "o_orderkey")


FAN_IN_SQL = """select o_orderkey, o_totalprice / 500000 as proba_price,
              case when o_totalprice / 500000 > 0.5 then 1.0 else 0.0 end::double as pred_price,
              length(o_orderpriority) / 20.0::double as proba_priority,
              case when length(o_orderpriority) / 20.0::double > 0.5 then 1.0 else 0.0 end::double as pred_priority
       from orders"""


def _orders_and_scores(spark, folder):
    orders = table(spark, folder, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    scores = {
        "price": F.col("o_totalprice") / 500000,
        "priority": F.length("o_orderpriority") / 20.0,
    }
    scored = [
        orders.select(
            "o_orderkey",
            s.alias(f"proba_{label}"),
            F.when(s > 0.5, 1.0).otherwise(0.0).alias(f"pred_{label}"),
        )
        for label, s in scores.items()
    ]
    return orders.select("o_orderkey"), scored


@query(FAN_IN_SQL)
def multi_label_fan_in(spark, folder):
    ids, scored = _orders_and_scores(spark, folder)
    return joins.multi_label_fan_in(ids, scored, "o_orderkey")


@query(FAN_IN_SQL)
def fan_in_saved(spark, folder):
    """The same from tables saved in buckets, which join without a shuffle."""
    ids, scored = _orders_and_scores(spark, folder)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = []
    for df in (ids, *scored):
        names.append(f"scores_{uuid.uuid4().hex}")
        write_bucketed(df, names[-1], "o_orderkey", buckets, scratch_path(spark, "scores"))
    wide = joins.fan_in_saved(spark, names, "o_orderkey")
    for name in names:  # only its entry in the catalog: the files stay until the driver exits
        spark.sql(f"drop table {name}")
    return wide
