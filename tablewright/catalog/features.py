"""Text and categorical features."""

from math import log

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tablewright.catalog.registry import (
    INCOME,
    LINE_KEY_SQL,
    RISK,
    bucket_sql,
    query,
)
from tablewright.operators import features as ops
from tablewright.operators.clean import null_tokens
from tablewright.operators.slots import SlotStages
from tablewright.operators.split import split_train_test
from tablewright.plans.standins import (
    INCOME_CATEGORICAL,
    INCOME_NUMERIC,
    LINE_KEYS,
    RISK_FEATURES,
    income_rows,
    labeled_texts,
    line_keys,
    risk_rows,
    table,
    texts,
)
from tablewright.session import materialize

BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS_SQL = f"""case when lower(text) = '' then ['']
  when rtrim(lower(text), {BLANKS_SQL}) = '' then []::varchar[]
  else regexp_split_to_array(rtrim(lower(text), {BLANKS_SQL}), '[ \\t\\n\\x0B\\f\\r]') end"""

WORDS = f"words as (select doc_id, unnest({WORDS_SQL}) as term from documents)"
SLOT_SQL = f"cast({bucket_sql('slot', 10000, 'term')} as integer)"


def _documents(spark, folder):
    return table(spark, folder, "documents", "doc_id", "text")


@query(
    f"""with t as (select doc_id, {WORDS_SQL} as words from documents)
    select doc_id, len(words)::integer as n_words, md5(array_to_string(words, chr(31))) as words_md5 from t"""
)
def tokenize(spark, folder):
    rows = ops.tokenize(texts(spark, folder), "text")
    joined = F.array_join("words", "\x1f")
    return rows.select("doc_id", F.size("words").alias("n_words"), F.md5(joined).alias("words_md5"))


@query(f"with {WORDS} select doc_id, term, count(*) as tf from words group by all")
def term_frequency(spark, folder):
    return ops.term_frequency(_documents(spark, folder), "doc_id", "text")


@query(f"with {WORDS} select doc_id, {SLOT_SQL} as slot, count(*) as tf from words group by all")
def hashed_term_frequency(spark, folder):
    return ops.hashed_term_frequency(_documents(spark, folder), "doc_id", "text")


@query(f"with {WORDS} select term, count(distinct doc_id) as df from words group by term")
def document_frequency(spark, folder):
    return ops.document_frequency(texts(spark, folder), "text")


@query(
    f"""with {WORDS}
    select term, count(distinct doc_id) as df,
           round(ln(((select count(*) from documents) + 1) / (count(distinct doc_id) + 1)::double), 6) as idf
    from words group by term"""
)
def idf(spark, folder):
    counts = ops.document_frequency(texts(spark, folder), "text")
    documents = table(spark, folder, "documents", "doc_id")
    return ops.idf(counts, documents).withColumn("idf", F.round("idf", 6))


def _weighted(key):
    """Weights from the labeled texts applied to the unlabeled ones."""
    return f"""with {WORDS},
    tf as materialized (select doc_id, {key} as unit, count(*) as tf from words group by all),
    known as materialized (select tf.unit, tf.doc_id from tf semi join labels on tf.doc_id = labels.doc_id),
    weights as materialized (
      select unit,
             ln(((select count(*) from labels) + 1) / (count(*) + 1)::double) as idf
      from known group by unit)
    select tf.doc_id, tf.unit, tf.tf, round(idf, 6) as idf, round(tf.tf * idf, 6) as tfidf
    from (select tf.* from tf anti join labels on tf.doc_id = labels.doc_id) tf
    join weights on tf.unit = weights.unit"""


def _train_and_test(spark, folder):
    documents, labels = _documents(spark, folder), table(spark, folder, "labels", "doc_id")
    return (
        documents.join(labels, "doc_id", "left_semi"),
        documents.join(labels, "doc_id", "left_anti"),
        labels,
    )


@query(_weighted("term"))
def tf_idf(spark, folder):
    train, test, labels = _train_and_test(spark, folder)
    counts = ops.document_frequency(train, "text")
    weights = materialize(ops.idf(counts, labels), "idf")
    tf = ops.term_frequency(test, "doc_id", "text")
    return ops.tf_idf(tf, weights, "doc_id").select(
        "doc_id",
        F.col("term").alias("unit"),
        "tf",
        F.round("idf", 6).alias("idf"),
        F.round("tfidf", 6).alias("tfidf"),
    )


@query(_weighted(SLOT_SQL))
def hashed_tf_idf(spark, folder):
    train, test, labels = _train_and_test(spark, folder)
    train_tf = ops.hashed_term_frequency(train, "doc_id", "text")
    weights = ops.idf(ops.hashed_document_frequency(train_tf), labels)
    tf = ops.hashed_term_frequency(test, "doc_id", "text")
    return ops.hashed_tf_idf(tf, weights, "doc_id").select(
        "doc_id",
        F.col("slot").alias("unit"),
        "tf",
        F.round("idf", 6).alias("idf"),
        F.round("tfidf", 6).alias("tfidf"),
    )


@query()
def hashing_tf(spark, folder):
    """Totals per slot of the hashed counts that models are trained on."""
    words, counts, _ = ops.text_stages("text")
    vectors = PipelineModel([words, counts]).transform(texts(spark, folder))
    summary = Summarizer.metrics("sum", "numNonZeros").summary(F.col(counts.getOutputCol()))
    totals = vectors.agg(summary.alias("s")).select(
        vector_to_array("s.sum").alias("tf"), vector_to_array("s.numNonZeros").alias("df")
    )
    pairs = F.posexplode(F.arrays_zip("tf", "df")).alias("slot", "pair")
    return totals.select(pairs).select("slot", "pair.tf", "pair.df")


@query(f"with {WORDS} select count(*)::double as n_words from words")
def hashing_tf_total(spark, folder):
    """The hashed counts of all slots add up to the number of words."""
    slots = hashing_tf(spark, folder)
    return slots.agg(F.sum("tf").alias("n_words"))


@query(
    """select cast(range as integer) as slot, (select count(*) from labels where toxic is not null) as n_texts,
    true as fits from range(10000)"""
)
def idf_model(spark, folder):
    """Every slot, the number of labeled texts, and whether its weight follows from its counts."""
    train = labeled_texts(spark, folder).filter(F.col("toxic").isNotNull())
    fitted = ops.fit_stages(ops.text_stages("text"), train).stages[-1]
    n = fitted.numDocs
    rows = [
        (slot, int(n), abs(float(weight) - log((n + 1) / (df + 1))) < 1e-9)
        for slot, (df, weight) in enumerate(zip(fitted.docFreq, fitted.idf.toArray()))
    ]
    return spark.createDataFrame(rows, "slot int, n_texts bigint, fits boolean")


def _index_sql(source, column):
    return f"""select '{column}' as "column", {column} as category, count(*) as n,
      cast(row_number() over (order by count(*) desc, {column}) - 1 as integer) as idx
      from {source} where {column} is not null group by {column}"""


@query(f"with {INCOME} " + " union all ".join(_index_sql("income", c) for c in INCOME_CATEGORICAL))
def string_index(spark, folder):
    return ops.string_index(income_rows(spark, folder), INCOME_CATEGORICAL)


ORDER_CATEGORIES = ["o_orderstatus", "o_orderpriority"]

TRAIN_ORDERS = f"""
train as (
  select o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') as o_orderpriority
  from orders where {bucket_sql('47', 100, 'o_orderkey')} < 80),
dictionary as ({' union all '.join(_index_sql('train', c) for c in ORDER_CATEGORIES)})
"""


def _order_dictionary(spark, folder):
    """Categories of the training part, where one priority counts as missing."""
    orders = table(spark, folder, "orders", "o_orderkey", *ORDER_CATEGORIES)
    train, _ = split_train_test(null_tokens(orders, "4-NOT SPECIFIED"), ["o_orderkey"], 80, 47)
    return orders, ops.string_index(train, ORDER_CATEGORIES)


@query(
    f"""with {TRAIN_ORDERS},
    sizes as (select "column", cast(count(*) as integer) as size from dictionary group by 1)
    select o_orderkey, o_orderstatus, o_orderpriority,
      coalesce(s.idx, (select size from sizes where "column" = 'o_orderstatus')) as o_orderstatus_idx,
      coalesce(p.idx, (select size from sizes where "column" = 'o_orderpriority')) as o_orderpriority_idx
    from orders
    left join dictionary s on s."column" = 'o_orderstatus' and s.category = o_orderstatus
    left join dictionary p on p."column" = 'o_orderpriority' and p.category = o_orderpriority"""
)
def apply_index(spark, folder):
    orders, dictionary = _order_dictionary(spark, folder)
    return ops.apply_index(orders, dictionary, ORDER_CATEGORIES)


@query(
    f"""with {TRAIN_ORDERS},
    long as (select o_orderkey, 'o_orderstatus' as "column", o_orderstatus as category from orders
             union all select o_orderkey, 'o_orderpriority', o_orderpriority from orders)
    select o_orderkey, l."column", d.idx as slot, 1.0::double as value
    from long l join dictionary d on l."column" = d."column" and l.category = d.category"""
)
def one_hot(spark, folder):
    orders, dictionary = _order_dictionary(spark, folder)
    return ops.one_hot(orders, dictionary, ["o_orderkey"], ORDER_CATEGORIES)


@query(
    f"with {RISK} select {', '.join(LINE_KEYS)}, "
    + ", ".join(f"{c}::double as f{i}" for i, c in enumerate(RISK_FEATURES))
    + " from risk"
)
def assemble(spark, folder):
    rows = ops.assemble(risk_rows(spark, folder), RISK_FEATURES)
    return rows.select(*LINE_KEYS, *[F.col("features")[i].alias(f"f{i}") for i in range(4)])


@query(
    f"""with {INCOME},
    bucketed as (select *, {bucket_sql('47', 100, *LINE_KEY_SQL)} as b from income)
    select {', '.join(LINE_KEYS)}, label,
      cast(3 + (select {' + '.join(f'count(distinct {c})' for c in INCOME_CATEGORICAL)}
                from bucketed where b < 80) as integer) as n_slots,
      cast({' + '.join(f'({c} in (select {c} from bucketed where b < 80))::integer' for c in INCOME_CATEGORICAL)}
           as double) as n_set,
      p_retailprice as price
    from bucketed where b >= 80"""
)
def feature_stages(spark, folder):
    """Stages fitted on the training part, applied to the held-out part."""
    train, test = split_train_test(income_rows(spark, folder), line_keys(), 80, 47)
    prepared = ops.fit_stages(ops.table_stages(INCOME_CATEGORICAL, INCOME_NUMERIC), train)
    rows = prepared.transform(test).withColumn("f", vector_to_array("features"))
    hot = F.slice("f", len(INCOME_NUMERIC) + 1, F.size("f"))
    return rows.select(
        *LINE_KEYS,
        "label",
        F.size("f").alias("n_slots"),
        F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("n_set"),
        F.col("f")[2].alias("price"),
    )


#: Categories of fewer training rows share a slot in :func:`feature_slots`.
LEAST_COUNT = 350


def _slots_sql(c):
    often = f"(select {c} from bucketed where b < 80 group by {c} having count(*) >= {LEAST_COUNT})"
    rare = f"(select {c} from bucketed where b < 80 group by {c} having count(*) < {LEAST_COUNT})"
    return often, rare


@query(
    f"""with {INCOME},
    bucketed as (select *, {bucket_sql('47', 100, *LINE_KEY_SQL)} as b from income)
    select {', '.join(LINE_KEYS)}, label,
      cast(3 + {' + '.join(f'(select count(*) from {often}) + (select least(count(*), 1) from {rare})' for often, rare in map(_slots_sql, INCOME_CATEGORICAL))} as integer) as n_slots,
      cast({' + '.join(f'({c} in {_slots_sql(c)[0]})::integer + ({c} in {_slots_sql(c)[1]})::integer' for c in INCOME_CATEGORICAL)} as double) as n_set,
      cast({' + '.join(f'({c} in {_slots_sql(c)[1]})::integer' for c in INCOME_CATEGORICAL)} as double) as n_shared
    from bucketed where b >= 80"""
)
def feature_slots(spark, folder):
    """Vectors from the written dictionary, rare categories in a slot of their column."""
    rows = materialize(income_rows(spark, folder), "income")
    train, test = split_train_test(rows, line_keys(), 80, 47)
    slots = SlotStages(tuple(INCOME_CATEGORICAL), tuple(INCOME_NUMERIC), LEAST_COUNT).fit(train)
    found = slots.transform(test).withColumn("f", vector_to_array("features"))
    hot = F.slice("f", len(INCOME_NUMERIC) + 1, F.size("f"))
    shared = [F.col("f")[first + often] for _, first, often, n in slots.columns if n > often]
    return found.select(
        *LINE_KEYS,
        "label",
        F.size("f").alias("n_slots"),
        F.aggregate(hot, F.lit(0.0), lambda a, x: a + x).alias("n_set"),
        sum(shared, F.lit(0.0)).alias("n_shared"),
    )


@query(
    f"with {INCOME}, dictionary as ("
    + " union all ".join(
        f"select {i} as part, * from ({_index_sql('income', c)})"
        for i, c in enumerate(INCOME_CATEGORICAL)
    )
    + """), names as (
      select -1 as part, range as idx, ['l_quantity', 'p_size', 'p_retailprice'][range + 1] as name from range(3)
      union all
      select part, idx, "column" || '_vec_' || category from dictionary)
    select cast(row_number() over (order by part, idx) - 1 as integer) as slot, name from names"""
)
def feature_names(spark, folder):
    rows = income_rows(spark, folder)
    prepared = ops.fit_stages(ops.table_stages(INCOME_CATEGORICAL, INCOME_NUMERIC), rows)
    names = ops.feature_names(prepared.transform(rows.limit(0)))
    return spark.createDataFrame(list(enumerate(names)), "slot int, name string")
