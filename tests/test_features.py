import math
import re

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tablewright.operators import features, joins
from tablewright.operators.joins import frequent_keys, lookup_hot_keys
from tablewright.session import materialize

LETTERS = list("bbacad")


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame([(i, c) for i, c in enumerate(LETTERS)], "i int, c string")


def test_string_index_order(spark, letters):
    got = features.string_index(letters, ["c"]).collect()
    assert {r["category"]: r["idx"] for r in got} == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_string_index_equals_stage(spark, letters):
    from pyspark.ml.feature import StringIndexer

    dictionary = features.string_index(letters, ["c"])
    more = letters.union(spark.createDataFrame([(90, "zzz"), (91, None)], letters.schema))
    ours = features.apply_index(more, dictionary, ["c"])
    stage = StringIndexer(inputCol="c", outputCol="theirs", handleInvalid="keep").fit(letters)
    assert stage.transform(ours).filter(F.col("theirs") != F.col("c_idx")).count() == 0
    assert {r["c_idx"] for r in ours.filter("i >= 90").collect()} == {4}


def test_one_hot_equals_stages(spark, letters):
    stages = features.table_stages(["c"], [])
    more = letters.union(spark.createDataFrame([(90, "zzz"), (91, None)], letters.schema))
    vectors = features.fit_stages(stages, letters).transform(more)
    wide = vectors.select("i", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    theirs = {(r["i"], r["slot"]) for r in wide.filter("value > 0").collect()}
    ours = features.one_hot(more, features.string_index(letters, ["c"]), ["i"], ["c"]).collect()
    assert {(r["i"], r["slot"]) for r in ours} == theirs
    assert not [r for r in ours if r["i"] >= 90]
    assert wide.filter("i = 90").count() == 4


def test_feature_names(spark, letters):
    rows = letters.withColumn("n", F.col("i").cast("double"))
    vectors = features.fit_stages(features.table_stages(["c"], ["n"]), rows).transform(rows)
    assert features.feature_names(vectors) == ["n", "c_vec_a", "c_vec_b", "c_vec_c", "c_vec_d"]


def test_hashed_slots_are_numbered(spark):
    rows = spark.createDataFrame([(1, "a b")], "id int, text string")
    stages = features.text_stages("text", 4)
    vectors = features.fit_stages(stages, rows).transform(rows)
    assert features.feature_names(vectors, "features_tf") == [f"features_tf_{i}" for i in range(4)]


def test_idf_formula(spark):
    rows = spark.createDataFrame([(1, "a a b"), (2, "b"), (3, "c")], "id int, text string")
    weights = features.idf(features.document_frequency(rows, "text"), rows)
    got = {r["term"]: r["idf"] for r in weights.collect()}
    assert got["a"] == got["c"] == pytest.approx(math.log(4 / 2))
    assert got["b"] == pytest.approx(math.log(4 / 3))


def test_idf_equals_stage(spark):
    """The weight of a word that has a hash slot to itself equals its table weight."""
    texts = [f"w{i % 7} w{i % 3} x" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    fitted = features.fit_stages(features.text_stages("text", 1 << 18), rows)
    model = fitted.stages[-1]
    stage = sorted(round(v, 9) for v in model.idf.toArray() if abs(v - math.log(41)) > 1e-12)
    weights = features.idf(features.document_frequency(rows, "text"), rows).collect()
    assert stage == sorted(round(r["idf"], 9) for r in weights)


def test_hashed_counts_cover_all_words(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    n_words = rows.agg(F.sum(F.size(features.tokens("text")))).first()[0]
    words, counts, _ = features.text_stages("text")
    vectors = PipelineModel([words, counts]).transform(rows)
    total = vectors.agg(Summarizer.sum(F.col(counts.getOutputCol())).alias("s")).first()["s"]
    assert sum(total.toArray()) == n_words
    for table in (
        features.term_frequency(rows, "doc_id", "text"),
        features.hashed_term_frequency(rows, "doc_id", "text"),
    ):
        assert table.agg(F.sum("tf")).first()[0] == n_words


@pytest.mark.parametrize("count", [features.term_frequency, features.hashed_term_frequency])
def test_parts_of_a_word_count_grow_in_number(spark, count, monkeypatch):
    """More text makes more tasks, not larger ones; a repeated key and a null key still count as one each."""
    monkeypatch.setattr(features, "TASK_CHARACTERS", 100)
    rows = [(i, "one two two " + "x" * 20) for i in range(100)] + [(7, "two"), (None, "two"), (None, "two one"), (200, None)]
    texts = spark.createDataFrame(rows, "id int, text string")
    table = count(texts, "id", "text")
    assert table.rdd.getNumPartitions() >= 30
    assert count(texts.limit(0), "id", "text").count() == 0
    sums = {r["id"]: r["n"] for r in table.groupBy("id").agg(F.sum("tf").alias("n")).collect()}
    assert sums == {**dict.fromkeys(range(100), 4), 7: 5, None: 3}
    assert table.count() == table.select(*table.columns[:2]).distinct().count()


def test_parts_of_a_large_lookup_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    facts = spark.range(3000).select("id", (F.col("id") % 700).cast("string").alias("k"))
    table = facts.select("k").distinct().withColumn("w", F.length("k"))
    got = lookup_hot_keys(facts, table, "k", hot_share=0.5, most_broadcast_rows=0)
    assert "hashpartitioning(k" in (plan := got._jdf.queryExecution().executedPlan().toString())
    assert {int(n) for n in re.findall(r"hashpartitioning\(k#\d+, (\d+)\), REPARTITION_BY_NUM", plan)} == {37}
    assert got.count() == 3000


def test_tf_idf_drops_unseen_words(spark):
    train = spark.createDataFrame([(1, "a b"), (2, "b")], "id int, text string")
    test = spark.createDataFrame([(9, "b b new")], "id int, text string")
    weights = materialize(features.idf(features.document_frequency(train, "text"), train), "w")
    got = features.tf_idf(features.term_frequency(test, "id", "text"), weights, "id").collect()
    assert [(r["term"], r["tf"]) for r in got] == [("b", 2)]
    assert got[0]["tfidf"] == pytest.approx(2 * math.log(3 / 3))


def test_counting_words_needs_one_shuffle(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = features.term_frequency(rows, "doc_id", "text")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("most", [0, 1000])
@pytest.mark.parametrize("share", [0.001, 0.05, 0.9])
def test_hot_lookup_is_an_inner_join(spark, share, most):
    """Hot or not, every fact row meets its key's row once, and unknown keys drop out."""
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    table = materialize(
        facts.groupBy("k").agg(F.count("*").alias("n")).filter("k <> 'k7'").withColumn("w", F.length("k")),
        "hot",
    )
    got = lookup_hot_keys(facts, table, "k", hot_share=share, most_broadcast_rows=most)
    want = facts.join(table, "k")
    columns = ["id", "k", "w"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())


def test_frequent_keys_are_found_without_a_shuffle_of_keys(spark):
    keys = F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 9 == 0, None).otherwise(F.col("id").cast("string"))
    facts = spark.range(0, 20_000, 1, 7).select(keys.alias("k"))
    found = frequent_keys(facts, "k", 0.01)
    assert "hot" in {r["k"] for r in found.collect()} and found.count() <= 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_assemble_refuses_nulls(spark):
    rows = spark.createDataFrame([(1.0, 2), (3.0, None)], "a double, b int")
    good = features.assemble(rows.filter("b is not null"), ["b", "a"])
    assert good.first()["features"] == [2.0, 1.0]
    with pytest.raises(Exception, match="null in feature column b"):
        features.assemble(rows, ["a", "b"]).collect()
