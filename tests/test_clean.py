import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import hash_bucket, strip_dots, tokens
from tablewright.operators import clean
from tablewright.plans import income
from tablewright.sources import CENSUS, scan_csv_header, scan_csv_headerless, scan_csv_text
from tablewright.sources.layouts import COMMENTS


def values(df, *columns):
    return [tuple(r[c] for c in columns or df.columns) for r in df.collect()]


def test_quoted_text_csv(spark, tmp_path):
    path = tmp_path / "text.csv"
    path.write_text(
        'id,comment_text,toxic,severe_toxic,obscene,threat,insult,identity_hate\n'
        '1,"line one\nline two, with comma",1,0,0,0,0,0\n'
        '2,"say ""hi"" now, ok",0,0,0,0,0,0\n'
        '3,"""",1,0,0,0,0,0\n'
        "4,plain,0,0,0,0,0,0\n"
    )
    rows = scan_csv_text(spark, str(path))
    assert values(rows, "id", "comment_text", "toxic") == [
        ("1", "line one\nline two, with comma", "1"),
        ("2", 'say "hi" now, ok', "0"),
        ("3", '"', "1"),
        ("4", "plain", "0"),
    ]
    kept = clean.filter_not_equal(rows, "comment_text", COMMENTS.junk_text)
    assert values(kept, "id") == [("1",), ("2",), ("4",)]


CENSUS_TRAIN = """\
39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family, White, Male, 2174, 0, 40, United-States, <=50K
50, ?, 83311, Bachelors, 13, Married-civ-spouse, Exec-managerial, Husband, White, Male, 0, 0, 13, United-States, >50K
"""
CENSUS_TEST = """\
|1x3 Cross validator
25, Private, 226802, 11th, 7, Never-married, Machine-op-inspct, Own-child, Black, Male, 0, 0, 40, United-States, <=50K.
44, Private, 160323, Some-college, 10, Married-civ-spouse, Machine-op-inspct, Husband, Black, Male, 7688, 0, 40, United-States, >50K.
38, Private, 89814, HS-grad, 9, Married-civ-spouse, Farming-fishing, Husband, White, Male, 0, 0, 50, United-States, rich
"""


def census_files(tmp_path):
    train, test = tmp_path / "train.csv", tmp_path / "test.csv"
    train.write_text(CENSUS_TRAIN)
    test.write_text(CENSUS_TEST)
    return str(train), str(test)


def test_clean_census(spark, tmp_path):
    files = [scan_csv_headerless(spark, p, CENSUS.columns) for p in census_files(tmp_path)]
    rows = income.clean_census(*files)
    assert rows.columns == [c for c in CENSUS.columns if c not in CENSUS.unused]
    assert values(rows, "age", "workClass", "educationNum", "hoursPerWeek", "Labels") == [
        (39.0, "State-gov", 13.0, 40.0, 0),
        (25.0, "Private", 7.0, 40.0, 0),
        (44.0, "Private", 10.0, 40.0, 1),
        (38.0, "Private", 9.0, 50.0, None),
    ]


def test_non_numeric_rows_go(spark, tmp_path):
    _, test = census_files(tmp_path)
    rows = scan_csv_headerless(spark, test, CENSUS.columns)
    assert values(clean.filter_non_numeric_rows(rows, "age"), "age") == [("25",), ("44",), ("38",)]


def test_header_columns_match_by_name(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("b,extra,a\n2.5,x,1\noops,y,2\n")
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in ("a", "b")])
    rows = scan_csv_header(spark, str(path), schema)
    assert values(rows, "a", "b", "extra") == [(1.0, 2.5, "x"), (2.0, None, "y")]
    with pytest.raises(ValueError, match="no columns"):
        scan_csv_header(spark, str(path), T.StructType([T.StructField("c", T.DoubleType())]))


def test_cast_is_tolerant(spark):
    rows = spark.createDataFrame([("1", "x"), ("2.5", "3")], "a string, b string")
    cast = clean.cast_columns(rows, {"float": ["a"], "int": ["b"]})
    assert values(cast) == [(1.0, None), (2.5, 3)]
    assert dict(cast.dtypes) == {"a": "float", "b": "int"}
    with pytest.raises(ValueError, match="no such"):
        clean.cast_columns(rows, {"int": ["c"]})


def test_trim_keeps_types(spark):
    rows = spark.createDataFrame([(" a ", 1)], "s string, n int")
    assert clean.trim_all(rows).dtypes == rows.dtypes
    assert values(clean.trim_all(rows)) == [("a", 1)]


def test_null_rules(spark):
    rows = spark.createDataFrame([("?", 1), ("x", None), (None, 2), ("y", 3)], "s string, n int")
    marked = clean.null_tokens(rows)
    assert values(marked, "s") == [(None,), ("x",), (None,), ("y",)]
    assert values(clean.drop_any_null(marked)) == [("y", 3)]
    assert values(clean.drop_null_subset(marked, ["n"]), "n") == [(1,), (2,), (3,)]
    assert values(clean.filter_not_equal(rows, "s", "x"), "s") == [("?",), ("y",)]


def test_binary_label(spark):
    rows = spark.createDataFrame(
        [(v,) for v in ("<=50K", "<=50K.", ">50K", ">50K.", "1", "other", None)], "l string"
    )
    encoded = clean.encode_binary_label(rows, "l", CENSUS.negative, CENSUS.positive)
    assert values(encoded) == [(0,), (0,), (1,), (1,), (1,), (None,), (None,)]


def test_strip_dots(spark):
    rows = spark.createDataFrame([(" >50K.. ",), ("a.b.",)], "l string")
    assert values(rows.select(strip_dots("l").alias("l"))) == [(">50K",), ("a.b",)]


def test_tokens(spark):
    texts = [" Hello  World hello ", "", "   ", "a  ", None, "a\tb\nc"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert values(rows.select("i", tokens("t").alias("w")).orderBy("i"), "w") == [
        (["", "hello", "", "world", "hello"],),
        ([""],),
        ([],),
        (["a"],),
        (None,),
        (["a", "b", "c"],),
    ]


def test_tokens_equal_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(-1, ""), (-2, "  "), (-3, " x "), (-4, "a\x0bb\r\n"), (-5, "ÀÉ ß")], rows.schema
    )
    both = Tokenizer(inputCol="text", outputCol="w").transform(rows.union(odd))
    assert both.filter(F.col("w") != tokens("text")).count() == 0


def test_stable_id_and_bucket(spark):
    rows = spark.createDataFrame([("123", 1), ("123", 2)], "a string, b int")
    assert values(rows.select(hash_bucket("a", salt="").alias("x")).distinct()) != []
    ids = clean.surrogate_id(rows, ["a", "b"])
    assert ids.select("uid").distinct().count() == 2
    again = clean.surrogate_id(rows.repartition(7), ["a", "b"])
    assert sorted(values(ids)) == sorted(values(again))
