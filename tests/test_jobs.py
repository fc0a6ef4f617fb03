"""The command-line jobs on small CSV files written here."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import jobs
from tablewright.operators import joins
from tablewright.session import materialize, scratch_path, shared_folder, spread
from tablewright.sources import (
    CENSUS,
    HEART,
    quarantine,
    read_metrics,
    read_results,
    scan_csv_header,
    scan_csv_headerless,
    write_bucketed,
    write_metrics,
)


def write(path, header, rows):
    lines = ([",".join(header)] if header else []) + [",".join(map(str, r)) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_risk_job(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(400):
        row = [round(float(rng.normal(50, 9)), 1) if c in HEART.fractional else int(rng.integers(0, 3)) for c in HEART.columns]
        row[-1] = int(row[0] + 8 * row[2] + rng.normal(0, 6) > 58)
        rows.append(row)
    path = write(tmp_path / "heart.csv", HEART.columns, rows)
    out = str(tmp_path / "out")
    shown = jobs.run_risk(spark, path, out)
    assert shown.columns == [*HEART.report, "target", "prediction", "risk"]
    assert shown.count() == 20
    assert read_results(spark, f"{out}/metrics", "metrics").count() == 4
    names = {r["feature"] for r in read_results(spark, f"{out}/coefficients", "coefficients").collect()}
    assert names == {*HEART.features, "intercept"}
    assert read_results(spark, f"{out}/confusion", "confusion").count() >= 2


def test_command_line_runs_a_job(spark, tmp_path, capsys):
    rng = np.random.default_rng(6)
    rows = [[int(v) for v in rng.integers(0, 3, 13)] + [int(rng.integers(0, 2))] for _ in range(150)]
    # Columns in another order than usual, found by name.
    path = write(tmp_path / "heart.csv", HEART.columns[::-1], [r[::-1] for r in rows])
    jobs.main(["risk", path, "--out", str(tmp_path / "out")])
    assert "risk" in capsys.readouterr().out
    assert (tmp_path / "out" / "coefficients" / "_SUCCESS").exists()


def census_rows(rng, n, dot):
    rows = []
    for _ in range(n):
        age, years, hours = int(rng.integers(18, 70)), int(rng.integers(1, 17)), int(rng.integers(10, 60))
        work = str(rng.choice(["Private", "State-gov", "?"]))
        rich = age + 3 * years + hours / 2 + rng.normal(0, 5) > 95
        label = (">50K" if rich else "<=50K") + dot
        rows.append(
            [age, f" {work}", " 1", " HS", f" {years}", " Never", f" job{rng.integers(0, 4)}", " Own",
             " White", " Male", " 0", " 0", f" {hours}", " US", f" {label}"]
        )
    return rows


@pytest.fixture(scope="module")
def census(tmp_path_factory):
    folder = tmp_path_factory.mktemp("census")
    rng = np.random.default_rng(9)
    assert len(CENSUS.columns) == 15
    train = write(folder / "train.csv", None, census_rows(rng, 600, ""))
    test = write(folder / "test.csv", None, [["|1x3 Cross validator"], *census_rows(rng, 300, ".")])
    return train, test


def test_income_logreg_job(spark, tmp_path, census):
    top = jobs.run_income_logreg(spark, *census, str(tmp_path / "out"))
    assert top.count() <= 15
    metrics = read_results(spark, f"{tmp_path}/out/metrics", "metrics").collect()
    values = {r["metric"]: r["value"] for r in metrics}
    assert values["areaUnderROC"] > 0.8


def test_income_trees_job(spark, tmp_path, census):
    shown = jobs.run_income_trees(spark, *census, str(tmp_path / "out")).collect()
    assert {r["model"] for r in shown} == {"RF", "DT"} and len(shown) == 10


def test_comments_job(spark, tmp_path):
    labels = "toxic,severe_toxic,obscene,threat,insult,identity_hate"
    train = tmp_path / "train.csv"
    lines = [f"id,comment_text,{labels}"]
    for i in range(60):
        bad = i % 3 == 0
        text = '"you are ""bad""\nreally"' if bad else '"a nice, friendly word"'
        lines.append(f"a{i},{text}," + ",".join(str(int(bad and (i + k) % 2 == 0)) for k in range(6)))
    lines.append("broken,text,x,0,0,0,0,0")
    train.write_text("\n".join(lines) + "\n")
    test = tmp_path / "test.csv"
    test.write_text('id,comment_text\nt1,"bad\nreally"\nt2,""""\nt3,friendly\n')
    jobs.run_comments(spark, str(train), str(test), str(tmp_path / "out"))
    written = spark.read.parquet(f"{tmp_path}/out/predictions")
    assert sorted(r["id"] for r in written.collect()) == ["t1", "t3"]
    assert len(written.columns) == 1 + 2 * 6


def test_command_line_needs_a_known_job():
    with pytest.raises(SystemExit):
        jobs.main(["unknown"])


def test_materialize_round_trip(spark):
    rows = spark.range(10).selectExpr("id", "array(id) as a")
    table = materialize(rows, "round")
    assert sorted(table.collect()) == sorted(rows.collect())
    assert scratch_path(spark, "x").startswith(shared_folder(spark))


def test_spread_only_when_needed(spark):
    one = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert spread(one, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=40)
    assert spread(many, "id") is many


def test_compare_job(spark, tmp_path, census):
    jobs.run_income_logreg(spark, *census, str(tmp_path / "lr"))
    jobs.run_income_trees(spark, *census, str(tmp_path / "trees"))
    table = jobs.run_compare(spark, f"{tmp_path}/lr/metrics", f"{tmp_path}/trees/metrics", str(tmp_path / "out")).collect()
    assert len(table) == 5
    for row in table:
        values = {m: row[m] for m in ("DT", "LR", "RF")}
        assert values[row["best"]] == max(values.values())
    assert (tmp_path / "out" / "comparison" / "_SUCCESS").exists()


def test_profile_jobs(spark, tmp_path, census):
    shown = jobs.run_profile_income(spark, *census, str(tmp_path / "income")).collect()
    assert 500 < sum(r["n"] for r in shown) < 900 and abs(sum(r["share"] for r in shown) - 1) < 1e-9
    rng = np.random.default_rng(5)
    rows = [[int(v) for v in rng.integers(0, 9, 13)] + [int(rng.integers(0, 2))] for _ in range(80)]
    path = write(tmp_path / "heart.csv", HEART.columns, rows)
    assert jobs.run_profile_risk(spark, path, str(tmp_path / "risk")).count() == 13
    text = "id,comment_text,toxic,insult\n" + "".join(f'{i},"some text {i}\nmore",{i % 2},{i % 3 % 2}\n' for i in range(30))
    (tmp_path / "comments.csv").write_text(text)
    counts = jobs.run_profile_comments(spark, str(tmp_path / "comments.csv"), str(tmp_path / "comments")).collect()
    assert {r["label"]: r["positives"] for r in counts} == {"toxic": 15, "insult": 10}
    for job, name in (("income", "rate_sex"), ("risk", "histogram_age"), ("comments", "text_length_by_class")):
        assert (tmp_path / job / name / "_SUCCESS").exists()


def test_cross_validation_leaves_no_feature_tables(spark):
    from tablewright.operators import train
    from tablewright.operators.features import table_stages

    rows = spark.range(300).selectExpr("cast(id % 7 as double) a", "cast(id % 2 as double) label", "cast(id % 3 as int) fold")
    estimator = train.logreg("label", maxIter=3)
    found = train.cross_validate(materialize(rows, "rows"), table_stages([], ["a"]), estimator, train.param_grid(estimator))
    assert found.count() == 9
    import os

    folder = scratch_path(spark, "x").rsplit("/", 1)[0]
    assert not [n for n in os.listdir(folder) if n.startswith(("fold-", "feature-table-"))]


def test_compare_job_reads_saved_layouts(spark, tmp_path):
    """One run in a file of its own and two in another, with the names that such files have for their metrics."""
    (tmp_path / "one.csv").write_text("metric,value\nAccuracy,0.8\nRecall,0.8\nPrecision,0.7\nF1 Score,0.75\nROC-AUC,0.9\n")
    lines = [f"{c},{m},{v}" for c, v in (("RF", 0.78), ("DT", 0.81)) for m in ("Accuracy", "Weightedprecision", "Weightedrecall", "F1", "Roc_auc")]
    (tmp_path / "two.csv").write_text("classifier,metric,value\n" + "\n".join(lines) + "\n")
    table = jobs.run_compare(spark, f"LR={tmp_path}/one.csv", f"{tmp_path}/two.csv", str(tmp_path / "out")).collect()
    assert {r["metric"]: (r["LR"], r["RF"], r["DT"], r["best"]) for r in table} == {
        "accuracy": (0.8, 0.78, 0.81, "DT"),
        "weightedPrecision": (0.7, 0.78, 0.81, "DT"),
        "weightedRecall": (0.8, 0.78, 0.81, "DT"),
        "f1": (0.75, 0.78, 0.81, "DT"),
        "areaUnderROC": (0.9, 0.78, 0.81, "LR"),
    }
    (tmp_path / "odd.csv").write_text("metric,value\nLuck,1.0\n")
    with pytest.raises(Exception, match="unknown metric Luck"):
        read_metrics(spark, str(tmp_path / "odd.csv")).collect()


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "metrics")
    good = spark.createDataFrame([("LR", "f1", 0.5)], "model string, metric string, value double")
    write_metrics(good, path)
    failing = spark.range(0, 8, 1, 4).select(
        F.lit("LR").alias("model"), F.lit("f1").alias("metric"),
        F.when(F.col("id") < 6, 1.0).otherwise(F.raise_error(F.lit("lost midway")).cast("double")).alias("value"),
    )
    with pytest.raises(Exception, match="lost midway"):
        write_metrics(failing, path)
    assert read_results(spark, path, "metrics").collect() == good.collect()
    assert [p.name for p in tmp_path.iterdir()] == ["metrics"]
    # A driver that is lost between both renames leaves the old table aside; the next reader brings it back.
    (tmp_path / "metrics").rename(tmp_path / "_old-metrics")
    assert read_results(spark, path, "metrics").collect() == good.collect()
    write_metrics(good.withColumn("value", F.lit(0.75)), path)
    assert [r["value"] for r in read_results(spark, path, "metrics").collect()] == [0.75]
    assert [p.name for p in tmp_path.iterdir()] == ["metrics"]


def test_bad_lines_are_quarantined(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("age,chol\n60,300\nold,200\n61\n62,5,7\n,\n")
    (folder / "b.csv").write_text("age,chol\n63,310\n64,x1\n")
    schema = "age double, chol double"
    scanned = scan_csv_header(spark, str(folder), T._parse_datatype_string(schema), bad_lines=True)
    good, counts = quarantine(scanned, str(tmp_path / "bad"))
    assert sorted(map(tuple, good.collect()), key=str) == [(60.0, 300.0), (63.0, 310.0), (None, None)]
    assert {r["file"].rsplit("/", 1)[1]: (r["lines"], r["bad_lines"]) for r in counts.collect()} == {"a.csv": (5, 3), "b.csv": (2, 1)}
    bad = {(r["file"].rsplit("/", 1)[1], r["line"]) for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad == {("a.csv", "old,200"), ("a.csv", "61"), ("a.csv", "62,5,7"), ("b.csv", "64,x1")}
    assert scan_csv_header(spark, str(folder), T._parse_datatype_string(schema)).columns == ["age", "chol"]
    (tmp_path / "plain.csv").write_text("1, a\n2, b, c\n3\n")
    plain = scan_csv_headerless(spark, str(tmp_path / "plain.csv"), ["n", "s"], bad_lines=True)
    good, counts = quarantine(plain, str(tmp_path / "bad2"))
    assert [tuple(r) for r in good.collect()] == [("1", "a")] and counts.first()["bad_lines"] == 2


def test_saved_scores_join_without_a_shuffle(spark, tmp_path):
    ids = spark.range(500).selectExpr("cast(id as bigint) as row", "id % 7 as part")
    tables = []
    for i in range(6):
        scored = ids.select("row", (F.col("row") / (i + 2)).alias(f"proba_{i}")).filter(F.col("row") % 11 != i)
        scored = scored.unionByName(spark.createDataFrame([(None, 0.5)], f"row long, proba_{i} double"))
        tables.append(f"saved_scores_{i}")
        write_bucketed(scored, tables[-1], "row", 8, str(tmp_path / str(i)))
    try:
        wide = joins.fan_in_saved(spark, tables, "row")
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan and "Broadcast" not in plan
        rows = {r.row: r for r in wide.collect()}
        assert set(rows) == {r for r in range(500) if r % 11 > 5}
        assert all(r[f"proba_{i}"] == r.row / (i + 2) for r in rows.values() for i in range(6))
        assert all(len(list((tmp_path / str(i)).glob("*.parquet"))) <= 8 for i in range(6))
        with pytest.raises(Exception, match="already exists"):
            write_bucketed(spark.table(tables[0]), tables[0], "row", 8, str(tmp_path / "again"))
    finally:
        for name in tables:
            spark.sql(f"drop table if exists {name}")
