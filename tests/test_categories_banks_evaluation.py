"""Sparse one-hot rows of wide columns, option banks from files, all models in one scan."""

import pytest
from pyspark.sql import functions as F

from wellscore.operators import models as md
from wellscore.operators import survey as sv
from wellscore.operators.categories import category_table, sparse_one_hot
from wellscore.session import scratch_path
from wellscore.spec import TARGET_COL


def test_hundred_thousand_categories(spark):
    df = spark.range(120_000).select("id", F.concat(F.lit("v"), F.col("id") % 100_000).alias("wide"), F.when(F.col("id") % 3 != 0, "hot").alias("few"))
    rows = sparse_one_hot(df, "id", ["wide", "few"])
    stats = rows.agg(F.count("*"), F.max("size"), F.sum(F.size("indices")), F.count_distinct(F.get("indices", F.lit(0)))).first()
    # the least value of each column has no number: v0 and the only value of `few`
    assert tuple(stats) == (120_000, 99_999, 120_000 - 2, 99_999)


def test_category_numbers_nulls_and_unknown_values(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", "x"), (3, None, None), (4, "c", "y")], "id int, p string, q string")
    table = category_table(df, ["p", "q"], drop_first=False)
    assert sorted(map(tuple, table.collect())) == [("p", "a", 0), ("p", "b", 1), ("p", "c", 2), ("q", "x", 3), ("q", "y", 4)]
    got = {r["id"]: r["indices"] for r in sparse_one_hot(df.withColumn("q", F.lit("zzz")), "id", ["p", "q"], table).collect()}
    assert got == {1: [1], 2: [0], 3: [], 4: [2]}
    assert sparse_one_hot(df.limit(0), "id", ["p"]).count() == 0


def test_bank_file_round_trip_and_issues(spark):
    bank = sv.option_bank(spark)
    path = scratch_path(spark, "t-bank")
    sv.write_bank(bank, path)
    assert sorted(map(tuple, sv.read_bank(spark, path).collect()), key=str) == sorted(map(tuple, bank.collect()), key=str)
    assert sv.load_bank(spark, path, banks=["A", "B"]).count() == bank.where("bank IN ('A', 'B')").count()
    with pytest.raises(ValueError, match="D/mental_fatigue: extra; E/sleep_quality: missing"):
        sv.load_bank(spark, path)
    a = bank.where("bank = 'A'")
    broken = a.where("NOT (feature = 'headache' AND opt_idx > 1)").withColumn("value", F.when(F.col("feature") == "bullying", F.lit(99)).otherwise(F.col("value")))
    broken = broken.withColumn("label", F.when(F.col("feature") == "safety", F.lit(" ")).otherwise(F.col("label")))
    issues = {(r["feature"], r["issue"]) for r in sv.bank_issues(broken).collect()}
    assert {("headache", "too_few_options"), ("bullying", "out_of_range"), ("bullying", "not_low"), ("safety", "empty_label")} <= issues
    with pytest.raises(ValueError, match="no questions"):
        sv.load_bank(spark, path, banks=["none"])


def test_all_models_read_the_test_part_once(spark):
    df = spark.range(300).selectExpr("id AS respondent_id", "id % 13 AS a", "id % 5 AS b", f"(id % 13) * 2.0D + (id % 5) AS {TARGET_COL}")
    path = scratch_path(spark, "t-part")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    small = md.ModelConfig(rf_trees=3, rf_depth=4)
    models = {"linear": md.fit_linear(df, ["a", "b"]), "half": md.fit_linear(df, ["a"]), "forest": md.make_pipeline(["a", "b"], md.estimators(small)["RandomForest"]).fit(df)}
    got = {r["model"]: r for r in md.evaluate(models, df).collect()}
    assert list(sorted(got)) == ["forest", "half", "linear"] and got["linear"]["r2"] == 1.0
    for name, m in models.items():
        one = md.regression_metrics(m.transform(df)).first()
        assert [got[name][c] for c in ("mae", "rmse", "r2")] == [one[c] for c in ("mae", "rmse", "r2")]
    plan = md.evaluate(models, df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 1
